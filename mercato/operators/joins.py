"""Joins with a side that is usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a dimension or an aggregate.  Nothing is hinted, counted or cached:
    Spark broadcasts a side by its bytes, the file sizes at planning or what its
    shuffle wrote at run time, and splits skewed partitions otherwise."""
    return big.join(small, on, how)
