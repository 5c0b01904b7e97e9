"""Numbers of partitions that grow with the input.

A session's number of shuffle partitions is fixed, so what a task holds of a
shuffle grows with the tables.  Steps that hold much a row (pairs of a basket,
days of a product) are dealt into as many partitions as their input files ask for
where the session has fewer.  Rows that are dealt by an explicit number are not
combined before their shuffle, so keys should have few rows for a task: a pair has
a row an order at most, a product's day as many as the day has orders."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input files that make one more partition.
PART_BYTES = 16 << 20


def input_bytes(*frames: DataFrame) -> int:
    """Bytes of the files (or local rows) that frames read, columns not read
    included; no job runs.  Sources of unknown size count nothing."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        total += sum(s for s in sizes if s < 1 << 53)
    return total


def partitions(*frames: DataFrame) -> int | None:
    """Partitions for a shuffle of what is made of ``frames``, where their files
    ask for more than the session has; else none."""
    n = -(-input_bytes(*frames) // PART_BYTES)
    return n if n > int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def unmerged(*frames: DataFrame) -> int | None:
    """Partitions for a shuffle whose tasks hold hundreds of bytes a row: as
    ``partitions``, but a number also where the session has more than the files ask
    for.  Spark merges the session's own partitions at run time by their compressed
    bytes (64 MB by default, millions of such rows in a task), numbered ones never.
    Up to the session's number, a partition is a quarter of ``PART_BYTES``."""
    n = -(-input_bytes(*frames) // PART_BYTES)
    session = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, min(4 * n, session)) if n > 1 else None


def spread(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """``df`` in ``n`` partitions by its keys, as a shuffle that the grouping,
    window or join by these keys then needs not make; as it is without ``n``."""
    return df if n is None else df.repartition(n, *keys)
