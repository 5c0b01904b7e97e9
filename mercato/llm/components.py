"""Connected components of a link table, by alternating large-star and
small-star steps (groupBy-min and joins; no vertex's neighbours are gathered).

Every step pre-aggregates on the map side, and its joins are ordinary shuffle
joins whose hot keys AQE can split; each round is written to the shared
checkpoint folder, so the lineage stays short and a lost executor costs one
round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import written


def _minimum(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _round(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (both.join(_minimum(both), "u").where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.explode(F.array(
        F.struct(F.col("u"), F.col("m").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
    return small.where("u <> v").distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex that is not the smallest of its component;
    ``edges`` has the columns u and v (self-links are ignored)."""
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u <> v").distinct(), "links")
    state = _state(e)
    while state[0]:
        e = written(_round(e), "links")
        now = _state(e)
        if now == state:
            break
        state = now
    return e.withColumnRenamed("v", "root")
