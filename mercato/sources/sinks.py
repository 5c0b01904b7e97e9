"""Sinks: full refresh, incremental with high-water mark and look-back,
snapshot diff (change capture), clustered layout, exports (I09-I16, X06).

Paths live under the cluster's shared checkpoint folder unless given.
Every write is idempotent: overwrite (whole table or dynamic partitions),
never blind append.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.selection import below
from mercato.session import scratch_path

#: Days before the high-water mark that an incremental run computes again.
LOOKBACK_DAYS = 2


def materialize_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Full refresh (``materialized='table'``): overwrite, then serve reads
    from the written table (lineage cut, survives executor loss)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def table_exists(spark, path: str) -> bool:
    """Whether a table has been written (asked of the file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def partition_days(spark, path: str, column: str) -> list[dt.date]:
    """Days of a table that is partitioned by a date: a listing of folders,
    no file is read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    days = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted(dt.date.fromisoformat(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__")


def first_open_day(spark, path: str, date_col: str, lookback_days: int) -> dt.date | None:
    """First day that the next run computes again; None: all of them."""
    days = partition_days(spark, path, date_col) if table_exists(spark, path) else []
    return days[-1] - dt.timedelta(days=lookback_days - 1) if days else None


def incremental_by_date(source, path: str, date_col: str, lookback_days: int = LOOKBACK_DAYS, spark=None) -> DataFrame:
    """Incremental model keyed by day.

    First run: everything.  Later runs: days after the high-water mark (the
    last partition, from a listing) minus ``lookback_days``, so that rows which
    arrive late for a loaded day are counted; 0 is the strict ``> max`` filter,
    which loses them.  ``source`` is a frame, or a function of the first day
    to compute (None: all) that returns one: the function pushes the bound
    into its scans, so a run reads the open days only.  Days are written with
    dynamic partition overwrite, so a re-run replaces whole days and never
    duplicates them."""
    spark = spark or source.sparkSession
    since = first_open_day(spark, path, date_col, lookback_days)
    df = source(since) if callable(source) else source
    if since is not None:
        df = df.filter(F.col(date_col) >= F.lit(since))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return spark.read.parquet(path)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Change capture between two snapshots of a table: one full outer join
    on the key; rows tagged INSERT / UPDATE / DELETE (unchanged rows drop)."""
    o = old.select(F.col(key).alias("_ok"), *[F.col(c).alias(f"o_{c}") for c in compare])
    n = new.select(F.col(key).alias("_nk"), *[F.col(c).alias(f"n_{c}") for c in compare])
    j = o.join(n, F.col("_ok") == F.col("_nk"), "full_outer")
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    action = (F.when(F.col("_ok").isNull(), "INSERT").when(F.col("_nk").isNull(), "DELETE")
              .when(~same, "UPDATE"))
    out = j.select(F.coalesce("_nk", "_ok").alias(key), action.alias("change_type"),
                   *[F.when(F.col("_nk").isNotNull(), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c)
                     for c in compare])
    return out.filter(F.col("change_type").isNotNull())


def clustered_write(df: DataFrame, path: str, cluster_by: Sequence[str], partition_by: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Clustered layout: range-partition on the clustering keys and sort
    within files, so Parquet row-group min/max statistics skip data for
    range predicates on those keys; optional directory partitioning (files are
    sorted by it first: that is the order the partitioned writer asks for, so
    it leaves the rows as they are)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    laid = df.repartitionByRange(n, *cluster_by).sortWithinPartitions(*([partition_by] if partition_by else []), *cluster_by)
    w = laid.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Bits of each key's rank in the space-filling curve.
CURVE_BITS = 8


def curve_write(df: DataFrame, path: str, keys: Sequence[Column], num_partitions: int | None = None, options: dict | None = None) -> DataFrame:
    """Layout by several keys at once: rows are ordered along a space-filling
    curve (the interleaved bits of the keys' ranks), so that a file or row group
    covers a narrow range of *every* key and Parquet statistics skip data for a
    predicate on any of them, where a sort serves its first key alone.

    A rank is the number of sketched quantiles (``percentile_approx``, a scalar
    subquery) below the key: ranks have equal counts whatever the keys'
    distribution, and their accuracy decides file bounds only.  ``keys`` are
    numeric columns; one shuffle."""
    ranks = 1 << CURVE_BITS
    grid = ", ".join(f"{i / ranks}D" for i in range(1, ranks))
    keyed = df.select("*", *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    cuts = keyed.selectExpr("named_struct(" + ", ".join(
        f"'c{i}', percentile_approx(_k{i}, array({grid}), 10000)" for i in range(len(keys))) + ") AS c").scalar()
    ranked = keyed.select("*", cuts.alias("_cuts")).selectExpr("*", *[
        f"COALESCE({below(f'_cuts.c{i}', ranks - 1, f'_k{i}')}, 0) AS _r{i}" for i in range(len(keys))])
    curve = " + ".join(f"shiftleft(CAST(shiftright(_r{i}, {b}) & 1 AS BIGINT), {b * len(keys) + i})"
                       for i in range(len(keys)) for b in range(CURVE_BITS))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    laid = ranked.selectExpr(*[f"`{c}`" for c in df.columns], f"{curve} AS _curve_at").repartitionByRange(n, "_curve_at").sortWithinPartitions("_curve_at")
    laid.drop("_curve_at").write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export(df: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Result export (csv with header, json or parquet); returns the re-read
    export so callers can verify it."""
    spark = df.sparkSession
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
        return spark.read.option("header", True).schema(df.schema).csv(path)
    if fmt == "json":
        w.json(path)
        return spark.read.schema(df.schema).json(path)
    w.parquet(path)
    return spark.read.parquet(path)
