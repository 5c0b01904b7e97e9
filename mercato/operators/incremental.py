"""Aggregates kept up to date from changes.

A change is two signed rows: what a key was (-1) and what it is now (+1); an
insert has only the latter, a delete only the former.  Sums and counts of
signed rows are added to stored ones, so a run reads the changes and the
stored groups that they touch, never the table that the aggregate is of.
Distinct counts are kept as one stored row a value with its number of
occurrences: a value leaves the count when its last occurrence does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.sessions import fact_customer_behavior, session_behavior, sessionize
from mercato.session import materialize
from mercato.sources.sinks import table_exists
from mercato.streaming.ingest import days_filter, days_of, overwrite_partitions


def signed_changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, *columns, _sign) of the rows that differ between two snapshots: one
    full outer join on the key."""
    was = old.select(F.col(key).alias("_ok"), F.struct(*columns).alias("_was"))
    now = new.select(F.col(key).alias("_nk"), F.struct(*columns).alias("_now"))
    j = was.join(now, F.col("_ok") == F.col("_nk"), "full_outer").where(
        "_ok IS NULL OR _nk IS NULL OR NOT (_was <=> _now)")
    before = F.when(F.col("_ok").isNotNull(), F.struct(F.col("_ok").alias(key), F.col("_was").alias("_r"), F.lit(-1).alias("_sign")))
    after = F.when(F.col("_nk").isNotNull(), F.struct(F.col("_nk").alias(key), F.col("_now").alias("_r"), F.lit(1).alias("_sign")))
    return j.select(F.explode(F.filter(F.array(before, after), lambda x: x.isNotNull())).alias("c")).select(
        f"c.{key}", "c._r.*", "c._sign")


def delta(changes: DataFrame, keys: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """Signed count (``rows``) and sums of changes by ``keys``."""
    return changes.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.sum("_sign").cast("long").alias("rows"), *[F.sum(c * F.col("_sign")).alias(k) for k, c in sums.items()])


def merge_delta(path: str, day: str, keys: Sequence[str], changed: DataFrame) -> DataFrame:
    """Add a delta (see ``delta``; ``keys`` hold ``day``) to the aggregate stored at
    ``path``, which is partitioned by ``day`` (a day, or the month of days): only
    the partitions of the delta are read and written.  Groups without a row left
    are removed."""
    spark = changed.sparkSession
    changed = materialize(changed)
    days = days_of(changed, day)
    if days:
        rows = changed
        if table_exists(spark, path):
            rows = spark.read.schema(changed.schema).parquet(path).where(days_filter(day, days)).unionByName(changed)
        values = [f for f in changed.schema.fields if f.name not in keys]
        merged = rows.groupBy(*keys).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in values]).where("rows <> 0")
        overwrite_partitions(path, day, days, materialize(merged.select(*changed.columns)))
    return spark.read.schema(changed.schema).parquet(path)


def distinct_by_day(occurrences: DataFrame, day: str, value: str, out: str) -> DataFrame:
    """Distinct values a day, of a stored (day, value, rows) table."""
    return occurrences.groupBy(day).agg(F.sum("rows").alias("rows"), F.count(value).alias(out))


def funnel_delta(old_events: DataFrame, new_events: DataFrame, gap_seconds: int) -> DataFrame:
    """The delta of the daily funnel counts: a change of an event can change its
    user's sessions, so the sessions of the users with changes are cut before
    and after, and those that differ are signed."""
    changes = signed_changes(old_events, new_events, "event_id", [c for c in new_events.columns if c != "event_id"])
    users = materialize(changes.select("customer_id").where("customer_id IS NOT NULL").distinct())

    def facts(events: DataFrame) -> DataFrame:
        mine = events.join(users, "customer_id", "left_semi").select(*events.columns)
        return fact_customer_behavior(session_behavior(sessionize(mine, gap_seconds)))

    flags = ["session_date", "total_product_views", "total_add_to_cart", "checkout_started", "purchase_completed"]
    signed = signed_changes(facts(old_events), facts(new_events), "session_id", flags)
    stages = [F.lit(1), (F.col("total_product_views") > 0).cast("int"), (F.col("total_add_to_cart") > 0).cast("int"),
              F.col("checkout_started").cast("int"), F.col("purchase_completed").cast("int")]
    return delta(signed, {"funnel_date": F.col("session_date")}, {f"n{i}": s for i, s in enumerate(stages)})

