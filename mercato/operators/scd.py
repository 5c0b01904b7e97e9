"""Slowly changing dimensions, type 2.

``scd2_build`` makes the dimension of a whole history of snapshots in one
pass.  ``scd2_merge`` applies one new snapshot: no MERGE on Parquet, it is
compared with the open versions by a full outer join on the natural key, and
each joined row emits its old version (kept or closed) and, when needed, its
new one.  Validity is half-open
``[effective_date, expiry_date)``; an open version has a null expiry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.expressions import surrogate_key
from mercato.operators.selection import shared
from mercato.operators.windows import HOT_KEY_ROWS, with_carry, with_slices

META = ["effective_date", "expiry_date", "is_current"]


def scd2_initial(snapshot: DataFrame, effective_date: str) -> DataFrame:
    return snapshot.select("*", F.lit(effective_date).cast("date").alias("effective_date"),
                           F.lit(None).cast("date").alias("expiry_date"), F.lit(True).alias("is_current"))


def scd2_merge(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str],
               snapshot_date: str, close_missing: bool = False) -> DataFrame:
    """Apply one snapshot to a type-2 dimension.

    * key in both, attributes equal -> open version kept
    * key in both, attributes differ -> open version closed at the snapshot
      date, new open version from the snapshot
    * key only in the snapshot -> new open version
    * key only in the dimension -> stays open (closed if ``close_missing``)
    """
    cols = [key, *tracked]
    sd = F.lit(snapshot_date).cast("date")
    closed = dim.filter(~F.col("is_current"))
    cur = dim.filter(F.col("is_current")).select(*[F.col(c).alias(f"o_{c}") for c in cols + ["effective_date"]])
    new = snapshot.select(*[F.col(c).alias(f"n_{c}") for c in cols])
    j = cur.join(new, F.col(f"o_{key}") == F.col(f"n_{key}"), "full_outer")
    in_old, in_new = F.col(f"o_{key}").isNotNull(), F.col(f"n_{key}").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    changed = in_old & in_new & ~same
    close = changed | (in_old & ~in_new & F.lit(bool(close_missing)))
    old_v = F.when(in_old, F.struct(*[F.col(f"o_{c}").alias(c) for c in cols],
                                    F.col("o_effective_date").alias("effective_date"),
                                    F.when(close, sd).cast("date").alias("expiry_date"),
                                    (~close).alias("is_current")))
    new_v = F.when(in_new & (~in_old | changed),
                   F.struct(*[F.col(f"n_{c}").alias(c) for c in cols], sd.alias("effective_date"),
                            F.lit(None).cast("date").alias("expiry_date"), F.lit(True).alias("is_current")))
    versions = j.select(F.explode(F.filter(F.array(old_v, new_v), lambda x: x.isNotNull())).alias("v")) \
        .select("v.*")
    return closed.select(*cols, *META).unionByName(versions)


def scd2_build(snapshots: Sequence[tuple[str, DataFrame]], key: str, tracked: Sequence[str],
               close_missing: bool = False) -> DataFrame:
    """Type-2 dimension of dated snapshots (oldest first)."""
    rows = None
    for d, s in snapshots:
        part = s.select(key, *tracked, F.lit(d).cast("date").alias("snapshot_date"))
        rows = part if rows is None else rows.unionByName(part)
    return scd2_from_rows(rows, key, tracked, [d for d, _ in snapshots], close_missing)


def scd2_from_rows(rows: DataFrame, key: str, tracked: Sequence[str], dates: Sequence[str],
                   close_missing: bool = False) -> DataFrame:
    """Type-2 dimension of all snapshots in one pass: ``rows`` has a row for
    each key and ``snapshot_date`` (one of ``dates``) that knows it.  Each row
    is compared with the key's row before it; a window holds one row a
    snapshot.  The plan has one shuffle on the key however many snapshots
    there are.  A key missing from a snapshot stays open unless
    ``close_missing``."""
    held = F.array(*[F.lit(d).cast("date") for d in dates])
    r = rows.select(key, F.struct(*tracked).alias("_a"), F.array_position(held, F.col("snapshot_date")).alias("_i"))
    w = Window.partitionBy(key).orderBy("_i")
    before, seen = F.lag("_a").over(w), F.lag("_i").over(w)
    starts = seen.isNull() | ~before.eqNullSafe(F.col("_a"))
    if close_missing:
        starts = starts | (F.col("_i") - seen > 1)
    r = r.withColumn("_s", starts.cast("int")).withColumn("_v", F.sum("_s").over(w))
    v = r.groupBy(key, "_v").agg(F.min_by("_a", "_i").alias("_a"), F.min("_i").alias("_from"), F.max("_i").alias("_to"))
    end = F.lead("_from").over(Window.partitionBy(key).orderBy("_v"))
    if close_missing:  # the next change, or the first snapshot without the key
        end = F.least(end, F.when(F.col("_to") < len(dates), F.col("_to") + 1))
    v = v.withColumn("_end", end)
    return v.select(key, "_a.*", F.element_at(held, F.col("_from").cast("int")).alias("effective_date"),
                    F.when(F.col("_end").isNotNull(), F.element_at(held, F.col("_end").cast("int"))).alias("expiry_date"),
                    F.col("_end").isNull().alias("is_current"))


def with_version_key(dim: DataFrame, key: str, out: str) -> DataFrame:
    """The surrogate key of each version: natural key and effective date."""
    return dim.withColumn(out, surrogate_key(key, "effective_date"))


def scd2_lookup(facts: DataFrame, dim: DataFrame, key: str, ts: str, attrs: Sequence[str],
                how: str = "left") -> DataFrame:
    """Point-in-time lookup: the version valid at each fact's timestamp
    (equi-join on the key plus a range condition; at most one match).  A fact is
    compared with every version of its key: right for a few versions each."""
    d = dim.select(F.col(key).alias("_k"), *attrs, "effective_date", "expiry_date")
    t = F.col(ts).cast("date")
    cond = (F.col(key) == F.col("_k")) & (t >= F.col("effective_date")) \
        & (F.col("expiry_date").isNull() | (t < F.col("expiry_date")))
    return facts.join(d, cond, how).drop("_k", "expiry_date")


def scd2_sweep(facts: DataFrame, dim: DataFrame, key: str, ts: str, attrs: Sequence[str],
               how: str = "left", hot_threshold: int | None = HOT_KEY_ROWS) -> DataFrame:
    """The same as ``scd2_lookup``, as a sweep, for keys with many versions.

    Facts and versions go through one sorted stream a key, and each fact takes
    the last version before it: one shuffle, however many versions a key has,
    and no range condition in a join.  A hot key's stream is cut into slices of
    equal counts, to which the last version of the slices before is carried."""
    shown = [*attrs, "effective_date"]
    version = F.struct(*shown, "expiry_date")
    f = facts.select(F.col(key).alias("_key"), F.col(ts).cast("date").alias("_t"), F.lit(1).alias("_fact"), F.struct("*").alias("_f"))
    v = dim.select(F.col(key).alias("_key"), F.col("effective_date").alias("_t"), F.lit(0).alias("_fact"), version.alias("_version"))
    both = f.unionByName(shared(v), allowMissingColumns=True)
    value = F.date_diff("_t", F.lit("1970-01-01").cast("date"))
    d0 = with_slices(both, ["_key"], value, hot_threshold, sketched=f.select("_key", "_t"))
    w = Window.partitionBy("_key", "_b").orderBy("_t", "_fact").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d0.withColumn("_last", F.last("_version", ignorenulls=True).over(w))
    ends = d0.where("_b IS NOT NULL").groupBy("_key", "_b").agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_t"))).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    d = with_carry(d.where("_fact = 1"), ends.select("_key", "_b", F.last("_end", ignorenulls=True).over(before).alias("_carry")), ["_key"])
    d = d.withColumn("_at", F.coalesce("_last", "_carry"))
    d = d.withColumn("_at", F.when(F.col("_key").isNotNull() & F.col("_t").isNotNull()
                                   & (F.col("_at.expiry_date").isNull() | (F.col("_t") < F.col("_at.expiry_date"))), F.col("_at")))
    if how == "inner":
        d = d.where("_at IS NOT NULL")
    return d.select("_f.*", *[F.col(f"_at.{c}").alias(c) for c in shown])


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))
