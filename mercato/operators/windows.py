"""Per-key ordered windows that survive hot keys.

``Window.partitionBy(key)`` sends every row of a key to one task; one key
holding a third of the data would make one task sort a third of the data.

The helpers here cut *hot* keys, those with more than ``hot_threshold`` rows,
into slices of about equal row counts, in three steps that are part of the plan
(no job runs while it is built):

1. a frequent-items sketch (``approx_top_k``: bounded, merged, no shuffle by key)
   gives the hot keys; it cannot miss a key with more than one in ``HOT_KEYS`` of
   the rows, and at most ``HOT_KEYS`` keys have as many;
2. for those keys, quantiles of the order column (``percentile_approx``) cut their
   rows into ``SLICES`` ranges;
3. windows run on (key, slice), and a slice-level table (at most
   ``HOT_KEYS * SLICES`` rows, hence broadcast) carries the state from slice to
   slice, like the second pass of a parallel prefix scan.

Keys below the threshold are one slice.  Which keys are cut, and where, decides
the work of a task only, never a result; rows of equal order value stay together.
A caller can give the slices itself (``bucket``, monotone in the order), and
``hot_threshold=None`` then cuts every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.expressions import col_
from mercato.operators.parts import partitions, spread
from mercato.operators.selection import below

HOT_KEY_ROWS = 1_000_000
HOT_KEYS = 1000
SLICES = 512
ACCURACY = 20_000


def hot_counts(df: DataFrame, keys: Sequence[str], threshold: int) -> Column:
    """A scalar subquery: the hashes of the keys with more than ``threshold``
    rows, as a map to their (estimated) counts.  A hash shared by chance costs
    slices, nothing else."""
    return df.select(F.xxhash64(*keys).alias("k")).selectExpr(
        f"map_from_entries(filter(approx_top_k(k, {HOT_KEYS}, {16 * HOT_KEYS}), x -> x.count > {int(threshold)})) AS k").scalar()


def with_slices(df: DataFrame, keys: Sequence[str], value: Column, hot_threshold: int | None,
                bucket: Column | None = None, sketched: DataFrame | None = None) -> DataFrame:
    """Add ``_b``, the slice of each row of a hot key, null for other keys'
    rows.  ``value`` is a number that the window order starts with.  The sketches
    read ``sketched`` (default: all of ``df``), rows with the same keys and value."""
    if hot_threshold is None:
        return df.withColumn("_b", value if bucket is None else bucket)
    of = df if sketched is None else sketched
    hot_keys = F.map_keys(hot_counts(of, keys, hot_threshold)).alias("_hot")
    d = df.select("*", F.xxhash64(*keys).alias("_slice_k"), value.alias("_slice_v"), hot_keys)
    hot = F.array_contains("_hot", F.col("_slice_k"))
    if bucket is not None:
        return d.select(*df.columns, F.when(hot, bucket).alias("_b"))
    grid = ", ".join(f"{i / SLICES}D" for i in range(1, SLICES))
    rows = of.select(F.xxhash64(*keys).alias("_slice_k"), value.alias("_slice_v"), hot_keys)
    cuts = (rows.where(hot).groupBy("_slice_k").agg(F.expr(f"percentile_approx(_slice_v, array({grid}), {ACCURACY})").alias("c"))
            .selectExpr("map_from_entries(collect_list(struct(_slice_k, c))) AS m").scalar())
    d = d.select("*", cuts.alias("_slice_cuts"))
    at = below("_slice_cuts[_slice_k]", SLICES - 1, "_slice_v")
    return d.selectExpr(*[f"`{c}`" for c in df.columns], f"IF(array_contains(_hot, _slice_k), {at}, NULL) AS _b")


def with_carry(d: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a slice-level table (one row a slice of a hot key) on key, which
    may be null, and slice."""
    names = [*keys, "_b"]
    c = F.broadcast(carry.withColumnsRenamed({k: f"_c{i}" for i, k in enumerate(names)}))
    same = " AND ".join(f"`{k}` <=> _c{i}" for i, k in enumerate(keys))
    return d.join(c, F.expr(f"{same} AND _b = _c{len(keys)}"), "left").drop(*[f"_c{i}" for i in range(len(names))])


def previous_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                      payload: dict, hot_threshold: int | None = HOT_KEY_ROWS, bucket: Column | None = None) -> DataFrame:
    """Add ``prev_<name>`` for each payload column: its value on the previous
    row of the same key in ``order`` (null on the key's first row).

    ``order`` must be a total order within the key; ``value`` a number monotone
    in it (see ``with_slices``).
    """
    keys, order = list(keys), list(order)
    names = list(payload)
    s = F.struct(*[col_(payload[n]).alias(n) for n in names])
    at = F.struct(*[col_(o).alias(f"_o{i}") for i, o in enumerate(order)])
    d0 = with_slices(df, keys, value, hot_threshold, bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*[col_(o) for o in order])
    d = d0.withColumn("_prev_in", F.lag(s).over(w))
    # last row of every hot (key, slice), then of the slice before
    last = d0.where("_b IS NOT NULL").groupBy(*keys, "_b").agg(F.max_by(s, at).alias("_last"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    d = with_carry(d, last.select(*keys, "_b", F.lag("_last").over(wb).alias("_carry")), keys)
    prev = F.coalesce(F.col("_prev_in"), F.col("_carry"))
    return d.select(*df.columns, *[prev.getField(n).alias(f"prev_{n}") for n in names])


def running_max_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                         of: str, out: str, hot_threshold: int | None = HOT_KEY_ROWS, bucket: Column | None = None) -> DataFrame:
    """``max(of) over (partition by key order by order rows unbounded
    preceding)`` with slice carry-over for hot keys."""
    keys, order = list(keys), list(order)
    d0 = with_slices(df, keys, value, hot_threshold, bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*[col_(o) for o in order]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d0.withColumn("_run_in", F.max(of).over(w))
    per_slice = d0.where("_b IS NOT NULL").groupBy(*keys, "_b").agg(F.max(of).alias("_bmax"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    d = with_carry(d, per_slice.select(*keys, "_b", F.max("_bmax").over(wb).alias("_carry")), keys)
    return d.select(*df.columns, F.greatest("_run_in", "_carry").alias(out))


def row_number_in_group(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column,
                        out: str, hot_threshold: int | None = HOT_KEY_ROWS, bucket: Column | None = None) -> DataFrame:
    """``row_number() over (partition by key order by order)``; hot keys add
    the row count of their earlier slices (prefix sum on slice-level rows)."""
    keys = list(keys)
    d0 = with_slices(df, keys, value, hot_threshold, bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*[col_(o) for o in order])
    d = spread(d0, partitions(df), *keys, "_b").withColumn("_rn_in", F.row_number().over(w))
    sizes = d0.where("_b IS NOT NULL").groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    d = with_carry(d, sizes.select(*keys, "_b", F.sum("_bn").over(wb).alias("_off")), keys)
    return d.select(*df.columns, (F.col("_rn_in") + F.coalesce(F.col("_off"), F.lit(0))).cast("long").alias(out))
