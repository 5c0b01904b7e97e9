"""Global ordering operators that stay distributed.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.
These helpers give the same answers with a range-partitioned layout:

* ``with_global_position``: 0-based position of each row in a total order.
  Range-partition on the order keys, sort inside partitions, checkpoint the
  layout (so both passes see it), count rows per partition (one number per
  partition reaches the driver) and add the partition offset.
* ``distributed_ntile``: SQL ``NTILE(n)`` from the positions.
* ``quantile_edges`` / ``quantile_score``: exact linear-interpolated quantiles
  (``quantile_cont`` / numpy "linear") from at most two rows per quantile.
* ``top_k``: ``orderBy().limit()`` (TakeOrderedAndProject: per-partition
  top-k then merge, never a full sort).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import col_
from mercato.session import materialize

_POS = "_gpos"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def with_global_position(df: DataFrame, order: Sequence, num_partitions: int | None = None,
                         pos_col: str = _POS) -> tuple[DataFrame, int]:
    """Return (df + 0-based ``pos_col``, total row count).

    ``order`` must be a total order (include a unique tie-break) so the
    result is deterministic and recomputation after executor loss is exact.
    """
    order_cols = [col_(c) for c in order]
    n_parts = _num_partitions(df, num_partitions)
    laid = (df.repartitionByRange(n_parts, *order_cols)
            .sortWithinPartitions(*order_cols)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))
    laid = materialize(laid)
    counts = {r["_pid"]: r["n"] for r in laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, acc = [], 0
    for pid in range(max(counts.keys(), default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(pid, 0)
    total = acc
    if not offsets:
        return laid.withColumn(pos_col, F.lit(None).cast("long")).drop("_pid", "_mid"), 0
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_pid") + 1)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return laid.withColumn(pos_col, offset + local).drop("_pid", "_mid"), total


def ntile_expr(pos: Column, total: int, n: int) -> Column:
    """NTILE(n) bucket for 0-based position ``pos`` among ``total`` rows:
    the first ``total % n`` buckets hold one extra row."""
    rn = pos + 1
    if total <= 0:
        return F.lit(None).cast("int")
    q, r = divmod(total, n)
    if q == 0:
        return rn.cast("int")
    cut = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = F.lit(r) + F.floor((rn - cut - 1) / q) + 1
    return F.when(rn <= cut, first).otherwise(rest).cast("int")


def distributed_ntile(df: DataFrame, n: int, order: Sequence, out_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY order...)`` without a single-partition window."""
    positioned, total = with_global_position(df, order, num_partitions)
    return positioned.withColumn(out_col, ntile_expr(F.col(_POS), total, n)).drop(_POS)


def quantile_edges(df: DataFrame, column: str, probs: Sequence[float],
                   tiebreak: Sequence = (), num_partitions: int | None = None) -> list[float]:
    """Exact linear-interpolated quantiles of ``column`` (nulls ignored).

    Only the rows at positions floor/ceil((n-1)*p) are read back: at most
    2*len(probs) values reach the driver, whatever the data size.
    """
    vals = df.select(F.col(column).cast("double").alias("_v"), *[col_(t) for t in tiebreak]) \
        .filter(F.col("_v").isNotNull())
    positioned, total = with_global_position(vals, ["_v", *tiebreak], num_partitions)
    if total == 0:
        return [None] * len(probs)
    need = {}
    for p in probs:
        h = (total - 1) * float(p)
        lo, hi = math.floor(h), math.ceil(h)
        need[p] = (h, lo, hi)
    wanted = sorted({i for (_, lo, hi) in need.values() for i in (lo, hi)})
    got = {r[_POS]: r["_v"] for r in positioned.filter(F.col(_POS).isin(wanted)).select(_POS, "_v").collect()}
    edges = []
    for p in probs:
        h, lo, hi = need[p]
        a, b = got[lo], got[hi]
        edges.append(a + (b - a) * (h - lo))
    return edges


def quantile_edges_histogram(df: DataFrame, column, probs: Sequence[float]):
    """Exact quantiles for columns with bounded cardinality (days since the
    last order, order counts): one aggregation to (column, value, count),
    cumulative counts over that histogram, and only the values at the needed
    positions reach the driver.  The ordered window runs on the histogram -
    one row per distinct value - not on the data.  ``column`` may be a list:
    all histograms are built in the same pass (returns {column: edges})."""
    from pyspark.sql import Window

    cols = [column] if isinstance(column, str) else list(column)
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (_col, _v)").filter(F.col("_v").isNotNull())
    h = long.groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_col").orderBy("_v")
    h = h.select("_col", "_v", "_c", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
                 F.sum("_c").over(Window.partitionBy("_col")).alias("_n"))
    h = h.withColumn("_start", F.col("_cum") - F.col("_c"))
    # positions floor/ceil((n-1)p) for every p, computed in Spark from _n
    cond = None
    for p in probs:
        hpos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        for pos in (F.floor(hpos), F.ceil(hpos)):
            c = (F.col("_start") <= pos) & (pos < F.col("_cum"))
            cond = c if cond is None else cond | c
    got = h.filter(cond).select("_col", "_v", "_start", "_cum", "_n").collect()
    out = {}
    for c in cols:
        rows_c = [r for r in got if r["_col"] == c]
        if not rows_c:
            out[c] = [None] * len(probs)
            continue
        total = rows_c[0]["_n"]

        def value_at(i, rows_c=rows_c):
            for r in rows_c:
                if r["_start"] <= i < r["_cum"]:
                    return r["_v"]
            raise AssertionError(i)

        edges = []
        for p in probs:
            hp = (total - 1) * float(p)
            lo, hi = math.floor(hp), math.ceil(hp)
            a, b = value_at(lo), value_at(hi)
            edges.append(a + (b - a) * (hp - lo))
        out[c] = edges
    return out[column] if isinstance(column, str) else out


def quantile_bin(value, edges: Sequence[float], labels: Sequence[int]) -> Column:
    """Right-closed bins, lowest edge included: label of the first edge i>=1
    with value <= edges[i] (collapsed edges leave empty bins)."""
    v = col_(value).cast("double")
    expr = None
    for i in range(1, len(edges)):
        cond = v <= F.lit(float(edges[i]))
        expr = F.when(cond, F.lit(labels[i - 1])) if expr is None else expr.when(cond, F.lit(labels[i - 1]))
    return expr.otherwise(F.lit(None)).cast("int")


def quantile_score(df: DataFrame, column: str, out_col: str, bins: int = 5,
                   descending_labels: bool = False, strict: bool = False,
                   tiebreak: Sequence = (), bounded_cardinality: bool = False,
                   edges: Sequence[float] | None = None) -> DataFrame:
    """Quantile bin labels.  ``bounded_cardinality`` selects the histogram
    method (one job); otherwise global positions (range partitioning).
    Precomputed ``edges`` skip both."""
    probs = [i / bins for i in range(bins + 1)]
    if edges is None:
        if bounded_cardinality:
            edges = quantile_edges_histogram(df, column, probs)
        else:
            edges = quantile_edges(df, column, probs, tiebreak)
    if edges[0] is None:
        return df.withColumn(out_col, F.lit(None).cast("int"))
    if strict and len(set(edges)) != len(edges):
        raise ValueError(f"quantile edges of {column} collapse: {edges}")
    labels = list(range(bins, 0, -1)) if descending_labels else list(range(1, bins + 1))
    return df.withColumn(out_col, quantile_bin(column, edges, labels))


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """Top-k with a total order (TakeOrderedAndProject)."""
    return df.orderBy(*[col_(c) for c in order]).limit(k)
