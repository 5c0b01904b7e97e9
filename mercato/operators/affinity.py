"""Market-basket affinity.

Two exact ways count how many orders hold both items of a pair.

* **Vertical**, while there are at most ``BITMAP_ITEMS`` items (brands, categories,
  or what a support threshold leaves): orders are numbered within hash buckets,
  each item gets a bitmap of order numbers for each bucket, and a pair's count is
  the size of two bitmaps' intersection.  No pair is expanded per order, so a
  basket of 10,000 lines is 10,000 bits.
* **Horizontal** otherwise: a self equi-join on the order id (never a nested loop
  or a cross join), counted with partial aggregation.  Baskets of more than
  ``hot_threshold`` lines are salted: left rows are spread over sub-keys and right
  rows replicated once per sub-key.  The pairs of a basket grow with the square of
  its size, so the number of sub-keys does: no task makes more than about
  ``hot_threshold`` squared pairs of one order.

Inputs that need more partitions than the session has are dealt into theirs by
order, and the pairs by pair (``parts``).

Which way, and which baskets are hot, is decided while the plan runs, by scalar
subqueries (a count of items; a frequent-items sketch of the orders): the rows
of the way not taken are dropped at their scan, and no job runs while the plan
is built.  Apriori pruning removes items below the support threshold first.
Lines without an order or an item are in no basket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import ratio
from mercato.operators.facts import order_item_ids
from mercato.operators.parts import partitions, spread
from mercato.operators.windows import hot_counts

HOT_BASKET = 10_000
SALT_BUCKETS = 16
#: Items up to which pairs are counted by bitmaps.
BITMAP_ITEMS = 256
#: Orders a bucket (its bitmaps have 32,768 bits), and buckets at least.
BUCKET_ORDERS = 30_000
BUCKETS = 32
BITS = 32_768


def _total_orders(orders: DataFrame) -> Column:
    return orders.agg(F.count(F.lit(1)).alias("n")).scalar()


def _self_join(items: DataFrame, cond) -> DataFrame:
    """items(order_id, item, k) -> (order_id, a, b) for pairs with cond(l, r)."""
    left = items.select("order_id", F.col("item").alias("a"), F.col("k").alias("ka"))
    right = items.select("order_id", F.col("item").alias("b"), F.col("k").alias("kb"))
    return left.join(right, "order_id").filter(cond(F.col("ka"), F.col("kb"))).select("order_id", "a", "b")


def _salted_join(items: DataFrame, cond, hot_threshold: int, salt_buckets: int) -> DataFrame:
    """The same for hot orders; ``_hot`` is an order's estimated size."""
    salts = F.greatest(F.ceil(F.pow(F.col("_hot") / F.lit(max(1, hot_threshold)), 2)), F.lit(salt_buckets)).cast("long")
    left = items.select("order_id", F.col("item").alias("a"), F.col("k").alias("ka"),
                        F.pmod(F.xxhash64("item", "k"), salts).alias("_salt"))
    right = items.select("order_id", F.col("item").alias("b"), F.col("k").alias("kb"),
                         F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt"))
    return left.join(right, ["order_id", "_salt"]).filter(cond(F.col("ka"), F.col("kb"))).select("order_id", "a", "b")


def _split_hot(lines: DataFrame, hot_threshold: int | None) -> tuple[DataFrame, DataFrame | None]:
    """The lines of ordinary orders, and those of orders with more than
    ``hot_threshold`` lines (usually none) with their size ``_hot``."""
    if hot_threshold is None:
        return lines, None
    sized = lines.withColumn("_sizes", hot_counts(lines, ["order_id"], hot_threshold)).withColumn(
        "_hot", F.expr("_sizes[xxhash64(order_id)]")).drop("_sizes")
    return sized.where("_hot IS NULL").drop("_hot"), sized.where("_hot IS NOT NULL")


def _pairs(items: DataFrame, cond, hot_threshold: int | None, salt_buckets: int = SALT_BUCKETS, n: int | None = None) -> DataFrame:
    """items(order_id, item, k) -> (order_id, a, b) for pairs with cond(l, r)."""
    plain, hot = _split_hot(items, hot_threshold)
    out = _self_join(spread(plain, n, "order_id"), cond)
    return out if hot is None else out.unionByName(_salted_join(hot, cond, hot_threshold, salt_buckets))


def _lines(order_items: DataFrame, item_col: str) -> DataFrame:
    return order_items.select("order_id", F.col(item_col).alias("item")).where("order_id IS NOT NULL AND item IS NOT NULL")


def positional_pairs(order_items: DataFrame, item_col: str = "product_id", hot_threshold: int | None = HOT_BASKET,
                     salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Positional semantics: every (items[i], items[j]) with i < j in line
    order; direction-sensitive, keeps self-pairs and repeats.  The position is
    a line's number in its order, so identical lines pair as well."""
    items = order_item_ids(order_items).select("order_id", F.col(item_col).alias("item"), F.col("line_position").alias("k"))
    return _pairs(items, lambda l, r: l < r, hot_threshold, salt_buckets, partitions(order_items))


def _distinct_items(lines: DataFrame, hot_threshold: int | None) -> tuple[DataFrame, DataFrame | None]:
    """lines(order_id, item) without repeats: those of ordinary orders, in
    partitions by order, and those of hot orders with ``_hot``."""
    plain, hot = _split_hot(lines, hot_threshold)
    n = partitions(lines)
    items = (plain.repartition("order_id") if n is None else spread(plain, n, "order_id")).dropDuplicates(["order_id", "item"])
    return items, None if hot is None else hot.groupBy("order_id", "item").agg(F.first("_hot").alias("_hot"))


def _below(items: DataFrame, hot: DataFrame | None, hot_threshold: int | None, salt_buckets: int) -> DataFrame:
    below = lambda l, r: l < r
    out = _self_join(items.withColumn("k", F.col("item")), below)
    return out if hot is None else out.unionByName(
        _salted_join(hot.withColumn("k", F.col("item")), below, hot_threshold, salt_buckets))


def canonical_pairs(order_items: DataFrame, item_col: str = "product_id", hot_threshold: int | None = HOT_BASKET,
                    salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Distinct items per order, unordered pairs with a < b.

    One shuffle of the ordinary lines on the order id serves the dedup (its keys
    include the order id) and both sides of the self-join.  Hot orders' lines are
    deduplicated on (order, item), combined map-side, before their salted join."""
    return _below(*_distinct_items(_lines(order_items, item_col), hot_threshold), hot_threshold, salt_buckets)


def _counted(pairs: DataFrame, n: int | None) -> DataFrame:
    """(product_a, product_b, co_occurrence_count)"""
    return spread(pairs.select(F.col("a").alias("product_a"), F.col("b").alias("product_b")), n, "product_a", "product_b") \
        .groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias("co_occurrence_count"))


def pair_counts(pairs: DataFrame, orders: DataFrame, n: int | None = None) -> DataFrame:
    """co_occurrence_count per (a, b) and support over all orders (those
    without items included)."""
    c = _counted(pairs, n)
    return c.withColumn("support", F.col("co_occurrence_count").cast("double") / _total_orders(orders))


def affinity_positional(order_items: DataFrame, orders: DataFrame, **kw) -> DataFrame:
    return pair_counts(positional_pairs(order_items, **kw), orders, partitions(order_items))


def product_affinity(order_items: DataFrame, orders: DataFrame, item_col: str = "product_id", **kw) -> DataFrame:
    return pair_counts(canonical_pairs(order_items, item_col, **kw), orders, partitions(order_items))


def _vertical(lines: DataFrame, total: Column) -> DataFrame:
    """(product_a, product_b, co_occurrence_count, n_a, n_b) by bitmaps.

    A line's order gets its number within the bucket from a dense rank, so one
    shuffle of the lines on the bucket serves the numbering and the bitmaps
    (a bucket's repeats of an order and item set the same bit)."""
    buckets = F.greatest(F.ceil(total / BUCKET_ORDERS), F.lit(BUCKETS)).cast("long")
    numbered = lines.select("item", "order_id", F.pmod(F.xxhash64("order_id"), buckets).alias("bucket")).selectExpr(
        "bucket", "item", "dense_rank() OVER (PARTITION BY bucket ORDER BY order_id) - 1 AS at")
    held = numbered.groupBy("bucket", F.expr(f"at DIV {BITS} AS part"), "item").agg(
        F.expr(f"bitmap_construct_agg(at % {BITS})").alias("orders"))
    counts = held.groupBy("item").agg(F.sum(F.expr("bitmap_count(orders)")).alias("n"))
    a = held.withColumnsRenamed({"item": "product_a", "orders": "_a"})
    b = held.withColumnsRenamed({"item": "product_b", "orders": "_b"})
    both = a.join(b, ["bucket", "part"]).where("product_a < product_b").select(
        "bucket", "part", "product_a", "product_b", F.explode(F.array("_a", "_b")).alias("orders"))
    shared = both.groupBy("bucket", "part", "product_a", "product_b").agg(F.expr("bitmap_count(bitmap_and_agg(orders))").alias("n"))
    pairs = shared.groupBy("product_a", "product_b").agg(F.sum("n").alias("co_occurrence_count")).where("co_occurrence_count > 0")
    return _with_counts(pairs, counts)


def _with_counts(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    na = counts.select(F.col("item").alias("product_a"), F.col("n").alias("n_a"))
    nb = counts.select(F.col("item").alias("product_b"), F.col("n").alias("n_b"))
    return pairs.join(na, "product_a").join(nb, "product_b")


def _horizontal(lines: DataFrame, hot_threshold: int | None, salt_buckets: int) -> DataFrame:
    """The same by a self-join on the order.  Of large inputs the pairs, which
    outnumber the items by far, pass by hash tables of the items' counts and are
    not sorted."""
    n = partitions(lines)
    items, hot = _distinct_items(lines, hot_threshold)
    pairs = _counted(_below(items, hot, hot_threshold, salt_buckets), n)
    held = items.select("item") if hot is None else items.select("item").unionByName(hot.select("item"))
    counts = held.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return _with_counts(pairs, counts if n is None else counts.hint("shuffle_hash"))


def pair_table(order_items: DataFrame, orders: DataFrame, item_col: str = "product_id", min_support: float | None = None,
               bitmap_items: int = BITMAP_ITEMS, hot_threshold: int | None = HOT_BASKET,
               salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Canonical pairs with support, confidence(a->b) = n_ab/n_a, lift, n_a and
    n_b.  With ``min_support``, items below it are removed first: an item's lines
    are at least its orders, so lines decide, and those left are at most (lines an
    order / min_support) items, a proven bound for their broadcast."""
    lines = _lines(order_items, item_col)
    total = _total_orders(orders)
    items = lines.groupBy("item").agg(F.count(F.lit(1)).alias("lines"))
    if min_support is not None:
        items = items.where(F.col("lines").cast("double") / total >= F.lit(min_support))
        lines = lines.join(F.broadcast(items.select("item")), "item", "left_semi").select("order_id", "item")
    few = items.limit(bitmap_items + 1).agg(F.count(F.lit(1)).alias("n")).scalar() <= bitmap_items
    pairs = _vertical(lines.where(few), total).unionByName(_horizontal(lines.where(~few), hot_threshold, salt_buckets))
    support = F.col("co_occurrence_count").cast("double") / total
    out = pairs.select(
        "product_a", "product_b", "co_occurrence_count", support.alias("support"),
        ratio("co_occurrence_count", "n_a").alias("confidence"),
        (F.col("co_occurrence_count").cast("double") * total / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
        "n_a", "n_b")
    return out if min_support is None else out.where(F.col("support") >= F.lit(min_support))


def affinity_lift(order_items: DataFrame, orders: DataFrame, item_col: str = "product_id", **kw) -> DataFrame:
    """Canonical pairs with confidence and lift."""
    return pair_table(order_items, orders, item_col, **kw).drop("n_a", "n_b")


def affinity_top(order_items: DataFrame, orders: DataFrame, item_col: str = "product_id",
                 min_support: float = 0.01, limit: int | None = 20, min_confidence: float | None = None,
                 min_lift: float | None = None, **kw) -> DataFrame:
    """Pairs above thresholds, most frequent first."""
    out = pair_table(order_items, orders, item_col, min_support, **kw).drop("n_a", "n_b")
    if min_confidence is not None:
        out = out.filter(F.col("confidence") >= F.lit(min_confidence))
    if min_lift is not None:
        out = out.filter(F.col("lift") >= F.lit(min_lift))
    out = out.orderBy(F.col("co_occurrence_count").desc(), "product_a", "product_b")
    return out.limit(limit) if limit else out


def cross_sell(order_items: DataFrame, orders: DataFrame, item_col: str = "product_id", k: int = 3,
               **kw) -> DataFrame:
    """Best ``k`` companions per item by lift (both directions).  The
    ``row_number() <= k`` filter is planned with a partial per-partition
    group limit before the shuffle, so a popular item sends at most k rows
    per partition."""
    from pyspark.sql import Window

    m = pair_table(order_items, orders, item_col, **kw)
    # both directions from ONE pass over the pair table (no self-union)
    fields = ["co_occurrence_count", "support", "lift"]
    fwd = F.struct(F.col("product_a").alias("product_id"), F.col("product_b").alias("recommended_product_id"),
                   *fields, F.col("confidence"))
    bwd = F.struct(F.col("product_b").alias("product_id"), F.col("product_a").alias("recommended_product_id"),
                   *fields, ratio("co_occurrence_count", "n_b").alias("confidence"))
    both = m.select(F.inline(F.array(fwd, bwd)))
    w = Window.partitionBy("product_id").orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                                                 "recommended_product_id")
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
