"""Shuffles of pairs and product days get partitions by the size of their
input, whatever the session has, and the same rows."""

import datetime as dt
from decimal import Decimal

import pytest

from mercato.operators import affinity, metrics, parts


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    lines = [(o, (o * 7 + k * k) % 23, 1 + k, (k, (o * 7 + k * k) % 23)) for o in range(60) for k in range(1 + o % 6)]
    lines += [(1, 7, 2, (0, 7)), (None, 3, 1, (0, 3)), (2, None, 1, (9, 0))]
    items = spark.createDataFrame(lines, "order_id long, product_id long, quantity int, line_sort struct<ln:int,pk:long>")
    items = items.selectExpr("*", "CAST(quantity * 3 AS DECIMAL(18,2)) AS line_total", "CAST(quantity AS DECIMAL(18,2)) AS profit")
    orders = spark.createDataFrame([(o, dt.datetime(2024, 1, 1 + o % 4)) for o in range(60)], "order_id long, order_date timestamp_ntz")
    at = tmp_path_factory.mktemp("parts")
    items.write.parquet(f"{at}/items")  # files have a size, rows of a local list have none
    orders.write.parquet(f"{at}/orders")
    return spark.read.parquet(f"{at}/items"), spark.read.parquet(f"{at}/orders")


QUERIES = {
    "positional": lambda i, o: affinity.affinity_positional(i, o),
    "canonical": lambda i, o: affinity.product_affinity(i, o),
    "canonical_hot": lambda i, o: affinity.product_affinity(i, o, hot_threshold=5, salt_buckets=2),
    "lift": lambda i, o: affinity.affinity_lift(i, o, bitmap_items=3),
    "lift_hot": lambda i, o: affinity.affinity_lift(i, o, bitmap_items=3, hot_threshold=5, salt_buckets=2),
    "days": lambda i, o: metrics.product_days(i, o),
}


@pytest.mark.parametrize("name", QUERIES)
def test_partitions_grow_with_the_input(spark, tables, monkeypatch, name):
    items, orders = tables
    want = rows(QUERIES[name](items, orders))
    assert want and parts.partitions(items, orders) is None
    monkeypatch.setattr(parts, "PART_BYTES", parts.input_bytes(items) // 37)
    n = parts.partitions(items)
    assert n > 8
    dealt = QUERIES[name](items, orders)
    assert rows(dealt) == want
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    keys = "product_id" if name == "days" else "product_a"
    n = parts.partitions(items, orders) if name == "days" else n
    assert any("REPARTITION_BY_NUM" in x and f", {n})" in x and keys in x for x in plan.split("\n"))


def test_days_are_not_merged_where_the_session_has_more_partitions(spark, tables, monkeypatch):
    """Merged by compressed bytes at run time, a task would hold all its lines."""
    items, orders = tables
    want = rows(metrics.product_days(items, orders))
    monkeypatch.setattr(parts, "PART_BYTES", parts.input_bytes(items, orders) // 5)
    had = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        n = 4 * -(-parts.input_bytes(items, orders) // parts.PART_BYTES)
        dealt = metrics.product_days(items, orders)
        dealt.collect()
        assert rows(dealt) == want
        plan = dealt._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)
    assert 8 < n < 64 and parts.partitions(items, orders) is None
    at = [i for i, x in enumerate(plan) if "Exchange hashpartitioning(order_id" in x]
    assert at and all(f", {n})" in plan[i] and "AQEShuffleRead" not in plan[i - 1] + plan[i - 2] for i in at)


def test_days_by_hand(spark, tables):
    items, orders = tables
    got = {r[:2]: r[2:] for r in rows(metrics.product_days(items, orders).where("product_id = 7 AND metric_date = DATE'2024-01-02'"),
                                      "product_id", "metric_date", "purchases", "quantity_sold", "revenue")}
    want = [(o, q) for o, p, q in items.select("order_id", "product_id", "quantity").collect() if p == 7 and o is not None and o % 4 == 1]
    assert got == {(7, dt.date(2024, 1, 2)): (len({o for o, _ in want}), sum(q for _, q in want), Decimal(3 * sum(q for _, q in want)))}
