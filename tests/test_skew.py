"""The skew-safe helpers give exactly what the plain single-key windows give
(brute force on small data, with slices small enough to split every key)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, rows
from mercato.operators import ranking, sessions, windows
from mercato.sources import tables as T


def _events(spark, n=400, users=3, seed=7):
    rnd = random.Random(seed)
    data, t = [], 1_700_000_000_000_000
    for i in range(n):
        t += rnd.choice([1, 10, 600, 3600, 7 * 3600]) * 1_000_000
        data.append((i, rnd.randrange(users), t))
    df = spark.createDataFrame(data, "event_id long, customer_id long, us long")
    return df.select("event_id", "customer_id",
                     F.timestamp_micros("us").cast("timestamp_ntz").alias("event_timestamp"))


def _brute_sessions(df, gap):
    w = Window.partitionBy("customer_id").orderBy("event_timestamp", "event_id")
    us = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    d = df.withColumn("_us", us).withColumn("_p", F.lag("_us").over(w))
    d = d.withColumn("_s", F.when(F.col("_p").isNull() | (F.col("_us") - F.col("_p") >= gap * 1_000_000), F.col("_us")))
    d = d.withColumn("_m", F.max("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.select("event_id", F.concat(F.col("customer_id").cast("string"), F.lit("-"),
                                         F.col("_m").cast("string")).alias("session_id"))


def test_sessionize_hot_user_slices_match_brute_force(spark):
    ev = _events(spark)
    expect = rows(_brute_sessions(ev, 6 * 3600))
    for bucket, hot in ((60, None), (3600, None), (86400 * 30, None), (3600, 100), (3600, 10**6)):
        got = rows(sessions.sessionize(ev, 6 * 3600, bucket_seconds=bucket, hot_threshold=hot)
                   .select("event_id", "session_id"))
        assert got == expect


def test_previous_in_group_matches_lag(spark):
    ev = _events(spark, users=3)
    b = F.floor(F.unix_seconds(F.col("event_timestamp").cast("timestamp")) / 1800)
    w = Window.partitionBy("customer_id").orderBy("event_timestamp", "event_id")
    expect = rows(ev.select("event_id", F.lag("event_timestamp").over(w).alias("p"), F.lag("event_id").over(w).alias("q")))
    for hot in (None, 120, 10**6):
        got = windows.previous_in_group(ev, ["customer_id"], ["event_timestamp", "event_id"], b,
                                        {"p": F.col("event_timestamp"), "q": F.col("event_id")}, hot)
        assert rows(got.select("event_id", F.col("prev_p").alias("p"), F.col("prev_q").alias("q"))) == expect
        fast = windows.previous_in_group(ev, ["customer_id"], ["event_timestamp", "event_id"], b,
                                         {"p": "event_timestamp"}, hot)
        assert rows(fast.select("event_id", "prev_p")) == [(a, p) for a, p, _ in expect]


def test_row_number_and_running_max_in_group(spark):
    ev = _events(spark, users=3)
    b = F.floor(F.col("event_id") / 37)
    w = Window.partitionBy("customer_id").orderBy("event_id")
    expect = rows(ev.select("event_id", F.row_number().over(w).alias("rn")))
    expect_m = rows(ev.select("event_id", F.max("event_timestamp").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m")))
    for hot in (None, 120, 10**6):
        got = windows.row_number_in_group(ev, ["customer_id"], ["event_id"], b, "rn", hot)
        assert rows(got.select("event_id", "rn")) == expect
        got_m = windows.running_max_in_group(ev, ["customer_id"], ["event_id"], b, "event_timestamp", "m", hot)
        assert rows(got_m.select("event_id", "m")) == expect_m


def test_distributed_ntile_matches_window_ntile(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, rnd.randrange(20)) for i in range(503)], "id long, v long")
    expect = rows(df.select("id", F.ntile(5).over(Window.orderBy(F.col("v").desc(), "id")).alias("b")))
    got = ranking.distributed_ntile(df, 5, [F.col("v").desc(), F.col("id")], "b", num_partitions=7)
    assert rows(got.select("id", "b")) == expect


def test_quantile_edges_match_numpy(spark):
    import numpy as np

    rnd = random.Random(5)
    vals = [rnd.random() * 100 for _ in range(311)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, 0.2, 0.4, 0.6, 0.8, 1.0]
    got = ranking.quantile_edges(df, "x", probs, num_partitions=5)
    assert np.allclose(got, np.quantile(vals, probs), rtol=0, atol=1e-9)


def test_dedup_latest_keeps_greatest(spark):
    from mercato.operators.cleaning import dedup_latest

    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (1, 2, "a")], "k int, seq int, v string")
    assert rows(dedup_latest(df, ["k"], ["seq"])) == [(1, 2, "b"), (2, 1, "c")]


def test_order_item_ids_unique(spark):
    from mercato.operators.facts import order_item_ids

    ids = order_item_ids(T.order_items(spark, SF001), line_bucket=2, hot_threshold=3)
    n = ids.count()
    assert ids.select("order_item_id").distinct().count() == n
    w = Window.partitionBy("order_id").orderBy("line_sort")
    expect = rows(T.order_items(spark, SF001).select("order_id", "line_sort", F.row_number().over(w).alias("p")),
                  "order_id", "p")
    assert rows(ids.select("order_id", F.col("line_position").alias("p"))) == expect


def test_histogram_quantiles_match_positions(spark):
    rnd = random.Random(11)
    df = spark.createDataFrame([(rnd.randrange(40),) for _ in range(997)], "x long")
    probs = [0, 0.2, 0.4, 0.6, 0.8, 1.0]
    assert ranking.quantile_edges_histogram(df, "x", probs) == ranking.quantile_edges(df, "x", probs, num_partitions=4)


def test_hot_third_of_events_on_real_data(spark):
    """A third of the sf0.01 events re-assigned to one customer: the sliced
    (hot) path and the plain per-key path give the same sessions, and the
    hot path really slices (the hot-key list is joined into the plan)."""
    from conftest import SF01
    from mercato.plans import params as P

    raw = T.raw_events(spark, SF01)
    skewed = raw.withColumn("customer_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_id")))
    plain = sessions.sessionize(skewed, P.SESSION_GAP_SECONDS, hot_threshold=10**9)
    sliced = sessions.sessionize(skewed, P.SESSION_GAP_SECONDS, hot_threshold=1000)
    assert rows(plain.select("event_id", "session_id")) == rows(sliced.select("event_id", "session_id"))
    p = sliced._jdf.queryExecution().executedPlan().toString()
    assert "_hot" in p
    assert sliced.filter("customer_id = -1").select("session_id").distinct().count() >= 1


def test_hot_baskets_with_repeated_items_match_plain_pairs(spark):
    """Every line doubled and a low threshold: most baskets take the salted
    path, whose dedup is hashed on (order, item); counts equal the plain path."""
    from mercato.operators import affinity

    lines = T.order_lines(spark, SF001).select("order_id", "product_id", "line_sort")
    doubled = lines.unionByName(lines)
    orders = T.read(spark, SF001, "orders")
    plain = affinity.product_affinity(doubled, orders, hot_threshold=None)
    salted = affinity.product_affinity(doubled, orders, hot_threshold=4, salt_buckets=5)
    assert plain.count() > 0
    assert rows(plain) == rows(salted)


def test_one_users_hour_spreads_over_slices(spark):
    """All events of one user within an hour: slices of about equal counts,
    each a task of its own, and the same sessions."""
    rnd = random.Random(9)
    data = [(i, 1, 1_700_000_000_000_000 + rnd.randrange(3_600_000_000)) for i in range(6000)]
    data += [(10_000 + i, 2 + i, 1_700_000_000_000_000) for i in range(500)]
    ev = spark.createDataFrame(data, "event_id long, customer_id long, us long").select(
        "event_id", "customer_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("event_timestamp"))
    cut = windows.with_slices(ev.withColumn("_us", F.unix_micros(F.col("event_timestamp").cast("timestamp"))),
                              ["customer_id"], F.col("_us"), 1000)
    sizes = [r["count"] for r in cut.where("customer_id = 1").groupBy("_b").count().collect()]
    assert len(sizes) > 300 and max(sizes) < 6000 / windows.SLICES * 4
    assert cut.where("customer_id <> 1 AND _b IS NOT NULL").count() == 0
    tasks = cut.repartition(16, "customer_id", "_b").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < 6500 / 4
    got = rows(sessions.sessionize(ev, 20, hot_threshold=1000).select("event_id", "session_id"))
    assert got == rows(_brute_sessions(ev, 20))
