"""Golden micro-fixtures (hand-computed, see FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from mercato.operators import affinity, cohort, funnel, ranking, rfm, scd, sessions
from mercato.sources import sinks


def ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def basket(spark):
    items = spark.createDataFrame(
        [("O1", "A", 1), ("O1", "B", 2), ("O2", "A", 1), ("O2", "C", 2), ("O3", "B", 1)],
        "order_id string, product_id string, pos int").withColumn("line_sort", F.struct("pos"))
    return items


def _orders(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("order_id"))


def test_affinity_support_50_orders(spark, basket):
    out = affinity.product_affinity(basket, _orders(spark, 50))
    assert rows(out) == [("A", "B", 1, 0.02), ("A", "C", 1, 0.02)]


def test_affinity_confidence_lift_3_orders(spark, basket):
    out = affinity.affinity_lift(basket, _orders(spark, 3))
    got = {(r.product_a, r.product_b): (r.support, r.confidence, r.lift) for r in out.collect()}
    assert got[("A", "B")] == pytest.approx((1 / 3, 0.5, 0.75))
    assert got[("A", "C")] == pytest.approx((1 / 3, 0.5, 1.5))


def test_positional_vs_canonical_pairs(spark):
    items = spark.createDataFrame([("O1", "B", 1), ("O1", "A", 2), ("O1", "A", 3)],
                                  "order_id string, product_id string, pos int").withColumn("line_sort", F.struct("pos"))
    m01 = affinity.affinity_positional(items, _orders(spark, 1))
    assert rows(m01, "product_a", "product_b", "co_occurrence_count") == [("A", "A", 1), ("B", "A", 2)]
    m03 = affinity.product_affinity(items, _orders(spark, 1))
    assert rows(m03, "product_a", "product_b", "co_occurrence_count") == [("A", "B", 1)]


def test_hot_basket_salting_is_exact(spark, basket):
    plain = affinity.product_affinity(basket, _orders(spark, 3))
    salted = affinity.product_affinity(basket, _orders(spark, 3), hot_threshold=1, salt_buckets=4)
    assert rows(plain) == rows(salted)
    pos_plain = affinity.affinity_positional(basket, _orders(spark, 3))
    pos_salted = affinity.affinity_positional(basket, _orders(spark, 3), hot_threshold=0, salt_buckets=3)
    assert rows(pos_plain) == rows(pos_salted)


@pytest.fixture
def session_events(spark):
    data = [("e1", "C1", "S1", ts("2024-01-01 00:00:00"), 1, 0, 1, 0, 0),
            ("e2", "C1", "S1", ts("2024-01-01 00:01:30.500"), 2, 1, 0, 0, 0),
            ("e3", "C2", "S2", ts("2024-01-01 00:05:00"), 1, 0, 1, 1, 1)]
    return spark.createDataFrame(data, "event_id string, customer_id string, session_id string, "
                                 "event_timestamp timestamp_ntz, page_views int, product_views int, add_to_cart int, "
                                 "checkout_started int, purchase_completed int")


def test_session_behavior(session_events):
    b = sessions.session_behavior(session_events)
    got = rows(b, "customer_id", "session_id", "event_timestamp_count", "page_views_sum",
               "session_duration_seconds", "converted", "abandoned_cart")
    assert got == [("C1", "S1", 2, 3, 90.5, 0, 1), ("C2", "S2", 1, 1, 0.0, 1, 0)]


def test_behavior_summary(session_events):
    s = sessions.behavior_summary(sessions.session_behavior(session_events)).collect()[0]
    assert (s.total_sessions, s.avg_session_duration, s.conversion_rate, s.cart_abandonment_rate,
            s.avg_page_views) == (2, 45.25, 50.0, 50.0, 2.0)


def test_funnel_independent_stages(session_events):
    f = funnel.conversion_funnel(session_events)
    got = rows(f, "stage_order", "stage", "sessions", "conversion_rate", "drop_off_rate", "stage_conversion")
    assert got == [(1, "visit", 2, 100.0, 0.0, 100.0), (2, "product_view", 1, 50.0, 50.0, 50.0),
                   (3, "add_to_cart", 2, 100.0, 0.0, 200.0), (4, "checkout", 1, 50.0, 50.0, 50.0),
                   (5, "purchase", 1, 50.0, 50.0, 100.0)]


def test_cohort_retention(spark):
    o = spark.createDataFrame(
        [(1, "C1", ts("2024-01-05 00:00:00"), Decimal("10.00")), (2, "C1", ts("2024-02-10 00:00:00"), Decimal("20.00")),
         (3, "C1", ts("2024-02-20 00:00:00"), Decimal("30.00")), (4, "C2", ts("2024-01-31 00:00:00"), Decimal("40.00")),
         (5, "C3", ts("2024-02-01 00:00:00"), Decimal("50.00"))],
        "order_id int, customer_id string, order_date timestamp_ntz, order_total decimal(18,2)")
    r = cohort.cohort_retention(o)
    got = rows(r, "cohort_month", "months_since_first", "customers", "retention_rate", "revenue")
    assert got == [(dt.date(2024, 1, 1), 0, 2, 100.0, Decimal("50.00")),
                   (dt.date(2024, 1, 1), 1, 1, 50.0, Decimal("50.00")),
                   (dt.date(2024, 2, 1), 0, 1, 100.0, Decimal("50.00"))]
    m = cohort.cohort_matrix(o, [0, 1, 2]).orderBy("cohort_month").collect()
    assert (m[0].month_0, m[0].month_1, m[0].month_2) == (100.0, 50.0, None)


def test_segment_ladder(spark):
    cases = {(5, 5, 5): "Champions", (5, 5, 3): "Loyal Customers", (3, 3, 3): "Loyal Customers",
             (5, 2, 5): "New Customers", (1, 4, 4): "At Risk", (1, 1, 1): "Lost Customers",
             (3, 2, 1): "Potential Loyalists", (3, 3, 2): "Regular Customers", (4, 3, 1): "Regular Customers"}
    df = spark.createDataFrame(list(cases), "r_score int, f_score int, m_score int")
    from mercato.functions.expressions import segment_ladder
    got = {(r.r_score, r.f_score, r.m_score): r.s for r in df.select("*", segment_ladder().alias("s")).collect()}
    assert got == cases


def test_quantile_scores_and_strict(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 10, 7])], "id int, x double")
    s = ranking.quantile_score(df, "x", "score")
    assert [r.score for r in s.orderBy("id").collect()] == [1, 1, 2, 3, 5, 4]
    same = spark.createDataFrame([(i, 5.0) for i in range(10)], "id int, x double")
    assert {r.score for r in ranking.quantile_score(same, "x", "score").collect()} == {1}
    with pytest.raises(ValueError):
        ranking.quantile_score(same, "x", "score", strict=True)


def test_distributed_ntile_bucket_sizes(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    out = ranking.distributed_ntile(df, 5, ["k"], "b", num_partitions=3)
    sizes = [r["count"] for r in out.groupBy("b").count().orderBy("b").collect()]
    assert sizes == [2, 2, 1, 1, 1]


def test_recency_floor_vs_calendar_days(spark):
    o = spark.createDataFrame([(1, "C1", ts("2024-01-01 23:00:00"), Decimal("10.00"), "completed")],
                              "order_id int, customer_id string, order_date timestamp_ntz, order_total decimal(18,2), "
                              "order_status string")
    assert rfm.rfm_metrics(o, "2024-01-02 01:00:00").collect()[0].recency == 0
    c = spark.createDataFrame([("C1",)], "customer_id string")
    assert rfm.rfm_ntile(c, o, "2024-01-02").collect()[0].recency_days == 1


def test_scd2_and_point_in_time_lookup(spark):
    s1 = spark.createDataFrame([("C1", "A"), ("C2", "B")], "customer_id string, city string")
    s2 = spark.createDataFrame([("C1", "Z"), ("C2", "B"), ("C3", "D")], "customer_id string, city string")
    dim = scd.scd2_build([("2024-01-01", s1), ("2024-02-01", s2)], "customer_id", ["city"])
    got = rows(dim, "customer_id", "city", "effective_date", "expiry_date", "is_current")
    d = dt.date
    assert got == [("C1", "A", d(2024, 1, 1), d(2024, 2, 1), False), ("C1", "Z", d(2024, 2, 1), None, True),
                   ("C2", "B", d(2024, 1, 1), None, True), ("C3", "D", d(2024, 2, 1), None, True)]
    facts = spark.createDataFrame([(1, "C1", ts("2024-01-31 12:00:00")), (2, "C1", ts("2024-02-01 00:00:00"))],
                                  "id int, customer_id string, t timestamp_ntz")
    look = scd.scd2_lookup(facts, dim, "customer_id", "t", ["city"])
    assert rows(look, "id", "city") == [(1, "A"), (2, "Z")]


def test_incremental_lookback(spark, tmp_path):
    def frame(days):
        return spark.createDataFrame([(dt.date(2024, 1, d), v) for d, v in days], "funnel_date date, v int")

    target = {1: 1, 2: 2, 3: 3}
    new_input = [(1, 1), (2, 2), (3, 30), (4, 4)]
    for lookback, expect in ((0, {1: 1, 2: 2, 3: 3, 4: 4}), (1, {1: 1, 2: 2, 3: 30, 4: 4})):
        path = str(tmp_path / f"lb{lookback}")
        sinks.incremental_by_date(frame(list(target.items())), path, "funnel_date", lookback)
        out = sinks.incremental_by_date(frame(new_input), path, "funnel_date", lookback)
        assert {r.funnel_date.day: r.v for r in out.collect()} == expect
        again = sinks.incremental_by_date(frame(new_input), path, "funnel_date", lookback)
        assert {r.funnel_date.day: r.v for r in again.collect()} == expect


def test_funnel_from_behavior_equals_event_funnel(spark, session_events):
    a = funnel.conversion_funnel(session_events)
    b = funnel.conversion_funnel_from_behavior(sessions.session_behavior(session_events))
    assert rows(a) == rows(b)


def test_full_pipeline_runs(spark):
    from conftest import SF001
    from mercato.plans.pipeline import release, run_full_pipeline

    res = run_full_pipeline(spark, SF001)
    assert set(res) >= {"customer_behavior", "rfm_scores", "conversion_funnel", "cohort_retention",
                        "product_affinity", "summary"}
    s = res["summary"].collect()[0]
    assert s.total_events > 0 and s.total_orders > 0 and s.unique_customers > 0 and s.total_revenue > 0
    assert res["conversion_funnel"].count() == 5
    release(res)


def test_full_pipeline_concurrent_equals_sequential(spark):
    from conftest import SF001
    from mercato.plans.pipeline import execute, release, run_full_pipeline

    def collect_into(out):
        def write(name, df):
            out.append((name, sorted(map(tuple, df.collect()), key=repr)))
        return write

    got = {}
    for parallel in (1, 4):
        res, out = run_full_pipeline(spark, SF001), []
        execute(res, collect_into(out), parallel=parallel)
        release(res)
        assert out[0][0] == "customer_behavior" and len(out) == len(res)
        got[parallel] = dict(out)
    assert got[1] == got[4]


def test_metric_alerts_and_revenue_drop(spark):
    from mercato.operators import metrics

    d = dt.date
    daily = spark.createDataFrame(
        [(d(2024, 1, 1), 100, 0.01, 0.8), (d(2024, 1, 2), 100, 0.05, 0.5), (d(2024, 1, 3), 0, None, None)],
        "metric_date date, total_sessions long, conversion_rate double, cart_abandonment_rate double")
    got = rows(metrics.metric_alerts(daily), "metric_date", "alert_name", "metric_value", "threshold")
    assert got == [(d(2024, 1, 1), "high_cart_abandonment", 0.8, 0.75), (d(2024, 1, 1), "low_conversion_rate", 0.01, 0.02)]
    rev = spark.createDataFrame([(d(2024, 1, i), Decimal(v)) for i, v in [(1, "100"), (2, "100"), (3, "40"), (30, "10")]],
                                "metric_date date, total_revenue decimal(28,2)")
    drops = rows(metrics.revenue_drop_alerts(rev), "metric_date", "avg_revenue")
    assert drops == [(d(2024, 1, 3), 100.0), (d(2024, 1, 30), 70.0)]  # day 30 averages days 2..29


def test_combine_rows_no_join(spark):
    from mercato.operators import metrics

    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2.5,)], "c double")
    r = metrics.combine_rows(a, b)
    assert r.collect()[0].asDict() == {"a": 1, "b": "x", "c": 2.5}
    p = r._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and "CartesianProduct" not in p


def test_drop_null_keys_and_presets(spark):
    from mercato.operators import cleaning

    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, v string")
    assert rows(cleaning.drop_null_keys(df, ["k"])) == [(1, "a"), (2, None)]
    assert cleaning.preset_range("2024-03-31", "7d") == ("2024-03-24", "2024-03-31")
    assert cleaning.preset_range("2024-03-31", "1y") == ("2023-03-31", "2024-03-31")


def test_month_over_month_uses_calendar_previous_month(spark):
    from mercato.operators import metrics

    o = spark.createDataFrame(
        [(ts("2024-01-10 00:00:00"), Decimal("10.00")), (ts("2024-02-10 00:00:00"), Decimal("15.00")),
         (ts("2024-04-10 00:00:00"), Decimal("30.00"))], "order_date timestamp_ntz, order_total decimal(18,2)")
    got = rows(metrics.revenue_mom_change(o), "month", "previous_revenue", "pct_change")
    d = dt.date
    assert got == [(d(2024, 1, 1), None, None), (d(2024, 2, 1), Decimal("10.00"), 50.0), (d(2024, 4, 1), None, None)]


def test_dim_date_and_time_generators(spark):
    from mercato.operators import dims

    d = dims.dim_date(spark)
    assert d.count() == 3650
    last = d.orderBy(F.col("full_date").desc()).first()
    assert last.full_date == dt.date(2029, 12, 28) and last.date_key == 20291228
    jan7 = d.filter("full_date = date'2024-01-07'").first()  # a Sunday
    assert (jan7.day_of_week, jan7.day_name, jan7.month_name, jan7.is_weekend, jan7.week) == (0, "Sun", "Jan", True, 1)
    t = dims.dim_time(spark)
    assert t.count() == 86400
    r = {x.time_key: x for x in t.filter("time_key in (0, 32400, 64799, 64800, 75600, 79199)").collect()}
    assert (r[32400].time_of_day, r[32400].is_business_hours) == ("Morning", True)
    assert (r[64799].hour, r[64799].minute, r[64799].second, r[64799].is_business_hours) == (17, 59, 59, True)
    assert (r[64800].time_of_day, r[64800].is_business_hours) == ("Evening", False)
    assert r[0].time_of_day == "Night" and r[79199].time_of_day == "Evening"


def test_surrogate_keys_unique(spark):
    from conftest import SF001
    from mercato.operators import facts
    from mercato.sources import tables as T

    fo = facts.fact_orders(T.orders(spark, SF001), with_keys=True)
    assert fo.select("order_key").distinct().count() == fo.count()


def test_reporting_views_registered(spark):
    from conftest import SF001
    from mercato.plans.views import register_reporting_views

    names = register_reporting_views(spark, SF001)
    assert "customer_lifetime_value" in names
    n = spark.sql("SELECT COUNT(*) AS n FROM customer_lifetime_value WHERE activity_status IS NOT NULL").first().n
    assert n > 0


def test_product_performance_with_event_bridge(spark):
    from mercato.operators import facts, metrics

    d = dt.date
    orders = spark.createDataFrame([(1, ts("2024-01-01 10:00:00")), (2, ts("2024-01-01 11:00:00"))],
                                   "order_id int, order_date timestamp_ntz")
    items = spark.createDataFrame(
        [(1, 7, 2, Decimal("20.00"), Decimal("0.00"), Decimal("10.00")), (2, 7, 1, Decimal("10.00"), Decimal("1.00"), Decimal("10.00"))],
        "order_id int, product_id int, quantity int, extended_price decimal(18,2), discount decimal(18,2), unit_price decimal(18,2)")
    products = spark.createDataFrame([(7, Decimal("6.00"))], "product_id int, cost decimal(18,2)")
    fi = facts.fact_order_items(items, products)
    ev = spark.createDataFrame(
        [(10, ts("2024-01-01 09:00:00"), 1, 0), (11, ts("2024-01-01 09:05:00"), 1, 0), (12, ts("2024-01-01 09:06:00"), 1, 0),
         (13, ts("2024-01-01 09:07:00"), 1, 0), (14, ts("2024-01-01 09:08:00"), 0, 1), (15, ts("2024-01-02 09:00:00"), 1, 0)],
        "event_id int, event_timestamp timestamp_ntz, product_views int, add_to_cart int")
    bridge = spark.createDataFrame([(10, 7), (11, 7), (12, 7), (13, 7), (14, 7), (15, 7)], "event_id int, product_id int")
    got = rows(metrics.product_performance(fi, orders, ev, bridge),
               "product_id", "metric_date", "views", "add_to_cart", "purchases", "quantity_sold", "revenue", "conversion_rate")
    assert got == [(7, d(2024, 1, 1), 4, 1, 2, 3, Decimal("29.00"), 0.5), (7, d(2024, 1, 2), 1, 0, 0, 0, Decimal("0.00"), 0.0)]
    plain = metrics.product_performance(fi, orders).collect()[0]
    assert plain.views is None and plain.conversion_rate is None
