"""Registered queries: one per operator of the inventory, each over the
whole landed tables, each with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import cohort, funnel, metrics, rfm, sessions
from mercato.plans import params as P
from mercato.plans.oracle_sql import BEH, FACT_BEH, ORD, RFM_A, RFM_B, ord_cte, web_cte, with_
from mercato.plans.registry import query
from mercato.sources import tables as T

WEB = web_cte()


def _web(spark, sf):
    return T.web_events(spark, sf, gap_seconds=P.SESSION_GAP_SECONDS)


def _behavior(spark, sf):
    return sessions.session_behavior(_web(spark, sf))


def _fact_behavior(spark, sf):
    return sessions.fact_customer_behavior(_behavior(spark, sf))


# ---------------------------------------------------------------- sources --

@query("scan_web_events", with_(web_cte(
    f"WHERE ts >= TIMESTAMP '{P.EVENT_RANGE[0]}' AND ts < TIMESTAMP '{P.EVENT_RANGE[1]}' + INTERVAL 1 DAY"))
    + "SELECT event_id, customer_id, session_id, event_timestamp, page_views, product_views, add_to_cart,"
      " checkout_started, purchase_completed FROM web")
def q_scan_web_events(spark, sf):
    ev = T.web_events(spark, sf, *P.EVENT_RANGE, gap_seconds=P.SESSION_GAP_SECONDS)
    return ev.select("event_id", "customer_id", "session_id", "event_timestamp", *sessions.COUNTERS)


@query("scan_orders", with_(ord_cte(
    f"WHERE o_orderdate >= TIMESTAMP '{P.ORDER_RANGE[0]}' AND o_orderdate < TIMESTAMP '{P.ORDER_RANGE[1]}' + INTERVAL 1 DAY"))
    + "SELECT order_id, customer_id, order_date, order_total, order_status FROM ord")
def q_scan_orders(spark, sf):
    return T.orders(spark, sf, *P.ORDER_RANGE).select("order_id", "customer_id", "order_date",
                                                      "order_total", "order_status")


# --------------------------------------------------------------- sessions --

@query("sessionize", with_(WEB) + "SELECT event_id, customer_id, event_timestamp, session_id FROM web")
def q_sessionize(spark, sf):
    return _web(spark, sf).select("event_id", "customer_id", "event_timestamp", "session_id")


@query("session_behavior", with_(WEB, BEH) + "SELECT * FROM beh")
def q_session_behavior(spark, sf):
    return _behavior(spark, sf)


@query("behavior_summary", with_(WEB, BEH) + """
SELECT COUNT(*) AS total_sessions,
       CAST(SUM(epoch_us(event_timestamp_max) - epoch_us(event_timestamp_min)) AS DOUBLE) / 1e6 / COUNT(*) AS avg_session_duration,
       CAST(SUM(converted) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS conversion_rate,
       CAST(SUM(abandoned_cart) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS cart_abandonment_rate,
       CAST(SUM(page_views_sum) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_page_views
FROM beh""")
def q_behavior_summary(spark, sf):
    return sessions.behavior_summary(_behavior(spark, sf))


@query("sample_sessions", with_(WEB, BEH) + "SELECT * FROM beh ORDER BY customer_id, session_id LIMIT 10")
def q_sample_sessions(spark, sf):
    return sessions.sample_sessions(_behavior(spark, sf), 10)


@query("customer_sessions", with_(WEB, BEH) + f"SELECT * FROM beh WHERE customer_id = {P.SAMPLE_CUSTOMER}")
def q_customer_sessions(spark, sf):
    return sessions.customer_sessions(_behavior(spark, sf), P.SAMPLE_CUSTOMER)


@query("fact_customer_behavior", with_(WEB, BEH, FACT_BEH) + "SELECT * FROM fbeh")
def q_fact_customer_behavior(spark, sf):
    return _fact_behavior(spark, sf)


@query("dim_session", with_(WEB) + """,
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS rf,
                     ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC) AS rl
           FROM web)
SELECT session_id, customer_id, MIN(event_timestamp) AS session_start_timestamp,
       MAX(event_timestamp) AS session_end_timestamp,
       CAST((epoch_us(MAX(event_timestamp)) - epoch_us(MIN(event_timestamp))) // 1000000 AS INTEGER) AS session_duration_seconds,
       CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS browser, CAST(NULL AS VARCHAR) AS referrer_source,
       MAX(CASE WHEN rf = 1 THEN event_type END) AS landing_page,
       MAX(CASE WHEN rl = 1 THEN event_type END) AS exit_page
FROM ranked GROUP BY session_id, customer_id""")
def q_dim_session(spark, sf):
    return sessions.dim_session(_web(spark, sf))


# ----------------------------------------------------------------- funnel --

_FUNNEL_FLAGS = """,
sf AS (SELECT session_id, MAX(product_views > 0) AS pv, MAX(add_to_cart > 0) AS atc,
              MAX(checkout_started > 0) AS co, MAX(purchase_completed > 0) AS pur
       FROM web GROUP BY session_id),
n AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (WHERE pv) AS n1, COUNT(*) FILTER (WHERE atc) AS n2,
             COUNT(*) FILTER (WHERE co) AS n3, COUNT(*) FILTER (WHERE pur) AS n4 FROM sf)
"""


_FUNNEL_STAGES = """,
st AS (
  SELECT 'visit' AS stage, n0 AS sessions, 1 AS stage_order, n0 AS first_s, NULL::BIGINT AS prev_s FROM n UNION ALL
  SELECT 'product_view', n1, 2, n0, n0 FROM n UNION ALL
  SELECT 'add_to_cart', n2, 3, n0, n1 FROM n UNION ALL
  SELECT 'checkout', n3, 4, n0, n2 FROM n UNION ALL
  SELECT 'purchase', n4, 5, n0, n3 FROM n)
SELECT stage, sessions, stage_order,
       CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) * 100 AS conversion_rate,
       100.0 - CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) * 100 AS drop_off_rate,
       COALESCE(CAST(sessions AS DOUBLE) / NULLIF(CAST(prev_s AS DOUBLE), 0) * 100, 100.0) AS stage_conversion
FROM st"""


@query("conversion_funnel", with_(WEB) + _FUNNEL_FLAGS + _FUNNEL_STAGES)
def q_conversion_funnel(spark, sf):
    return funnel.conversion_funnel(_web(spark, sf))


def _sequential(sql: str) -> str:
    return sql.replace("FILTER (WHERE atc)", "FILTER (WHERE pv AND atc)").replace(
        "FILTER (WHERE co)", "FILTER (WHERE pv AND atc AND co)").replace(
        "FILTER (WHERE pur)", "FILTER (WHERE pv AND atc AND co AND pur)")


@query("conversion_funnel_sequential", with_(WEB) + _sequential(_FUNNEL_FLAGS) + _FUNNEL_STAGES)
def q_conversion_funnel_sequential(spark, sf):
    return funnel.conversion_funnel(_web(spark, sf), sequential=True)


@query("overall_conversion", with_(WEB) + _FUNNEL_FLAGS +
       "SELECT round(CAST(n4 AS DOUBLE) / NULLIF(CAST(n0 AS DOUBLE), 0) * 100, 2) AS overall_conversion_rate FROM n")
def q_overall_conversion(spark, sf):
    return funnel.overall_conversion(_web(spark, sf))


_DAILY = """,
d AS (SELECT session_date AS funnel_date, COUNT(*) AS n0,
             COUNT(*) FILTER (WHERE total_product_views > 0) AS n1,
             COUNT(*) FILTER (WHERE total_add_to_cart > 0) AS n2,
             COUNT(*) FILTER (WHERE checkout_started) AS n3,
             COUNT(*) FILTER (WHERE purchase_completed) AS n4
      FROM fbeh GROUP BY session_date),
st AS (
  SELECT funnel_date, 'Visit' AS stage, 1 AS stage_order, n0 AS sessions, n0 AS first_s, NULL::BIGINT AS prev_s FROM d UNION ALL
  SELECT funnel_date, 'Product View', 2, n1, n0, n0 FROM d UNION ALL
  SELECT funnel_date, 'Add to Cart', 3, n2, n0, n1 FROM d UNION ALL
  SELECT funnel_date, 'Checkout', 4, n3, n0, n2 FROM d UNION ALL
  SELECT funnel_date, 'Purchase', 5, n4, n0, n3 FROM d)
"""


@query("funnel_daily", with_(WEB, BEH, FACT_BEH) + _DAILY + """
SELECT funnel_date, stage, stage_order, sessions,
       CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS conversion_rate,
       1.0 - CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS drop_off_rate
FROM st ORDER BY funnel_date, stage_order""")
def q_funnel_daily(spark, sf):
    return funnel.funnel_daily(_fact_behavior(spark, sf))


@query("funnel_dropoff", with_(WEB, BEH, FACT_BEH) + _DAILY + """
SELECT funnel_date, stage, stage_order, sessions, prev_s AS previous_stage_sessions,
       prev_s - sessions AS dropped_sessions,
       CAST(sessions AS DOUBLE) / NULLIF(CAST(prev_s AS DOUBLE), 0) AS step_conversion_rate
FROM st""")
def q_funnel_dropoff(spark, sf):
    return funnel.funnel_dropoff(_fact_behavior(spark, sf))


# -------------------------------------------------------------------- rfm --

def _rfm_a(spark, sf):
    return rfm.rfm_segments(T.orders(spark, sf), P.AS_OF)


def _rfm_b(spark, sf):
    return rfm.rfm_ntile(T.customers(spark, sf), T.orders(spark, sf), P.AS_OF)


@query("rfm_metrics", with_(ORD, RFM_A) + "SELECT * FROM rfm")
def q_rfm_metrics(spark, sf):
    return rfm.rfm_metrics(T.orders(spark, sf), P.AS_OF)


@query("rfm_quantile_scores", with_(ORD, RFM_A) + "SELECT * FROM scored")
def q_rfm_quantile_scores(spark, sf):
    return rfm.rfm_quantile_scores(rfm.rfm_metrics(T.orders(spark, sf), P.AS_OF))


@query("rfm_segments", with_(ORD, RFM_A) + "SELECT * FROM seg")
def q_rfm_segments(spark, sf):
    return _rfm_a(spark, sf)


@query("segments_from_rules", with_(ORD, RFM_A) + """
SELECT customer_id, r_score, f_score, m_score,
  CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'champions'
       WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'loyal_customers'
       WHEN r_score <= 2 AND f_score >= 3 THEN 'at_risk'
       WHEN r_score <= 2 AND f_score <= 2 THEN 'lost_customers' END AS rule_segment
FROM scored""")
def q_segments_from_rules(spark, sf):
    s = rfm.rfm_quantile_scores(rfm.rfm_metrics(T.orders(spark, sf), P.AS_OF))
    return rfm.rules_segment(s.select("customer_id", "r_score", "f_score", "m_score"))


@query("rfm_segment_filter", with_(ORD, RFM_A) + f"SELECT * FROM seg WHERE segment = '{P.SEGMENT_FILTER}'")
def q_rfm_segment_filter(spark, sf):
    return rfm.filter_segment(_rfm_a(spark, sf), P.SEGMENT_FILTER)


@query("segment_distribution", with_(ORD, RFM_A) +
       "SELECT segment, COUNT(*) AS customers FROM seg GROUP BY segment")
def q_segment_distribution(spark, sf):
    return rfm.segment_distribution(_rfm_a(spark, sf))


@query("top_customers", with_(ORD, RFM_A) +
       "SELECT customer_id, recency, frequency, monetary, segment FROM seg ORDER BY monetary DESC, customer_id LIMIT 10")
def q_top_customers(spark, sf):
    return rfm.top_customers(_rfm_a(spark, sf), 10)


def _segment_values_sql() -> str:
    rows = ", ".join(f"('{n}', '{d.replace(chr(39), chr(39) * 2)}', {str(r).upper()})" for n, d, r in rfm.SEGMENTS)
    return f"segs(segment, description, reported) AS (VALUES {rows})"


@query("segment_profile", with_(ORD, RFM_A, _segment_values_sql()) + """,
a AS (SELECT segment, COUNT(*) AS customers, SUM(monetary) AS m FROM seg GROUP BY segment)
SELECT s.segment, s.description, COALESCE(a.customers, 0) AS customers,
       CAST(a.m AS DOUBLE) / NULLIF(CAST(a.customers AS DOUBLE), 0) AS avg_monetary, s.reported
FROM segs s LEFT JOIN a ON a.segment = s.segment""")
def q_segment_profile(spark, sf):
    return rfm.segment_profile(_rfm_a(spark, sf))


@query("rfm_ntile", with_(ORD, RFM_B) + "SELECT * FROM rfmb")
def q_rfm_ntile(spark, sf):
    return _rfm_b(spark, sf)


@query("segment_report", with_(ORD, RFM_B) + """,
g AS (SELECT customer_segment, COUNT(*) AS customers, SUM(total_revenue) AS rev,
             SUM(total_orders) AS ord, SUM(recency_days) AS rec FROM rfmb GROUP BY customer_segment)
SELECT customer_segment, customers,
       CAST(rev AS DOUBLE) / NULLIF(CAST(customers AS DOUBLE), 0) AS avg_revenue,
       CAST(ord AS DOUBLE) / NULLIF(CAST(customers AS DOUBLE), 0) AS avg_orders,
       CAST(rec AS DOUBLE) / NULLIF(CAST(customers AS DOUBLE), 0) AS avg_recency_days,
       CASE WHEN CAST(rec AS DOUBLE) / NULLIF(CAST(customers AS DOUBLE), 0) <= 30 THEN 'Active'
            WHEN CAST(rec AS DOUBLE) / NULLIF(CAST(customers AS DOUBLE), 0) <= 90 THEN 'At Risk'
            ELSE 'Inactive' END AS status
FROM g""")
def q_segment_report(spark, sf):
    return rfm.segment_report(_rfm_b(spark, sf))


# ------------------------------------------------------------- null keys --
# P10: a quarter of the keys are nulled by an expression on both sides.

_NULL_EVENTS = WEB.replace("SELECT event_id, user_id AS customer_id", "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN user_id END AS customer_id", 1).replace(
    "PARTITION BY user_id ORDER BY", "PARTITION BY CASE WHEN event_id % 4 <> 0 THEN user_id END ORDER BY", 1)
_NULL_ORD = ORD.replace("o_custkey AS customer_id", "CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS customer_id")


def _null_events(spark, sf):
    raw = T.raw_events(spark, sf)
    some = raw.withColumn("customer_id", F.when(F.col("event_id") % 4 != 0, F.col("customer_id")))
    return sessions.sessionize(some, P.SESSION_GAP_SECONDS)


def _null_orders(spark, sf):
    return T.orders(spark, sf).withColumn("customer_id", F.when(F.col("order_id") % 4 != 0, F.col("customer_id")))


@query("session_behavior_null_keys", with_(_NULL_EVENTS, BEH) + "SELECT * FROM beh WHERE customer_id IS NOT NULL")
def q_session_behavior_null_keys(spark, sf):
    return sessions.session_behavior(_null_events(spark, sf))


@query("conversion_funnel_null_keys", with_(_NULL_EVENTS) + _FUNNEL_FLAGS.replace(
    "FROM web GROUP BY", "FROM web WHERE session_id IS NOT NULL GROUP BY") + _FUNNEL_STAGES)
def q_conversion_funnel_null_keys(spark, sf):
    return funnel.conversion_funnel(_null_events(spark, sf))


@query("rfm_metrics_null_keys", with_(_NULL_ORD, RFM_A) + "SELECT * FROM rfm WHERE customer_id IS NOT NULL")
def q_rfm_metrics_null_keys(spark, sf):
    return rfm.rfm_metrics(_null_orders(spark, sf), P.AS_OF)


@query("summary_null_keys", with_(_NULL_ORD) + """
SELECT (SELECT COUNT(*) FROM events) AS total_events, COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
       CAST(SUM(order_total) AS DECIMAL(28,2)) AS total_revenue,
       CAST(SUM(order_total) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS avg_order_value FROM ord""")
def q_summary_null_keys(spark, sf):
    return metrics.summary(T.raw_events(spark, sf), _null_orders(spark, sf))


@query("cohort_counts_null_keys", with_(_NULL_ORD) + """,
cm AS (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS m FROM ord WHERE customer_id IS NOT NULL),
f AS (SELECT customer_id, MIN(m) AS f FROM cm GROUP BY customer_id)
SELECT CAST(f AS DATE) AS cohort_month, CAST(date_diff('month', f, m) AS INTEGER) AS months_since_first, COUNT(*) AS customers
FROM cm JOIN f USING (customer_id) GROUP BY 1, 2""")
def q_cohort_counts_null_keys(spark, sf):
    return cohort.cohort_counts(_null_orders(spark, sf))


@query("pipeline_summary", with_(ord_cte(
    f"WHERE o_orderdate >= TIMESTAMP '{P.ORDER_RANGE[0]}' AND o_orderdate < TIMESTAMP '{P.ORDER_RANGE[1]}' + INTERVAL 1 DAY"), RFM_A) + f"""
SELECT (SELECT COUNT(*) FROM ord) AS total_orders,
       (SELECT CAST(SUM(order_total) AS DECIMAL(28,2)) FROM ord) AS total_revenue,
       (SELECT COUNT(*) FROM events WHERE ts >= TIMESTAMP '{P.ORDER_RANGE[0]}'
          AND ts < TIMESTAMP '{P.ORDER_RANGE[1]}' + INTERVAL 1 DAY) AS total_events,
       (SELECT COUNT(*) FROM rfm) AS customers_scored,
       (SELECT CAST(SUM(n * (n - 1) // 2) AS BIGINT) FROM (SELECT COUNT(DISTINCT l_partkey) AS n FROM lineitem
          WHERE l_orderkey IN (SELECT order_id FROM ord) GROUP BY l_orderkey)) AS pair_occurrences""")
def q_pipeline_summary(spark, sf):
    """K03 over a date range: every output covers the extracted orders only."""
    from mercato.plans.pipeline import release, run_full_pipeline

    res = run_full_pipeline(spark, sf, *P.ORDER_RANGE)
    row = metrics.combine_rows(
        res["summary"].select("total_orders", "total_revenue", "total_events"),
        res["rfm_scores"].agg(F.count(F.lit(1)).alias("customers_scored")),
        res["product_affinity"].agg(F.sum("co_occurrence_count").alias("pair_occurrences")))
    release(res)
    return row


# further query groups register themselves on import
from mercato.plans import catalog_baskets  # noqa: E402,F401
from mercato.plans import catalog_warehouse  # noqa: E402,F401
from mercato.plans import catalog_io  # noqa: E402,F401
from mercato.plans import catalog_changes  # noqa: E402,F401
