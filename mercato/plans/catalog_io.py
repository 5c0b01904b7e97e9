"""Registered quality, governance, sink and streaming queries (Q01-Q11,
I06-I16, X01-X06)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from mercato.operators import funnel, governance, quality, rfm, scd, sessions
from mercato.plans import params as P
from mercato.plans.catalog import _DAILY, _rfm_b
from mercato.plans.catalog_warehouse import CUST, CUST_SCD, _customer_scd, _forders
from mercato.plans.oracle_sql import BEH, FACT_BEH, ORD, RFM_A, RFM_B, web_cte, with_
from mercato.plans.registry import query
from mercato.schemas import MONEY, RAW_EVENTS
from mercato.session import scratch_path
from mercato.sources import files, sinks
from mercato.sources import tables as T
from mercato.streaming import ingest

# ---------------------------------------------------------------- quality --


def _checks_sql(table: str, src: str, rules: list[tuple[str, str, str]]) -> str:
    aggs = ", ".join(f"COUNT(*) FILTER (WHERE {bad}) AS f{i}" for i, (_, _, bad) in enumerate(rules))
    parts = [f"SELECT '{table}' AS table_name, '{k}' AS check_type, '{c}' AS column_name, n AS records_checked, "
             f"f{i} AS records_failed, CASE WHEN f{i} = 0 THEN 'PASS' ELSE 'FAIL' END AS check_result FROM agg_{src}"
             for i, (k, c, _) in enumerate(rules)]
    return f", agg_{src} AS (SELECT COUNT(*) AS n, {aggs} FROM {src})\n" + "\nUNION ALL\n".join(parts)


_ORDER_RULES_SQL = [
    ("not_null", "order_id", "order_id IS NULL"),
    ("not_null", "customer_id", "customer_id IS NULL"),
    ("not_null", "order_date", "order_date IS NULL"),
    ("positive", "order_total", "NOT COALESCE(order_total > 0, FALSE)"),
    ("accepted_values", "order_status",
     "NOT COALESCE(order_status IN ('completed', 'pending', 'cancelled', 'refunded'), FALSE)"),
]
_EVENT_RULES_SQL = [
    ("not_null", "event_id", "event_id IS NULL"),
    ("not_null", "session_id", "session_id IS NULL"),
    ("not_null", "customer_id", "customer_id IS NULL"),
    ("timestamp_range", "event_timestamp",
     "NOT COALESCE(event_timestamp >= TIMESTAMP '2020-01-01' AND event_timestamp < TIMESTAMP '2031-01-01', FALSE)"),
]
_CUST_RULES_SQL = [("email_format", "email",
                    "NOT COALESCE(regexp_matches(email, '" + quality.EMAIL_PATTERN + "'), FALSE)")]


def _dq_orders(spark, sf):
    return quality.run_checks(T.orders(spark, sf), "fact.orders",
                              quality.not_null(["order_id", "customer_id", "order_date"])
                              + quality.positive(["order_total"])
                              + quality.accepted_values("order_status", T.VALID_ORDER_STATUSES))


def _dq_events(spark, sf):
    ev = T.web_events(spark, sf, gap_seconds=P.SESSION_GAP_SECONDS)
    return quality.run_checks(ev, "fact.web_events",
                              quality.not_null(["event_id", "session_id", "customer_id"])
                              + quality.timestamp_range("event_timestamp", "2020-01-01", "2030-12-31"))


def _dq_customer(spark, sf):
    return quality.run_checks(T.customers(spark, sf), "dim.customer", quality.email_format("email"))


def _dq_unique(spark, sf, dim=None):
    cur = scd.current(dim if dim is not None else _customer_scd(spark, sf))
    return (quality.uniqueness(cur, "dim.customer", ["customer_id"])
            .unionByName(quality.uniqueness(T.orders(spark, sf), "fact.orders", ["order_id"]))
            .unionByName(quality.uniqueness(T.raw_events(spark, sf), "fact.web_events", ["event_id"])))


def _dq_referential(spark, sf):
    o, li, ev = T.orders(spark, sf), T.order_lines(spark, sf), T.raw_events(spark, sf)
    cu, pr = T.read(spark, sf, "customer"), T.read(spark, sf, "part")
    return (quality.referential(o, cu, "customer_id", "c_custkey", "fact.orders", "customer_id->customer")
            .unionByName(quality.referential(li, o, "order_id", "order_id", "fact.order_items", "order_id->orders"))
            .unionByName(quality.referential(li, pr, "product_id", "p_partkey", "fact.order_items", "product_id->product"))
            .unionByName(quality.referential(ev, cu, "customer_id", "c_custkey", "fact.web_events", "customer_id->customer")))


def _dq_scd(spark, sf, dim=None):
    return quality.scd_integrity(dim if dim is not None else _customer_scd(spark, sf), "customer_id", "dim.customer")


_UNIQ_SQL = """
SELECT 'dim.customer' AS table_name, 'unique' AS check_type, 'customer_id' AS column_name,
       CAST(COALESCE(SUM(c), 0) AS BIGINT) AS records_checked, CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS records_failed,
       CASE WHEN COALESCE(SUM(c - 1), 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS check_result
FROM (SELECT customer_id, COUNT(*) AS c FROM dimc WHERE is_current GROUP BY 1)
UNION ALL
SELECT 'fact.orders', 'unique', 'order_id', CAST(SUM(c) AS BIGINT), CAST(SUM(c - 1) AS BIGINT),
       CASE WHEN SUM(c - 1) = 0 THEN 'PASS' ELSE 'FAIL' END
FROM (SELECT o_orderkey, COUNT(*) AS c FROM orders GROUP BY 1)
UNION ALL
SELECT 'fact.web_events', 'unique', 'event_id', CAST(SUM(c) AS BIGINT), CAST(SUM(c - 1) AS BIGINT),
       CASE WHEN SUM(c - 1) = 0 THEN 'PASS' ELSE 'FAIL' END
FROM (SELECT event_id, COUNT(*) AS c FROM events GROUP BY 1)"""


def _ref_sql(table, name, child_sql, parent_sql):
    return (f"SELECT '{table}' AS table_name, 'referential' AS check_type, '{name}' AS column_name, "
            f"(SELECT COUNT(*) FROM ({child_sql})) AS records_checked, "
            f"(SELECT COUNT(*) FROM ({child_sql}) c WHERE NOT EXISTS (SELECT 1 FROM ({parent_sql}) p WHERE p.k = c.k)) AS records_failed, "
            f"CASE WHEN (SELECT COUNT(*) FROM ({child_sql}) c WHERE NOT EXISTS (SELECT 1 FROM ({parent_sql}) p WHERE p.k = c.k)) = 0 "
            f"THEN 'PASS' ELSE 'FAIL' END AS check_result")


_REF_SQL = "\nUNION ALL\n".join([
    _ref_sql("fact.orders", "customer_id->customer", "SELECT o_custkey AS k FROM orders", "SELECT c_custkey AS k FROM customer"),
    _ref_sql("fact.order_items", "order_id->orders", "SELECT l_orderkey AS k FROM lineitem", "SELECT o_orderkey AS k FROM orders"),
    _ref_sql("fact.order_items", "product_id->product", "SELECT l_partkey AS k FROM lineitem", "SELECT p_partkey AS k FROM part"),
    _ref_sql("fact.web_events", "customer_id->customer", "SELECT user_id AS k FROM events", "SELECT c_custkey AS k FROM customer"),
])

_SCD_SQL = """,
d AS (SELECT customer_id, effective_date, expiry_date, is_current,
             LEAD(effective_date) OVER (PARTITION BY customer_id ORDER BY effective_date) AS nxt FROM dimc),
pk AS (SELECT customer_id,
              bool_or(nxt IS NOT NULL AND (expiry_date IS NULL OR expiry_date > nxt)) AS overlap,
              bool_or(nxt IS NOT NULL AND expiry_date IS NOT NULL AND expiry_date < nxt) AS gap,
              bool_or(is_current != (expiry_date IS NULL)) AS flag_mismatch,
              SUM(CAST(is_current AS INTEGER)) AS cur
       FROM d GROUP BY customer_id)"""


@query("dq_orders", with_(ORD) + _checks_sql("fact.orders", "ord", _ORDER_RULES_SQL))
def q_dq_orders(spark, sf):
    return _dq_orders(spark, sf)


@query("dq_events", with_(web_cte()) + _checks_sql("fact.web_events", "web", _EVENT_RULES_SQL))
def q_dq_events(spark, sf):
    return _dq_events(spark, sf)


@query("dq_customer", with_(CUST) + _checks_sql("dim.customer", "cust", _CUST_RULES_SQL))
def q_dq_customer(spark, sf):
    return _dq_customer(spark, sf)


@query("dq_unique", with_(*CUST_SCD) + _UNIQ_SQL)
def q_dq_unique(spark, sf):
    return _dq_unique(spark, sf)


@query("dq_referential", _REF_SQL)
def q_dq_referential(spark, sf):
    return _dq_referential(spark, sf)


@query("dq_scd_integrity", with_(*CUST_SCD) + _SCD_SQL + _checks_sql("dim.customer", "pk", [
    ("scd_no_overlap", "effective_date", "overlap"), ("scd_no_gap", "effective_date", "gap"),
    ("scd_current_open", "is_current", "flag_mismatch"), ("scd_one_current", "is_current", "cur != 1")]))
def q_dq_scd_integrity(spark, sf):
    return _dq_scd(spark, sf)


def _dq_report_sql() -> str:
    from mercato.plans.registry import ORACLE

    parts = [f"SELECT * FROM ({ORACLE[k]})" for k in
             ("dq_orders", "dq_events", "dq_customer", "dq_unique", "dq_referential", "dq_scd_integrity")]
    return (f"SELECT *, DATE '{P.EVENTS_AS_OF}' AS check_date, "
            "concat_ws(' ', CAST(records_failed AS VARCHAR), 'of', CAST(records_checked AS VARCHAR), 'rows failed') AS details "
            "FROM (" + "\nUNION ALL\n".join(parts) + ")")


@query("dq_report", _dq_report_sql())
def q_dq_report(spark, sf):
    """Q09: all check rows of one run, stamped with the check date."""
    dim = _customer_scd(spark, sf)  # one dimension build shared by two checks
    parts = [_dq_orders(spark, sf), _dq_events(spark, sf), _dq_customer(spark, sf), _dq_unique(spark, sf, dim),
             _dq_referential(spark, sf), _dq_scd(spark, sf, dim)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("check_date", F.lit(P.EVENTS_AS_OF).cast("date")) \
        .withColumn("details", F.concat_ws(" ", F.col("records_failed").cast("string"), F.lit("of"),
                                           F.col("records_checked").cast("string"), F.lit("rows failed")))


@query("masked_customers", with_(CUST) + """
SELECT customer_id, regexp_replace(email, '^[^@]*', '***') AS email, first_name, last_name, country, state, city FROM cust""")
def q_masked_customers(spark, sf):
    masked, _missing = governance.mask_columns(T.customers(spark, sf), ["email", "phone"])
    return masked


# ------------------------------------------------------------ sinks / io --

@query("ingest_json_events", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(NULL AS VARCHAR) AS _corrupt_record,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""")
def q_ingest_json_events(spark, sf):
    path = files.land_json(T.read(spark, sf, "events"), scratch_path(spark, "json-landing"))
    return files.read_json_events(spark, path)


@query("load_stamped_events", """
SELECT event_id, user_id AS customer_id, ts AS event_timestamp, TRUE AS loaded_after_event FROM events""")
def q_load_stamped_events(spark, sf):
    """The stamp itself is the wall clock, so its order to the event's
    own time is compared."""
    ev = files.with_load_timestamp(T.raw_events(spark, sf))
    return ev.select("event_id", "customer_id", "event_timestamp",
                     (F.col("load_timestamp") > F.col("event_timestamp")).alias("loaded_after_event"))


@query("quality_log", with_(ORD) + """,
n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT COALESCE(order_total > 200000, FALSE)) AS f FROM ord)
SELECT run, 'fact.orders' AS table_name, 'minimum' AS check_type, n AS records_checked, f AS records_failed
FROM n, (VALUES (1), (2)) r(run)""")
def q_quality_log(spark, sf):
    """Q09: check rows appended to a log, run after run."""
    path = scratch_path(spark, "quality-log")
    rows = quality.run_checks(T.orders(spark, sf), "fact.orders",
                              [("minimum", "order_total", ~F.coalesce(F.col("order_total") > 200000, F.lit(False)))])
    for run in (1, 2):
        log = quality.append_log(rows.withColumn("run", F.lit(run)), path)
    return log.select("run", "table_name", "check_type", "records_checked", "records_failed")


@query("audit_log", with_(ORD) + """,
n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE order_status = 'cancelled') AS f FROM ord)
SELECT pipeline_name, 'success' AS status, n AS rows_processed, n - f AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
       f AS rows_failed, n - f AS rows_in_table FROM n, (VALUES ('load 1'), ('load 2')) r(pipeline_name)""")
def q_audit_log(spark, sf):
    """Q10: two audited loads; the counts agree with the written table."""
    path, log = scratch_path(spark, "audited-orders"), scratch_path(spark, "audit-log")
    o = T.orders(spark, sf)
    for name in ("load 1", "load 2"):
        quality.audited_write(o, path, name, F.col("order_status") == "cancelled", log_path=log)
    n = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
    return spark.read.parquet(log).select("pipeline_name", "status", "rows_processed", "rows_inserted", "rows_updated",
                                          "rows_failed", n.alias("rows_in_table"))


@query("rfm_materialized", with_(ORD, RFM_B) + "SELECT * FROM rfmb")
def q_rfm_materialized(spark, sf):
    return sinks.materialize_table(_rfm_b(spark, sf), "customer_rfm")


_CUTOFF = "2024-01-21"


def _funnel_runs_sql(lookback: int) -> str:
    first = (web_cte(f"WHERE ts < TIMESTAMP '{_CUTOFF}'") + "," + BEH + "," + FACT_BEH)
    first = re.sub(r"\b(ev2|ev|web|beh0|fbeh|beh)\b", r"r1\1", first)
    second = web_cte() + "," + BEH + "," + FACT_BEH

    def daily(src, name):
        return f"""
{name} AS (
  SELECT funnel_date, stage, stage_order, sessions,
         CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS conversion_rate,
         1.0 - CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS drop_off_rate
  FROM (SELECT funnel_date, u.* FROM (
          SELECT session_date AS funnel_date, COUNT(*) AS n0,
                 COUNT(*) FILTER (WHERE total_product_views > 0) AS n1, COUNT(*) FILTER (WHERE total_add_to_cart > 0) AS n2,
                 COUNT(*) FILTER (WHERE checkout_started) AS n3, COUNT(*) FILTER (WHERE purchase_completed) AS n4
          FROM {src} GROUP BY session_date) d,
        LATERAL (SELECT * FROM (VALUES ('Visit', 1, d.n0, d.n0), ('Product View', 2, d.n1, d.n0),
                 ('Add to Cart', 3, d.n2, d.n0), ('Checkout', 4, d.n3, d.n0), ('Purchase', 5, d.n4, d.n0))
                 AS v(stage, stage_order, sessions, first_s)) u))"""
    return ("WITH " + first.strip("\n") + "," + second.strip("\n") + "," + daily("r1fbeh", "run1").strip("\n")
            + "," + daily("fbeh", "run2").strip("\n") + f""",
hwm AS (SELECT MAX(funnel_date) AS m FROM run1)
SELECT run1.* FROM run1, hwm WHERE funnel_date <= m - {lookback}
UNION ALL
SELECT run2.* FROM run2, hwm WHERE funnel_date > m - {lookback}""")


def funnel_days(spark, sf, since=None, end=None):
    """Daily funnel of the sessions that start on ``since`` or later.  Events
    are read from one gap before that day: a session that goes on over its
    midnight then shows its first event before it."""
    raw = T.raw_events(spark, sf)
    if since is not None:
        first = F.lit(since).cast("timestamp_ntz") - F.expr(f"INTERVAL {P.SESSION_GAP_SECONDS} SECONDS")
        raw = raw.filter(F.col("event_timestamp") >= first)
    if end is not None:
        raw = raw.filter(F.col("event_timestamp") < F.lit(end).cast("timestamp_ntz"))
    fb = sessions.fact_customer_behavior(sessions.session_behavior(sessions.sessionize(raw, P.SESSION_GAP_SECONDS)))
    if since is not None:
        fb = fb.filter(F.col("session_date") >= F.lit(since))
    return funnel.funnel_daily(fb, ordered=False)


def _funnel_incremental(spark, sf, lookback):
    path = scratch_path(spark, "agg-conversion-funnel")
    for end in (_CUTOFF, None):
        out = sinks.incremental_by_date(lambda since, end=end: funnel_days(spark, sf, since, end), path, "funnel_date", lookback, spark)
    return out.select("funnel_date", "stage", "stage_order", "sessions", "conversion_rate", "drop_off_rate")


@query("funnel_incremental", _funnel_runs_sql(0))
def q_funnel_incremental(spark, sf):
    """The strict filter, as an option."""
    return _funnel_incremental(spark, sf, 0)


@query("funnel_incremental_lookback", _funnel_runs_sql(sinks.LOOKBACK_DAYS))
def q_funnel_incremental_lookback(spark, sf):
    """The default look-back: late days are counted again."""
    return _funnel_incremental(spark, sf, sinks.LOOKBACK_DAYS)


_SNAP_DATE = "2001-01-01"


@query("orders_snapshot_diff", with_(ORD) + f""",
old AS (SELECT order_id, customer_id, order_total,
               CASE WHEN order_date >= TIMESTAMP '{_SNAP_DATE}' - INTERVAL 30 DAY THEN 'pending' ELSE order_status END AS order_status
        FROM ord WHERE order_date < TIMESTAMP '{_SNAP_DATE}')
SELECT COALESCE(n.order_id, o.order_id) AS order_id,
       CASE WHEN o.order_id IS NULL THEN 'INSERT' WHEN n.order_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change_type,
       CASE WHEN n.order_id IS NOT NULL THEN n.customer_id ELSE o.customer_id END AS customer_id,
       CASE WHEN n.order_id IS NOT NULL THEN n.order_total ELSE o.order_total END AS order_total,
       CASE WHEN n.order_id IS NOT NULL THEN n.order_status ELSE o.order_status END AS order_status
FROM old o FULL OUTER JOIN ord n ON o.order_id = n.order_id
WHERE o.order_id IS NULL OR n.order_id IS NULL OR o.customer_id IS DISTINCT FROM n.customer_id
      OR o.order_total IS DISTINCT FROM n.order_total OR o.order_status IS DISTINCT FROM n.order_status""")
def q_orders_snapshot_diff(spark, sf):
    """Earlier extract (orders before the snapshot date, the last 30
    days still pending) against the current table."""
    cur = T.orders(spark, sf)
    sd = F.lit(_SNAP_DATE).cast("timestamp_ntz")
    old = cur.filter(F.col("order_date") < sd).withColumn(
        "order_status", F.when(F.col("order_date") >= F.date_sub(sd.cast("date"), 30).cast("timestamp_ntz"),
                               F.lit("pending")).otherwise(F.col("order_status")))
    return sinks.snapshot_diff(old, cur, "order_id", ["customer_id", "order_total", "order_status"])


@query("clustered_orders", with_(ORD) + """
SELECT order_id, customer_id, order_date, order_status, order_total, CAST(year(order_date) AS INTEGER) AS order_year FROM ord""")
def q_clustered_orders(spark, sf):
    o = _forders(spark, sf).select("order_id", "customer_id", "order_date", "order_status", "order_total") \
        .withColumn("order_year", F.year("order_date"))
    out = sinks.clustered_write(o, scratch_path(spark, "fact-orders-clustered"), ["order_date", "customer_id"],
                                partition_by="order_year")
    return out.select("order_id", "customer_id", "order_date", "order_status", "order_total", "order_year")


@query("export_segments", with_(ORD, RFM_A) + "SELECT * FROM seg")
def q_export_segments(spark, sf):
    seg = rfm.rfm_segments(T.orders(spark, sf), P.AS_OF)
    return sinks.export(seg, scratch_path(spark, "export-segments"), "csv")


# -------------------------------------------------------------- streaming --

def _landed_events(spark, sf, name, copies=1):
    """Eight landed files that are not in order of time; each holds a share of
    all days."""
    raw = T.read(spark, sf, "events").select(*[f.name for f in RAW_EVENTS.fields])
    data = raw
    for _ in range(copies - 1):
        data = data.unionByName(raw)
    return ingest.land(data, scratch_path(spark, name), F.pmod(F.xxhash64("event_id"), F.lit(8)), files=8)


_STAGED_EVENTS_SQL = """
SELECT event_id, user_id AS customer_id, ts AS event_timestamp, event_type, 1 AS page_views,
       CAST(event_type = 'view' AS INTEGER) AS product_views, CAST(event_type = 'click' AS INTEGER) AS add_to_cart,
       CAST(event_type = 'signup' AS INTEGER) AS checkout_started,
       CAST(event_type = 'purchase' AS INTEGER) AS purchase_completed
FROM events"""


@query("stream_ingest_events", _STAGED_EVENTS_SQL)
def q_stream_ingest_events(spark, sf):
    """The staged rows (the wall-clock ``load_timestamp`` column is
    checked in the streaming tests, not compared here)."""
    landing = _landed_events(spark, sf, "landing-events")
    out = ingest.ingest_events(spark, landing, scratch_path(spark, "staging-web-events"),
                               scratch_path(spark, "ckpt-ingest"), max_files_per_trigger=2)
    return out.drop("load_timestamp")


@query("stream_dedup", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_dedup(spark, sf):
    landing = _landed_events(spark, sf, "landing-events-redelivered", copies=2)
    out = ingest.dedup_events_stream(spark, landing, scratch_path(spark, "events-dedup"),
                                     scratch_path(spark, "ckpt-dedup"), max_files_per_trigger=2)
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("stream_daily_metrics", """
SELECT CAST(ts AS DATE) AS metric_date, COUNT(*) AS events, COUNT(DISTINCT user_id) AS visitors,
       COUNT(*) FILTER (WHERE event_type = 'view') AS product_views,
       COUNT(*) FILTER (WHERE event_type = 'click') AS add_to_cart,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS value
FROM events GROUP BY CAST(ts AS DATE)""")
def q_stream_daily_metrics(spark, sf):
    landing = _landed_events(spark, sf, "landing-events-daily")
    out = ingest.daily_metrics_stream(spark, landing, scratch_path(spark, "daily-metrics-stream"),
                                      scratch_path(spark, "ckpt-daily"), max_files_per_trigger=2)
    return out.select("metric_date", "events", "visitors", "product_views", "add_to_cart", "purchases", "value")


def _moved_events(spark, sf):
    """All events, and a second delivery of every fifth, moved by some days or
    without a time: (first deliveries, second ones)."""
    raw = T.read(spark, sf, "events").select(*[f.name for f in RAW_EVENTS.fields])
    raw = raw.withColumn("ts", F.expr("IF(event_id % 11 = 0, CAST(NULL AS TIMESTAMP_NTZ), ts)"))
    days = F.expr("make_dt_interval(CAST(event_id % 7 - 3 AS INT))")
    return raw, raw.where("event_id % 5 = 0").withColumn("ts", F.col("ts") + days)


_MOVED_SQL = """
WITH first AS (SELECT * REPLACE (CASE WHEN event_id % 11 <> 0 THEN ts END AS ts) FROM events),
ev AS (SELECT * FROM first UNION ALL
       SELECT * REPLACE (ts + to_days(CAST(event_id % 7 - 3 AS INTEGER)) AS ts) FROM first WHERE event_id % 5 = 0),
latest AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts DESC NULLS LAST) AS k FROM ev)
"""


def _land_moved(spark, sf, name):
    first, second = _moved_events(spark, sf)
    both = first.withColumn("_n", F.lit(0)).unionByName(second.withColumn("_n", F.lit(1)))
    # the two deliveries of an event are in different files, in either order
    file = F.pmod(F.xxhash64("event_id") + F.col("_n") * 3, F.lit(8))
    return ingest.land(both.withColumn("_f", file.cast("int")).repartitionById(8, "_f").drop("_f", "_n"), scratch_path(spark, name))


@query("stream_dedup_moved", _MOVED_SQL + "SELECT event_id, ts, user_id, event_type, value, props FROM latest WHERE k = 1")
def q_stream_dedup_moved(spark, sf):
    """X02 with re-deliveries that move an event to another day, in a later or
    an earlier batch."""
    out = ingest.dedup_events_stream(spark, _land_moved(spark, sf, "landing-moved"), scratch_path(spark, "events-moved"),
                                     scratch_path(spark, "ckpt-moved"), max_files_per_trigger=2)
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("stream_daily_metrics_moved", _MOVED_SQL + """
SELECT CAST(ts AS DATE) AS metric_date, COUNT(*) AS events, COUNT(DISTINCT user_id) AS visitors,
       COUNT(*) FILTER (WHERE event_type = 'view') AS product_views,
       COUNT(*) FILTER (WHERE event_type = 'click') AS add_to_cart,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS value
FROM latest WHERE k = 1 GROUP BY CAST(ts AS DATE)""")
def q_stream_daily_metrics_moved(spark, sf):
    """X03 over the same deliveries: events without a time have the null day."""
    out = ingest.daily_metrics_stream(spark, _land_moved(spark, sf, "landing-moved-daily"), scratch_path(spark, "daily-moved"),
                                      scratch_path(spark, "ckpt-daily-moved"), max_files_per_trigger=2)
    return out.select("metric_date", "events", "visitors", "product_views", "add_to_cart", "purchases", "value")


_SESSION_COLS = ["customer_id", "session_id", "event_timestamp_min", "event_timestamp_max", "event_timestamp_count",
                 "product_views_sum", "add_to_cart_sum", "checkout_started_sum", "purchase_completed_sum"]


def _stream_sessions(spark, sf):
    landing = _landed_events(spark, sf, "landing-events-sessions")
    return ingest.sessions_stream(spark, landing, scratch_path(spark, "sessions-stream"),
                                  scratch_path(spark, "ckpt-sessions"), P.SESSION_GAP_SECONDS, max_files_per_trigger=2)


@query("stream_sessions", with_(web_cte(), BEH) + f"SELECT {', '.join(_SESSION_COLS)} FROM beh")
def q_stream_sessions(spark, sf):
    return _stream_sessions(spark, sf).select(*_SESSION_COLS)


@query("stream_sessions_closed", with_(web_cte(), BEH) + f"""
SELECT customer_id, event_timestamp_min, event_timestamp_max, event_timestamp_count AS events, product_views_sum AS product_views,
       purchase_completed_sum AS purchase_completed
FROM beh WHERE epoch_us(event_timestamp_max) + {P.SESSION_GAP_SECONDS}000000
      <= (SELECT (epoch_us(MAX(ts)) // 1000 - 86400000) * 1000 FROM events)""")
def q_stream_sessions_closed(spark, sf):
    """X02 and X04 with state in the store: the sessions that the watermark (a
    day behind the last event) has closed.  Events land week by week; a week,
    however many files it has, is drained as one micro-batch."""
    from mercato.streaming import stateful

    staged, landing, closed, ckpt = (scratch_path(spark, x) for x in ("staged-weeks", "landing-weeks", "sessions-closed", "ckpt-closed"))
    raw = T.read(spark, sf, "events").select(*[f.name for f in RAW_EVENTS.fields], F.date_trunc("week", "ts").cast("date").alias("week"))
    raw = raw.where("week IS NOT NULL")
    # the weeks are told apart in one pass over the events
    raw.write.partitionBy("week").parquet(staged)
    weeks = sorted(r[0] for r in raw.select("week").distinct().collect())
    out = spark.createDataFrame([], stateful.OUTPUT)
    for w in weeks:
        spark.read.schema(raw.schema).parquet(staged).where(F.col("week") == F.lit(w)).drop("week").write.mode("append").parquet(landing)
        out = stateful.stateful_sessions(spark, landing, closed, ckpt, P.SESSION_GAP_SECONDS,
                                         max_files_per_trigger=None, closing=w == weeks[-1])
    time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.where("kind = 'session'").select(
        "customer_id", time("first_us").alias("event_timestamp_min"), time("last_us").alias("event_timestamp_max"), "events",
        "product_views", "purchase_completed")


@query("stream_funnel_daily", with_(web_cte(), BEH, FACT_BEH) + _DAILY + """
SELECT funnel_date, stage, stage_order, sessions,
       CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS conversion_rate,
       1.0 - CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS drop_off_rate
FROM st""")
def q_stream_funnel_daily(spark, sf):
    """The daily funnel over the streamed sessions."""
    fact = sessions.fact_customer_behavior(_stream_sessions(spark, sf).drop("start_day"))
    return funnel.funnel_daily(fact, ordered=False)


@query("stream_orders_upsert", with_(ORD) + """,
loads AS (
  SELECT *, 1 AS load_seq FROM ord
  UNION ALL SELECT * REPLACE (order_total + 1 AS order_total, order_date + INTERVAL 40 DAY AS order_date), 3 FROM ord WHERE order_id % 7 = 0
  UNION ALL SELECT * REPLACE (order_total + 2 AS order_total), 2 FROM ord WHERE order_id % 5 = 0),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY load_seq DESC) AS k FROM loads)
SELECT * EXCLUDE (k) REPLACE (CAST(order_total AS DECIMAL(18,2)) AS order_total),
       CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM best WHERE k = 1""")
def q_stream_orders_upsert(spark, sf):
    """Eight files, two a batch, dealt by a hash of order and load, so an
    order's loads arrive in any order: first loads, updates that move an order
    to another month, and reloads that are stale by then."""
    o = T.orders(spark, sf)
    moved = o.filter(F.col("order_id") % 7 == 0).withColumns({
        "order_total": (F.col("order_total") + 1).cast(MONEY), "order_date": F.col("order_date") + F.expr("INTERVAL 40 DAYS")})
    again = o.filter(F.col("order_id") % 5 == 0).withColumn("order_total", (F.col("order_total") + 2).cast(MONEY))
    loads = o.withColumn("load_seq", F.lit(1)).unionByName(moved.withColumn("load_seq", F.lit(3))).unionByName(
        again.withColumn("load_seq", F.lit(2)))
    landing = ingest.land(loads, scratch_path(spark, "landing-orders"), F.pmod(F.xxhash64("order_id", "load_seq"), F.lit(8)), files=8)
    return ingest.orders_upsert_stream(spark, landing, scratch_path(spark, "fact-orders-upsert"),
                                       scratch_path(spark, "ckpt-orders"), loads.schema, max_files_per_trigger=2)
