"""Registered star-schema queries: scans, dimensions (incl. SCD2), facts,
metrics, KPIs, reporting views (I03-I05, P09, P11, D01-D08, G01-G03,
T01-T08, K01-K02, V01-V02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import cleaning, dims, facts, funnel, metrics, rfm, scd, sessions, views
from mercato.plans import params as P
from mercato.plans.catalog import WEB, _behavior, _fact_behavior, _rfm_b, _web
from mercato.plans.oracle_sql import BEH, FACT_BEH, ORD, RFM_B, ord_cte, rfm_b_cte, with_
from mercato.plans.registry import query
from mercato.sources import tables as T

S1, S2 = P.SNAPSHOT_DATES

CUST = """
cust AS (
  SELECT c.c_custkey AS customer_id, lower(replace(c.c_name, '#', '.')) || '@example.com' AS email,
         split_part(c.c_name, '#', 1) AS first_name, split_part(c.c_name, '#', 2) AS last_name,
         n.n_name AS country, r.r_name AS state, c.c_mktsegment AS city
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PROD = f"""
prod AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_size AS VARCHAR) AS subcategory, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST({P.COST_RATIO} AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS cost
  FROM part)"""

ITEMS = """
lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS extended_price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS discount,
         l_shipdate AS ship_date,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line_position
  FROM lineitem),
items AS (
  SELECT CAST(order_id AS VARCHAR) || '-' || CAST(line_position AS VARCHAR) AS order_item_id, order_id, product_id, quantity,
         CAST(CAST((CAST(extended_price * 100 AS BIGINT) * 2 + quantity) // NULLIF(2 * quantity, 0) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS unit_price,
         discount, extended_price, ship_date, line_position
  FROM lines)"""

FITEMS = """
fitems AS (
  SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.discount,
         CAST(i.extended_price - i.discount AS DECIMAL(18,2)) AS line_total,
         CAST(p.cost * i.quantity AS DECIMAL(18,2)) AS cost,
         CAST(CAST(i.extended_price - i.discount AS DECIMAL(18,2)) - CAST(p.cost * i.quantity AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS profit,
         CAST(CAST(i.extended_price - i.discount AS DECIMAL(18,2)) - CAST(p.cost * i.quantity AS DECIMAL(18,2)) AS DOUBLE)
           / NULLIF(CAST(CAST(i.extended_price - i.discount AS DECIMAL(18,2)) AS DOUBLE), 0) * 100 AS profit_margin_pct
  FROM items i LEFT JOIN prod p ON p.product_id = i.product_id)"""

FORD = """
fo AS (
  SELECT order_id, customer_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, order_date,
         order_status, order_total, shipping_cost, tax_amount, discount_amount,
         CAST(order_total - shipping_cost - tax_amount - discount_amount AS DECIMAL(18,2)) AS net_revenue,
         payment_method,
         (LAG(order_date) OVER w) IS NULL AS is_first_order,
         CAST(date_diff('day', CAST(LAG(order_date) OVER w AS DATE), CAST(order_date AS DATE)) AS INTEGER) AS days_since_last_order
  FROM ord WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id))"""

DATE_COLS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%b') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
  dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday,
  CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter,
  CAST(month(d) AS INTEGER) AS fiscal_month"""

TIME_COLS = """CAST(tk AS INTEGER) AS time_key, CAST(tk // 3600 AS INTEGER) AS hour,
  CAST((tk % 3600) // 60 AS INTEGER) AS minute, CAST(tk % 60 AS INTEGER) AS second,
  CASE WHEN tk // 3600 BETWEEN 6 AND 11 THEN 'Morning' WHEN tk // 3600 BETWEEN 12 AND 17 THEN 'Afternoon'
       WHEN tk // 3600 BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS time_of_day,
  tk // 3600 BETWEEN 9 AND 17 AS is_business_hours"""

CUST_TRACKED = ["email", "first_name", "last_name", "country", "state", "city", "activity_status"]
PROD_TRACKED = ["product_name", "category", "subcategory", "brand", "price", "cost", "margin_pct", "lifecycle"]


def _activity_sql(days: str) -> str:
    return f"CASE WHEN {days} <= 30 THEN 'Active' WHEN {days} <= 90 THEN 'At Risk' ELSE 'Inactive' END"


def _cust_snap_sql(name: str, sd: str) -> str:
    return f"""
{name} AS (
  SELECT cust.*, {_activity_sql(f"date_diff('day', CAST(l.last AS DATE), DATE '{sd}')")} AS activity_status
  FROM cust JOIN (SELECT customer_id, MAX(order_date) AS last FROM ord
                  WHERE order_date < TIMESTAMP '{sd}' GROUP BY customer_id) l USING (customer_id))"""


def _prod_snap_sql(name: str, sd: str) -> str:
    return f"""
{name} AS (
  SELECT prod.*, CAST(price - cost AS DOUBLE) / NULLIF(CAST(price AS DOUBLE), 0) * 100 AS margin_pct,
         CASE WHEN r.product_id IS NOT NULL THEN 'active' ELSE 'dormant' END AS lifecycle
  FROM prod LEFT JOIN (SELECT DISTINCT l_partkey AS product_id FROM lineitem
                       WHERE l_shipdate >= CAST(DATE '{sd}' - 365 AS TIMESTAMP) AND l_shipdate < TIMESTAMP '{sd}') r
       USING (product_id))"""


def _scd2_sql(name: str, key: str, tracked: list[str], s1: str, s2: str) -> str:
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in tracked)
    cols_a = ", ".join(f"a.{c}" for c in [key, *tracked])
    cols_b = ", ".join(f"b.{c}" for c in [key, *tracked])
    return f"""
{name} AS (
  SELECT {cols_a}, DATE '{S1}' AS effective_date,
         CASE WHEN b.{key} IS NOT NULL AND NOT ({same}) THEN DATE '{S2}' END AS expiry_date,
         NOT (b.{key} IS NOT NULL AND NOT ({same})) AS is_current
  FROM {s1} a LEFT JOIN {s2} b ON a.{key} = b.{key}
  UNION ALL
  SELECT {cols_b}, DATE '{S2}', CAST(NULL AS DATE), TRUE
  FROM {s2} b LEFT JOIN {s1} a ON a.{key} = b.{key}
  WHERE a.{key} IS NULL OR NOT ({same}))"""


CUST_SCD = [CUST, ORD, _cust_snap_sql("cs1", S1), _cust_snap_sql("cs2", S2),
            _scd2_sql("dimc", "customer_id", CUST_TRACKED, "cs1", "cs2")]
PROD_SCD = [PROD, _prod_snap_sql("ps1", S1), _prod_snap_sql("ps2", S2),
            _scd2_sql("dimp", "product_id", PROD_TRACKED, "ps1", "ps2")]


def _items(spark, sf):
    return facts.order_item_ids(T.order_items(spark, sf))


def _fitems(spark, sf, line_ids: bool = False):
    items = _items(spark, sf) if line_ids else T.order_items(spark, sf)
    return facts.fact_order_items(items, T.products(spark, sf, P.COST_RATIO))


def _forders(spark, sf):
    return facts.fact_orders(T.orders(spark, sf))


def _customer_scd(spark, sf):
    cu, od = T.customers(spark, sf), T.orders(spark, sf)
    snaps = facts.customer_snapshots(cu, od, P.SNAPSHOT_DATES)
    return scd.scd2_from_rows(snaps, "customer_id", CUST_TRACKED, P.SNAPSHOT_DATES)


def _product_scd(spark, sf):
    pr, li = T.products(spark, sf, P.COST_RATIO), T.order_lines(spark, sf)
    snaps = facts.product_snapshots(pr, li, P.SNAPSHOT_DATES)
    return scd.scd2_from_rows(snaps, "product_id", PROD_TRACKED, P.SNAPSHOT_DATES)


# ------------------------------------------------------------------ scans --

@query("scan_order_items", with_(ITEMS) +
       "SELECT order_item_id, order_id, product_id, quantity, unit_price, discount FROM items")
def q_scan_order_items(spark, sf):
    return _items(spark, sf).select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount")


@query("scan_products", with_(PROD) + "SELECT * FROM prod")
def q_scan_products(spark, sf):
    return T.products(spark, sf, P.COST_RATIO)


@query("scan_customers", with_(CUST) + "SELECT * FROM cust")
def q_scan_customers(spark, sf):
    return T.customers(spark, sf)


_L30 = cleaning.preset_range(P.AS_OF, "30d")


@query("orders_last_30d", with_(ord_cte(
    f"WHERE o_orderdate >= TIMESTAMP '{_L30[0]}' AND o_orderdate < TIMESTAMP '{_L30[1]}' + INTERVAL 1 DAY")) + "SELECT * FROM ord")
def q_orders_last_30d(spark, sf):
    return T.orders(spark, sf, *_L30)


@query("dedup_events", """
SELECT event_id, user_id AS customer_id, ts AS event_timestamp, event_type, 1 AS page_views,
       CAST(event_type = 'view' AS INTEGER) AS product_views, CAST(event_type = 'click' AS INTEGER) AS add_to_cart,
       CAST(event_type = 'signup' AS INTEGER) AS checkout_started,
       CAST(event_type = 'purchase' AS INTEGER) AS purchase_completed, 2 AS load_batch
FROM events""")
def q_dedup_events(spark, sf):
    raw = T.raw_events(spark, sf)
    replayed = raw.withColumn("load_batch", F.lit(1)).unionByName(raw.withColumn("load_batch", F.lit(2)))
    return cleaning.dedup_latest(replayed, ["event_id"], ["load_batch"])


# ------------------------------------------------------------- dimensions --

@query("dim_date", """
WITH span AS (SELECT MIN(d) AS lo, MAX(d) AS hi FROM (
        SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events)),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT """ + DATE_COLS + " FROM days")
def q_dim_date(spark, sf):
    dates = T.read(spark, sf, "orders").select(F.col("o_orderdate").alias("d")) \
        .unionByName(T.read(spark, sf, "events").select(F.col("ts").alias("d")))
    return dims.dim_date_spanning(dates, "d")


@query("dim_time", """
WITH n AS (SELECT tk, COUNT(*) AS n FROM (
    SELECT hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS tk FROM events UNION ALL
    SELECT hour(o_orderdate) * 3600 + minute(o_orderdate) * 60 + second(o_orderdate) FROM orders) GROUP BY tk),
t AS (SELECT s.tk, COALESCE(n.n, 0) AS n_facts FROM range(86400) s(tk) LEFT JOIN n ON n.tk = s.tk)
SELECT """ + TIME_COLS + ", n_facts FROM t")
def q_dim_time(spark, sf):
    from mercato.functions.expressions import time_key

    tks = T.read(spark, sf, "events").select(time_key("ts").alias("time_key")) \
        .unionByName(T.read(spark, sf, "orders").select(time_key("o_orderdate").alias("time_key")))
    return dims.dim_time_with_facts(spark, tks)


@query("dim_customer_scd2", with_(*CUST_SCD) + "SELECT * FROM dimc")
def q_dim_customer_scd2(spark, sf):
    return _customer_scd(spark, sf)


@query("dim_product_scd2", with_(*PROD_SCD) + "SELECT * FROM dimp")
def q_dim_product_scd2(spark, sf):
    return _product_scd(spark, sf)


@query("scd2_asof_lookup", with_(*CUST_SCD) + """
SELECT o.order_id, o.customer_id, o.order_date, d.activity_status, d.effective_date
FROM ord o LEFT JOIN dimc d ON d.customer_id = o.customer_id AND CAST(o.order_date AS DATE) >= d.effective_date
     AND (d.expiry_date IS NULL OR CAST(o.order_date AS DATE) < d.expiry_date)""")
def q_scd2_asof_lookup(spark, sf):
    o = T.orders(spark, sf).select("order_id", "customer_id", "order_date")
    return scd.scd2_lookup(o, _customer_scd(spark, sf), "customer_id", "order_date", ["activity_status"])


@query("scd2_asof_sweep", with_(*CUST_SCD) + """
SELECT o.order_id, o.customer_id, o.order_date, d.activity_status, d.effective_date
FROM ord o LEFT JOIN dimc d ON d.customer_id = o.customer_id AND CAST(o.order_date AS DATE) >= d.effective_date
     AND (d.expiry_date IS NULL OR CAST(o.order_date AS DATE) < d.expiry_date)""")
def q_scd2_asof_sweep(spark, sf):
    """D07 as one sorted stream of facts and versions a key."""
    o = T.orders(spark, sf).select("order_id", "customer_id", "order_date")
    return scd.scd2_sweep(o, _customer_scd(spark, sf), "customer_id", "order_date", ["activity_status"])


@query("dim_customer_with_segment", with_(CUST, ORD, RFM_B) + """
SELECT cust.*, rfmb.customer_segment, rfmb.rfm_score FROM cust LEFT JOIN rfmb USING (customer_id)""")
def q_dim_customer_with_segment(spark, sf):
    return views.customer_with_segment(T.customers(spark, sf), _rfm_b(spark, sf))


@query("dim_customer_segment_scd2", with_(ORD, rfm_b_cte("seg1", S1, S1), rfm_b_cte("seg2", S2, S2),
                                          _scd2_sql("dims", "customer_id", ["customer_segment", "rfm_score"],
                                                    "seg1", "seg2")) + "SELECT * FROM dims")
def q_dim_customer_segment_scd2(spark, sf):
    """D08 then D03: segment write-back as a type-2 history of each
    customer's RFM segment at the snapshot dates."""
    snaps = views.segment_snapshots(T.customers(spark, sf), T.orders(spark, sf), P.SNAPSHOT_DATES)
    return scd.scd2_build(snaps, "customer_id", ["customer_segment", "rfm_score"])


# ------------------------------------------------------------------ facts --

@query("fact_web_events", with_(WEB) + """
SELECT event_id, CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(event_timestamp) * 3600 + minute(event_timestamp) * 60 + second(event_timestamp) AS INTEGER) AS time_key,
       customer_id, session_id, event_type, page_views, product_views, add_to_cart, 0 AS remove_from_cart,
       checkout_started, purchase_completed, event_timestamp
FROM web""")
def q_fact_web_events(spark, sf):
    return facts.fact_web_events(_web(spark, sf))


@query("fact_orders", with_(ORD, FORD) + "SELECT * FROM fo")
def q_fact_orders(spark, sf):
    return _forders(spark, sf)


@query("fact_order_items", with_(PROD, ITEMS, FITEMS) + "SELECT * FROM fitems")
def q_fact_order_items(spark, sf):
    return _fitems(spark, sf, line_ids=True)


# D07 on the facts: the key of the dimension version valid at the fact's time
# (null before the first version).

def _version_key_sql(key: str) -> str:
    return (f"""CASE WHEN d.effective_date IS NOT NULL THEN md5('{{"k0":' || d.{key} || ',"k1":"' """
            """|| strftime(d.effective_date, '%Y-%m-%d') || '"}') END""")


def _asof_sql(key: str, dim: str, day: str) -> str:
    return (f"LEFT JOIN {dim} d ON d.{key} = x.{key} AND {day} >= d.effective_date"
            f" AND (d.expiry_date IS NULL OR {day} < d.expiry_date)")


def _keyed(fact, dim, key, ts, out):
    return scd.scd2_lookup(fact, scd.with_version_key(dim, key, out), key, ts, [out]).drop("effective_date")


@query("fact_orders_keyed", with_(*CUST_SCD) + f"""
SELECT x.order_id, x.customer_id, x.order_date, {_version_key_sql("customer_id")} AS customer_key
FROM ord x {_asof_sql("customer_id", "dimc", "CAST(x.order_date AS DATE)")}""")
def q_fact_orders_keyed(spark, sf):
    o = _forders(spark, sf).select("order_id", "customer_id", "order_date")
    return _keyed(o, _customer_scd(spark, sf), "customer_id", "order_date", "customer_key")


@query("fact_order_items_keyed", with_(ITEMS, *PROD_SCD) + f"""
, oi AS (SELECT i.order_item_id, i.order_id, i.product_id, o.o_orderdate AS order_date FROM items i JOIN orders o ON o.o_orderkey = i.order_id)
SELECT x.order_item_id, x.order_id, x.product_id, x.order_date, {_version_key_sql("product_id")} AS product_key
FROM oi x {_asof_sql("product_id", "dimp", "CAST(x.order_date AS DATE)")}""")
def q_fact_order_items_keyed(spark, sf):
    items = _items(spark, sf).select("order_item_id", "order_id", "product_id")
    dated = items.join(T.orders(spark, sf).select("order_id", "order_date"), "order_id")
    return _keyed(dated, _product_scd(spark, sf), "product_id", "order_date", "product_key") \
        .select("order_item_id", "order_id", "product_id", "order_date", "product_key")


@query("fact_web_events_keyed", with_(*CUST_SCD, WEB) + f"""
SELECT x.event_id, x.customer_id, x.event_timestamp, {_version_key_sql("customer_id")} AS customer_key,
       md5('{{"k0":"' || x.session_id || '"}}') AS session_key
FROM web x {_asof_sql("customer_id", "dimc", "CAST(x.event_timestamp AS DATE)")}""")
def q_fact_web_events_keyed(spark, sf):
    ev = facts.fact_web_events(_web(spark, sf), with_keys=True).select("event_id", "customer_id", "event_timestamp", "session_key")
    return _keyed(ev, _customer_scd(spark, sf), "customer_id", "event_timestamp", "customer_key") \
        .select("event_id", "customer_id", "event_timestamp", "customer_key", "session_key")


@query("dq_version_keys", with_(*CUST_SCD) + f"""
, k AS (SELECT {_version_key_sql("customer_id")} AS customer_key FROM ord x {_asof_sql("customer_id", "dimc", "CAST(x.order_date AS DATE)")})
SELECT 'fact.orders' AS table_name, 'referential' AS check_type, 'customer_key' AS column_name, COUNT(*) AS records_checked,
       CAST(0 AS BIGINT) AS records_failed, 'PASS' AS check_result FROM k WHERE customer_key IS NOT NULL""")
def q_dq_version_keys(spark, sf):
    """Every customer_key of the order fact is a version of the dimension."""
    from mercato.operators import quality

    dim = scd.with_version_key(_customer_scd(spark, sf), "customer_id", "customer_key")
    o = _forders(spark, sf).select("order_id", "customer_id", "order_date")
    keyed = scd.scd2_lookup(o, dim, "customer_id", "order_date", ["customer_key"]).filter("customer_key IS NOT NULL")
    return quality.referential(keyed, dim, "customer_key", "customer_key", "fact.orders", "customer_key")


# ---------------------------------------------------------------- metrics --

_DS = """,
ds AS (SELECT session_date AS metric_date, SUM(s) AS total_sessions, COUNT(*) AS unique_visitors,
              SUM(pv) AS total_page_views, SUM(conv) AS conv, SUM(ab) AS ab
       FROM (SELECT session_date, customer_id, COUNT(*) AS s, SUM(total_page_views) AS pv,
                    COUNT(*) FILTER (WHERE purchase_completed) AS conv, COUNT(*) FILTER (WHERE cart_abandoned) AS ab
             FROM fbeh GROUP BY 1, 2) GROUP BY 1)"""

_DOR = """,
dor AS (SELECT d AS metric_date, SUM(n) AS total_orders, CAST(SUM(rev) AS DECIMAL(28,2)) AS total_revenue,
               COUNT(*) FILTER (WHERE has_first) AS new_customers, COUNT(*) FILTER (WHERE has_repeat) AS returning_customers,
               CAST(COALESCE(SUM(new_rev), 0) AS DECIMAL(28,2)) AS new_customer_revenue
        FROM (SELECT CAST(order_date AS DATE) AS d, customer_id, COUNT(*) AS n, SUM(order_total) AS rev,
                     SUM(CASE WHEN is_first_order THEN order_total END) AS new_rev,
                     bool_or(is_first_order) AS has_first, bool_or(NOT is_first_order) AS has_repeat
              FROM fo GROUP BY 1, 2) GROUP BY 1)"""

_DAILY_METRICS = """,
dm AS (
  SELECT COALESCE(ds.metric_date, dor.metric_date) AS metric_date,
         CAST(COALESCE(total_sessions, 0) AS BIGINT) AS total_sessions,
         CAST(COALESCE(unique_visitors, 0) AS BIGINT) AS unique_visitors,
         CAST(COALESCE(total_page_views, 0) AS BIGINT) AS total_page_views,
         CAST(COALESCE(total_orders, 0) AS BIGINT) AS total_orders,
         CAST(COALESCE(total_revenue, 0) AS DECIMAL(28,2)) AS total_revenue,
         CAST(total_revenue AS DOUBLE) / NULLIF(CAST(total_orders AS DOUBLE), 0) AS avg_order_value,
         CAST(conv AS DOUBLE) / NULLIF(CAST(total_sessions AS DOUBLE), 0) AS conversion_rate,
         CAST(ab AS DOUBLE) / NULLIF(CAST(total_sessions AS DOUBLE), 0) AS cart_abandonment_rate,
         CAST(COALESCE(new_customers, 0) AS BIGINT) AS new_customers,
         CAST(COALESCE(returning_customers, 0) AS BIGINT) AS returning_customers
  FROM ds FULL OUTER JOIN dor ON ds.metric_date = dor.metric_date)"""


def _daily_metrics(spark, sf):
    return metrics.daily_metrics(_fact_behavior(spark, sf), _forders(spark, sf))


@query("daily_metrics", with_(WEB, BEH, FACT_BEH, ORD, FORD) + _DS + _DOR + _DAILY_METRICS + "SELECT * FROM dm")
def q_daily_metrics(spark, sf):
    return _daily_metrics(spark, sf)


@query("new_vs_returning", with_(ORD, FORD) + _DOR + """
SELECT metric_date, new_customers, returning_customers, new_customer_revenue,
       CAST(total_revenue - new_customer_revenue AS DECIMAL(28,2)) AS returning_customer_revenue FROM dor""")
def q_new_vs_returning(spark, sf):
    return metrics.new_vs_returning(_forders(spark, sf))


_PERF = """,
perf AS (
  SELECT product_id, metric_date, CAST(NULL AS BIGINT) AS views, CAST(NULL AS BIGINT) AS add_to_cart,
         COUNT(*) AS purchases, CAST(SUM(q) AS BIGINT) AS quantity_sold,
         CAST(SUM(r) AS DECIMAL(28,2)) AS revenue, CAST(SUM(p) AS DECIMAL(28,2)) AS profit,
         CAST(NULL AS DOUBLE) AS conversion_rate
  FROM (SELECT fi.product_id, CAST(o.o_orderdate AS DATE) AS metric_date, fi.order_id,
               SUM(fi.quantity) AS q, SUM(fi.line_total) AS r, SUM(fi.profit) AS p
        FROM fitems fi JOIN orders o ON o.o_orderkey = fi.order_id GROUP BY 1, 2, 3)
  GROUP BY 1, 2)"""


def _perf(spark, sf):
    return metrics.product_performance(_fitems(spark, sf), T.orders(spark, sf))


@query("product_performance", with_(PROD, ITEMS, FITEMS) + _PERF + "SELECT * FROM perf")
def q_product_performance(spark, sf):
    return _perf(spark, sf)


@query("product_performance_events", with_(PROD, ITEMS, FITEMS) + _PERF + """,
ev AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS product_id, CAST(ts AS DATE) AS metric_date,
              COUNT(*) FILTER (WHERE event_type = 'view') AS views, COUNT(*) FILTER (WHERE event_type = 'click') AS add_to_cart
       FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1, 2)
SELECT COALESCE(e.product_id, p.product_id) AS product_id, COALESCE(e.metric_date, p.metric_date) AS metric_date,
       COALESCE(e.views, 0) AS views, COALESCE(e.add_to_cart, 0) AS add_to_cart, COALESCE(p.purchases, 0) AS purchases,
       COALESCE(p.quantity_sold, 0) AS quantity_sold, COALESCE(p.revenue, CAST(0 AS DECIMAL(28,2))) AS revenue,
       COALESCE(p.profit, CAST(0 AS DECIMAL(28,2))) AS profit,
       CAST(COALESCE(p.purchases, 0) AS DOUBLE) / NULLIF(CAST(e.views AS DOUBLE), 0) AS conversion_rate
FROM ev e FULL OUTER JOIN perf p ON p.product_id = e.product_id AND p.metric_date = e.metric_date""")
def q_product_performance_events(spark, sf):
    """T02 with views and carts: an event's product is its property k (a
    declared mapping of the landed events)."""
    from mercato.schemas import PROPS_JSON

    bridge = T.read(spark, sf, "events").select("event_id", F.from_json("props", PROPS_JSON).getField("k").alias("product_id")) \
        .filter(F.col("product_id").isNotNull())
    return metrics.product_performance(_fitems(spark, sf), T.orders(spark, sf), T.raw_events(spark, sf), bridge)


@query("revenue_trend", with_(ORD) + """
SELECT CASE WHEN GROUPING(day) = 0 THEN 'day' WHEN GROUPING(week) = 0 THEN 'week' ELSE 'month' END AS grain,
       COALESCE(day, week, month) AS period_start, COUNT(*) AS orders,
       CAST(SUM(order_total) AS DECIMAL(28,2)) AS revenue
FROM (SELECT CAST(order_date AS DATE) AS day, CAST(date_trunc('week', order_date) AS DATE) AS week,
             CAST(date_trunc('month', order_date) AS DATE) AS month, order_total FROM ord)
GROUP BY GROUPING SETS ((day), (week), (month))""")
def q_revenue_trend(spark, sf):
    return metrics.revenue_trend(T.orders(spark, sf))


@query("daily_revenue_mv", with_(ORD) + """
SELECT CAST(order_date AS DATE) AS period_start, COUNT(*) AS orders, CAST(SUM(order_total) AS DECIMAL(28,2)) AS revenue
FROM ord GROUP BY 1""")
def q_daily_revenue_mv(spark, sf):
    from mercato.sources.sinks import materialize_table

    return materialize_table(metrics.daily_revenue(T.orders(spark, sf)), "daily_revenue")


@query("revenue_mom_change", with_(ORD) + """,
m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(SUM(order_total) AS DECIMAL(28,2)) AS revenue
      FROM ord GROUP BY 1)
SELECT m.month, m.revenue, p.revenue AS previous_revenue,
       CAST(m.revenue - p.revenue AS DOUBLE) / NULLIF(CAST(p.revenue AS DOUBLE), 0) * 100 AS pct_change
FROM m LEFT JOIN m p ON m.month = CAST(p.month + INTERVAL 1 MONTH AS DATE)""")
def q_revenue_mom_change(spark, sf):
    return metrics.revenue_mom_change(T.orders(spark, sf))


@query("category_rollup", with_(PROD, ITEMS, FITEMS) + """
SELECT p.category, p.subcategory, CAST(GROUPING_ID(p.category, p.subcategory) AS INTEGER) AS grouping_level,
       CAST(SUM(fi.line_total) AS DECIMAL(28,2)) AS revenue, CAST(SUM(fi.quantity) AS BIGINT) AS quantity,
       COUNT(*) AS lines
FROM fitems fi JOIN prod p ON p.product_id = fi.product_id GROUP BY ROLLUP (p.category, p.subcategory)""")
def q_category_rollup(spark, sf):
    return metrics.category_rollup(_fitems(spark, sf), T.products(spark, sf, P.COST_RATIO))


@query("metric_alerts", with_(WEB, BEH, FACT_BEH, ORD, FORD) + _DS + _DOR + _DAILY_METRICS + """
SELECT metric_date, 'low_conversion_rate' AS alert_name, 'warning' AS severity, conversion_rate AS metric_value,
       CAST({lo} AS DOUBLE) AS threshold FROM dm WHERE total_sessions > 0 AND conversion_rate < {lo}
UNION ALL
SELECT metric_date, 'high_cart_abandonment', 'warning', cart_abandonment_rate, CAST({hi} AS DOUBLE)
FROM dm WHERE total_sessions > 0 AND cart_abandonment_rate > {hi}""".format(lo=P.ALERT_MIN_CONVERSION, hi=P.ALERT_MAX_ABANDONMENT))
def q_metric_alerts(spark, sf):
    """T08 with thresholds near the data's own rates, so that alerts occur."""
    return metrics.metric_alerts(_daily_metrics(spark, sf), P.ALERT_MIN_CONVERSION, P.ALERT_MAX_ABANDONMENT)


@query("revenue_drop_alerts", with_(ORD, FORD) + _DOR + """,
w AS (SELECT metric_date, total_revenue, SUM(total_revenue) OVER win AS s, COUNT(*) OVER win AS n FROM dor
      WINDOW win AS (ORDER BY metric_date RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT metric_date, total_revenue AS daily_revenue, CAST(s AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS avg_revenue
FROM w WHERE CAST(total_revenue AS DOUBLE) < 0.5 * (CAST(s AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0))""")
def q_revenue_drop_alerts(spark, sf):
    return metrics.revenue_drop_alerts(metrics.daily_orders(_forders(spark, sf)))


_SUMMARY = """,
summ AS (SELECT (SELECT COUNT(*) FROM events) AS total_events, COUNT(*) AS total_orders,
                COUNT(DISTINCT customer_id) AS unique_customers,
                CAST(SUM(order_total) AS DECIMAL(28,2)) AS total_revenue,
                CAST(SUM(order_total) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS avg_order_value
         FROM ord)"""


@query("summary", with_(ORD) + _SUMMARY + "SELECT * FROM summ")
def q_summary(spark, sf):
    return metrics.summary(T.raw_events(spark, sf), T.orders(spark, sf))


@query("kpis", with_(ORD, WEB, BEH) + _SUMMARY + """,
sflags AS (SELECT session_id, MAX(purchase_completed > 0) AS pur FROM web GROUP BY session_id),
fun AS (SELECT CAST(COUNT(*) FILTER (WHERE pur) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) * 100 AS overall FROM sflags),
bs AS (SELECT CAST(SUM(epoch_us(event_timestamp_max) - epoch_us(event_timestamp_min)) AS DOUBLE) / 1e6 / COUNT(*) AS avg_session_duration,
              CAST(SUM(abandoned_cart) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS cart_abandonment_rate,
              CAST(SUM(page_views_sum) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_page_views FROM beh)
SELECT CAST(round(total_revenue, 2) AS DECIMAL(28,2)) AS total_revenue, round(avg_order_value, 2) AS avg_order_value,
       round(CAST(total_revenue AS DOUBLE) / NULLIF(CAST(unique_customers AS DOUBLE), 0), 2) AS revenue_per_customer,
       round(fun.overall, 2) AS overall_conversion_rate, round(bs.cart_abandonment_rate, 2) AS cart_abandonment_rate,
       round(bs.avg_session_duration, 2) AS avg_session_duration, round(bs.avg_page_views, 2) AS avg_page_views,
       unique_customers AS total_customers, total_orders,
       round(CAST(total_orders AS DOUBLE) / NULLIF(CAST(unique_customers AS DOUBLE), 0), 2) AS orders_per_customer
FROM summ, fun, bs""")
def q_kpis(spark, sf):
    beh = _behavior(spark, sf)
    s = metrics.summary(T.raw_events(spark, sf), T.orders(spark, sf))
    counts = funnel.behavior_counts(beh).select((F.col("n4").cast("double") / F.col("n0") * 100).alias("overall"))
    b = sessions.behavior_summary(beh)
    return metrics.kpis(s, counts, b)


# ------------------------------------------------------------------ views --

@query("customer_lifetime_value", with_(CUST, ORD, RFM_B) + """
SELECT c.customer_id, c.first_name, c.last_name, r.customer_segment, r.total_orders, r.total_revenue AS lifetime_value,
       r.avg_order_value, CAST(date_diff('day', r.first_order_date, r.last_order_date) AS INTEGER) AS customer_age_days,
       r.recency_days, """ + _activity_sql("r.recency_days") + """ AS activity_status
FROM cust c JOIN rfmb r ON r.customer_id = c.customer_id""")
def q_customer_lifetime_value(spark, sf):
    return views.customer_lifetime_value(T.customers(spark, sf), _rfm_b(spark, sf))


@query("customer_ltv_mv", with_(CUST, ORD, RFM_B) + """
SELECT c.customer_id, c.first_name, c.last_name, r.customer_segment, r.total_orders, r.total_revenue AS lifetime_value,
       r.avg_order_value, CAST(date_diff('day', r.first_order_date, r.last_order_date) AS INTEGER) AS customer_age_days,
       r.recency_days, """ + _activity_sql("r.recency_days") + """ AS activity_status
FROM cust c JOIN rfmb r ON r.customer_id = c.customer_id""")
def q_customer_ltv_mv(spark, sf):
    """Customer lifetime value as a stored table."""
    from mercato.sources.sinks import materialize_table

    ltv = views.customer_lifetime_value(T.customers(spark, sf), _rfm_b(spark, sf))
    return materialize_table(ltv, "customer_ltv")


@query("product_bestsellers", with_(PROD, ITEMS, FITEMS) + _PERF + """
SELECT p.product_id, p.product_name, p.category, p.brand, CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity_sold,
       CAST(SUM(revenue) AS DECIMAL(28,2)) AS total_revenue, CAST(SUM(profit) AS DECIMAL(28,2)) AS total_profit,
       CAST(AVG(conversion_rate) AS DOUBLE) AS avg_conversion_rate
FROM prod p JOIN perf ON perf.product_id = p.product_id
GROUP BY 1, 2, 3, 4 ORDER BY total_revenue DESC, p.product_id""")
def q_product_bestsellers(spark, sf):
    return views.product_bestsellers(T.products(spark, sf, P.COST_RATIO), _perf(spark, sf))


# ------------------------------------------------- current versions (P03) --

_RFM_CURRENT = RFM_B.replace("JOIN customer c ON c.c_custkey = po.customer_id", "JOIN dimc c ON c.customer_id = po.customer_id AND c.is_current")


@query("rfm_ntile_current", with_(*CUST_SCD, _RFM_CURRENT) + "SELECT * FROM rfmb")
def q_rfm_ntile_current(spark, sf):
    """R10 over the current versions of D03 (customers with two versions count
    once, those that D03 does not know do not)."""
    return rfm.rfm_ntile(_customer_scd(spark, sf), T.orders(spark, sf), P.AS_OF)


@query("customer_lifetime_value_current", with_(*CUST_SCD, _RFM_CURRENT) + """
SELECT c.customer_id, c.first_name, c.last_name, r.customer_segment, r.total_orders, r.total_revenue AS lifetime_value,
       r.avg_order_value, CAST(date_diff('day', r.first_order_date, r.last_order_date) AS INTEGER) AS customer_age_days,
       r.recency_days, """ + _activity_sql("r.recency_days") + """ AS activity_status
FROM dimc c JOIN rfmb r ON r.customer_id = c.customer_id WHERE c.is_current""")
def q_customer_lifetime_value_current(spark, sf):
    dim = _customer_scd(spark, sf)
    return views.customer_lifetime_value(dim, rfm.rfm_ntile(dim, T.orders(spark, sf), P.AS_OF))


_EVENT_PERF = """,
ev AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS product_id, CAST(ts AS DATE) AS metric_date,
              COUNT(*) FILTER (WHERE event_type = 'view') AS views, COUNT(*) FILTER (WHERE event_type = 'click') AS add_to_cart
       FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1, 2),
eperf AS (SELECT COALESCE(e.product_id, p.product_id) AS product_id, COALESCE(e.metric_date, p.metric_date) AS metric_date,
       COALESCE(e.views, 0) AS views, COALESCE(e.add_to_cart, 0) AS add_to_cart, COALESCE(p.purchases, 0) AS purchases,
       COALESCE(p.quantity_sold, 0) AS quantity_sold, COALESCE(p.revenue, CAST(0 AS DECIMAL(28,2))) AS revenue,
       COALESCE(p.profit, CAST(0 AS DECIMAL(28,2))) AS profit,
       CAST(COALESCE(p.purchases, 0) AS DOUBLE) / NULLIF(CAST(e.views AS DOUBLE), 0) AS conversion_rate
FROM ev e FULL OUTER JOIN perf p ON p.product_id = e.product_id AND p.metric_date = e.metric_date)
"""


def _best_sql(products: str) -> str:
    # rates are ratios of small counts: their mean to nine places does not
    # depend on the order in which they are added
    return f"""
SELECT p.product_id, p.product_name, p.category, p.brand, CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity_sold,
       CAST(SUM(revenue) AS DECIMAL(28,2)) AS total_revenue, CAST(SUM(profit) AS DECIMAL(28,2)) AS total_profit,
       round(AVG(conversion_rate), 9) AS avg_conversion_rate
FROM {products} p JOIN eperf f ON f.product_id = p.product_id GROUP BY 1, 2, 3, 4"""


@query("product_bestsellers_current", with_(ITEMS, *PROD_SCD, FITEMS) + _PERF + _EVENT_PERF + _best_sql("(SELECT * FROM dimp WHERE is_current)"))
def q_product_bestsellers_current(spark, sf):
    """V02 with a real conversion rate, over the current versions of D04."""
    best = views.product_bestsellers(_product_scd(spark, sf), q_product_performance_events(spark, sf))
    return best.withColumn("avg_conversion_rate", F.round("avg_conversion_rate", 9))


# ------------------------------------------------------ views by name (I11) --

def _view(spark, sf, name):
    from mercato.plans.views import register_reporting_views

    register_reporting_views(spark, sf)
    return spark.sql(f"SELECT * FROM {name}")


@query("view_customer_rfm", with_(ORD, RFM_B) + "SELECT * FROM rfmb")
def q_view_customer_rfm(spark, sf):
    return _view(spark, sf, "customer_rfm")


@query("view_customer_lifetime_value", with_(CUST, ORD, RFM_B) + """
SELECT c.customer_id, c.first_name, c.last_name, r.customer_segment, r.total_orders, r.total_revenue AS lifetime_value,
       r.avg_order_value, CAST(date_diff('day', r.first_order_date, r.last_order_date) AS INTEGER) AS customer_age_days,
       r.recency_days, """ + _activity_sql("r.recency_days") + """ AS activity_status
FROM cust c JOIN rfmb r ON r.customer_id = c.customer_id""")
def q_view_customer_lifetime_value(spark, sf):
    return _view(spark, sf, "customer_lifetime_value")


@query("view_product_performance", with_(PROD, ITEMS, FITEMS) + _PERF + _EVENT_PERF + "SELECT * FROM eperf")
def q_view_product_performance(spark, sf):
    return _view(spark, sf, "product_performance")


@query("view_product_bestsellers", with_(PROD, ITEMS, FITEMS) + _PERF + _EVENT_PERF + _best_sql("prod"))
def q_view_product_bestsellers(spark, sf):
    return _view(spark, sf, "product_bestsellers").withColumn("avg_conversion_rate", F.round("avg_conversion_rate", 9))


@query("at_risk_customers", with_(ORD, RFM_B) + """,
a AS (SELECT customer_id, recency_days, customer_segment, """ + _activity_sql("recency_days") + """ AS activity_status FROM rfmb)
SELECT *, CASE WHEN customer_segment = 'At Risk' AND activity_status = 'At Risk' THEN 'segment+recency'
               WHEN customer_segment = 'At Risk' THEN 'segment' ELSE 'recency' END AS reason
FROM a WHERE customer_segment = 'At Risk' OR activity_status = 'At Risk'""")
def q_at_risk_customers(spark, sf):
    return views.at_risk_customers(_rfm_b(spark, sf))

