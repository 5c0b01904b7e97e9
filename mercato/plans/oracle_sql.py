"""DuckDB SQL that computes each registered query independently of Spark.

Fragments are CTEs over the landed tables (views ``events``, ``orders``,
``lineitem``, ``customer``, ``part``, ``nation``, ``region``).  Money stays
exact (DECIMAL, integer cents); ratios are DOUBLE divisions of exact sums.
"""

from mercato.functions.expressions import segment_sql
from mercato.plans import params as P

GAP_US = P.SESSION_GAP_SECONDS * 1_000_000


def web_cte(where: str = "") -> str:
    return f"""
ev AS (
  SELECT event_id, user_id AS customer_id, ts AS event_timestamp, event_type,
         1 AS page_views,
         CAST(event_type = 'view' AS INTEGER) AS product_views,
         CAST(event_type = 'click' AS INTEGER) AS add_to_cart,
         CAST(event_type = 'signup' AS INTEGER) AS checkout_started,
         CAST(event_type = 'purchase' AS INTEGER) AS purchase_completed,
         epoch_us(ts) AS _us,
         LAG(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS _prev
  FROM events {where}),
ev2 AS (SELECT *, CASE WHEN _prev IS NULL OR _us - _prev >= {GAP_US} THEN _us END AS _start FROM ev),
web AS (
  SELECT event_id, customer_id, event_timestamp, event_type, page_views, product_views,
         add_to_cart, checkout_started, purchase_completed,
         CAST(customer_id AS VARCHAR) || '-' || CAST(MAX(_start) OVER (PARTITION BY customer_id
              ORDER BY _us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS session_id
  FROM ev2)"""


BEH = """
beh0 AS (
  SELECT customer_id, session_id,
         MIN(event_timestamp) AS event_timestamp_min, MAX(event_timestamp) AS event_timestamp_max,
         COUNT(event_timestamp) AS event_timestamp_count,
         CAST(SUM(page_views) AS BIGINT) AS page_views_sum,
         CAST(SUM(product_views) AS BIGINT) AS product_views_sum,
         CAST(SUM(add_to_cart) AS BIGINT) AS add_to_cart_sum,
         CAST(SUM(checkout_started) AS BIGINT) AS checkout_started_sum,
         CAST(SUM(purchase_completed) AS BIGINT) AS purchase_completed_sum
  FROM web GROUP BY customer_id, session_id),
beh AS (
  SELECT *, CAST(epoch_us(event_timestamp_max) - epoch_us(event_timestamp_min) AS DOUBLE) / 1e6 AS session_duration_seconds,
         CAST(purchase_completed_sum > 0 AS INTEGER) AS converted,
         CAST(add_to_cart_sum > 0 AND purchase_completed_sum = 0 AS INTEGER) AS abandoned_cart
  FROM beh0)"""

FACT_BEH = """
fbeh AS (
  SELECT CAST(strftime(event_timestamp_min, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(event_timestamp_min AS DATE) AS session_date,
         customer_id, session_id,
         page_views_sum AS total_page_views, product_views_sum AS total_product_views,
         add_to_cart_sum AS total_add_to_cart, CAST(0 AS BIGINT) AS total_remove_from_cart,
         checkout_started_sum > 0 AS checkout_started, purchase_completed_sum > 0 AS purchase_completed,
         add_to_cart_sum > 0 AND purchase_completed_sum = 0 AS cart_abandoned,
         CAST((epoch_us(event_timestamp_max) - epoch_us(event_timestamp_min)) // 1000000 AS INTEGER) AS session_duration_seconds
  FROM beh)"""


def ord_cte(where: str = "") -> str:
    return f"""
ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled' END AS order_status,
         CAST(o_totalprice AS DECIMAL(18,2)) AS order_total,
         CAST(0 AS DECIMAL(18,2)) AS shipping_cost, CAST(0 AS DECIMAL(18,2)) AS tax_amount,
         CAST(0 AS DECIMAL(18,2)) AS discount_amount, CAST(NULL AS VARCHAR) AS payment_method
  FROM orders {where})"""


ORD = ord_cte()

SEGMENT_CASE = segment_sql()

RFM_SCORE = "CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)"

RFM_A = f"""
rfm AS (
  SELECT customer_id,
         CAST(FLOOR(CAST(epoch_us(TIMESTAMP '{P.AS_OF}') - epoch_us(MAX(order_date)) AS DOUBLE) / 86400000000.0) AS BIGINT) AS recency,
         COUNT(order_id) AS frequency, CAST(SUM(order_total) AS DECIMAL(28,2)) AS monetary
  FROM ord GROUP BY customer_id),
q AS (
  SELECT quantile_cont(CAST(recency AS DOUBLE), [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS rq,
         quantile_cont(CAST(frequency AS DOUBLE), [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS fq,
         quantile_cont(CAST(monetary AS DOUBLE), [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS mq
  FROM rfm),
scored AS (
  SELECT rfm.*,
    CAST(CASE WHEN CAST(recency AS DOUBLE) <= rq[2] THEN 5 WHEN CAST(recency AS DOUBLE) <= rq[3] THEN 4
         WHEN CAST(recency AS DOUBLE) <= rq[4] THEN 3 WHEN CAST(recency AS DOUBLE) <= rq[5] THEN 2
         WHEN CAST(recency AS DOUBLE) <= rq[6] THEN 1 END AS INTEGER) AS r_score,
    CAST(CASE WHEN CAST(frequency AS DOUBLE) <= fq[2] THEN 1 WHEN CAST(frequency AS DOUBLE) <= fq[3] THEN 2
         WHEN CAST(frequency AS DOUBLE) <= fq[4] THEN 3 WHEN CAST(frequency AS DOUBLE) <= fq[5] THEN 4
         WHEN CAST(frequency AS DOUBLE) <= fq[6] THEN 5 END AS INTEGER) AS f_score,
    CAST(CASE WHEN CAST(monetary AS DOUBLE) <= mq[2] THEN 1 WHEN CAST(monetary AS DOUBLE) <= mq[3] THEN 2
         WHEN CAST(monetary AS DOUBLE) <= mq[4] THEN 3 WHEN CAST(monetary AS DOUBLE) <= mq[5] THEN 4
         WHEN CAST(monetary AS DOUBLE) <= mq[6] THEN 5 END AS INTEGER) AS m_score
  FROM rfm, q),
seg AS (SELECT *, {RFM_SCORE} AS rfm_score, {SEGMENT_CASE} AS segment FROM scored)"""

RFM_B = f"""
po AS (
  SELECT customer_id, order_id, MAX(order_date) AS order_date, SUM(order_total) AS order_total
  FROM ord WHERE order_status = 'completed' GROUP BY customer_id, order_id),
m AS (
  SELECT po.customer_id,
         CAST(date_diff('day', CAST(MAX(order_date) AS DATE), DATE '{P.AS_OF}') AS INTEGER) AS recency_days,
         COUNT(order_id) AS frequency, CAST(SUM(order_total) AS DECIMAL(28,2)) AS monetary,
         CAST(MIN(order_date) AS DATE) AS first_order_date, CAST(MAX(order_date) AS DATE) AS last_order_date
  FROM po JOIN customer c ON c.c_custkey = po.customer_id GROUP BY po.customer_id),
s AS (
  SELECT *, CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
         CAST(NTILE(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
         CAST(NTILE(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
  FROM m),
rfmb AS (
  SELECT customer_id, recency_days, frequency, monetary, r_score, f_score, m_score,
         {RFM_SCORE} AS rfm_score, {SEGMENT_CASE} AS customer_segment,
         first_order_date, last_order_date, frequency AS total_orders, monetary AS total_revenue,
         CAST(monetary AS DOUBLE) / NULLIF(CAST(frequency AS DOUBLE), 0) AS avg_order_value
  FROM s)"""


def rfm_b_cte(name: str, as_of: str, before: str | None = None) -> str:
    """The warehouse RFM model as one CTE ``name`` (orders before ``before``
    only, when given), for point-in-time segment snapshots."""
    cond = f" AND order_date < TIMESTAMP '{before}'" if before else ""
    return f"""
{name} AS (
  SELECT customer_id, {RFM_SCORE} AS rfm_score, {SEGMENT_CASE} AS customer_segment
  FROM (SELECT *, CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
               CAST(NTILE(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
               CAST(NTILE(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
        FROM (SELECT po.customer_id,
                     CAST(date_diff('day', CAST(MAX(order_date) AS DATE), DATE '{as_of}') AS INTEGER) AS recency_days,
                     COUNT(order_id) AS frequency, CAST(SUM(order_total) AS DECIMAL(28,2)) AS monetary
              FROM (SELECT customer_id, order_id, MAX(order_date) AS order_date, SUM(order_total) AS order_total
                    FROM ord WHERE order_status = 'completed'{cond} GROUP BY customer_id, order_id) po
              JOIN customer c ON c.c_custkey = po.customer_id GROUP BY po.customer_id)))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"
