"""The reporting views, by name for SQL users (``spark.sql("SELECT * FROM
customer_lifetime_value")``).

Each view is SQL text over the landed files.  Registering one analyses the text
(Spark looks at the footer of each landed table) and computes nothing; every
read lists the files, finds its NTILE cuts and computes the rows anew, so a
view follows its tables.  The cuts are scalar subqueries (``selection``), so no
view sorts its customers or gathers them into one task."""

from __future__ import annotations

from pyspark.sql import SparkSession

from mercato.functions.expressions import segment_sql
from mercato.operators.rfm import NTILE_SCORES
from mercato.operators.selection import ntile_sql
from mercato.plans import params as P
from mercato.sources.tables import staging_sql

MONEY, TOTAL = "DECIMAL(18,2)", "DECIMAL(28,2)"


def activity_sql(days: str) -> str:
    return f"CASE WHEN {days} <= 30 THEN 'Active' WHEN {days} <= 90 THEN 'At Risk' ELSE 'Inactive' END"


def view_sql(sf_dir: str, as_of: str = P.AS_OF, cost_ratio: float = P.COST_RATIO, bins: int = 5) -> dict[str, str]:
    """Name to SQL text, in an order in which views refer to earlier ones."""
    orders, customers, products, items, events = (
        f"({staging_sql(sf_dir, t, cost_ratio)})" for t in ("orders", "customers", "products", "order_items", "event_products"))
    ctes, scored = ntile_sql("m", bins, NTILE_SCORES, "customer_id")
    return {
        "customer_rfm": f"""
WITH po AS (SELECT customer_id, order_id, MAX(order_date) AS order_date, SUM(order_total) AS order_total
  FROM {orders} WHERE order_status = 'completed' GROUP BY customer_id, order_id),
m AS (SELECT customer_id, date_diff(DATE '{as_of}', CAST(MAX(order_date) AS DATE)) AS recency_days, COUNT(order_id) AS frequency,
    CAST(SUM(order_total) AS {TOTAL}) AS monetary, CAST(MIN(order_date) AS DATE) AS first_order_date,
    CAST(MAX(order_date) AS DATE) AS last_order_date
  FROM po JOIN (SELECT customer_id FROM {customers}) USING (customer_id) GROUP BY customer_id),
{ctes.strip()},
scored AS ({scored})
SELECT customer_id, recency_days, frequency, monetary, r_score, f_score, m_score,
  concat(r_score, f_score, m_score) AS rfm_score, {segment_sql()} AS customer_segment, first_order_date, last_order_date,
  frequency AS total_orders, monetary AS total_revenue,
  try_divide(CAST(monetary AS DOUBLE), CAST(frequency AS DOUBLE)) AS avg_order_value
FROM scored""",
        "customer_lifetime_value": f"""
SELECT customer_id, c.first_name, c.last_name, r.customer_segment, r.total_orders, r.total_revenue AS lifetime_value, r.avg_order_value,
  date_diff(r.last_order_date, r.first_order_date) AS customer_age_days, r.recency_days, {activity_sql("r.recency_days")} AS activity_status
FROM {customers} c JOIN customer_rfm r USING (customer_id)""",
        "product_performance": f"""
WITH sold AS (SELECT i.order_id, i.product_id, SUM(i.quantity) AS q, SUM(i.line_total) AS r,
    SUM(CAST(i.line_total - CAST(p.cost * i.quantity AS {MONEY}) AS {MONEY})) AS p
  FROM {items} i LEFT JOIN {products} p ON p.product_id = i.product_id GROUP BY i.order_id, i.product_id),
bought AS (SELECT product_id, CAST(order_date AS DATE) AS metric_date, COUNT(*) AS purchases, CAST(SUM(q) AS BIGINT) AS quantity_sold,
    CAST(SUM(r) AS {TOTAL}) AS revenue, CAST(SUM(p) AS {TOTAL}) AS profit
  FROM sold JOIN {orders} USING (order_id) GROUP BY product_id, CAST(order_date AS DATE)),
seen AS (SELECT product_id, metric_date, COUNT_IF(viewed) AS views, COUNT_IF(carted) AS add_to_cart FROM {events} GROUP BY product_id, metric_date)
SELECT product_id, metric_date, COALESCE(views, 0) AS views, COALESCE(add_to_cart, 0) AS add_to_cart, COALESCE(purchases, 0) AS purchases,
  COALESCE(quantity_sold, 0) AS quantity_sold, COALESCE(revenue, CAST(0 AS {TOTAL})) AS revenue, COALESCE(profit, CAST(0 AS {TOTAL})) AS profit,
  try_divide(CAST(COALESCE(purchases, 0) AS DOUBLE), CAST(views AS DOUBLE)) AS conversion_rate
FROM seen FULL OUTER JOIN bought USING (product_id, metric_date)""",
        "product_bestsellers": f"""
SELECT product_id, p.product_name, p.category, p.brand, CAST(SUM(f.quantity_sold) AS BIGINT) AS total_quantity_sold,
  CAST(SUM(f.revenue) AS {TOTAL}) AS total_revenue, CAST(SUM(f.profit) AS {TOTAL}) AS total_profit,
  try_divide(SUM(f.conversion_rate), CAST(COUNT(f.conversion_rate) AS DOUBLE)) AS avg_conversion_rate
FROM product_performance f JOIN {products} p USING (product_id)
GROUP BY product_id, p.product_name, p.category, p.brand""",
    }


def register_reporting_views(spark: SparkSession, sf_dir: str, as_of: str = P.AS_OF, cost_ratio: float = P.COST_RATIO) -> list[str]:
    """Create or replace the views; their names."""
    texts = view_sql(sf_dir, as_of, cost_ratio)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")
    return list(texts)
