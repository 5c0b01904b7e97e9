"""Registered cohort and market-basket queries."""

from __future__ import annotations

from mercato.operators import affinity, cohort
from mercato.plans import params as P
from mercato.plans.oracle_sql import ORD, with_
from mercato.plans.registry import query
from mercato.sources import tables as T

# ---------------------------------------------------------------- cohorts --

_CELLS = """,
cm AS (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month,
              SUM(order_total) AS rev FROM ord GROUP BY 1, 2),
cc AS (SELECT *, MIN(order_month) OVER (PARTITION BY customer_id) AS cohort_month FROM cm),
cells AS (SELECT cohort_month,
                 CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS INTEGER) AS months_since_first,
                 COUNT(*) AS customers, CAST(SUM(rev) AS DECIMAL(28,2)) AS revenue
          FROM cc GROUP BY 1, 2),
ret AS (SELECT *, MAX(CASE WHEN months_since_first = 0 THEN customers END) OVER (PARTITION BY cohort_month) AS cohort_size
        FROM cells),
ret2 AS (SELECT cohort_month, months_since_first, customers,
                CAST(customers AS DOUBLE) / NULLIF(CAST(cohort_size AS DOUBLE), 0) * 100 AS retention_rate,
                revenue, cohort_size FROM ret)
"""


@query("cohort_assignment", with_(ORD) + """,
f AS (SELECT customer_id, MIN(order_date) AS first_purchase_date FROM ord GROUP BY customer_id)
SELECT o.order_id, o.customer_id, o.order_date, CAST(date_trunc('month', o.order_date) AS DATE) AS order_month,
       f.first_purchase_date, CAST(date_trunc('month', f.first_purchase_date) AS DATE) AS cohort_month,
       CAST((year(o.order_date) - year(f.first_purchase_date)) * 12 + month(o.order_date) - month(f.first_purchase_date) AS INTEGER) AS months_since_first
FROM ord o JOIN f USING (customer_id)""")
def q_cohort_assignment(spark, sf):
    return cohort.cohort_assignment(T.orders(spark, sf))


@query("cohort_counts", with_(ORD) + _CELLS + "SELECT cohort_month, months_since_first, customers FROM cells")
def q_cohort_counts(spark, sf):
    return cohort.cohort_counts(T.orders(spark, sf))


@query("cohort_retention", with_(ORD) + _CELLS + "SELECT * FROM ret2")
def q_cohort_retention(spark, sf):
    return cohort.cohort_retention(T.orders(spark, sf))


@query("cohort_retention_limited", with_(ORD) + _CELLS +
       f"SELECT * FROM ret2 WHERE months_since_first <= {P.RETENTION_PERIODS} AND cohort_size >= {P.MIN_COHORT_SIZE}")
def q_cohort_retention_limited(spark, sf):
    return cohort.cohort_retention_limited(T.orders(spark, sf), P.RETENTION_PERIODS, P.MIN_COHORT_SIZE)


@query("cohort_matrix", with_(ORD) + _CELLS + "SELECT cohort_month, " + ", ".join(
    f"MAX(CASE WHEN months_since_first = {i} THEN retention_rate END) AS month_{i}" for i in range(cohort.MATRIX_MONTHS))
    + " FROM ret2 GROUP BY cohort_month")
def q_cohort_matrix(spark, sf):
    return cohort.cohort_matrix(T.orders(spark, sf))


# --------------------------------------------------------------- affinity --

def _brand_items(spark, sf):
    li = T.order_lines(spark, sf).select("order_id", "product_id", "line_sort")
    return li.join(T.products(spark, sf).select("product_id", "brand"), "product_id")


_LI_POS = """
li AS (SELECT l_orderkey AS order_id, l_partkey AS item,
              ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos
       FROM lineitem)"""

_CANON = """
di AS (SELECT DISTINCT order_id, item FROM {src}),
pr AS (SELECT a.item AS product_a, b.item AS product_b, COUNT(*) AS co_occurrence_count
       FROM di a JOIN di b ON a.order_id = b.order_id AND a.item < b.item GROUP BY 1, 2),
ic AS (SELECT item, COUNT(*) AS n FROM di GROUP BY item),
tot AS (SELECT COUNT(*) AS n FROM orders),
lift AS (SELECT pr.product_a, pr.product_b, pr.co_occurrence_count,
                CAST(pr.co_occurrence_count AS DOUBLE) / tot.n AS support,
                CAST(pr.co_occurrence_count AS DOUBLE) / NULLIF(CAST(a.n AS DOUBLE), 0) AS confidence,
                CAST(pr.co_occurrence_count AS DOUBLE) * tot.n / (CAST(a.n AS DOUBLE) * b.n) AS lift,
                a.n AS n_a, b.n AS n_b
         FROM pr JOIN ic a ON a.item = pr.product_a JOIN ic b ON b.item = pr.product_b, tot)"""

_PART_ITEMS = "pit AS (SELECT l_orderkey AS order_id, l_partkey AS item FROM lineitem)"
_BRAND_ITEMS = "bit AS (SELECT l.l_orderkey AS order_id, p.p_brand AS item FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)"


@query("affinity_positional", with_(_LI_POS) + """
SELECT a.item AS product_a, b.item AS product_b, COUNT(*) AS co_occurrence_count,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM orders) AS support
FROM li a JOIN li b ON a.order_id = b.order_id AND a.pos < b.pos GROUP BY 1, 2""")
def q_affinity_positional(spark, sf):
    return affinity.affinity_positional(T.order_lines(spark, sf), T.read(spark, sf, "orders"))


@query("product_affinity", with_(_PART_ITEMS, _CANON.format(src="pit")) +
       "SELECT product_a, product_b, co_occurrence_count, support FROM lift")
def q_product_affinity(spark, sf):
    return affinity.product_affinity(T.order_lines(spark, sf), T.read(spark, sf, "orders"))


@query("affinity_lift", with_(_PART_ITEMS, _CANON.format(src="pit")) +
       "SELECT product_a, product_b, co_occurrence_count, support, confidence, lift FROM lift")
def q_affinity_lift(spark, sf):
    return affinity.affinity_lift(T.order_lines(spark, sf), T.read(spark, sf, "orders"))


@query("affinity_top", with_(_BRAND_ITEMS, _CANON.format(src="bit")) + f"""
SELECT product_a, product_b, co_occurrence_count, support, confidence, lift FROM lift
WHERE support >= {P.MIN_SUPPORT} ORDER BY co_occurrence_count DESC, product_a, product_b LIMIT {P.TOP_PAIRS}""")
def q_affinity_top(spark, sf):
    return affinity.affinity_top(_brand_items(spark, sf), T.read(spark, sf, "orders"), "brand",
                                 min_support=P.MIN_SUPPORT, limit=P.TOP_PAIRS)


@query("affinity_configured", with_(_BRAND_ITEMS, _CANON.format(src="bit")) + f"""
SELECT product_a, product_b, co_occurrence_count, support, confidence, lift FROM lift
WHERE support >= {P.MIN_SUPPORT} AND confidence >= {P.MIN_CONFIDENCE} AND lift >= {P.MIN_LIFT}
ORDER BY co_occurrence_count DESC, product_a, product_b LIMIT {P.MAX_PAIRS}""")
def q_affinity_configured(spark, sf):
    """M05 with all configured thresholds as parameters."""
    return affinity.affinity_top(_brand_items(spark, sf), T.read(spark, sf, "orders"), "brand", min_support=P.MIN_SUPPORT,
                                 min_confidence=P.MIN_CONFIDENCE, min_lift=P.MIN_LIFT, limit=P.MAX_PAIRS)


@query("cross_sell", with_(_BRAND_ITEMS, _CANON.format(src="bit")) + f""",
bth AS (SELECT product_a AS product_id, product_b AS recommended_product_id, co_occurrence_count, support, confidence, lift FROM lift
         UNION ALL
         SELECT product_b, product_a, co_occurrence_count, support,
                CAST(co_occurrence_count AS DOUBLE) / NULLIF(CAST(n_b AS DOUBLE), 0), lift FROM lift),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY lift DESC, confidence DESC, recommended_product_id) AS rank FROM bth)
SELECT product_id, recommended_product_id, co_occurrence_count, support, confidence, lift, CAST(rank AS INTEGER) AS rank
FROM r WHERE rank <= {P.CROSS_SELL_K}""")
def q_cross_sell(spark, sf):
    return affinity.cross_sell(_brand_items(spark, sf), T.read(spark, sf, "orders"), "brand", P.CROSS_SELL_K)

