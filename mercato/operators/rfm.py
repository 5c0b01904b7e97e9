"""RFM metrics, scoring and segmentation.

Two variants:
* A (``rfm_metrics`` -> ``rfm_segments``): all orders, recency as whole
  24-hour periods, frequency = order rows, quantile (qcut-style) scores.
* B (``rfm_ntile``): completed orders of current customers, recency in
  calendar days, distinct orders, ``NTILE(5)`` scores with the customer id as
  tie-break, all three by one selection of their cuts (``selection``: no
  single-partition window, no sort of the customers, no job before the plan runs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import (activity_status, epoch_micros, money_avg, ratio,
                                           rfm_score_string, segment_ladder)
from mercato.operators.cleaning import drop_null_keys
from mercato.operators.ranking import top_k
from mercato.operators.scd import current
from mercato.operators.selection import ntile_scores, quantile_bins, quantile_edges_sql
from mercato.schemas import MONEY_SUM

# Segment descriptions (the first four are the reported ones).
SEGMENTS = [
    ("Champions", "Best customers with high RFM scores", True),
    ("Loyal Customers", "Regular buyers with good engagement", True),
    ("At Risk", "Previously good customers who haven't purchased recently", True),
    ("Lost Customers", "Haven't purchased in a long time", True),
    ("New Customers", "Recent buyers with few orders", False),
    ("Potential Loyalists", "Recent buyers who may become loyal", False),
    ("Regular Customers", "Customers with average scores", False),
]

# Config-driven segment rules (name, min_r, max_r, min_f, max_f,
# min_m, max_m); the first matching rule wins.
SEGMENT_RULES = [
    ("champions", 4, None, 4, None, 4, None),
    ("loyal_customers", 3, None, 3, None, 3, None),
    ("at_risk", None, 2, 3, None, None, None),
    ("lost_customers", None, 2, None, 2, None, None),
]


#: The metrics of variant A, with their units (money in cents).
RFM = {"recency": 1, "frequency": 1, "monetary": 100}
#: What the three NTILE scores order by, as whole numbers.
NTILE_SCORES = {"r_score": "-recency_days", "f_score": "frequency", "m_score": "monetary * 100"}


def _ts(as_of: str):
    return F.lit(as_of).cast("timestamp_ntz")


def rfm_metrics(orders: DataFrame, as_of: str) -> DataFrame:
    """Variant A metrics over all orders.  Recency = floor of whole days
    between the last order and ``as_of``."""
    g = drop_null_keys(orders, ["customer_id"]).groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        F.count("order_id").alias("frequency"),
        F.sum("order_total").alias("monetary"),
    )
    us = (epoch_micros(_ts(as_of)) - epoch_micros("_last")).cast("double")
    return g.select("customer_id",
                    F.floor(us / F.lit(86_400_000_000.0)).cast("long").alias("recency"),
                    "frequency", "monetary")


def rfm_quantile_scores(rfm: DataFrame, bins: int = 5, strict: bool = False) -> DataFrame:
    """Quantile scores, recency labels reversed.  Edges are exact
    linear-interpolated quantiles, found within the plan (``selection``).
    ``strict`` looks at them first and raises if they collapse."""
    probs = [i / bins for i in range(bins + 1)]
    up = list(range(1, bins + 1))
    if strict:
        edges = rfm.sparkSession.sql(f"WITH {quantile_edges_sql('{src}', RFM, probs)} SELECT e FROM edges", src=rfm).first()[0]
        for c, e in (edges or {}).items():
            if len(set(e)) != len(e):
                raise ValueError(f"quantile edges of {c} collapse: {e}")
    out = {"recency": ("r_score", up[::-1]), "frequency": ("f_score", up), "monetary": ("m_score", up)}
    return quantile_bins(rfm, {c: (*to, RFM[c]) for c, to in out.items()}, probs)


def rfm_segments(orders: DataFrame, as_of: str, bins: int = 5, strict: bool = False) -> DataFrame:
    s = rfm_quantile_scores(rfm_metrics(orders, as_of), bins, strict)
    return s.withColumn("rfm_score", rfm_score_string()).withColumn("segment", segment_ladder())


def rules_segment(scores: DataFrame, rules=SEGMENT_RULES, out: str = "rule_segment",
                  default: str | None = None) -> DataFrame:
    """Segment from a rule list (min/max per score); the rule list is
    configuration, so it becomes one CASE expression - no join at all."""
    expr = None
    for name, rmin, rmax, fmin, fmax, mmin, mmax in rules:
        cond = F.lit(True)
        for c, lo, hi in (("r_score", rmin, rmax), ("f_score", fmin, fmax), ("m_score", mmin, mmax)):
            if lo is not None:
                cond = cond & (F.col(c) >= lo)
            if hi is not None:
                cond = cond & (F.col(c) <= hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return scores.withColumn(out, expr.otherwise(F.lit(default)))


def rfm_ntile(customers: DataFrame, orders: DataFrame, as_of: str, n: int = 5) -> DataFrame:
    """Warehouse RFM model (variant B).  Of a customer dimension with versions
    (a column ``is_current``) only the current ones count."""
    if "is_current" in customers.columns:
        customers = current(customers)
    completed = orders.filter(F.col("order_status") == "completed") \
        .select("order_id", "customer_id", "order_date", "order_total")
    # every joined row counts for the sum, an order once for the count; distinct
    # orders per customer in two balanced steps: dedup on
    # (customer, order) first, then a partial+final count per customer.
    per_order = completed.groupBy("customer_id", "order_id").agg(
        F.max("order_date").alias("order_date"), F.sum("order_total").alias("order_total"))
    cust = customers.select("customer_id")
    j = per_order.join(cust, "customer_id", "inner")
    m = j.groupBy("customer_id").agg(
        F.date_diff(F.lit(as_of).cast("date"), F.max("order_date").cast("date")).alias("recency_days"),
        F.count("order_id").alias("frequency"),
        F.sum("order_total").cast(MONEY_SUM).alias("monetary"),
        F.min("order_date").cast("date").alias("first_order_date"),
        F.max("order_date").cast("date").alias("last_order_date"),
    )
    m = ntile_scores(m, n, NTILE_SCORES, "customer_id")
    return m.select(
        "customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        rfm_score_string().alias("rfm_score"),
        segment_ladder().alias("customer_segment"),
        "first_order_date", "last_order_date",
        F.col("frequency").alias("total_orders"),
        F.col("monetary").alias("total_revenue"),
        money_avg("monetary", "frequency").alias("avg_order_value"),
    )


def segment_distribution(segments: DataFrame, col: str = "segment") -> DataFrame:
    return segments.groupBy(col).agg(F.count(F.lit(1)).alias("customers"))


def top_customers(segments: DataFrame, k: int = 10) -> DataFrame:
    return top_k(segments.select("customer_id", "recency", "frequency", "monetary", "segment"), k,
                 [F.col("monetary").desc(), F.col("customer_id")])


def segment_table(spark) -> DataFrame:
    """The 7 segments with descriptions (fixed, 7 rows)."""
    return spark.createDataFrame(SEGMENTS, "segment string, description string, reported boolean")


def segment_profile(segments: DataFrame) -> DataFrame:
    """Per segment: description, customers, average monetary (null when the
    segment is empty).  Aggregate first, then join the 7-row table."""
    agg = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"),
                                          F.sum("monetary").alias("_m"))
    seg = segment_table(segments.sparkSession)
    j = F.broadcast(seg).join(agg, "segment", "left")
    return j.select("segment", "description",
                    F.coalesce(F.col("customers"), F.lit(0).cast("long")).alias("customers"),
                    money_avg("_m", "customers").alias("avg_monetary"), "reported")


def segment_report(rfm_b: DataFrame) -> DataFrame:
    """Dashboard segment table: size, average revenue/orders/recency, status."""
    g = rfm_b.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_revenue").alias("_rev"),
        F.sum("total_orders").alias("_ord"),
        F.sum("recency_days").alias("_rec"),
    )
    avg_rec = ratio("_rec", "customers")
    return g.select("customer_segment", "customers",
                    money_avg("_rev", "customers").alias("avg_revenue"),
                    ratio("_ord", "customers").alias("avg_orders"),
                    avg_rec.alias("avg_recency_days"),
                    activity_status(avg_rec).alias("status"))


def filter_segment(segments: DataFrame, segment: str, col: str = "segment") -> DataFrame:
    return segments.filter(F.col(col) == F.lit(segment))
