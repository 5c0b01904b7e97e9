"""Reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import activity_status, ratio
from mercato.operators.scd import current
from mercato.schemas import MONEY_SUM


def _current(dim: DataFrame) -> DataFrame:
    """The current versions of a dimension that has versions."""
    return current(dim) if "is_current" in dim.columns else dim


def customer_lifetime_value(customers: DataFrame, rfm_b: DataFrame) -> DataFrame:
    """``customers`` is the landed table, or a dimension of which the current
    versions count."""
    c = _current(customers).select("customer_id", "first_name", "last_name")
    j = c.join(rfm_b, "customer_id")
    return j.select(
        "customer_id", "first_name", "last_name", "customer_segment", "total_orders",
        F.col("total_revenue").alias("lifetime_value"), "avg_order_value",
        F.date_diff("last_order_date", "first_order_date").alias("customer_age_days"),
        "recency_days", activity_status("recency_days").alias("activity_status"))


def product_bestsellers(products: DataFrame, performance: DataFrame) -> DataFrame:
    """Aggregate the performance table per product first, then join the
    product attributes (the join sees one row per product; of a dimension the
    current versions count).  The conversion rate is the mean of the days that
    have one."""
    g = performance.groupBy("product_id").agg(
        F.sum("quantity_sold").cast("long").alias("total_quantity_sold"),
        F.sum("revenue").cast(MONEY_SUM).alias("total_revenue"),
        F.sum("profit").cast(MONEY_SUM).alias("total_profit"),
        F.sum("conversion_rate").alias("_cr"), F.count("conversion_rate").alias("_crn"))
    p = _current(products).select("product_id", "product_name", "category", "brand")
    j = p.join(g, "product_id")
    return j.select("product_id", "product_name", "category", "brand", "total_quantity_sold",
                    "total_revenue", "total_profit", ratio("_cr", "_crn").alias("avg_conversion_rate")) \
        .orderBy(F.col("total_revenue").desc(), "product_id")


def at_risk_customers(rfm_b: DataFrame) -> DataFrame:
    """Customers flagged by the segment ladder or by the recency rule."""
    a = rfm_b.select("customer_id", "recency_days", "customer_segment",
                     activity_status("recency_days").alias("activity_status"))
    seg, act = F.col("customer_segment") == "At Risk", F.col("activity_status") == "At Risk"
    return a.filter(seg | act).withColumn(
        "reason", F.when(seg & act, "segment+recency").when(seg, "segment").otherwise("recency"))


def segment_snapshots(customers: DataFrame, orders: DataFrame, dates) -> list[tuple[str, DataFrame]]:
    """RFM segment of every customer as of each date (only orders placed
    before it): the snapshots that feed the segment history (D08 -> D03)."""
    from mercato.operators.rfm import rfm_ntile

    out = []
    for d in dates:
        before = orders.filter(F.col("order_date") < F.lit(d).cast("timestamp_ntz"))
        out.append((d, rfm_ntile(customers, before, d).select("customer_id", "customer_segment", "rfm_score")))
    return out


def customer_with_segment(customers_current: DataFrame, rfm_b: DataFrame) -> DataFrame:
    """Segment write-back: current customers with segment and RFM score."""
    r = rfm_b.select("customer_id", "customer_segment", "rfm_score")
    return customers_current.join(r, "customer_id", "left")
