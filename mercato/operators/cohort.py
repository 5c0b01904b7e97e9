"""Cohort retention.

Orders are first rolled up to (customer, order month) - map-side partial
aggregation, so a customer with a huge number of orders is no hot spot - and
every per-customer window runs on that grain, which has at most one row per
customer and calendar month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.expressions import month_start, months_between_starts, ratio
from mercato.operators.cleaning import drop_null_keys
from mercato.schemas import MONEY_SUM

#: Month offsets with a column in the retention matrix (ten years).
MATRIX_MONTHS = 120


def cohort_assignment(orders: DataFrame) -> DataFrame:
    """Each order with its customer's first purchase, cohort month and month
    offset.  First purchase per customer is an aggregate joined back (AQE
    splits a hot customer's partition in the join; a window could not)."""
    orders = drop_null_keys(orders, ["customer_id"])
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("first_purchase_date"))
    j = orders.select("order_id", "customer_id", "order_date").join(first, "customer_id")
    return j.select(
        "order_id", "customer_id", "order_date",
        month_start("order_date").alias("order_month"),
        "first_purchase_date",
        month_start("first_purchase_date").alias("cohort_month"),
        months_between_starts(month_start("order_date"), month_start("first_purchase_date")).alias("months_since_first"),
    )


def customer_months(orders: DataFrame) -> DataFrame:
    cm = drop_null_keys(orders, ["customer_id"]).groupBy("customer_id", month_start("order_date").alias("order_month")) \
        .agg(F.sum("order_total").alias("revenue"))
    w = Window.partitionBy("customer_id")  # bounded: one row per month
    return cm.withColumn("cohort_month", F.min("order_month").over(w)) \
        .withColumn("months_since_first", months_between_starts("order_month", "cohort_month"))


def cohort_cells(orders: DataFrame) -> DataFrame:
    """Per cohort and offset: active customers and their revenue."""
    cm = customer_months(orders)
    return cm.groupBy("cohort_month", "months_since_first").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("revenue").cast(MONEY_SUM).alias("revenue"))


def cohort_counts(orders: DataFrame) -> DataFrame:
    return cohort_cells(orders).select("cohort_month", "months_since_first", "customers")


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Long form: customers, % of the cohort's size, revenue."""
    c = cohort_cells(orders)
    w = Window.partitionBy("cohort_month")  # tiny table: cohorts x offsets
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("customers"))).over(w)
    return c.withColumn("cohort_size", size).select(
        "cohort_month", "months_since_first", "customers",
        (ratio("customers", "cohort_size") * 100).alias("retention_rate"),
        "revenue", "cohort_size")


def cohort_retention_limited(orders: DataFrame, retention_periods: int = 12,
                             min_cohort_size: int = 10) -> DataFrame:
    r = cohort_retention(orders)
    return r.filter((F.col("months_since_first") <= retention_periods)
                    & (F.col("cohort_size") >= min_cohort_size))


def cohort_matrix(orders: DataFrame, offsets: list[int] | None = None, months: int = MATRIX_MONTHS) -> DataFrame:
    """Wide form: one row per cohort, ``month_<i>`` = retention % at offset i
    (null where no customer was active).  The columns are those of ``offsets``,
    else of every offset below ``months``: a schema that does not depend on the
    data, and no job to find it.  An offset that has no column raises (unless
    ``offsets`` leaves it out on purpose), so no cell is lost in silence."""
    r = cohort_retention(orders)
    if offsets is None:
        offsets = list(range(months))
        r = r.withColumn("retention_rate", F.when(F.col("months_since_first") < months, F.col("retention_rate")).otherwise(F.raise_error(
            F.concat(F.lit(f"cohort_matrix has {months} months, but orders are apart by "), F.col("months_since_first").cast("string"))).cast("double")))
    return r.groupBy("cohort_month").agg(*[F.expr(
        f"max(retention_rate) FILTER (WHERE months_since_first = {int(i)}) AS month_{int(i)}") for i in offsets])
