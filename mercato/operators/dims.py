"""Date and time dimensions (D01, D02) and dimension helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.expressions import col_, date_key


def date_attributes(d: Column) -> list[Column]:
    dow = (F.dayofweek(d) - 1).cast("int")  # 0 = Sunday
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"),
    ]


def dim_date(spark: SparkSession, start: str = "2020-01-01", n_days: int = 3650) -> DataFrame:
    """Calendar of ``n_days`` days from ``start`` (distributed range)."""
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return spark.range(n_days).select(*date_attributes(d))


def dim_date_spanning(dates: DataFrame, col: str = "d") -> DataFrame:
    """Calendar covering every day between the first and last date present in
    ``dates`` (the facts); its size is the time span, not the row count."""
    span = dates.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*date_attributes(F.col("d")))


# First and last hour of the parts of the day and of business hours.
DAY_PARTS = {"Morning": (6, 11), "Afternoon": (12, 17), "Evening": (18, 21)}
OTHER_PART = "Night"
BUSINESS_HOURS = (9, 17)


def time_attributes(tk: Column) -> list[Column]:
    hour = F.floor(tk / 3600).cast("int")
    part = F.lit(OTHER_PART)
    for name, hours in DAY_PARTS.items():
        part = F.when(hour.between(*hours), name).otherwise(part)
    return [
        tk.cast("int").alias("time_key"),
        hour.alias("hour"),
        F.floor((tk % 3600) / 60).cast("int").alias("minute"),
        (tk % 60).cast("int").alias("second"),
        part.alias("time_of_day"),
        hour.between(*BUSINESS_HOURS).alias("is_business_hours"),
    ]


def dim_time(spark: SparkSession) -> DataFrame:
    """All 86,400 seconds of the day."""
    return spark.range(86400).select(*time_attributes(F.col("id")))


def dim_time_with_facts(spark: SparkSession, time_keys: DataFrame, col: str = "time_key") -> DataFrame:
    """All seconds of the day, each with the number of facts in it.  The facts
    are counted per second first (combined map-side), so the join has at most
    86,400 rows on either side."""
    n = time_keys.groupBy(col_(col).alias("time_key")).agg(F.count(F.lit(1)).alias("n_facts"))
    return dim_time(spark).join(n, "time_key", "left").withColumn("n_facts", F.coalesce("n_facts", F.lit(0).cast("long")))
