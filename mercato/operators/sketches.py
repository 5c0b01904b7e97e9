"""Stored visitor sketches (T01, K02): distinct visitors of any range of days
from the days alone.

A day's row holds an HLL sketch of its visitors.  Sketches merge, so a month or
any other range is a union of some days' sketches and reads no event; visitors
who come on several days count once.  The relative standard error of an
estimate is ``ERROR`` (small sets are exact)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers.
LOG_K = 14
ERROR = 1.04 / math.sqrt(1 << LOG_K)


def daily_visitors(events: DataFrame, user: str = "customer_id", ts: str = "event_timestamp") -> DataFrame:
    """(day, events, visitors_sketch) to be stored, one row a day."""
    return events.groupBy(F.col(ts).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.hll_sketch_agg(user, F.lit(LOG_K)).alias("visitors_sketch"))


def estimate(sketch: str | Column = "visitors_sketch") -> Column:
    """Visitors of the rows of a group, from their sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def visitors_between(days: DataFrame, start: str, end: str) -> DataFrame:
    """Events and estimated visitors from ``start`` to ``end`` (both included)."""
    return days.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).agg(
        F.sum("events").alias("events"), estimate().alias("visitors"))


def visitors_by(days: DataFrame, period: Column, out: str = "period") -> DataFrame:
    """Events and estimated visitors by a function of the day (month, week)."""
    return days.groupBy(period.alias(out)).agg(F.sum("events").alias("events"), estimate().alias("visitors"))
