"""Registered queries over changes, sketches, curves and semi-structured landing
(I06, I10, I12, I14, T01, X03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import epoch_micros
from mercato.operators import funnel, incremental, sketches
from mercato.operators.sessions import fact_customer_behavior, session_behavior, sessionize
from mercato.plans import params as P
from mercato.plans.oracle_sql import BEH, FACT_BEH, ORD, web_cte, with_
from mercato.plans.catalog import _DAILY
from mercato.plans.registry import query
from mercato.schemas import MONEY, RAW_EVENTS
from mercato.session import scratch_path
from mercato.sources import files, sinks
from mercato.sources import tables as T

# ------------------------------------------- aggregates from changes (I12) --
# The table as it was: some rows are not there yet, some differ, and some have
# been deleted since.  Each query stores the aggregate of that, applies the
# changes, and must equal the aggregate of the table as it is.


def _orders_before(cur: DataFrame) -> DataFrame:
    was = cur.where("order_id % 10 <> 0").withColumn(
        "order_total", F.expr("IF(order_id % 7 = 0, order_total + 5, order_total)").cast(MONEY)).withColumn(
        "order_date", F.expr("IF(order_id % 9 = 0, order_date + INTERVAL 3 DAYS, order_date)"))
    gone = cur.where("order_id % 8 = 0").withColumn("order_id", -F.col("order_id") - 1)
    return was.unionByName(gone)


@query("daily_revenue_from_changes", with_(ORD) + """
SELECT CAST(order_date AS DATE) AS period_start, COUNT(*) AS orders, CAST(SUM(order_total) AS DECIMAL(28,2)) AS revenue
FROM ord GROUP BY 1""")
def q_daily_revenue_from_changes(spark, sf):
    cur = T.orders(spark, sf).select("order_id", "order_date", "order_total")
    old, path = _orders_before(cur), scratch_path(spark, "daily-revenue")
    keys = {"month": F.trunc(F.col("order_date").cast("date"), "month"), "period_start": F.col("order_date").cast("date")}

    def signed(rows: DataFrame) -> DataFrame:
        return incremental.delta(rows, keys, {"revenue": F.col("order_total")}).withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))

    signed(old.withColumn("_sign", F.lit(1))).write.partitionBy("month").parquet(path)
    changes = incremental.signed_changes(old, cur, "order_id", ["order_date", "order_total"])
    return incremental.merge_delta(path, "month", ["month", "period_start"], signed(changes)).select(
        "period_start", F.col("rows").alias("orders"), "revenue")


def _events_before(cur: DataFrame) -> DataFrame:
    was = cur.where("event_id % 10 <> 0").withColumn(
        "event_timestamp", F.expr("IF(event_id % 9 = 0, event_timestamp + INTERVAL 30 HOURS, event_timestamp)")).withColumn(
        "customer_id", F.expr("IF(event_id % 21 = 0, customer_id + 1, customer_id)"))
    gone = cur.where("event_id % 12 = 0").withColumn("event_id", -F.col("event_id") - 1)
    return was.unionByName(gone)


@query("daily_visitors_from_changes", """
SELECT CAST(ts AS DATE) AS day, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS visitors FROM events GROUP BY 1""")
def q_daily_visitors_from_changes(spark, sf):
    """Distinct visitors a day: stored as one row a visitor with its events."""
    cur = T.raw_events(spark, sf).select("event_id", "customer_id", "event_timestamp")
    old, path = _events_before(cur), scratch_path(spark, "daily-visitors")
    keys = {"day": F.col("event_timestamp").cast("date"), "customer_id": F.col("customer_id")}
    incremental.delta(old.withColumn("_sign", F.lit(1)), keys, {}).write.partitionBy("day").parquet(path)
    changes = incremental.signed_changes(old, cur, "event_id", ["customer_id", "event_timestamp"])
    stored = incremental.merge_delta(path, "day", ["day", "customer_id"], incremental.delta(changes, keys, {}))
    return incremental.distinct_by_day(stored, "day", "customer_id", "visitors")


@query("funnel_from_changes", with_(web_cte(), BEH, FACT_BEH) + _DAILY + """
SELECT funnel_date, stage, stage_order, sessions,
       CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS conversion_rate,
       1.0 - CAST(sessions AS DOUBLE) / NULLIF(CAST(first_s AS DOUBLE), 0) AS drop_off_rate
FROM st""")
def q_funnel_from_changes(spark, sf):
    """The daily funnel, of which only users with changes are cut into sessions
    again."""
    cur = T.raw_events(spark, sf)
    # few users change: those of every fifth id
    old = _events_before(cur.where("customer_id % 5 = 0")).unionByName(cur.where("customer_id % 5 <> 0 OR customer_id IS NULL"))
    path = scratch_path(spark, "funnel-counts")
    first = funnel.daily_counts(fact_customer_behavior(session_behavior(sessionize(old, P.SESSION_GAP_SECONDS))))
    first.select("funnel_date", F.col("n0").alias("rows"), *[F.col(f"n{i}").cast("long") for i in range(5)]) \
        .write.partitionBy("funnel_date").parquet(path)
    step = incremental.funnel_delta(old, cur, P.SESSION_GAP_SECONDS)
    stored = incremental.merge_delta(path, "funnel_date", ["funnel_date"], step)
    return funnel.funnel_of_counts(stored.drop("rows"), ordered=False)


# ------------------------------------------------------- stored sketches --

@query("visitors_from_sketches", """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, COUNT(*) AS events, COUNT(DISTINCT user_id) AS visitors, TRUE AS estimate_within_bound
FROM events GROUP BY 1""")
def q_visitors_from_sketches(spark, sf):
    """Visitors by week from the stored days' sketches, next to the exact
    count: within four standard errors."""
    ev = T.raw_events(spark, sf)
    days = sinks.materialize_table(sketches.daily_visitors(ev), "daily-sketches")
    week = lambda c: F.date_trunc("week", c).cast("date")
    est = sketches.visitors_by(days, week(F.col("day")), "week").withColumnRenamed("visitors", "estimate")
    exact = ev.groupBy(week(F.col("event_timestamp")).alias("week"), "customer_id").agg(F.lit(1)).groupBy("week").agg(F.count("customer_id").alias("visitors"))
    near = F.abs(F.col("estimate") - F.col("visitors")) <= F.ceil(4 * sketches.ERROR * F.col("visitors"))
    return est.join(exact, "week").select("week", "events", "visitors", near.alias("estimate_within_bound"))


# --------------------------------------------------------- curve layout --

@query("clustered_events", "SELECT event_id, user_id AS customer_id, ts AS event_timestamp, event_type FROM events")
def q_clustered_events(spark, sf):
    """Events laid out by time and customer at once."""
    ev = T.raw_events(spark, sf).select("event_id", "customer_id", "event_timestamp", "event_type")
    return sinks.curve_write(ev, scratch_path(spark, "events-curve"), [epoch_micros("event_timestamp"), F.col("customer_id")])


# ----------------------------------------------- semi-structured landing --

def _variant_lines(spark, sf) -> DataFrame:
    """Events as JSON lines: some with a field that no schema has, some with a
    value of another type; and lines that are no event."""
    ev = T.read(spark, sf, "events").select(*[f.name for f in RAW_EVENTS.fields])
    fields = ("event_id", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")", "user_id", "event_type", "value", "props")
    named = ", ".join(f"'{f.name}', {e}" for f, e in zip(RAW_EVENTS.fields, fields))
    plain = f"to_json(named_struct({named}))"
    line = f"""CASE WHEN event_id % 13 = 0 THEN to_json(named_struct({named}, 'campaign', concat('c', event_id % 3)))
        WHEN event_id % 17 = 0 THEN to_json(named_struct({named.replace("'value', value", "'value', 'n/a'")})) ELSE {plain} END"""
    bad = f"""filter(array(IF(event_id % 19 = 0, left({plain}, 20), NULL), IF(event_id % 23 = 0, concat('[', event_id, ']'), NULL),
        IF(event_id % 29 = 0, to_json(named_struct('user_id', user_id)), NULL)), x -> x IS NOT NULL)"""
    return ev.selectExpr(f"explode(concat(array({line}), {bad})) AS value")


def _landed_lines(spark, sf) -> str:
    path = scratch_path(spark, "json-variant")
    _variant_lines(spark, sf).write.text(path)
    return path


@query("ingest_variant_events", """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 13 <> 0 AND event_id % 17 = 0 THEN NULL ELSE value END AS value, props,
       CASE WHEN event_id % 13 = 0 THEN '{"campaign":"c' || (event_id % 3) || '"}' WHEN event_id % 17 = 0 THEN '{"value":"n/a"}' END AS rescued
FROM events""")
def q_ingest_variant_events(spark, sf):
    """I06 with VARIANT: every event, and what its line held besides."""
    return files.read_variant_events(spark, _landed_lines(spark, sf))[0]


@query("ingest_variant_rescue", """
SELECT reason, COUNT(*) AS lines FROM (
  SELECT 'malformed' AS reason FROM events WHERE event_id % 19 = 0 UNION ALL
  SELECT 'not an object' FROM events WHERE event_id % 23 = 0 UNION ALL
  SELECT 'no event_id' FROM events WHERE event_id % 29 = 0) GROUP BY reason""")
def q_ingest_variant_rescue(spark, sf):
    """The lines that are no event, counted by reason."""
    rescue = files.read_variant_events(spark, _landed_lines(spark, sf))[1]
    return rescue.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
