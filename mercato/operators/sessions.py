"""Sessionization and session behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.expressions import date_key, epoch_micros, ratio, surrogate_key
from mercato.operators.cleaning import drop_null_keys
from mercato.operators.windows import HOT_KEY_ROWS, with_carry, with_slices

COUNTERS = ["page_views", "product_views", "add_to_cart", "checkout_started", "purchase_completed"]


def sessionize(events: DataFrame, gap_seconds: int = 6 * 3600, user: str = "customer_id",
               ts: str = "event_timestamp", tiebreak: str = "event_id", out: str = "session_id",
               bucket_seconds: int | None = None, hot_threshold: int | None = HOT_KEY_ROWS) -> DataFrame:
    """Assign ``session_id`` = "<user>-<epoch micros of the session's first
    event>".  A new session starts when the gap to the user's previous event
    is >= ``gap_seconds`` (the same rule as ``session_window``).

    Events are shuffled once, on (user, slice).  A user with more than
    ``hot_threshold`` events is cut into slices of about equal numbers of events
    (or of ``bucket_seconds``, if given); a slice-level summary of those users
    (first/last event, latest session start inside the slice) carries sessions
    across slice borders.  Other users are one slice each, so no task ever
    holds a hot user whole, even if all its events fall in one hour.

    Events without a user (often the largest key) get a null session and
    bypass the shuffle.
    """
    anonymous = events.where(F.col(user).isNull()).withColumn(out, F.lit(None).cast("string"))
    return _sessionize(events.where(F.col(user).isNotNull()), gap_seconds, user, ts, tiebreak, out,
                       bucket_seconds, hot_threshold).unionByName(anonymous)


def _sessionize(events: DataFrame, gap_seconds: int, user: str, ts: str, tiebreak: str, out: str,
                bucket_seconds: int | None, hot_threshold: int | None) -> DataFrame:
    gap = F.lit(int(gap_seconds) * 1_000_000)
    us = F.col("_us")
    bucket = None if bucket_seconds is None else F.floor(us / F.lit(int(bucket_seconds) * 1_000_000)).cast("long")
    d0 = with_slices(events.withColumn("_us", epoch_micros(ts)), [user], us, hot_threshold, bucket)
    w = Window.partitionBy(user, "_b").orderBy("_us", tiebreak)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def starts(d: DataFrame) -> DataFrame:
        """Starts decided inside the slice (all but the slice's first event)."""
        prev = F.lag("_us").over(w)
        return d.withColumn("_istart", F.when(prev.isNotNull() & (us - prev >= gap), us))

    d = starts(d0).withColumn("_run", F.max("_istart").over(upto)).withColumn("_first", F.first("_us").over(upto))
    # of hot users' slices: the session that each one's first event is in
    s = starts(d0.where("_b IS NOT NULL").select(user, "_b", "_us", tiebreak)).groupBy(user, "_b").agg(
        F.min("_us").alias("_f"), F.max("_us").alias("_last"), F.max("_istart").alias("_bstart"))
    wb = Window.partitionBy(user).orderBy("_b")
    prev_last = F.lag("_last").over(wb)
    s = s.withColumn("_fstart", F.when(prev_last.isNull() | (F.col("_f") - prev_last >= gap), F.col("_f")))
    s = s.withColumn("_lstart", F.coalesce("_bstart", "_fstart"))
    s = s.withColumn("_carry", F.max("_lstart").over(wb.rowsBetween(Window.unboundedPreceding, -1)))
    d = with_carry(d, s.select(user, "_b", F.coalesce("_fstart", "_carry").alias("_enter")), [user])
    # a single-slice user: the slice's first event opens a session
    sess = F.coalesce("_run", "_enter", "_first")
    return d.select(*events.columns, F.concat(F.col(user).cast("string"), F.lit("-"), sess.cast("string")).alias(out))


def session_behavior(events: DataFrame) -> DataFrame:
    """Per (customer, session): first/last/count of events, counter sums,
    duration in seconds (fractional), converted and abandoned-cart flags.
    Events without a customer belong to no session."""
    b = drop_null_keys(events, ["customer_id", "session_id"]).groupBy("customer_id", "session_id").agg(
        F.min("event_timestamp").alias("event_timestamp_min"),
        F.max("event_timestamp").alias("event_timestamp_max"),
        F.count("event_timestamp").alias("event_timestamp_count"),
        *[F.sum(c).cast("long").alias(f"{c}_sum") for c in COUNTERS],
    )
    dur_us = epoch_micros("event_timestamp_max") - epoch_micros("event_timestamp_min")
    return b.select(
        "*",
        (dur_us.cast("double") / F.lit(1e6)).alias("session_duration_seconds"),
        (F.col("purchase_completed_sum") > 0).cast("int").alias("converted"),
        ((F.col("add_to_cart_sum") > 0) & (F.col("purchase_completed_sum") == 0)).cast("int").alias("abandoned_cart"),
    )


def behavior_summary(behavior: DataFrame) -> DataFrame:
    """One row: sessions, mean duration, conversion %, abandonment %, mean
    page views.  Means are computed from exact integer sums."""
    dur_us = epoch_micros("event_timestamp_max") - epoch_micros("event_timestamp_min")
    a = behavior.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum(dur_us).alias("_dur_us"),
        F.sum("converted").cast("long").alias("_conv"),
        F.sum("abandoned_cart").cast("long").alias("_aband"),
        F.sum("page_views_sum").cast("long").alias("_pv"),
    )
    return a.select(
        "total_sessions",
        (F.col("_dur_us").cast("double") / F.lit(1e6) / F.col("total_sessions")).alias("avg_session_duration"),
        (ratio("_conv", "total_sessions") * 100).alias("conversion_rate"),
        (ratio("_aband", "total_sessions") * 100).alias("cart_abandonment_rate"),
        ratio("_pv", "total_sessions").alias("avg_page_views"),
    )


def sample_sessions(behavior: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` sessions in (customer, session) order: a top-k, not a sort."""
    return behavior.orderBy("customer_id", "session_id").limit(n)


def customer_sessions(behavior: DataFrame, customer_id) -> DataFrame:
    """Sessions of one customer.  The predicate is on a grouping key, so
    Catalyst pushes it below the aggregate into the Parquet scan."""
    return behavior.filter(F.col("customer_id") == F.lit(customer_id))


def dim_session(events: DataFrame) -> DataFrame:
    """Session dimension: start/end/duration and landing/exit page (the first
    and last event type; no URLs in the landed data)."""
    order = F.struct("event_timestamp", "event_id")
    s = drop_null_keys(events, ["session_id"]).groupBy("session_id", "customer_id").agg(
        F.min("event_timestamp").alias("session_start_timestamp"),
        F.max("event_timestamp").alias("session_end_timestamp"),
        F.min_by("event_type", order).alias("landing_page"),
        F.max_by("event_type", order).alias("exit_page"),
    )
    dur_us = epoch_micros("session_end_timestamp") - epoch_micros("session_start_timestamp")
    return s.select(
        "session_id", "customer_id", "session_start_timestamp", "session_end_timestamp",
        F.floor(dur_us / F.lit(1_000_000)).cast("int").alias("session_duration_seconds"),
        F.lit(None).cast("string").alias("device_type"),
        F.lit(None).cast("string").alias("browser"),
        F.lit(None).cast("string").alias("referrer_source"),
        "landing_page", "exit_page",
    )


def fact_customer_behavior(behavior: DataFrame, with_keys: bool = False) -> DataFrame:
    """Session-grain behaviour fact dated at the session start."""
    dur_us = epoch_micros("event_timestamp_max") - epoch_micros("event_timestamp_min")
    out = behavior.select(
        date_key("event_timestamp_min").alias("date_key"),
        F.col("event_timestamp_min").cast("date").alias("session_date"),
        "customer_id", "session_id",
        F.col("page_views_sum").alias("total_page_views"),
        F.col("product_views_sum").alias("total_product_views"),
        F.col("add_to_cart_sum").alias("total_add_to_cart"),
        F.lit(0).cast("long").alias("total_remove_from_cart"),
        (F.col("checkout_started_sum") > 0).alias("checkout_started"),
        (F.col("purchase_completed_sum") > 0).alias("purchase_completed"),
        ((F.col("add_to_cart_sum") > 0) & (F.col("purchase_completed_sum") == 0)).alias("cart_abandoned"),
        F.floor(dur_us / F.lit(1_000_000)).cast("int").alias("session_duration_seconds"),
    )
    if with_keys:
        out = out.withColumn("session_key", surrogate_key("session_id")) \
            .withColumn("behavior_key", surrogate_key("session_id", "date_key"))
    return out
