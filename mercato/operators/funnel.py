"""Conversion funnel.

Several COUNT(DISTINCT session) per query would make Catalyst ``Expand`` the
input once per distinct column.  Instead the events are rolled up to session
grain once (one shuffle on session_id, map-side partial aggregation) and the
stages become plain conditional counts.  The stage rows are produced from a
single aggregated row with ``inline`` (no UNION, no window, no join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import ratio
from mercato.operators.cleaning import drop_null_keys

# Stage names and order of the two funnel variants.
STAGES = ["visit", "product_view", "add_to_cart", "checkout", "purchase"]
DAILY_STAGES = ["Visit", "Product View", "Add to Cart", "Checkout", "Purchase"]


def _stage_rows(agg: DataFrame, keys: list[str], counts: list[str], names: list[str]) -> DataFrame:
    """One row per stage carrying sessions, the first stage and the previous
    stage's sessions (all taken from the same aggregated row)."""
    structs = []
    for i, (c, name) in enumerate(zip(counts, names)):
        prev = F.col(counts[i - 1]) if i else F.lit(None).cast("long")
        structs.append(F.struct(F.lit(name).alias("stage"), F.lit(i + 1).alias("stage_order"),
                                F.col(c).alias("sessions"), F.col(counts[0]).alias("first_sessions"),
                                prev.alias("prev_sessions")))
    return agg.select(*keys, F.inline(F.array(*structs)))


def session_flags(events: DataFrame) -> DataFrame:
    """Session grain: which stages each session reached (stages independent)."""
    return drop_null_keys(events, ["session_id"]).groupBy("session_id").agg(
        F.max(F.col("product_views") > 0).alias("pv"),
        F.max(F.col("add_to_cart") > 0).alias("atc"),
        F.max(F.col("checkout_started") > 0).alias("co"),
        F.max(F.col("purchase_completed") > 0).alias("pur"),
    )


def _global_counts(events: DataFrame, sequential: bool = False) -> DataFrame:
    s = session_flags(events)
    if sequential:  # a stage counts only with all stages before it
        s = (s.withColumn("atc", F.col("pv") & F.col("atc")).withColumn("co", F.col("atc") & F.col("co"))
             .withColumn("pur", F.col("co") & F.col("pur")))
    return s.agg(F.count(F.lit(1)).alias("n0"), F.count_if("pv").alias("n1"), F.count_if("atc").alias("n2"),
                 F.count_if("co").alias("n3"), F.count_if("pur").alias("n4"))


def _funnel_from_counts(counts: DataFrame) -> DataFrame:
    """Global funnel: sessions per stage, % of first stage, drop-off %, and %
    of previous stage (100 for the first)."""
    rows = _stage_rows(counts, [], ["n0", "n1", "n2", "n3", "n4"], STAGES)
    conv = ratio("sessions", "first_sessions") * 100
    return rows.select(
        "stage", "sessions", "stage_order",
        conv.alias("conversion_rate"),
        (F.lit(100.0) - conv).alias("drop_off_rate"),
        F.coalesce(ratio("sessions", "prev_sessions") * 100, F.lit(100.0)).alias("stage_conversion"),
    )


def conversion_funnel(events: DataFrame, sequential: bool = False) -> DataFrame:
    """Global funnel.  Stages are independent flags of a session, or with
    ``sequential`` each one needs all before it, so the counts never rise."""
    return _funnel_from_counts(_global_counts(events, sequential))


def behavior_counts(behavior: DataFrame) -> DataFrame:
    """Stage counts from the session rollup (B01 output) - no second pass
    over the events.  Valid because session ids are unique across customers
    (they embed the customer id)."""
    return behavior.agg(F.count(F.lit(1)).alias("n0"),
                        F.count_if(F.col("product_views_sum") > 0).alias("n1"),
                        F.count_if(F.col("add_to_cart_sum") > 0).alias("n2"),
                        F.count_if(F.col("checkout_started_sum") > 0).alias("n3"),
                        F.count_if(F.col("purchase_completed_sum") > 0).alias("n4"))


def conversion_funnel_from_behavior(behavior: DataFrame) -> DataFrame:
    return _funnel_from_counts(behavior_counts(behavior))


def overall_conversion(events: DataFrame) -> DataFrame:
    c = _global_counts(events)
    return c.select(F.round(ratio("n4", "n0") * 100, 2).alias("overall_conversion_rate"))


def daily_counts(fact_behavior: DataFrame) -> DataFrame:
    """Per session-start date: sessions reaching each stage."""
    return fact_behavior.groupBy(F.col("session_date").alias("funnel_date")).agg(
        F.count(F.lit(1)).alias("n0"),
        F.count_if(F.col("total_product_views") > 0).alias("n1"),
        F.count_if(F.col("total_add_to_cart") > 0).alias("n2"),
        F.count_if("checkout_started").alias("n3"),
        F.count_if("purchase_completed").alias("n4"),
    )


def funnel_daily(fact_behavior: DataFrame, ordered: bool = True) -> DataFrame:
    """Daily funnel with fractions of the first stage (warehouse model)."""
    return funnel_of_counts(daily_counts(fact_behavior), ordered)


def funnel_of_counts(counts: DataFrame, ordered: bool = True) -> DataFrame:
    """The daily funnel of counts per day (n0 to n4), however they were made."""
    rows = _stage_rows(counts, ["funnel_date"], ["n0", "n1", "n2", "n3", "n4"], DAILY_STAGES)
    conv = ratio("sessions", "first_sessions")
    out = rows.select("funnel_date", "stage", "stage_order", "sessions",
                      conv.alias("conversion_rate"), (F.lit(1.0) - conv).alias("drop_off_rate"))
    return out.orderBy("funnel_date", "stage_order") if ordered else out


def funnel_dropoff(fact_behavior: DataFrame) -> DataFrame:
    """Sessions lost between consecutive stages, per day."""
    rows = _stage_rows(daily_counts(fact_behavior), ["funnel_date"], ["n0", "n1", "n2", "n3", "n4"], DAILY_STAGES)
    return rows.select(
        "funnel_date", "stage", "stage_order", "sessions",
        F.col("prev_sessions").alias("previous_stage_sessions"),
        (F.col("prev_sessions") - F.col("sessions")).alias("dropped_sessions"),
        ratio("sessions", "prev_sessions").alias("step_conversion_rate"),
    )
