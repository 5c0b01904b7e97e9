"""Daily metrics, product performance, trends, KPIs and alerts (T01-T08,
K01, K02).  Distinct counts are taken on pre-aggregated (day, customer)
grain so no aggregate needs Catalyst's ``Expand``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import ratio
from mercato.operators.joins import join_small
from mercato.operators.parts import partitions, spread, unmerged
from mercato.schemas import MONEY_SUM


def daily_sessions(fact_behavior: DataFrame) -> DataFrame:
    dc = fact_behavior.groupBy("session_date", "customer_id").agg(
        F.count(F.lit(1)).alias("s"), F.sum("total_page_views").alias("pv"),
        F.count_if("purchase_completed").alias("conv"), F.count_if("cart_abandoned").alias("ab"))
    return dc.groupBy(F.col("session_date").alias("metric_date")).agg(
        F.sum("s").alias("total_sessions"),
        F.count(F.lit(1)).alias("unique_visitors"),
        F.sum("pv").alias("total_page_views"),
        F.sum("conv").alias("_conv"), F.sum("ab").alias("_ab"))


def daily_orders(fact_orders: DataFrame) -> DataFrame:
    dc = fact_orders.groupBy(F.col("order_date").cast("date").alias("d"), "customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_total").alias("rev"),
        F.sum(F.when(F.col("is_first_order"), F.col("order_total"))).alias("new_rev"),
        F.max("is_first_order").alias("has_first"), F.max(~F.col("is_first_order")).alias("has_repeat"))
    return dc.groupBy(F.col("d").alias("metric_date")).agg(
        F.sum("n").alias("total_orders"),
        F.sum("rev").cast(MONEY_SUM).alias("total_revenue"),
        F.count_if("has_first").alias("new_customers"),
        F.count_if("has_repeat").alias("returning_customers"),
        F.coalesce(F.sum("new_rev"), F.lit(0)).cast(MONEY_SUM).alias("new_customer_revenue"))


def daily_metrics(fact_behavior: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Sessions side and orders side per day, full outer joined on the date
    (web and order activity need not overlap)."""
    s = daily_sessions(fact_behavior)
    o = daily_orders(fact_orders)
    j = s.join(o, "metric_date", "full_outer")
    return j.select(
        "metric_date",
        F.coalesce("total_sessions", F.lit(0)).cast("long").alias("total_sessions"),
        F.coalesce("unique_visitors", F.lit(0)).cast("long").alias("unique_visitors"),
        F.coalesce("total_page_views", F.lit(0)).cast("long").alias("total_page_views"),
        F.coalesce("total_orders", F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce("total_revenue", F.lit(0)).cast(MONEY_SUM).alias("total_revenue"),
        ratio("total_revenue", "total_orders").alias("avg_order_value"),
        ratio("_conv", "total_sessions").alias("conversion_rate"),
        ratio("_ab", "total_sessions").alias("cart_abandonment_rate"),
        F.coalesce("new_customers", F.lit(0)).cast("long").alias("new_customers"),
        F.coalesce("returning_customers", F.lit(0)).cast("long").alias("returning_customers"),
    )


def new_vs_returning(fact_orders: DataFrame) -> DataFrame:
    o = daily_orders(fact_orders)
    return o.select("metric_date", "new_customers", "returning_customers", "new_customer_revenue",
                    (F.col("total_revenue") - F.col("new_customer_revenue")).cast(MONEY_SUM)
                    .alias("returning_customer_revenue"))


def product_days(items_fact: DataFrame, orders: DataFrame) -> DataFrame:
    """Per product and order day: distinct orders, quantity, revenue, profit.

    Lines are first summed to (order, product), on the shuffle by order that the
    join needs anyway; an order has one day, so the second shuffle counts rows for
    its distinct orders and combines them map-side.  The first shuffle's tasks hold
    most, so its partitions are not left to be merged (``parts.unmerged``).  Inputs that
    need more partitions than the session has are dealt into theirs in both shuffles."""
    n = unmerged(items_fact, orders)
    lines = items_fact.repartition("order_id") if n is None else spread(items_fact, n, "order_id")
    per_order = lines.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("q"), F.sum("line_total").alias("r"), F.sum("profit").alias("p"))
    od = orders.select("order_id", F.col("order_date").cast("date").alias("metric_date"))
    days = spread(per_order.join(od, "order_id"), partitions(items_fact, orders), "product_id", "metric_date")
    return days.groupBy("product_id", "metric_date").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("q").cast("long").alias("quantity_sold"),
        F.sum("r").cast(MONEY_SUM).alias("revenue"), F.sum("p").cast(MONEY_SUM).alias("profit"))


def product_performance(items_fact: DataFrame, orders: DataFrame, web_events: DataFrame | None = None,
                        event_products: DataFrame | None = None) -> DataFrame:
    """Per product and order day: distinct orders, quantity, revenue, profit.

    Views and add-to-cart need to know which product an event was about.
    When an ``event_products`` bridge (event_id, product_id) is given, they
    are counted from ``web_events`` per product and event day and full outer
    joined with the order side, and ``conversion_rate`` = purchases / views.
    Without a bridge (the landed events carry no product key) they are typed
    nulls."""
    g = product_days(items_fact, orders)
    if event_products is None or web_events is None:
        return g.select("product_id", "metric_date", F.lit(None).cast("long").alias("views"),
                        F.lit(None).cast("long").alias("add_to_cart"), "purchases", "quantity_sold",
                        "revenue", "profit", F.lit(None).cast("double").alias("conversion_rate"))
    ev = web_events.select("event_id", F.col("event_timestamp").cast("date").alias("metric_date"),
                           "product_views", "add_to_cart").join(event_products.select("event_id", "product_id"), "event_id")
    e = ev.groupBy("product_id", "metric_date").agg(
        F.count_if(F.col("product_views") > 0).alias("views"), F.count_if(F.col("add_to_cart") > 0).alias("add_to_cart"))
    k = e.join(g, ["product_id", "metric_date"], "full_outer")
    zero = F.lit(0).cast("long")
    return k.select("product_id", "metric_date",
                    F.coalesce("views", zero).alias("views"), F.coalesce("add_to_cart", zero).alias("add_to_cart"),
                    F.coalesce("purchases", zero).alias("purchases"), F.coalesce("quantity_sold", zero).alias("quantity_sold"),
                    F.coalesce("revenue", F.lit(0).cast(MONEY_SUM)).alias("revenue"),
                    F.coalesce("profit", F.lit(0).cast(MONEY_SUM)).alias("profit"),
                    ratio(F.coalesce("purchases", zero), "views").alias("conversion_rate"))


def revenue_trend(orders: DataFrame) -> DataFrame:
    """Revenue by day, ISO week and month in one pass (grouping sets)."""
    o = orders.select(F.col("order_date").cast("date").alias("day"),
                      F.date_trunc("week", "order_date").cast("date").alias("week"),
                      F.trunc(F.col("order_date").cast("date"), "month").alias("month"),
                      "order_total")
    g = o.groupingSets([["day"], ["week"], ["month"]], "day", "week", "month") \
        .agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("orders"), F.sum("order_total").cast(MONEY_SUM).alias("revenue"))
    return g.select(  # an order without a date is the null period of every grain
        F.when(F.col("_g") == 3, "day").when(F.col("_g") == 5, "week").otherwise("month").alias("grain"),
        F.coalesce("day", "week", "month").alias("period_start"), "orders", "revenue")


def revenue_mom_change(orders: DataFrame) -> DataFrame:
    """Month-over-month revenue change.  The previous month is found by an
    equi-join on ``month = add_months(previous, 1)`` - no unpartitioned
    window, so nothing is gathered into one task."""
    m = orders.groupBy(F.trunc(F.col("order_date").cast("date"), "month").alias("month")) \
        .agg(F.sum("order_total").cast(MONEY_SUM).alias("revenue"))
    prev = m.select(F.add_months("month", 1).alias("month"), F.col("revenue").alias("previous_revenue"))
    j = m.join(prev, "month", "left")
    return j.select("month", "revenue", "previous_revenue",
                    (ratio(F.col("revenue") - F.col("previous_revenue"), "previous_revenue") * 100).alias("pct_change"))


def category_rollup(items_fact: DataFrame, products: DataFrame) -> DataFrame:
    p = products.select("product_id", "category", "subcategory")
    j = join_small(items_fact, p, "product_id")
    g = j.rollup("category", "subcategory").agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.sum("line_total").cast(MONEY_SUM).alias("revenue"),
        F.sum("quantity").cast("long").alias("quantity"),
        F.count(F.lit(1)).alias("lines"))
    return g


def summary(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Run summary: one row; the event count enters as a scalar subquery."""
    n_events = events.agg(F.count(F.lit(1))).scalar()
    per_cust = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("order_total").alias("r"))
    a = per_cust.agg(F.sum("n").alias("total_orders"), F.count("customer_id").alias("unique_customers"),  # a null is no customer
                     F.sum("r").cast(MONEY_SUM).alias("total_revenue"))
    return a.select(n_events.alias("total_events"), "total_orders", "unique_customers", "total_revenue",
                    ratio("total_revenue", "total_orders").alias("avg_order_value"))


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Put the columns of several 1-row frames side by side without a join:
    union them (missing columns null) and take each column's single non-null
    value with a global aggregate."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def kpis(summary_row: DataFrame, funnel_counts: DataFrame, behavior_summary_row: DataFrame) -> DataFrame:
    """KPI bundle, each rounded to 2 places, from three 1-row frames."""
    s = combine_rows(summary_row, funnel_counts, behavior_summary_row)
    return s.select(
        F.round("total_revenue", 2).cast(MONEY_SUM).alias("total_revenue"),
        F.round("avg_order_value", 2).alias("avg_order_value"),
        F.round(ratio("total_revenue", "unique_customers"), 2).alias("revenue_per_customer"),
        F.round("overall", 2).alias("overall_conversion_rate"),
        F.round("cart_abandonment_rate", 2).alias("cart_abandonment_rate"),
        F.round("avg_session_duration", 2).alias("avg_session_duration"),
        F.round("avg_page_views", 2).alias("avg_page_views"),
        F.col("unique_customers").alias("total_customers"),
        "total_orders",
        F.round(ratio("total_orders", "unique_customers"), 2).alias("orders_per_customer"),
    )


def metric_alerts(daily: DataFrame, min_conversion: float = 0.02, max_abandonment: float = 0.75) -> DataFrame:
    """Threshold alerts on daily web metrics (days with sessions); every
    rule is evaluated in the same pass over the daily table."""
    d = daily.filter(F.col("total_sessions") > 0)

    def alert(cond, name, value, threshold):
        return F.when(cond, F.struct(F.lit(name).alias("alert_name"), F.lit("warning").alias("severity"),
                                     F.col(value).alias("metric_value"), F.lit(threshold).alias("threshold")))

    alerts = F.array(alert(F.col("conversion_rate") < min_conversion, "low_conversion_rate", "conversion_rate",
                           min_conversion),
                     alert(F.col("cart_abandonment_rate") > max_abandonment, "high_cart_abandonment",
                           "cart_abandonment_rate", max_abandonment))
    return d.select("metric_date", F.inline(F.filter(alerts, lambda x: x.isNotNull())))


def revenue_drop_alerts(daily_orders_df: DataFrame, factor: float = 0.5, trailing_days: int = 28) -> DataFrame:
    """Days whose revenue is below ``factor`` x the mean revenue of the
    previous ``trailing_days`` calendar days that had orders (today
    excluded).  Each day's revenue is sent to the ``trailing_days`` days it
    counts for (explode), summed per target day and joined back: an
    equi-join, no unpartitioned window."""
    d = daily_orders_df.select("metric_date", "total_revenue")
    spread = d.select(F.explode(F.sequence(F.date_add("metric_date", 1), F.date_add("metric_date", trailing_days)))
                      .alias("metric_date"), "total_revenue")
    trailing = spread.groupBy("metric_date").agg(F.sum("total_revenue").alias("_s"), F.count(F.lit(1)).alias("_n"))
    j = d.join(trailing, "metric_date", "left")
    avg = ratio("_s", "_n")
    out = j.select("metric_date", F.col("total_revenue").alias("daily_revenue"), avg.alias("avg_revenue"))
    return out.filter(F.col("daily_revenue").cast("double") < F.lit(factor) * F.col("avg_revenue"))


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Orders and revenue per day."""
    return orders.groupBy(F.col("order_date").cast("date").alias("period_start")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_total").cast(MONEY_SUM).alias("revenue"))
