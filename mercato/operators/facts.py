"""Fact tables (G01-G03) and the customer/product snapshots feeding SCD2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from mercato.functions.expressions import activity_status, date_key, epoch_micros, ratio, surrogate_key, time_key
from mercato.operators.joins import join_small
from mercato.operators.windows import HOT_KEY_ROWS, previous_in_group, row_number_in_group
from mercato.schemas import MONEY


def fact_web_events(events: DataFrame, with_keys: bool = False) -> DataFrame:
    out = events.select(
        "event_id",
        date_key("event_timestamp").alias("date_key"),
        time_key("event_timestamp").alias("time_key"),
        "customer_id", "session_id", "event_type", "page_views", "product_views", "add_to_cart",
        F.lit(0).alias("remove_from_cart"), "checkout_started", "purchase_completed", "event_timestamp")
    if with_keys:
        out = out.withColumn("event_key", surrogate_key("event_id")) \
            .withColumn("session_key", surrogate_key("session_id"))
    return out


def fact_orders(orders: DataFrame, with_keys: bool = False, hot_threshold: int | None = HOT_KEY_ROWS) -> DataFrame:
    """Order fact with first-order flag and days since the customer's previous
    order.  Customers with more than ``hot_threshold`` orders are split into
    slices of equal numbers of orders with carry-over, so no customer is a hot
    task."""
    o = previous_in_group(orders, ["customer_id"], ["order_date", "order_id"], epoch_micros("order_date"),
                          {"d": "order_date"}, hot_threshold)
    out = o.select(
        "order_id", "customer_id",
        date_key("order_date").alias("date_key"),
        "order_date", "order_status", "order_total", "shipping_cost", "tax_amount", "discount_amount",
        (F.col("order_total") - F.col("shipping_cost") - F.col("tax_amount") - F.col("discount_amount"))
        .cast(MONEY).alias("net_revenue"),
        "payment_method",
        F.col("prev_d").isNull().alias("is_first_order"),
        F.date_diff(F.col("order_date").cast("date"), F.col("prev_d").cast("date")).alias("days_since_last_order"),
    )
    if with_keys:
        out = out.withColumn("order_key", surrogate_key("order_id"))
    return out


def order_item_ids(lines: DataFrame, line_bucket: int = 1, hot_threshold: int | None = HOT_KEY_ROWS) -> DataFrame:
    """``order_item_id`` = "<order>-<position>", position = row number in
    line order (line number, part, supplier, price).  Orders with very many
    lines are numbered in slices of equal numbers of lines, cut by the first two
    fields of the order (line number, which is a number, and ranges of
    ``line_bucket`` parts), so a huge order is spread over many tasks."""
    first, *more = lines.schema["line_sort"].dataType.fields
    value = F.col(f"line_sort.{first.name}").cast("decimal(38,0)")
    if more and isinstance(more[0].dataType, IntegralType):
        value = (value * 10**12 + F.floor(F.col(f"line_sort.{more[0].name}") / int(line_bucket))).cast("decimal(38,0)")
    d = row_number_in_group(lines, ["order_id"], ["line_sort"], value, "line_position", hot_threshold)
    return d.withColumn(
        "order_item_id", F.concat(F.col("order_id").cast("string"), F.lit("-"), F.col("line_position").cast("string")))


def fact_order_items(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Line totals, cost from the product's unit cost, profit and margin.
    ``order_item_id``
    is kept when the input has it (``order_item_ids``); aggregates that do
    not need line ids skip that numbering step."""
    p = products.select("product_id", F.col("cost").alias("_unit_cost"))
    j = join_small(order_items, p, "product_id", "left")
    line_total = (F.col("extended_price") - F.col("discount")).cast(MONEY)
    cost = (F.col("_unit_cost") * F.col("quantity")).cast(MONEY)
    ids = ["order_item_id"] if "order_item_id" in order_items.columns else []
    return j.select(
        *ids, "order_id", "product_id", "quantity", "unit_price", "discount",
        line_total.alias("line_total"), cost.alias("cost"),
        (line_total - cost).cast(MONEY).alias("profit"),
        (ratio(line_total - cost, line_total) * 100).alias("profit_margin_pct"),
    )


def customer_snapshots(customers: DataFrame, orders: DataFrame, dates) -> DataFrame:
    """Customers known at each snapshot date (ordered before it) with their
    activity status as of that date, one row a ``snapshot_date``.  One scan
    and one aggregate of the orders serve every date."""
    dates = list(dates)
    last = orders.groupBy("customer_id").agg(*[
        F.max(F.when(F.col("order_date") < F.lit(d).cast("timestamp_ntz"), F.col("order_date"))).alias(f"_l{i}")
        for i, d in enumerate(dates)])
    at = F.array(*[F.struct(F.lit(d).cast("date").alias("d"), F.col(f"_l{i}").alias("last")) for i, d in enumerate(dates)])
    j = customers.join(last, "customer_id").withColumn("_s", F.explode(F.filter(at, lambda x: x["last"].isNotNull())))
    days = F.date_diff(F.col("_s.d"), F.col("_s.last").cast("date"))
    return j.select(*customers.columns, F.col("_s.d").alias("snapshot_date"), activity_status(days).alias("activity_status"))


def product_snapshots(products: DataFrame, lines: DataFrame, dates, window_days: int = 365) -> DataFrame:
    """Products with lifecycle 'active' when shipped in the ``window_days``
    before each snapshot date, else 'dormant'; margin % from price and cost;
    one row a ``snapshot_date``, from one aggregate over the order lines."""
    dates = list(dates)

    def shipped(d):
        lo = F.date_sub(F.lit(d).cast("date"), window_days).cast("timestamp_ntz")
        return (F.col("ship_date") >= lo) & (F.col("ship_date") < F.lit(d).cast("timestamp_ntz"))

    recent = lines.groupBy("product_id").agg(*[F.max(shipped(d)).alias(f"_a{i}") for i, d in enumerate(dates)])
    at = F.array(*[F.struct(F.lit(d).cast("date").alias("d"), F.coalesce(F.col(f"_a{i}"), F.lit(False)).alias("live"))
                   for i, d in enumerate(dates)])
    p = products.join(recent, "product_id", "left").withColumn("_s", F.explode(at))
    return p.select("product_id", "product_name", "category", "subcategory", "brand", "price", "cost",
                    F.col("_s.d").alias("snapshot_date"),
                    (ratio(F.col("price") - F.col("cost"), "price") * 100).alias("margin_pct"),
                    F.when(F.col("_s.live"), "active").otherwise("dormant").alias("lifecycle"))
