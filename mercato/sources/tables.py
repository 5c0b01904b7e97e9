"""Adapters from the landed Parquet tables to the warehouse staging layer.

This is the only module that knows the landed column names.  Everything
downstream sees the staging contract (customer_id, order_id, order_date, ...).
Reads always go through ``spark.read.parquet`` with explicit projections so
that Catalyst prunes columns and pushes range filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.schemas import LANDED, MONEY

# Event-type to counter mapping and order-status codes.
EVENT_COUNTERS = {
    "product_views": "view",
    "add_to_cart": "click",
    "checkout_started": "signup",
    "purchase_completed": "purchase",
}
ORDER_STATUS = {"F": "completed", "O": "pending", "P": "cancelled"}
VALID_ORDER_STATUSES = ["completed", "pending", "cancelled", "refunded"]
DEFAULT_COST_RATIO = 0.6


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A landed table with its declared columns."""
    return spark.read.schema(LANDED[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _range_filter(col: Column, start: str | None, end: str | None) -> Column | None:
    """Whole days from ``start`` to ``end``, both included (date strings)."""
    cond = None
    if start is not None:
        cond = col >= F.lit(start).cast("timestamp_ntz")
    if end is not None:
        c2 = col < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
        cond = c2 if cond is None else cond & c2
    return cond


def raw_events(spark: SparkSession, sf_dir: str, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """Web events without sessions: counters from ``event_type``, one page view
    per event (warehouse default)."""
    ev = read(spark, sf_dir, "events")
    cond = _range_filter(F.col("ts"), start, end)
    if cond is not None:
        ev = ev.filter(cond)  # pushed to the Parquet reader
    return events_from_raw(ev)


def events_from_raw(ev: DataFrame) -> DataFrame:
    cols = [
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("event_type"),
        F.lit(1).alias("page_views"),
    ]
    cols += [(F.col("event_type") == F.lit(t)).cast("int").alias(c) for c, t in EVENT_COUNTERS.items()]
    return ev.select(*cols)


def web_events(spark: SparkSession, sf_dir: str, start: str | None = None,
               end: str | None = None, gap_seconds: int = 6 * 3600) -> DataFrame:
    """Staging web events with ``session_id`` derived by sessionization."""
    from mercato.operators.sessions import sessionize

    return sessionize(raw_events(spark, sf_dir, start, end), gap_seconds=gap_seconds)


def orders(spark: SparkSession, sf_dir: str, start: str | None = None,
           end: str | None = None) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    cond = _range_filter(F.col("o_orderdate"), start, end)
    if cond is not None:
        o = o.filter(cond)
    status = F.when(F.col("o_orderstatus") == "F", "completed") \
        .when(F.col("o_orderstatus") == "O", "pending") \
        .when(F.col("o_orderstatus") == "P", "cancelled")
    zero = F.lit(0).cast(MONEY)
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("order_total"),
        zero.alias("shipping_cost"),
        zero.alias("tax_amount"),
        zero.alias("discount_amount"),
        F.lit(None).cast("string").alias("payment_method"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items without a line id.  ``line_sort`` is the unique in-order
    sort key (line number, part, supplier, price) used where row order matters."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("extended_price"),
        (F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)"))
        .cast(MONEY).alias("discount"),
        F.col("l_shipdate").alias("ship_date"),
        F.struct(F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
                 F.col("l_suppkey").alias("sk"), F.col("l_extendedprice").alias("ep")).alias("line_sort"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging order items: unit price = extended price / quantity."""
    lines = order_lines(spark, sf_dir)
    return lines.select(
        "order_id", "product_id", "quantity",
        F.try_divide(F.col("extended_price"), F.col("quantity")).cast(MONEY).alias("unit_price"),
        "discount", "extended_price", "ship_date", "line_sort",
    )


def products(spark: SparkSession, sf_dir: str, cost_ratio: float = DEFAULT_COST_RATIO) -> DataFrame:
    p = read(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast(MONEY)
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        price.alias("price"),
        (price * F.lit(cost_ratio).cast("decimal(4,2)")).cast(MONEY).alias("cost"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with country/state from nation/region.  Nation (25 rows) and
    region (5 rows) are fixed-size reference tables, so broadcasting them is
    bounded; with one row a key, a reader that needs neither is spared the joins."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").dropDuplicates(["n_nationkey"])
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name").dropDuplicates(["r_regionkey"])
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
         .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left"))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("city"),
    )


def staging_sql(sf_dir: str, name: str, cost_ratio: float = DEFAULT_COST_RATIO) -> str:
    """SQL text of a staging table over the landed files: ``orders``,
    ``customers``, ``products`` or ``order_items``.  Views hold text, so each
    read lists the files anew."""
    def landed(t: str) -> str:
        return f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`"

    money = "DECIMAL(18,2)"
    status = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in ORDER_STATUS.items())
    return {
        "orders": f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
  CASE o_orderstatus {status} END AS order_status, CAST(o_totalprice AS {money}) AS order_total FROM {landed("orders")}""",
        "customers": f"""SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name FROM {landed("customer")}""",
        "products": f"""SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
  CAST(CAST(p_retailprice AS {money}) * CAST({cost_ratio} AS DECIMAL(4,2)) AS {money}) AS cost FROM {landed("part")}""",
        "order_items": f"""SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
  CAST(CAST(l_extendedprice AS {money}) - CAST(CAST(l_extendedprice AS {money}) * CAST(l_discount AS DECIMAL(4,2)) AS {money}) AS {money}) AS line_total
  FROM {landed("lineitem")}""",
        # an event's product is its property k (a declared mapping)
        "event_products": f"""SELECT CAST(get_json_object(props, '$.k') AS BIGINT) AS product_id, CAST(ts AS DATE) AS metric_date,
  event_type = '{EVENT_COUNTERS["product_views"]}' AS viewed, event_type = '{EVENT_COUNTERS["add_to_cart"]}' AS carted
  FROM {landed("events")} WHERE get_json_object(props, '$.k') IS NOT NULL""",
    }[name]
