"""Fixed StructTypes of the staging layer and of landed JSON files.

Money is DECIMAL(18,2) as in the warehouse DDL; timestamps are
TIMESTAMP_NTZ.  Schemas are declared, never inferred.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)  # what Spark gives for sum(decimal(18,2))

WEB_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("page_views", T.IntegerType()),
    T.StructField("product_views", T.IntegerType()),
    T.StructField("add_to_cart", T.IntegerType()),
    T.StructField("checkout_started", T.IntegerType()),
    T.StructField("purchase_completed", T.IntegerType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_total", MONEY),
    T.StructField("shipping_cost", MONEY),
    T.StructField("tax_amount", MONEY),
    T.StructField("discount_amount", MONEY),
    T.StructField("payment_method", T.StringType()),
])

# Raw event records as they land in the JSON landing zone.
RAW_EVENT_JSON = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

RAW_EVENTS = T.StructType([f for f in RAW_EVENT_JSON.fields if f.name != "_corrupt_record"])

PROPS_JSON = T.StructType([T.StructField("k", T.LongType())])

# Columns of the landed tables that the warehouse reads (declared, so that no
# job looks at footers while a plan is built).
LANDED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
