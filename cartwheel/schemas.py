"""Declared schemas of the e-commerce data model and of the metric tables.

Every text-format read passes one of these; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("registration_date", T.DateType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("stock", T.LongType()),
    T.StructField("rating", T.DoubleType()),
])

# One row = one order of one product.
ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("order_date", T.DateType()),
])

# The file-format benchmark table.
FORMAT_TABLE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("category", T.StringType()),
])

# One row per storage format; ``ordinal`` keeps the measuring order for ties.
FORMAT_METRICS = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("ordinal", T.LongType()),
    T.StructField("file_size_mb", T.DoubleType()),
    T.StructField("write_time_s", T.DoubleType()),
    T.StructField("read_time_s", T.DoubleType()),
    T.StructField("peak_memory_mb", T.DoubleType()),
    T.StructField("cpu_time_s", T.DoubleType()),
    T.StructField("energy_wh", T.DoubleType()),
])

# Per-phase measurements from which cpu_time_s, peak_memory_mb and energy_wh derive.
PHASE_METRICS = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("ordinal", T.LongType()),
    T.StructField("write_cpu_s", T.DoubleType()),
    T.StructField("read_cpu_s", T.DoubleType()),
    T.StructField("write_peak_mb", T.DoubleType()),
    T.StructField("read_peak_mb", T.DoubleType()),
])

# Long table of engine timings.
ENGINE_TIMINGS = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("engine", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
])

SAMPLE_AMOUNTS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("amount", T.LongType()),
])

# Warehouse (test) tables, declared so that a scan needs no footer-reading
# job to infer them.  Fixed values: column names and types of the tables.
WAREHOUSE = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                 "c_mktsegment STRING"),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
               "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
}
