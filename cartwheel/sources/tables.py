"""Scans of the test tables and adapters to the e-commerce data model.

The warehouse tables are TPC-H shaped.  The analytics take the e-commerce
shape (orders at line grain, products with a category and a price), so
these adapters are plain projections and one key join, left to Catalyst:
column pruning and null-filter pushdown reach the parquet scans.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import WAREHOUSE

log = logging.getLogger(__name__)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_parquet(spark: SparkSession, path: str, log_count: bool = False) -> DataFrame:
    """Parquet scan of a file or directory.

    Lazy by default.  ``log_count=True`` runs one count job and logs the row
    count.  A failure is logged with the path and re-raised.
    """
    try:
        df = spark.read.parquet(path)
        if log_count:
            log.info("loaded %d records from %s", df.count(), path)
        return df
    except Exception:
        log.exception("failed to load parquet from %s", path)
        raise


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a warehouse table with its declared schema (no inference job).

    The files are listed at each call, so appended and rewritten tables are
    read as they are, in the session that asks.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = table_path(sf_dir, name)
    if name in WAREHOUSE:
        return spark.read.schema(WAREHOUSE[name]).parquet(path)
    return load_parquet(spark, path)


def products_from_part(part: DataFrame) -> DataFrame:
    """part -> products(product_id, category, price); category is p_type."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    """lineitem -> order lines(order_id, product_id, quantity)."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )


def orders_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """lineitem joined to its order header: the line-grain orders table.

    Columns: order_id, product_id, quantity, customer_id, order_date.  The
    join is on the order key, unique in ``orders``; a cluster-scale layout
    buckets both tables by it, which removes this shuffle entirely.
    """
    header = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    return order_lines(lineitem).join(header, "order_id", "inner")


def sales_inputs(spark: SparkSession, sf_dir: str, with_header: bool = True):
    """(orders, products) in the e-commerce shape from the warehouse tables.

    Queries that read neither the customer nor the date pass
    ``with_header=False`` and skip the order-header join.
    """
    lineitem = load_table(spark, sf_dir, "lineitem")
    products = products_from_part(load_table(spark, sf_dir, "part"))
    if with_header:
        return orders_from_lineitem(lineitem, load_table(spark, sf_dir, "orders")), products
    return order_lines(lineitem), products
