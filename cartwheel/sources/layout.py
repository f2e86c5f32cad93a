"""Co-located table layout: bucket the line and order tables on the order key.

The line-grain orders view joins every line to its order header on the
order key.  With both tables written with the same number of buckets on
that key (and sorted within buckets), Spark reads them already
hash-partitioned and sorted, so the sort-merge join needs no shuffle on
either side.  The tables are catalog tables (``saveAsTable``): bucketing
metadata lives in the catalog, the files in ``spark.sql.warehouse.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators import sales
from cartwheel.session import remove_path, scratch_path, shared_path
from cartwheel.sources.tables import load_table, orders_from_lineitem, products_from_part


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a catalog table bucketed and sorted by ``key``; return it.

    Rows are first dealt to one task for each bucket by the same hash, so each
    task writes one sorted file: as many files as buckets.  The files lie in
    ``path`` if it is given, else in the warehouse folder.
    """
    writer = (df.repartition(int(buckets), key).write.mode("overwrite")
                .bucketBy(int(buckets), key).sortBy(key))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_count(tables: list[DataFrame], least: int, rows: int) -> int:
    """Buckets for ``tables``: ``least``, or more where the largest would have over ``rows`` rows in one.

    Rows are counted from the Parquet footers.  Spark's own limit of buckets holds.
    """
    most = int(tables[0].sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    needed = -(-max(table.count() for table in tables) // rows)
    return max(int(least), min(needed, most))


def co_bucketed_sales_inputs(spark: SparkSession, sf_dir: str, buckets: int, prefix: str = "cartwheel",
                             folder: str | None = None, bucket_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(orders, products) whose line/header join reads co-bucketed tables.

    Writes ``{prefix}_lineitem`` and ``{prefix}_orders`` bucketed on the
    order key, below ``folder`` if it is given (else in the warehouse).  Both
    tables have the same number of buckets: ``buckets``, or as many as keep a
    bucket to some ``bucket_rows`` rows.  One task sorts one bucket, so its
    memory does not grow with the tables.
    """
    lineitem, orders = load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "orders")
    buckets = bucket_count([lineitem, orders], buckets, bucket_rows)
    lineitem = save_bucketed(lineitem, f"{prefix}_lineitem", "l_orderkey", buckets, folder and f"{folder}/lineitem")
    orders = save_bucketed(orders, f"{prefix}_orders", "o_orderkey", buckets, folder and f"{folder}/orders")
    return (orders_from_lineitem(lineitem, orders),
            products_from_part(load_table(spark, sf_dir, "part")))


def customers_on_buckets(spark: SparkSession, sf_dir: str, buckets: int, explain: list | None = None) -> DataFrame:
    """Revenue of every customer, over tables bucketed for this run and removed after it.

    The tables have ``buckets`` buckets, or more if they are large.  The result is a table in the session's shared folder, deleted when the
    application ends.  ``explain`` takes the formatted plan of the run.
    """
    prefix = f"cartwheel_{uuid.uuid4().hex}"
    folder, result = shared_path(spark, "buckets"), scratch_path(spark, "customers-on-buckets")
    try:
        orders, products = co_bucketed_sales_inputs(spark, sf_dir, buckets, prefix, folder)
        found = sales.top_customers_by_revenue(orders, products, n=None)
        if explain is not None:
            explain.append(found._jdf.queryExecution().executedPlan().toString())
        found.write.parquet(result)
    finally:
        for table in ("lineitem", "orders"):
            spark.sql(f"DROP TABLE IF EXISTS {prefix}_{table}")
        remove_path(spark, folder)
    return spark.read.schema(found.schema).parquet(result)
