"""File-format benchmark and synthetic-dataset runs.

``benchmark_formats`` writes one table in each storage format, reads it back
in full, and returns a metrics table (one row per format, in measuring
order) that the report operators take as input.  Only the timing is done on
the driver (wall clock around each Spark job); writing, reading and sizing
are Spark jobs.  Peak memory and CPU time of a distributed job are not
single-process quantities, so those columns are NULL.

``generate_dataset`` is the data-generation run: customers, products and
Pareto-weighted orders written as Parquet (or CSV / ORC), followed by a
summary of record counts and stored sizes.
"""

from __future__ import annotations

import datetime as dt
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import generate
from cartwheel.operators.reports import dataset_summary
from cartwheel.sources.io import format_file_size, read_table, stored_size, write_table

__all__ = ["benchmark_formats", "format_file_size", "generate_dataset"]

# Formats measured by default, in measuring order.
log = logging.getLogger(__name__)

DEFAULT_FORMATS = ("csv", "parquet", "orc")
# Labels of the formats in the metrics table.
FORMAT_LABELS = {"csv": "CSV", "parquet": "Parquet", "orc": "ORC"}


def benchmark_formats(df: DataFrame, out_dir: str,
                      formats: tuple[str, ...] = DEFAULT_FORMATS) -> DataFrame:
    """Write/read round trip per format; returns a FORMAT_METRICS table.

    A format whose write or read fails is logged with its error and gets no row
    (as a failed run does not), so reports see only measured formats.
    """
    spark = df.sparkSession
    rows = []
    for ordinal, fmt in enumerate(formats):
        path = f"{out_dir.rstrip('/')}/benchmark.{fmt}"
        try:
            t0 = time.perf_counter()
            write_table(df, path, fmt)
            t1 = time.perf_counter()
            read_table(spark, path, fmt, schema=df.schema).write.format("noop") \
                .mode("overwrite").save()
            t2 = time.perf_counter()
            size = stored_size(spark, path, glob="part-*").first()["size_bytes"]
        except Exception:  # noqa: BLE001 - a failed format is logged and left out
            log.exception("format %s failed", fmt)
            continue
        rows.append((FORMAT_LABELS.get(fmt, fmt), ordinal, size / (1024.0 * 1024.0),
                     t1 - t0, t2 - t1, None, None, None))
    return spark.createDataFrame(rows, schemas.FORMAT_METRICS)


def format_fidelity(df: DataFrame, out_dir: str, formats: tuple[str, ...] = DEFAULT_FORMATS) -> DataFrame:
    """What :func:`benchmark_formats` finds besides times: one row per format asked for.

    Columns: format, ordinal, rows_back, rows_differing (rows missing or added,
    counted with repeats), failed.  A format that fails has NULL counts.
    """
    spark, rows = df.sparkSession, []
    for ordinal, fmt in enumerate(formats):
        path = f"{out_dir.rstrip('/')}/fidelity.{fmt}"
        try:
            write_table(df, path, fmt)
            back = read_table(spark, path, fmt, schema=df.schema)
            sides = df.withColumn("_side", F.lit(1)).unionByName(back.withColumn("_side", F.lit(-1)))
            differing = sides.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.sum("_side").alias("_more"))
            found = differing.agg(F.coalesce(F.sum(F.abs("_more")), F.lit(0))).first()[0]
            rows.append((FORMAT_LABELS.get(fmt, fmt), ordinal, back.count(), found, False))
        except Exception:  # noqa: BLE001 - a failed format is logged and marked
            log.exception("format %s failed", fmt)
            rows.append((FORMAT_LABELS.get(fmt, fmt), ordinal, None, None, True))
    return spark.createDataFrame(rows, "format string, ordinal long, rows_back long, rows_differing long, failed boolean")


def generate_dataset(spark: SparkSession, out_dir: str, num_customers: int,
                     num_products: int, num_orders: int, seed: int = 0,
                     as_of: dt.date = generate.DEFAULT_AS_OF, fmt: str = "parquet") -> DataFrame:
    """Generate and save customers, products and orders; return a summary.

    Summary columns: dataset, record_count (counted from the written files),
    size_mb.  Orders draw their customers from the written customers table
    (read back, so the orders job does not recompute the customers).
    """
    base = out_dir.rstrip("/")
    paths = {name: f"{base}/{name}.{fmt}" for name in ("customers", "products", "orders")}
    write_table(generate.generate_customers(spark, num_customers, seed, as_of),
                paths["customers"], fmt)
    write_table(generate.generate_products(spark, num_products, seed), paths["products"], fmt)
    customers = read_table(spark, paths["customers"], fmt, schemas.CUSTOMERS)
    products = read_table(spark, paths["products"], fmt, schemas.PRODUCTS)
    # ids 1..n of the generated tables are primary keys
    write_table(generate.generate_orders(spark, num_orders, customers, products, seed,
                                         as_of=as_of, unique_keys=True), paths["orders"], fmt)
    schema_of = {"customers": schemas.CUSTOMERS, "products": schemas.PRODUCTS,
                 "orders": schemas.ORDERS}
    return dataset_summary({name: read_table(spark, path, fmt, schema_of[name])
                            for name, path in paths.items()}, paths=paths)
