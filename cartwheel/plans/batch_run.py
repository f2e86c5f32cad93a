"""End-to-end batch run: the three sales analyses, saved as Parquet.

Loads nothing eagerly and counts nothing.  By default the order lines are
scanned and joined to prices once: a GROUPING SETS aggregate computes the
per-customer, per-category and per-month totals in one pass, and that
(small) aggregate is written to the session's shared checkpoint folder.
The three results are then finished from the written aggregate, so the
expensive scan/join/shuffle never runs three times, and a lost executor
while writing the results re-reads the aggregate instead of recomputing the
joins.  Writes use ``overwrite`` with Spark's commit protocol, so a retried
job replaces its partial output instead of appending to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwheel.operators import sales
from cartwheel.session import remove_path, scratch_path
from cartwheel.sources.io import read_table, write_table

# Names of the saved result datasets.
OUTPUT_NAMES = ("top_customers", "category_sales", "monthly_trends")


def analyses(orders: DataFrame, products: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    """The three analyses, keyed by their output dataset name."""
    return {
        "top_customers": sales.top_customers_by_revenue(orders, products, n=n),
        "category_sales": sales.sales_by_category(orders, products),
        "monthly_trends": sales.monthly_trends(orders, products),
    }


def run_analytics(orders: DataFrame, products: DataFrame, out_dir: str, n: int = 10,
                  fmt: str = "parquet", single_pass: bool = True) -> dict[str, str]:
    """Run and save the analyses under ``out_dir``; return name -> path.

    ``single_pass=False`` runs the three standalone queries instead.
    """
    spark, staged = orders.sparkSession, None
    if single_pass:
        staged = scratch_path(spark, "combined-aggregates")
        # partitioned by grouping set: the category and month results read
        # only their own small directories, not the per-customer rows
        write_table(sales.combined_aggregates(orders, products), staged, "parquet",
                    partition_by=["_set"])
        results = sales.split_combined(read_table(spark, staged, "parquet"), n)
    else:
        results = analyses(orders, products, n)
    paths = {}
    for name, df in results.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        write_table(df, path, fmt)
        paths[name] = path
    if staged:
        remove_path(spark, staged)
    return paths


def timed_analytics(tables: dict[str, DataFrame], orders: DataFrame, products: DataFrame,
                    n: int = 10, engine: str = "spark") -> DataFrame:
    """Time loading and each analysis; return an ENGINE_TIMINGS table.

    Steps: ``Load <name>`` per table (a full count), then ``Top Customers``,
    ``Category Sales`` and ``Monthly Trends`` (each run to completion through
    the ``noop`` sink, nothing collected).  Only the clock is on the driver.
    Feed the result to ``reports.step_totals`` or, with another engine's
    timings, to ``reports.timing_compare``.
    """
    import time

    from cartwheel import schemas

    rows = []
    for name, df in tables.items():
        t0 = time.perf_counter()
        df.count()
        rows.append((f"Load {name}", engine, time.perf_counter() - t0))
    labels = {"top_customers": "Top Customers", "category_sales": "Category Sales",
              "monthly_trends": "Monthly Trends"}
    for name, df in analyses(orders, products, n).items():
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        rows.append((labels[name], engine, time.perf_counter() - t0))
    return orders.sparkSession.createDataFrame(rows, schemas.ENGINE_TIMINGS)
