"""The end-to-end run writes exactly what the standalone queries return."""

import datetime as dt

import pytest

from cartwheel.operators import sales
from cartwheel.plans.batch_run import OUTPUT_NAMES, analyses, run_analytics
from cartwheel.sources.io import read_table
from cartwheel.sources.tables import sales_inputs


@pytest.mark.parametrize("single_pass", [True, False])
def test_run_matches_standalone_queries(spark, tmp_path, single_pass):
    orders, products = sales_inputs(spark, "/root/testdata/sf0.01")
    paths = run_analytics(orders, products, str(tmp_path / "out"), single_pass=single_pass)
    assert tuple(paths) == OUTPUT_NAMES
    expected = analyses(orders, products)
    for name, path in paths.items():
        got = sorted(tuple(r) for r in read_table(spark, path).collect())
        want = sorted(tuple(r) for r in expected[name].collect())
        assert got == want, name


def test_single_pass_keeps_null_keys_apart(spark, tmp_path):
    o = spark.createDataFrame([
        (1, None, 1, 2, dt.date(2024, 1, 1)),
        (2, 5, 1, 1, None),
        (3, 5, 2, 1, dt.date(2024, 2, 1)),
    ], "order_id long, customer_id long, product_id long, quantity long, order_date date")
    p = spark.createDataFrame([(1, None, 5.0), (2, "Books", 7.0)],
                              "product_id long, category string, price double")
    combined = sales.split_combined(sales.combined_aggregates(o, p))
    for name, df in analyses(o, p).items():
        assert sorted(map(tuple, combined[name].collect()), key=repr) == \
            sorted(map(tuple, df.collect()), key=repr), name


def test_timed_analytics_feeds_timing_reports(spark):
    from cartwheel.operators.reports import step_totals, timing_compare
    from cartwheel.plans.batch_run import timed_analytics
    from cartwheel.sources.tables import load_table
    sf = "/root/testdata/sf0.001"
    orders, products = sales_inputs(spark, sf)
    t = timed_analytics({"orders": load_table(spark, sf, "orders")}, orders, products)
    steps = [r.step for r in t.collect()]
    assert steps == ["Load orders", "Top Customers", "Category Sales", "Monthly Trends"]
    assert all(r.seconds > 0 for r in t.collect())
    total = step_totals(t).collect()[0]
    assert total.engine == "spark" and total.total_seconds > 0
    other = t.selectExpr("step", "'other' AS engine", "seconds * 2 AS seconds")
    cmp = timing_compare(t.unionByName(other), "spark", "other").collect()
    assert {r.faster for r in cmp} == {"spark"}


def test_staged_aggregate_is_pruned_per_result(spark, tmp_path):
    from cartwheel.sources.io import write_table
    orders, products = sales_inputs(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "staged")
    write_table(sales.combined_aggregates(orders, products), path, "parquet",
                partition_by=["_set"])
    df = sales.split_combined(read_table(spark, path))["category_sales"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_set" in plan and "= category)]" in plan
