"""Format benchmark and dataset generation runs."""

import datetime as dt

from cartwheel.operators import reports
from cartwheel.plans.format_benchmark import (benchmark_formats, format_file_size,
                                              generate_dataset)
from cartwheel.sources.io import read_table
from cartwheel import schemas


def test_benchmark_formats_feeds_reports(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    m = benchmark_formats(df, str(tmp_path))
    rows = m.orderBy("ordinal").collect()
    assert [r.format for r in rows] == ["CSV", "Parquet", "ORC"]
    assert all(r.file_size_mb > 0 and r.write_time_s > 0 and r.read_time_s > 0 for r in rows)
    assert rows[0].file_size_mb > rows[1].file_size_mb   # columnar beats text
    s = reports.savings_vs_baseline(m).collect()
    assert {r.format for r in s} == {"Parquet", "ORC"}
    assert all(r["size_savings_%"] > 0 for r in s)
    best = {r.title: r.format for r in reports.best_per_metric(m).collect()}
    assert set(best) == {"Fastest Write", "Fastest Read", "Smallest File", "Lowest Energy"}
    assert best["Lowest Energy"] is None  # not measured


def test_failed_format_is_skipped(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "id long, a array<long>")   # CSV cannot hold it
    m = benchmark_formats(df, str(tmp_path))
    assert [r.format for r in m.orderBy("ordinal").collect()] == ["Parquet", "ORC"]


def test_format_file_size_unknown(spark, tmp_path):
    assert format_file_size(spark, str(tmp_path / "missing")) == "Unknown"


def test_generate_dataset(spark, tmp_path):
    out = str(tmp_path / "raw")
    summary = {r.dataset: (r.record_count, r.size_mb) for r in
               generate_dataset(spark, out, 300, 50, 2000, seed=4,
                                as_of=dt.date(2024, 1, 31)).collect()}
    assert {k: v[0] for k, v in summary.items()} == {"customers": 300, "products": 50,
                                                     "orders": 2000}
    assert all(v[1].endswith(" MB") for v in summary.values())
    orders = read_table(spark, f"{out}/orders.parquet", "parquet", schemas.ORDERS)
    customers = read_table(spark, f"{out}/customers.parquet", "parquet", schemas.CUSTOMERS)
    assert orders.join(customers, "customer_id", "left_anti").count() == 0
    csv = generate_dataset(spark, str(tmp_path / "csv"), 20, 5, 50, fmt="csv")
    assert {r.dataset: r.record_count for r in csv.collect()}["orders"] == 50


def test_failed_format_is_logged(spark, tmp_path, caplog):
    df = spark.createDataFrame([(1, [1, 2])], "id long, a array<long>")
    got = [r.format for r in benchmark_formats(df, str(tmp_path)).collect()]
    assert got == ["Parquet", "ORC"]
    assert any("csv failed" in r.getMessage() and r.exc_info for r in caplog.records)
