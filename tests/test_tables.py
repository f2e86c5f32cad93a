"""Warehouse scans and adapters to the e-commerce shape."""

import logging

import pytest

from cartwheel import schemas
from cartwheel.sources import tables

SF = "/root/testdata/sf0.001"


def test_declared_schemas_match_files(spark):
    for name in schemas.WAREHOUSE:
        declared = tables.load_table(spark, SF, name).schema
        inferred = spark.read.parquet(tables.table_path(SF, name)).schema
        assert [(f.name, f.dataType) for f in declared] == \
            [(f.name, f.dataType) for f in inferred], name


def test_adapter_columns_and_types(spark):
    orders, products = tables.sales_inputs(spark, SF)
    assert orders.dtypes == [("order_id", "bigint"), ("product_id", "bigint"),
                             ("quantity", "double"), ("customer_id", "bigint"),
                             ("order_date", "date")]
    assert products.dtypes == [("product_id", "bigint"), ("category", "string"),
                               ("price", "double")]
    lines, _ = tables.sales_inputs(spark, SF, with_header=False)
    assert lines.columns == ["order_id", "product_id", "quantity"]
    assert lines.count() == tables.load_table(spark, SF, "lineitem").count()


def test_appended_rewritten_and_other_session(spark, tmp_path):
    path = f"{tmp_path}/labels.parquet"
    spark.range(5).write.parquet(path)
    assert tables.load_table(spark, str(tmp_path), "labels").count() == 5
    spark.range(5).write.mode("append").parquet(path)
    assert tables.load_table(spark, str(tmp_path), "labels").count() == 10
    spark.range(7).write.mode("overwrite").parquet(path)
    assert tables.load_table(spark, str(tmp_path), "labels").count() == 7
    other = spark.newSession()
    assert tables.load_table(other, str(tmp_path), "labels").sparkSession is not spark
    orders, _ = tables.sales_inputs(other, SF)
    assert orders.sparkSession is other


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        tables.load_table(spark, SF, "nope")


def test_load_parquet_logs_count_and_failures(spark, caplog, tmp_path):
    caplog.set_level(logging.INFO, logger="cartwheel.sources.tables")
    df = tables.load_parquet(spark, tables.table_path(SF, "region"), log_count=True)
    assert df.count() == 5
    assert any("loaded 5 records" in r.getMessage() for r in caplog.records)
    with pytest.raises(Exception):
        tables.load_parquet(spark, str(tmp_path / "missing.parquet"))
    assert any("failed to load" in r.getMessage() for r in caplog.records)
