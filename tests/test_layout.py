"""Co-bucketed line and order tables join without a shuffle."""

import os

from cartwheel.operators import sales
from cartwheel.session import ensure_checkpoint_dir
from cartwheel.sources.layout import co_bucketed_sales_inputs, customers_on_buckets
from cartwheel.sources.tables import sales_inputs

SF = "/root/testdata/sf0.001"
NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_co_bucketed_join_has_no_shuffle_on_order_key(spark):
    saved = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k in NO_BROADCAST:
            spark.conf.set(k, "-1")
        orders, products = co_bucketed_sales_inputs(spark, SF, buckets=4, prefix="t_layout")
        plan = orders._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan          # both sides read pre-partitioned buckets
        files = spark.table("t_layout_lineitem").inputFiles()
        assert len(files) == 4                 # one sorted file for each bucket
        got = sorted(map(tuple, sales.top_customers_by_revenue(orders, products).collect()))
        plain_o, plain_p = sales_inputs(spark, SF)
        want = sorted(map(tuple, sales.top_customers_by_revenue(plain_o, plain_p).collect()))
        assert got == want
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        for t in ("t_layout_lineitem", "t_layout_orders"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_bucketed_run_has_no_shuffle_on_the_order_key_and_leaves_nothing(spark):
    saved, plans = {k: spark.conf.get(k, None) for k in NO_BROADCAST}, []
    try:
        for k in NO_BROADCAST:
            spark.conf.set(k, "-1")
        tables = {t.name for t in spark.catalog.listTables()}
        got = customers_on_buckets(spark, SF, buckets=4, explain=plans)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Exchange hashpartitioning(order_id" not in plans[0] and "Exchange hashpartitioning(l_orderkey" not in plans[0]
    assert "Exchange hashpartitioning(product_id" in plans[0] or "Exchange hashpartitioning(l_partkey" in plans[0]
    want = sales.top_customers_by_revenue(*sales_inputs(spark, SF), n=None)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {t.name for t in spark.catalog.listTables()} == tables
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("buckets-")]


def test_buckets_grow_with_the_tables(spark, tmp_path):
    from pyspark.sql import functions as F
    lines = spark.range(4000).select((F.col("id") % 1500).alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"),
                                     F.lit(2.0).alias("l_quantity"))
    orders = spark.range(1500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"),
                                      F.lit("2024-01-02 00:00:00").cast("timestamp").alias("o_orderdate"))
    part = spark.range(7).select(F.col("id").alias("p_partkey"), F.lit("t").alias("p_type"), F.lit(1.5).alias("p_retailprice"))
    for name, table in (("lineitem", lines), ("orders", orders), ("part", part)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    try:
        view, products = co_bucketed_sales_inputs(spark, str(tmp_path), buckets=2, prefix="t_grow", bucket_rows=100)
        for table in ("t_grow_lineitem", "t_grow_orders"):
            stored = spark.table(table)
            assert len(stored.inputFiles()) == 40   # 4,000 lines, 100 a bucket; headers take the same number
            assert max(r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()) < 200
        got = sales.top_customers_by_revenue(view, products, n=None).collect()
        want = sales.top_customers_by_revenue(*sales_inputs(spark, str(tmp_path)), n=None).collect()
        assert len(got) == 9 and sorted(map(tuple, got)) == sorted(map(tuple, want))
    finally:
        for table in ("t_grow_lineitem", "t_grow_orders"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
