"""Hot keys: one product and one customer hold a third of all lines.

With broadcast joins disabled and AQE's skew thresholds lowered, the join
plans split the hot partition; results must equal the broadcast plan's.
"""

import datetime as dt

from cartwheel.operators import sales

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot_data(spark):
    n = 6000
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append((i, 1 if hot else 2 + i % 97, 1 if hot else 2 + i % 53, 1 + i % 10,
                     dt.date(2024, 1 + i % 12, 1 + i % 28)))
    orders = spark.createDataFrame(
        rows, "order_id long, customer_id long, product_id long, quantity long, order_date date")
    products = spark.createDataFrame([(k, f"c{k % 4}", 1.0 + k * 0.25) for k in range(1, 60)],
                                     "product_id long, category string, price double")
    return orders.repartition(8), products


def _collect_all(spark, orders, products):
    return {
        "top": sorted(map(tuple, sales.top_customers_by_revenue(orders, products, 5).collect())),
        "cat": sorted(map(tuple, sales.sales_by_category(orders, products).collect())),
        "month": sorted(map(tuple, sales.monthly_trends(orders, products).collect())),
        "left": sorted(map(tuple, sales.customer_revenue_left(orders, products).collect()),
                       key=repr),
    }


def test_hot_keys_same_result_with_skew_split(spark):
    orders, products = _hot_data(spark)
    expected = _collect_all(spark, orders, products)
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = sales.top_customers_by_revenue(orders, products, 5)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan
        assert _collect_all(spark, orders, products) == expected
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert 1 in {r[0] for r in expected["top"]}   # the hot customer ranks
