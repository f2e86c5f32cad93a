"""Plan properties at cluster scale (broadcast joins disabled)."""

import pytest

from cartwheel.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.adaptive.autoBroadcastJoinThreshold")
# queries that write before returning are checked through their own operators
WRITES = {"format_benchmark", *(n for n in QUERIES if n.startswith("analytics_run"))}
SAMPLERS = {"generate_orders", "uniform_sparse", "weighted_owner", "weighted_sample", "weighted_sample_check",
            "generate_orders_check"}


@pytest.fixture
def no_broadcast(spark):
    saved = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k in NO_BROADCAST:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in WRITES and not n.startswith("roundtrip")))
def test_no_pairwise_joins_and_bounded_broadcasts(no_broadcast, name):
    df = QUERIES[name](no_broadcast, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in SAMPLERS:
        # with the threshold off, nothing is broadcast unless explicitly bounded
        assert "BroadcastExchange" not in plan


def test_sales_scan_is_pruned(spark):
    df = QUERIES["top_customers_by_revenue"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan


@pytest.mark.parametrize("name", ["sales_by_category", "sum_by_category"])
def test_category_sums_aggregate_lines_below_the_join(no_broadcast, name):
    df = QUERIES[name](no_broadcast, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(plan)}
    join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    lines = next(i for i, line in enumerate(plan) if "l_partkey" in line and "Relation" in line)
    below = [plan[i] for i in range(join + 1, lines) if depth[i] > depth[join]]
    assert any("Aggregate [" in line for line in below)


def test_dense_keys_are_drawn_without_a_join(spark):
    from cartwheel.operators.sampling import uniform_sample
    draws, dense = spark.range(100).withColumnRenamed("id", "d"), spark.range(7, 57).withColumnRenamed("id", "k")
    joins = lambda items: "Join" in uniform_sample(draws, "d", items, "k", unique_keys=True) \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert not joins(dense) and joins(dense.where("k <> 20"))
    assert joins(dense.unionByName(spark.createDataFrame([(None,)], "k long")))
    got = {r.k for r in uniform_sample(draws, "d", dense, "k", unique_keys=True).collect()}
    assert got <= set(range(7, 57)) and len(got) > 30
