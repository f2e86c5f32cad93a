"""Edge-row tests for the sales operators (FIXTURES.md section 2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.operators import sales

ORDER_COLS = "order_id long, customer_id long, product_id long, quantity long, order_date date"
PRODUCT_COLS = "product_id long, category string, price double"
D = dt.date


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDER_COLS)


def products(spark, rows):
    return spark.createDataFrame(rows, PRODUCT_COLS)


@pytest.fixture
def base(spark):
    o = orders(spark, [
        (1, 10, 100, 2, D(2024, 1, 5)),
        (2, 10, 101, 1, D(2024, 1, 20)),
        (3, 11, 100, 1, D(2024, 2, 2)),
        (4, 12, 102, 3, D(2024, 2, 9)),
    ])
    p = products(spark, [(100, "Books", 10.0), (101, "Home", 20.5), (102, "Books", 0.1)])
    return o, p


def test_top_customers_basic(base):
    o, p = base
    rows = sales.top_customers_by_revenue(o, p, n=10).collect()
    assert [tuple(r) for r in rows] == [
        (10, 40.5, 2, 20.25),
        (11, 10.0, 1, 10.0),
        (12, 0.3, 1, 0.3),
    ]


def test_top_customers_exact_money(base):
    # 3 * 0.1 is 0.30000000000000004 in doubles; the exact decimal gives 0.3
    o, p = base
    row = sales.top_customers_by_revenue(o, p).where("customer_id = 12").collect()[0]
    assert row.total_revenue == 0.3


def test_revenue_tie_goes_to_lower_customer(spark):
    o = orders(spark, [(1, 7, 1, 1, D(2024, 1, 1)), (2, 3, 1, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0)])
    rows = sales.top_customers_by_revenue(o, p, n=1).collect()
    assert rows[0].customer_id == 3


def test_unknown_and_null_product_dropped_by_inner(spark):
    o = orders(spark, [(1, 1, 1, 1, D(2024, 1, 1)), (2, 2, 99, 1, D(2024, 1, 1)),
                       (3, 3, None, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0)])
    got = {r.customer_id for r in sales.top_customers_by_revenue(o, p).collect()}
    assert got == {1}
    assert sales.sales_by_category(o, p).collect()[0].order_count == 1


def test_left_join_keeps_unknown_product_as_null_last(spark):
    o = orders(spark, [(1, 1, 1, 2, D(2024, 1, 1)), (2, 2, 99, 1, D(2024, 1, 1)),
                       (3, None, 1, 1, D(2024, 1, 1)), (4, 4, None, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0)])
    rows = [tuple(r) for r in sales.customer_revenue_left(o, p).collect()]
    assert rows[0] == (1, 10.0)
    assert rows[1] == (None, 5.0)
    assert set(rows[2:]) == {(2, None), (4, None)}
    assert rows[2:] == [(2, None), (4, None)]


def test_left_zero_variant(spark):
    o = orders(spark, [(1, 1, 1, 2, D(2024, 1, 1)), (2, 2, 99, 1, D(2024, 1, 1)),
                       (3, None, 1, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0)])
    rows = [tuple(r) for r in sales.customer_revenue_left_zero(o, p, n=10).collect()]
    assert rows == [(1, 10.0), (2, 0.0)]


def test_null_order_id_not_counted_but_revenue_kept(spark):
    o = orders(spark, [(None, 1, 1, 2, D(2024, 1, 1)), (5, 1, 1, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0)])
    r = sales.top_customers_by_revenue(o, p).collect()[0]
    assert (r.total_revenue, r.order_count, r.avg_order_value) == (15.0, 1, 15.0)


def test_all_null_order_ids_give_null_average(spark):
    o = orders(spark, [(None, 1, 1, 2, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0)])
    r = sales.top_customers_by_revenue(o, p).collect()[0]
    assert r.order_count == 0 and r.avg_order_value is None


def test_order_weighted_average_price(spark):
    o = orders(spark, [(1, 1, 1, 1, D(2024, 1, 1)), (2, 1, 1, 1, D(2024, 1, 1)),
                       (3, 1, 1, 1, D(2024, 1, 1)), (4, 1, 2, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 10.0), (2, "Books", 20.0)])
    r = sales.sales_by_category(o, p).collect()[0]
    assert r.avg_price == 12.5
    assert (r.total_units_sold, r.order_count, r.total_revenue) == (4, 4, 50.0)


def test_category_sorted_by_revenue(base):
    o, p = base
    cats = [r.category for r in sales.sales_by_category(o, p).collect()]
    assert cats == ["Books", "Home"]


def test_duplicate_product_id_multiplies_rows(spark):
    o = orders(spark, [(1, 1, 1, 1, D(2024, 1, 1))])
    p = products(spark, [(1, "Books", 5.0), (1, "Books", 5.0)])
    r = sales.top_customers_by_revenue(o, p).collect()[0]
    assert (r.total_revenue, r.order_count) == (10.0, 2)


def test_monthly_first_gap_and_zero_months(spark):
    o = orders(spark, [
        (1, 1, 1, 1, D(2024, 1, 3)),   # Jan: 5
        (2, 1, 2, 1, D(2024, 3, 9)),   # Mar: 0 (free product), Feb missing
        (3, 1, 1, 2, D(2024, 4, 1)),   # Apr: 10
    ])
    p = products(spark, [(1, "Books", 5.0), (2, "Books", 0.0)])
    rows = [tuple(r) for r in sales.monthly_trends(o, p).orderBy("year_month").collect()]
    assert rows == [
        (D(2024, 1, 1), 5.0, None, None),
        (D(2024, 3, 1), 0.0, 5.0, -100.0),
        (D(2024, 4, 1), 10.0, 0.0, None),   # previous is 0: NULL, no error
    ]


def test_monthly_null_date_sorts_first(spark):
    o = orders(spark, [(1, 1, 1, 1, None), (2, 1, 1, 2, D(2024, 5, 30))])
    p = products(spark, [(1, "Books", 5.0)])
    rows = [tuple(r) for r in sales.monthly_trends(o, p).collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0]))
    assert rows == [(None, 5.0, None, None), (D(2024, 5, 1), 10.0, 5.0, 100.0)]


def test_layout_independent_revenue(spark):
    rows = [(i, i % 37, i % 11, 1 + i % 10, D(2024, 1 + i % 12, 1)) for i in range(3000)]
    o = orders(spark, rows)
    p = products(spark, [(k, f"c{k % 3}", 10.0 + k * 0.07) for k in range(11)])
    a = sales.sales_by_category(o.repartition(1), p).collect()
    b = sales.sales_by_category(o.repartition(13, "quantity"), p).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_sum_by_key_sample_amounts(spark):
    rows = [(1, "Electronics", 1000), (2, "Books", 50), (3, "Electronics", 800),
            (4, "Clothing", 120), (5, "Books", 45)]
    df = spark.createDataFrame(rows, schemas.SAMPLE_AMOUNTS)
    got = {r.category: r.total_amount for r in sales.sum_by_key(df).collect()}
    assert got == {"Electronics": 1800, "Clothing": 120, "Books": 95}


def test_line_revenue_columns(base):
    o, p = base
    df = sales.line_revenue(o, p)
    assert "line_revenue" in df.columns and "_revenue_exact" not in df.columns
    assert sorted(r.line_revenue for r in df.collect()) == [0.3, 10.0, 20.0, 20.5]


def test_plan_prunes_and_aggregates_partially(spark, tmp_path):
    from cartwheel.sources.tables import sales_inputs
    orders_df, products_df = sales_inputs(spark, "/root/testdata/sf0.001")
    plan = sales.top_customers_by_revenue(orders_df, products_df)._jdf \
        .queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "partial_sum" in plan
    assert "l_extendedprice" not in plan  # pruned from the scan


def test_no_integer_division_errors_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", "True")
    o = orders(spark, [(1, 1, 1, 1, D(2024, 1, 1)), (2, 1, 1, 1, D(2024, 2, 1))])
    p = products(spark, [(1, "Books", 0.0)])
    rows = sales.monthly_trends(o, p).collect()
    assert all(r.growth_percentage is None for r in rows)


def test_top_customers_from_lines_matches(spark):
    from cartwheel.sources.tables import load_table, order_lines, sales_inputs
    sf = "/root/testdata/sf0.01"
    orders, products = sales_inputs(spark, sf)
    want = [tuple(r) for r in sales.top_customers_by_revenue(orders, products, 25).collect()]
    headers = load_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    got = [tuple(r) for r in sales.top_customers_from_lines(
        order_lines(load_table(spark, sf, "lineitem")), headers, products, 25).collect()]
    assert got == want


def test_category_sums_are_exact_for_fractions_and_wide_products(spark):
    from decimal import Decimal
    quantities = [0.25, 3.0, 1.125, 0.000001, 999999.0, None, 2000000.5, -1.5, 1e7]
    prices = [(1, "a", 0.1), (2, "a", 19.99), (3, "b", 0.00000001), (4, "b", None), (5, "c", 123456789.125),
              (1, "d", 2.5), (6, "e", 1e-12), (7, "f", float("inf"))]
    rows = [(i, 1, 1 + i % 8, quantities[i % 9], None) for i in range(400)]
    orders = spark.createDataFrame(rows, "order_id long, customer_id long, product_id long, quantity double, order_date date")
    products = spark.createDataFrame(prices, "product_id long, category string, price double")
    got = {r.category: r for r in sales.sales_by_category(orders, products).collect()}
    exact = lambda x: Decimal(repr(x))
    for c in "abcd":
        pairs = [(r[3], p[2]) for r in rows for p in prices if p[0] == r[2] and p[1] == c]
        lines = [exact(q) * exact(x) for q, x in pairs if q is not None and x is not None]
        assert got[c].total_revenue == float(sum(lines))
        assert got[c].total_units_sold == float(sum(exact(q) for q, _ in pairs if q is not None))
        priced = [exact(x) for _, x in pairs if x is not None]
        assert got[c].avg_price == float(sum(priced)) / len(priced) and got[c].order_count == len(pairs)
    assert abs(got["e"].total_revenue / sum(r[3] * 1e-12 for r in rows if r[2] == 6 and r[3] is not None) - 1) < 1e-12
    assert got["f"].avg_price == float("inf")


def test_category_sums_through_equal_the_lines(spark):
    from cartwheel.sources.tables import sales_inputs
    orders, products = sales_inputs(spark, "/root/testdata/sf0.01", with_header=False)
    orders = orders.withColumn("quantity", F.col("quantity") / 4)
    products = products.withColumn("price", F.col("price") / 8)
    lines = sales.priced_lines(orders, products, extra_product_cols=("category",))
    want = {r.category: r for r in lines.groupBy("category").agg(
        *sales.revenue_sums(), F.count("order_id").alias("n")).select(
        "category", sales.summed_parts("_line").alias("total"), "n").collect()}
    got = {r.category: r for r in sales.sales_by_category(orders, products).collect()}
    assert {c: (r.total, r.n) for c, r in want.items()} == {c: (r.total_revenue, r.order_count) for c, r in got.items()}
