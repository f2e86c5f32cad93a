"""Exactness of the money expressions."""

from decimal import Decimal


from cartwheel.functions import money


def test_split_sum_is_exact_for_large_and_negative_values(spark):
    values = [2**62 // 7, 9_007_199_254_740_993, -123_456_789_012_345, 1, 999_999, 1_000_000, -1,
              None]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, c long")
    got = {r.g: r.total for r in df.groupBy("g").agg(*money.sum_cents("c", "s"))
           .select("g", money.summed_cents("s").alias("total")).collect()}
    for g in (0, 1):
        expected = sum(v for i, v in enumerate(values) if i % 2 == g and v is not None)
        assert got[g] == Decimal(expected)


def test_split_sum_all_null_is_null(spark):
    df = spark.createDataFrame([(1, None)], "g int, c long")
    r = df.groupBy("g").agg(*money.sum_cents("c", "s")).select(
        money.cents_to_money(money.summed_cents("s")).alias("m")).collect()[0]
    assert r.m is None


def test_price_cents_and_money_round_trip(spark):
    df = spark.createDataFrame([(901.01,), (0.1,), (19.99,), (1e12 + 0.07,)], "p double")
    rows = df.select(money.price_cents("p").alias("c")).collect()
    assert [r.c for r in rows] == [90101, 10, 1999, 100000000000007]
    back = df.select(money.line_cents_to_money(money.price_cents("p")).alias("m")).collect()
    assert [r.m for r in back] == [901.01, 0.1, 19.99, 1e12 + 0.07]


def test_ratio_and_growth_null_on_zero(spark):
    df = spark.createDataFrame([(5.0, 0.0), (6.0, 3.0), (1.0, None)], "a double, b double")
    r = df.select(money.ratio("a", "b").alias("q"),
                  money.growth_percentage("a", "b").alias("g"),
                  money.savings_percentage("b", "a").alias("s")).collect()
    assert [(x.q, x.g) for x in r] == [(None, None), (2.0, 100.0), (None, None)]
    assert r[1].s == -100.0


def test_round_half_even_keeps_negative_zero(spark):
    import math
    df = spark.createDataFrame([(-0.001,), (0.125,), (0.135,), (-2.675,), (0.004,)], "x double")
    got = [r.r for r in df.select(money.round_half_even("x", 2).alias("r")).collect()]
    assert got[1:] == [0.12, 0.14, -2.68, 0.0]  # as numpy.round
    assert got[0] == 0.0 and math.copysign(1.0, got[0]) == -1.0
    assert math.copysign(1.0, got[4]) == 1.0


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-(2**62), max_value=2**62)),
                min_size=1, max_size=40))
def test_split_sum_matches_python_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c long")
    got = df.agg(*money.sum_cents("c", "s")).select(money.summed_cents("s").alias("t")).first().t
    present = [v for v in values if v is not None]
    assert got == (Decimal(sum(present)) if present else None)
