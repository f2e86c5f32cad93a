"""Property tests for the generators and the weighted sampler."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.functions.random import hashed_int, hashed_uniform
from cartwheel.operators import generate as G
from cartwheel.operators.sampling import (pareto_weights, positive_weights, uniform_sample,
                                          weight_intervals, weighted_sample)


def test_hashed_uniform_open_interval_and_layout_free(spark):
    df = spark.range(20000).select("id", hashed_uniform("id", 1, "u").alias("u"),
                                   hashed_int("id", 1, "k", 3, 5).alias("k"))
    r = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.min("k"), F.max("k")).collect()[0]
    assert 0.0 < r[0] and r[1] < 1.0 and abs(r[2] - 0.5) < 0.01
    assert (r[3], r[4]) == (3, 5)
    a = sorted(df.repartition(3).collect())
    b = sorted(df.repartition(11).collect())
    assert a == b


def test_customers_bounds_and_determinism(spark):
    c = G.generate_customers(spark, 3000, seed=7, as_of=dt.date(2024, 6, 30))
    r = c.agg(F.min("customer_id"), F.max("customer_id"), F.countDistinct("customer_id"),
              F.min("age"), F.max("age"), F.avg("age"),
              F.min("registration_date"), F.max("registration_date")).collect()[0]
    assert (r[0], r[1], r[2]) == (1, 3000, 3000)
    assert 18 <= r[3] and r[4] <= 95 and 33 < r[5] < 37
    assert r[6] >= dt.date(2019, 7, 1) and r[7] <= dt.date(2024, 6, 30)
    again = G.customers_from_ids(spark.range(1, 3001).repartition(5)
                                 .withColumnRenamed("id", "customer_id"),
                                 seed=7, as_of=dt.date(2024, 6, 30))
    assert sorted(c.collect()) == sorted(again.collect())
    assert c.schema.simpleString().startswith("struct<customer_id:bigint,name:string")


def test_products_bounds(spark):
    p = G.generate_products(spark, 5000, seed=3)
    r = p.agg(F.min("price"), F.max("price"), F.min("stock"), F.max("stock"),
              F.min("rating"), F.max("rating"), F.countDistinct("category"),
              F.sum((F.bround("price", 2) != F.col("price")).cast("int"))).collect()[0]
    assert 10.0 <= r[0] and r[1] <= 500.0
    assert (r[2], r[3]) == (0, 1000)
    assert 1.0 <= r[4] and r[5] <= 5.0
    assert r[6] == 5 and r[7] == 0


def test_format_table(spark):
    t = G.create_test_dataframe(spark, 2000)
    r = t.agg(F.min("id"), F.max("id"), F.min("amount"), F.max("amount"),
              F.countDistinct("name"), F.countDistinct("category")).collect()[0]
    assert (r[0], r[1]) == (1, 2000) and 10 <= r[2] and r[3] < 10000
    assert (r[4], r[5]) == (8, 5)
    assert t.where("id = 1").collect()[0].email == "user0@example.com"
    assert dict(t.dtypes)["date"] == "timestamp"


def test_intervals_tile_the_line(spark):
    items = spark.createDataFrame([(i, (i % 5)) for i in range(200)], "k long, weight long")
    w = positive_weights(items, "k")
    iv = sorted((r.lo, r.hi) for r in weight_intervals(w, "k", chunks=7).collect())
    assert len(iv) == 160                      # weight 0 items dropped
    assert iv[0][0] == 0
    assert all(a[1] == b[0] for a, b in zip(iv, iv[1:]))
    assert iv[-1][1] == sum(i % 5 for i in range(200))


def test_weighted_sample_exactly_once_and_heavy_item(spark):
    # item 0 holds a third of all weight and spans several explode pieces
    rows = [(0, 2500)] + [(i, 1) for i in range(1, 5001)]
    items = spark.createDataFrame(rows, "item long, weight long")
    draws = spark.range(30000).withColumnRenamed("id", "draw")
    s = weighted_sample(draws, "draw", items, "item", seed=5)
    r = s.agg(F.count("*"), F.countDistinct("draw"),
              F.sum((F.col("item") == 0).cast("int"))).collect()[0]
    assert r[0] == 30000 and r[1] == 30000
    assert abs(r[2] / 30000 - 1 / 3) < 0.02


def test_weighted_sample_layout_free(spark):
    items = spark.createDataFrame([(i, 1 + i % 7) for i in range(300)], "item long, weight long")
    draws = spark.range(2000).withColumnRenamed("id", "draw")
    a = sorted(weighted_sample(draws, "draw", items, "item").collect())
    b = sorted(weighted_sample(draws.repartition(7), "draw", items.repartition(3), "item")
               .collect())
    assert a == b


def test_uniform_sample_covers_items(spark):
    items = spark.range(1, 51).withColumnRenamed("id", "product_id")
    draws = spark.range(20000).withColumnRenamed("id", "order_id")
    s = uniform_sample(draws, "order_id", items, "product_id")
    counts = [r[1] for r in s.groupBy("product_id").count().collect()]
    assert len(counts) == 50 and min(counts) > 300 and max(counts) < 500


def test_orders_pareto_share(spark):
    customers = G.generate_customers(spark, 2000)
    products = G.generate_products(spark, 300)
    o = G.generate_orders(spark, 20000, customers, products, seed=0)
    r = o.agg(F.count("*"), F.countDistinct("order_id"), F.min("quantity"),
              F.max("quantity")).collect()[0]
    assert (r[0], r[1], r[2], r[3]) == (20000, 20000, 1, 10)
    per = sorted((x[1] for x in o.groupBy("customer_id").count().collect()), reverse=True)
    share = sum(per[:400]) / 20000
    assert 0.65 <= share <= 0.95


def test_pareto_weights_minimum(spark):
    w = pareto_weights(spark.range(5000).withColumnRenamed("id", "c"), "c", seed=2)
    r = w.agg(F.min("weight"), F.max("weight")).collect()[0]
    assert r[0] >= 10000 and r[1] > 100000


def test_uniform_sample_sparse_ids_exactly_once(spark):
    items = spark.createDataFrame([(k * 1000 + 7,) for k in range(40)], "product_id long")
    draws = spark.range(5000).withColumnRenamed("id", "order_id")
    s = uniform_sample(draws, "order_id", items, "product_id", seed=3)
    r = s.agg(F.count("*"), F.countDistinct("order_id"), F.countDistinct("product_id")).collect()[0]
    assert (r[0], r[1], r[2]) == (5000, 5000, 40)
    assert s.join(items, "product_id", "left_anti").count() == 0


def test_duplicate_hot_key_keeps_probability(spark):
    # key 0 fills a third of the input rows; it must be merged, not land in one chunk
    rows = [(0, 1)] * 3000 + [(i, 1) for i in range(1, 6001)]
    items = spark.createDataFrame(rows, "item long, weight long")
    draws = spark.range(30000).withColumnRenamed("id", "draw")
    s = weighted_sample(draws, "draw", items, "item", seed=9)
    r = s.agg(F.count("*"), F.countDistinct("draw"),
              F.sum((F.col("item") == 0).cast("int"))).collect()[0]
    assert r[0] == 30000 and r[1] == 30000
    assert abs(r[2] / 30000 - 1 / 3) < 0.02
    u = uniform_sample(draws, "draw", items.select("item"), "item", seed=9)
    share = u.where("item = 0").count() / 30000
    assert abs(share - 1 / 3) < 0.02


def test_unique_key_paths_match_merged_paths(spark):
    items = spark.createDataFrame([(i, 1 + i % 5) for i in range(400)], "item long, weight long")
    draws = spark.range(3000).withColumnRenamed("id", "draw")
    a = sorted(weighted_sample(draws, "draw", items, "item").collect())
    b = sorted(weighted_sample(draws, "draw", items, "item", unique_keys=True).collect())
    assert a == b
    u1 = uniform_sample(draws, "draw", items.select("item"), "item", unique_keys=True)
    r = u1.agg(F.count("*"), F.countDistinct("draw"), F.countDistinct("item")).collect()[0]
    assert (r[0], r[1]) == (3000, 3000) and r[2] > 390


def test_extreme_weights_light_items_share_a_bucket(spark):
    # one item holds ~all the weight; 20,000 light items pack into the same buckets
    rows = [(0, 10**12)] + [(i, 1) for i in range(1, 20001)]
    items = spark.createDataFrame(rows, "item long, weight long")
    draws = spark.range(20000).withColumnRenamed("id", "draw")
    s = weighted_sample(draws, "draw", items, "item", seed=2, unique_keys=True)
    r = s.agg(F.count("*"), F.countDistinct("draw"),
              F.sum((F.col("item") != 0).cast("int"))).collect()[0]
    assert r[0] == 20000 and r[1] == 20000
    assert r[2] <= 3            # light items hold 2e-8 of the weight


def test_no_positive_weights_gives_empty_sample(spark):
    items = spark.createDataFrame([(1, 0), (2, -5), (3, None)], "item long, weight long")
    draws = spark.range(10).withColumnRenamed("id", "draw")
    assert weighted_sample(draws, "draw", items, "item").count() == 0


def test_real_weights_are_drawn_in_proportion(spark):
    from collections import Counter

    from cartwheel.operators.sampling import weighted_sample
    draws = spark.range(6000).withColumnRenamed("id", "draw")
    for weights in ({1: 0.4, 2: 0.6}, {1: 0.4, 2: 0.6, 3: 1.9}, {1: 1e-300, 2: 2.5}, {1: 1e300, 2: 1e300}):
        items = spark.createDataFrame([*weights.items(), (8, float("nan")), (9, -1.0), (10, None)], "item long, weight double")
        got = Counter(r.item for r in weighted_sample(draws, "draw", items, "item").collect())
        assert sum(got.values()) == 6000
        for item, w in weights.items():
            assert abs(got[item] / 6000 - w / sum(weights.values())) < 0.03
