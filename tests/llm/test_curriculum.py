import random

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import curriculum as C
from cartwheel.llm import queries

SCHEMA = "doc_id bigint, text string, source string, size string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], SCHEMA)


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, repeat=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > repeat * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = repeat * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_targets_and_taken(spark):
    pick = random.Random(4)
    rows = [(i, "w " * pick.randint(0, 30), pick.choice(["b", "a", "a", "a", "ü", "Z", None])) for i in range(400)]
    rows += [(7, rows[7][1], rows[7][2]), (None, "w w", "a"), (500, None, "a"), (501, "", "empty")]
    got = C.plan_mix(frame(spark, rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    assert len(got) == len(rows) and got[0].key == "y"
    for r in got:
        assert r.mix.source_size == sizes[r.source]
        assert r.mix.target == pytest.approx(targets[r.source])
        assert r.mix.taken <= 2 * r.mix.size and r.mix.taken == r.mix.size * len(r.mix.positions)
        assert all(0 <= p <= 1 for p in r.mix.positions)
        taken[r.source] += r.mix.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 16
    again = C.plan_mix(frame(spark, rows[::-1]).repartition(5), bucket_digits=1).collect()
    key = lambda r: (str(r.doc_id), r.mix.size, tuple(r.mix.positions))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_positions_follow_the_schedule(spark):
    rows = [(i, "one two three", "s") for i in range(3000)]
    knots = ((0.0, 0.0), (0.5, 3.0), (1.0, 1.0))
    got = C.plan_mix(frame(spark, rows), weights=(1.0,), share=1.0, schedules=(knots,)).collect()
    at = sorted(p for r in got for p in r.mix.positions)
    area = 0.75 + 1.0
    for t, integral in ((0.25, 0.5 * 0.25 * 1.5), (0.5, 0.75), (0.75, 0.75 + 0.25 * 2.5)):
        assert sum(p <= t for p in at) / 3000 == pytest.approx(integral / area, abs=0.002)


def test_mix_is_sorted_and_repeats(spark):
    rows = [(i, "a b c", "small") for i in range(10)] + [(100 + i, "a b", "large") for i in range(100)]
    mixed = C.mix(frame(spark, rows), weights=(1.0, 9.0))
    got = mixed.collect()
    assert [(r.position, r.doc_id) for r in got] == sorted((r.position, r.doc_id) for r in got)
    assert mixed.columns == ["doc_id", "text", "source", "size", "key", "position"]
    assert max(sum(r.doc_id == i for r in got) for i in range(110)) <= 2


def test_places_number_the_copies_in_the_order_of_the_mix(spark):
    pick = random.Random(8)
    rows = [(i, "w " * pick.randint(0, 9), pick.choice(["b", "a", "a", None])) for i in range(500)]
    rows += rows[:40] + [(None, "w w", "a"), (None, "", "b"), (None, None, None), (3, None, "a"), (3, "", "a")]
    how = {"schedules": (((0.0, 2.0), (1.0, 1.0)), ((0.0, 0.0), (0.4, 0.0), (0.5, 1.0), (1.0, 0.0)))}
    got = C.plan_mix(frame(spark, rows).repartition(7), **how).collect()
    assert len(got) == len(rows) and any(len(r.mix.places) == 2 for r in got)
    copies = sorted((place, position, r.doc_id) for r in got for place, position in zip(r.mix.places, r.mix.positions))
    assert [c[0] for c in copies] == list(range(len(copies)))
    order = lambda c: (c[0], c[1] is not None, c[1] or 0)
    assert [c[1:] for c in copies] == sorted([c[1:] for c in copies], key=order)
    mixed = [(r.position, r.doc_id) for r in C.mix(frame(spark, rows), **how).collect()]
    assert [c[1:] for c in copies] == mixed
    assert all(len(r.mix.places) == len(r.mix.positions) and r.mix.places == sorted(r.mix.places) for r in got)


def test_query_lists_documents_in_training_order(spark, tmp_path):
    pick = random.Random(9)
    rows = [(i, "w " * pick.randint(0, 9), pick.choice("abcd")) for i in range(300)] + [(900 + i, "w", "e") for i in range(30)]
    frame(spark, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.position, r.doc_id) for r in queries.op5_curriculum(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) and any(p is None for p, _ in got)
    assert got == sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_numbers_in_order_over_many_partitions(spark):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), "id").repartition(9)
    got = C.in_order(rows, ["a", "id"], "place").collect()
    assert [r.place for r in sorted(got, key=lambda r: (r.a, r.id))] == list(range(20_000))
    assert C.in_order(rows.limit(0), ["a", "id"], "place").count() == 0


def test_empty_table_and_bad_schedule(spark):
    assert C.plan_mix(frame(spark, [])).count() == 0
    assert C.mix(frame(spark, [(1, "", "a"), (2, None, None)])).count() == 0
    with pytest.raises(ValueError):
        C.plan_mix(frame(spark, []), schedules=(((0.0, 0.0), (1.0, 0.0)),))
