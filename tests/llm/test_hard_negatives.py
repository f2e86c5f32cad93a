"""Hard negatives against brute force."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cartwheel.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, row int, score string"


def brute(rows, n_positives=5, n_negatives=10):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
              if label is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for a, (anchor, va, la) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, label) for b, (i, v, label) in enumerate(usable)
                  if b != a and len(v) == len(va)]
        for p, i, _ in sorted([s for s in scored if s[2] == la], key=order)[:n_positives]:
            inside = [s for s in scored if s[2] != la and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(anchor, i, rank, n, p, s) for rank, (s, n, _) in
                    enumerate(sorted(inside, key=order)[:n_negatives], 1)]
    return out


def mined(spark, rows, **options):
    frame = spark.createDataFrame(
        [(i, v and [x if x is None else float(x) for x in v], label, 1, "clash") for i, v, label in rows], SCHEMA)
    return [tuple(r) for r in hard_negatives.mine(frame.repartition(5), F.col("vec_id") % 100 == 0, **options).collect()]


def vectors(n, seed, dimension=6):
    pick = random.Random(seed)
    return [(i, [pick.gauss(0.3, 1) for _ in range(dimension)], pick.randrange(3)) for i in range(n)]


def test_matches_brute_force_in_one_and_many_blocks(spark):
    rows = vectors(700, 1)
    want = Counter(brute(rows))
    assert len(want) > 150
    assert Counter(mined(spark, rows)) == want
    assert Counter(mined(spark, rows, anchor_block=2)) == want


def test_nulls_ties_repeats_lengths_and_extremes(spark):
    rows = vectors(350, 2)
    same = rows[5][1]
    rows += [(400 + i, same, i % 3) for i in range(40)]  # ties
    rows += [rows[100], rows[100], rows[7], rows[7]]  # repeated rows, an anchor among them
    rows += [(None, same, 1), (None, same, 0), (800, None, 1), (801, same, None), (802, [], 1), (900, [], 1),
             (1000, [], 0), (803, [1.0, None, 0, 0, 0, 0], 1), (804, [float("nan")] * 6, 1),
             (805, [float("inf")] * 6, 0), (806, same[:3], 1), (1100, same[:3], 0), (1101, same[:3], 0),
             (1300, [9.0] * 4, 1), (None, [8.0] * 4, 1), (1301, [3.0] * 4, 0), (None, [3.0] * 4, 0),
             (1200, [1e6, 0, 0, 0, 0, 0], 2), (1201, [1e7, 1, 0, 0, 0, 0], 2), (1202, [4e6, 0, 1, 0, 0, 0], 0)]
    want = brute(rows)
    assert any(r[1] is None for r in want) and any(r[3] is None for r in want)
    assert Counter(mined(spark, rows)) == Counter(want)


def test_zero_and_negative_scores_and_one_label(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, -1.0], 2), (4, [0.0, 0.0], 2),
            (5, [-0.5, 0.0], 2)]
    assert Counter(mined(spark, rows)) == Counter(brute(rows)) != Counter()
    assert mined(spark, [(i, v, 7) for i, v, _ in rows]) == []
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_a_label_with_most_rows(spark):
    rows = [(i, v, 0 if i % 5 else label) for i, v, label in vectors(900, 3)]
    assert Counter(mined(spark, rows)) == Counter(brute(rows))
