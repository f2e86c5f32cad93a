import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm import ngram_lm as L
from cartwheel.llm.elias_fano import EliasFano, Trie, build_level, open_level

SCHEMA = "doc_id bigint, text string, word string, shard string"


def brute(rows, order, pool):
    words = lambda t: (t or "").lower().encode().split() + [None]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts, contexts = Counter(), Counter()
    for i, t in rows:
        if not fold(i):
            s = [0] * (order - 1) + words(t)
            for j in range(order - 1, len(s)):
                for k in range(order):
                    counts[tuple(s[j - k:j + 1])] += 1
                    contexts[tuple(s[j - k:j])] += 1
    n, v = contexts[()], sum(len(g) == 1 for g in counts)
    base = n + 0.5 * (v + 1)
    weights = [*pool[1:], 1.0]
    out = []
    for i, t in rows:
        s, score, plain = [0] * (order - 1) + words(t), 0.0, 0.0
        for j in range(order - 1, len(s)):
            p = (counts[(s[j],)] + 0.5) / base
            plain += math.log10(p)
            num, den = pool[0] * p, pool[0]
            for k in range(1, order):
                num += weights[k - 1] * counts[tuple(s[j - k:j + 1])]
                den += weights[k - 1] * contexts[tuple(s[j - k:j])]
            score += math.log10(num / den)
        out.append((i, fold(i), len(s) - order + 1, sum(counts[(w,)] > 0 for w in s[order - 1:]), n, plain, score))
    return out


def rows():
    pick = random.Random(12)
    vocabulary = [f"W{i}" for i in range(60)] + ["the"] * 60
    made = [(i, " ".join(pick.choice(vocabulary) for _ in range(pick.randint(0, 50)))) for i in range(120)]
    return made + [(7, made[7][1]), (7, made[7][1]), (None, "the the w1"), (200, None), (201, ""), (202, "É new\tthe"),
                   (203, "the " * 30_000)]


@pytest.mark.parametrize("order,pool,shard", [(3, (5.0, 0.02), 400), (3, (5.0, 0.02), 10 ** 6), (2, (8.0,), 700),
                                              (1, (8.0,), 700), (4, (3.0, 0.1, 0.3), 900)])
def test_scores_match_brute_force(spark, order, pool, shard):
    data = rows()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in data], SCHEMA).repartition(3)
    got = sorted(map(tuple, L.score(docs, order=order, pool=pool, shard_tokens=shard).collect()), key=str)
    want = sorted(brute(data, order, pool), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert abs(g[6] - w[6]) <= 2e-3 * w[2]  # quantisation


def test_chunks_are_cut_and_joined_again(spark, monkeypatch):
    data = rows()[:40]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in data], SCHEMA).coalesce(1)
    whole = {(r.doc_id, round(r.base_score, 6)) for r in L.score(docs, shard_tokens=300).collect()}
    cut = {(r[0], round(r[5], 6)) for r in brute(data, 3, (5.0, 0.02))}
    assert whole == cut


def test_number_of_shared_words_changes_nothing(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows()[:60]], SCHEMA)
    score = lambda **how: sorted((str(r[0]), r[5], round(r[6], 1)) for r in L.score(docs, shard_tokens=300, **how).collect())
    few, all_of = score(frequent=3), score()
    assert [r[0] for r in few] == [r[0] for r in all_of]
    assert all(abs(a[1] - b[1]) < 1e-9 and abs(a[2] - b[2]) <= 0.2 for a, b in zip(few, all_of))
    words = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [7] * 5 + [100, 1000])], "word bigint, n bigint")
    assert [sorted(r.n for r in L._commonest(words, k)) for k in (0, 1, 2, 6, 7, 100)] == [
        [], [1000], [100, 1000], [100, 1000], [7] * 5 + [100, 1000], [1] * 50 + [7] * 5 + [100, 1000]]


def test_empty_and_only_held_out(spark):
    assert L.score(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if L.is_held_out(str(i)))
    got = L.score(spark.createDataFrame([(held, "a b", "x", "y")], SCHEMA)).first()
    assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (True, 3, 0, 0)
    assert math.isfinite(got.score) and got.base_score == pytest.approx(0.0)


def test_probabilities_sum_to_one(spark):
    data = [(i, t) for i, t in rows()[:60]]
    vocabulary = sorted({w.lower() for _, t in data if t for w in t.split()})
    probe = [(100_000 + k, f"{vocabulary[0]} {vocabulary[1]} {w}") for k, w in enumerate([*vocabulary, "neverseen"])]
    scores = {i: s for i, *_, s in brute(data + [p for p in probe if L.is_held_out(str(p[0]))], 3, (5.0, 0.02))}
    assert all(s < 0 for s in scores.values())


def test_elias_fano_round_trip_and_search(tmp_path):
    rng = np.random.default_rng(3)
    for values in ([], [0], [5, 5, 5], rng.integers(0, 10 ** 9, 5000), rng.integers(0, 50, 5000)):
        values = np.sort(np.asarray(values, np.int64))
        EliasFano.encode(values).save(tmp_path / "s")
        assert (EliasFano.open(tmp_path / "s").values() == values).all()
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 40, (300, 2))})
    first = sorted({a for a, _ in pairs})
    build_level(tmp_path / "0", np.zeros(len(first), np.int64), np.array(first), 1, {"num": np.arange(len(first)) * 1.0})
    build_level(tmp_path / "1", np.array([first.index(a) for a, _ in pairs]), np.array([b for _, b in pairs]), len(first),
                {"num": np.arange(len(pairs)) * 0.5})
    trie = Trie([open_level(tmp_path / "0"), open_level(tmp_path / "1")])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(42), np.arange(42), indexing="ij"))
    found = trie.search([a, b])
    for x, y, one, two in zip(a, b, *found):
        assert one == (first.index(x) if x in first else -1)
        assert two == (pairs.index((x, y)) if (x, y) in pairs else -1)
    assert np.allclose(trie.levels[1].look_up("num", np.arange(len(pairs))), np.arange(len(pairs)) * 0.5, atol=0.05)
