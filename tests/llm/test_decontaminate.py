import random

import numpy as np

from cartwheel.llm import decontaminate as D

SCHEMA = "doc_id bigint, text string, item_id string, start string"


def brute_align(item, words):
    table = [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if a == b else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table))


def corpus():
    pick = random.Random(8)
    common, rare = ["the", "of", "and", "to"], ["r%d" % i for i in range(400)]
    word = lambda: pick.choice(common) if pick.random() < 0.5 else pick.choice(rare)
    items = [(i, " ".join(word() for _ in range(pick.randint(8, 40)))) for i in range(25)]
    docs = []
    for d in range(160):
        words = [word() for _ in range(pick.randint(0, 120))]
        if d % 2:
            copy = pick.choice(items)[1].split()
            for _ in range(pick.randint(0, len(copy) // 3)):
                k = pick.randrange(len(copy))
                edit = pick.random()
                copy[k:k + 1] = [word()] if edit < 0.5 else [] if edit < 0.75 else [copy[k], word()]
                copy = copy or ["x"]
            words[len(words) // 2:len(words) // 2] = copy
        docs.append((d, " ".join(words).upper() if d % 5 == 0 else "\n".join(words)))
    return items, docs


def hits(spark, docs, items, **how):
    found = D.contaminated_pairs(spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA),
                                 spark.createDataFrame(items, "item_id bigint, text string"), **how)
    return found.collect()


def test_alignment_equals_brute_force():
    pick = np.random.default_rng(0)
    for _ in range(200):
        item, words = pick.integers(1, 5, pick.integers(1, 12)), pick.integers(0, 5, pick.integers(0, 30))
        score, a, b = D.align(item, words)
        assert score == brute_align(list(item), list(words))
        assert 0 <= a <= b <= len(words)
        if score:
            assert brute_align(list(item), list(words[a:b])) == score


def test_finds_what_brute_force_finds(spark):
    items, docs = corpus()
    got = {(r.doc_id, r.item_id): r.score for r in hits(spark, docs, items)}
    seeds = lambda words: {tuple(words[i:i + 4]) for i in range(len(words) - 3)}
    want, unseeded = {}, 0
    for i, text in docs:
        words = text.lower().split()
        for k, item in items:
            score = brute_align(item.split(), words)
            if score >= 0.5 * 2 * len(item.split()):
                if seeds(words) & seeds(item.split()):  # a run of window + n - 1 words is always seeded
                    want[i, k] = score
                else:
                    unseeded += 1
    assert len(want) > 60 and unseeded <= 0.05 * len(want)
    missed = {p for p in want if p not in got}
    assert not missed
    assert all(got[p] <= s for p, s in want.items())
    assert sum(got[p] == s for p, s in want.items()) >= 0.98 * len(want)
    blocks = {(r.doc_id, r.item_id) for r in hits(spark, docs, items, block_words=150)}
    assert set(want) <= blocks


def test_passage_in_every_document_is_found(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "only here once in all of this text")]
    docs = [(i, f"w{i} " * 30 + items[0][1] + f" z{i}" * 9) for i in range(300)] + [(500, items[1][1])]
    got = hits(spark, docs, items)
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, 1) for i in range(300)] + [(500, 2)]
    assert all(r.similarity == 1.0 for r in got) and got[0].end - got[0].start == 10


def test_edges(spark):
    items = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, None), (3, ""), (4, "two words"), (None, "p q r s t u")]
    docs = [(1, None), (2, ""), (None, "x A B C D E F G H y"), (3, "a b c d e f g h"), (3, "a b c d e f g h"),
            (4, "p q r s t u"), (5, "z " * 50_000 + "a b c d e f g h"), (6, "two words")]
    got = hits(spark, docs, items)
    assert sorted((str(r.doc_id), r.item_id, r.start, r.end) for r in got) == [
        ("3", 1, 0, 8), ("3", 1, 0, 8), ("5", 1, 50_000, 50_008), ("None", 1, 1, 9)]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    kept = D.drop_contaminated(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]
    assert hits(spark, [], items) == [] and hits(spark, docs, []) == []


def test_evenly_edited_copies_are_found(spark):
    items, _ = corpus()
    edits = [lambda w, k, s: [w, f"new{k}"] if k % s == s - 1 else [w], lambda w, k, s: [] if k % s == s - 1 else [w],
             lambda w, k, s: [f"new{k}"] if k % s == s - 1 else [w]]
    docs = [(100 * i + 10 * e + s, " ".join(["x"] * 20 + [v for k, w in enumerate(t.split()) for v in edit(w, k, s)]))
            for i, t in items for e, edit in enumerate(edits) for s in (1, 2, 3, 4)]
    docs += [(10_000 + i, t) for i, t in corpus()[1][:60]]
    for min_similarity, window in ((0.5, 2), (0.7, 2), (0.5, 1), (0.25, 3)):
        want = {(d, i): s for d, t in docs for i, item in items
                if (s := D.align(*numbered(item, t))[0]) >= min_similarity * 2 * len(item.split())}
        got = {(r.doc_id, r.item_id): r.score for r in hits(spark, docs, items, min_similarity=min_similarity, window=window)}
        assert got == want and len(want) > 90


def numbered(*texts):
    known = {}
    return [np.array([known.setdefault(w, len(known)) for w in t.lower().split()], np.int64) for t in texts]
