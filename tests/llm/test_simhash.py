"""SimHash groups and contraction components against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cartwheel.llm import simhash
from cartwheel.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, fp string, root int"


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(rows[i][0], f"{fps[i]:016x}", least.get(find(i))) for i in range(len(rows))]


def texts():
    pick = random.Random(3)
    words = ["w%d" % i for i in range(40)]
    out = [(i, " ".join(pick.choice(words) for _ in range(pick.randint(1, 60)))) for i in range(60)]
    base = [pick.choice(words) for _ in range(400)]
    for i in range(60, 130):  # near copies: one word changed
        copy = list(base)
        copy[pick.randrange(400)] = "changed%d" % i
        out.append((i, " ".join(copy)))
    out += [(130, None), (131, ""), (132, " \t\n"), (133, "one two"), (134, "ONE x Two"), (None, out[0][1]),
            (None, None), (5, out[5][1]), (5, out[5][1]), (135, "É é a b"), (136, "x " * 70_000)]
    return out


def test_components_match_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    for segments in (2, 3):
        got = simhash.simhash_components(docs, segments=segments) \
            .select("doc_id", simhash.fingerprint_hex("fp"), "component_id").collect()
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, got), key=key) == sorted(brute_components(rows), key=key)


def test_larger_balls_find_every_pair(spark):
    pick = random.Random(5)
    base = [pick.getrandbits(64) for _ in range(20)]
    fps = {b for b in base}
    for b in base:
        for k in range(1, 8):
            fps.add(b ^ sum(1 << x for x in pick.sample(range(64), k)))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f, f) for f in signed], "fp bigint, root bigint")
    got = {frozenset(map(int, r)) for r in simhash._wide_links(frame, 5, 2).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed
            if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 5}
    assert got == want


def test_one_document_of_each_group_stays(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    kept = [tuple(r) for r in simhash.keep_one_per_group(docs).select("doc_id", "text").collect()]
    groups = brute_components(rows)
    assert len(kept) == len({g[2] for g in groups})
    assert {i for i, _ in kept} <= {g[2] for g in groups}
    assert set(docs.columns) == set(simhash.keep_one_per_group(docs).columns)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_components(docs).count() == 0
    assert simhash.keep_one_per_group(docs).count() == 0


def test_contraction_on_path_star_and_random_graph(spark):
    pick = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)]
    edges += [(pick.randrange(2000, 2200), pick.randrange(2000, 2200)) for _ in range(90)]
    edges += [(7, 7), (None, 3), (1000, 1001), (1001, 1000)]
    got = connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[find(a)] = find(b)
    assert {r.node for r in got} == set(parent)
    by_root, by_find = {}, {}
    for r in got:
        by_root.setdefault(r.root, set()).add(r.node)
        by_find.setdefault(find(r.node), set()).add(r.node)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_find.values()))


def test_links_of_a_crowd_stay_few(spark):
    # all fingerprints within 2 bits of one: 2081 nodes, over a million pairs within 3 bits
    center = 0x0123456789ABCDEF
    ball = {center} | {center ^ (1 << a) for a in range(63)} \
        | {center ^ (1 << a) ^ (1 << b) for a in range(63) for b in range(a)}
    fps = spark.createDataFrame([(f,) for f in ball], "fp bigint")
    linked = simhash.link_fingerprints(fps)
    assert linked.agg(F.countDistinct("root"), F.count("fp")).first() == (1, len(ball))


def test_keep_one_takes_any_column_names_and_types(spark):
    schema = ("doc_id bigint, text string, _id string, _digest int, `a.b` string, fp string, root int, n int, own int, "
              "id_of int, tags map<string,int>")
    rows = [(i, "one two three four" if i % 2 else f"text number {i} of its own kind", "x", i, "dot", "f", 1, 2, 3, 4, {"k": 1})
            for i in range(1, 9)]
    rows += [rows[0], (None, None, "x", 0, "dot", "f", 1, 2, 3, 4, None), (20, "", "x", 0, "dot", "f", 1, 2, 3, 4, {})]
    got = simhash.keep_one_per_group(spark.createDataFrame(rows, schema))
    assert got.schema == spark.createDataFrame(rows, schema).schema
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 4, 6, 8, 20]
    assert simhash.keep_one_per_group(spark.createDataFrame([], schema)).count() == 0
