"""Packing: exact round trip of every document, full sequences, and the plan against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwheel.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, doc_row int, class string"


def texts():
    pick = random.Random(4)
    words = ["the", "ÉCOLE", "it's", "don't", "x1y22", "...", "ΟΔΟΣ", "é", "日本語", "a b", "c\x1cd", "<tag>", "'ll", "we'LL"]
    make = lambda n: "".join(pick.choice(words) + pick.choice([" ", "\n", "\t", "  ", "\x0b", " ", "\x85"]) for _ in range(n))
    out = [make(pick.randint(1, 900)) for _ in range(120)]
    out += [None, "", " \n", "one", make(9000), "z" * 30_000, "<|endoftext|> a <|ENDOFTEXT|>", "a<|startoftext|>b", " ́x", out[0], out[0]]
    return out


TOKENIZER = Tokenizer.from_file(PATH)


def expected(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, want, capacity):
    """Every document once, whole; sequences gapless.  Returns the padding."""
    documents, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and zlib.crc32(bytes(r.ids)) == r.checksum
        documents.setdefault(r.doc_row, []).append((r.start, ids, r.doc_tokens, r.doc_id))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    got = Counter()
    for parts in documents.values():
        whole = []
        for start, ids, total, _ in sorted(parts):
            assert start == len(whole)
            whole += ids
        assert {p[2] for p in parts} == {len(whole)}
        got[parts[0][3], tuple(whole)] += 1
    assert got == Counter(want)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences) * capacity - sum(len(ids) for _, ids in want)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_round_trip(spark, capacity):
    rows = [(None if i % 40 == 39 else i // 2, t, "clash", 7, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = packing.pack(docs, PATH, capacity=capacity).collect()
    want = [(r[0], tuple(expected(r[1]))) for r in rows]
    padding = check(got, want, capacity)
    assert padding <= 0.03 * sum(len(ids) for _, ids in want)


def test_empty_table_and_lone_document(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    row, = packing.pack(spark.createDataFrame([(1, None, "", 1, "")], SCHEMA), PATH).collect()
    assert (row.start, row.length, row.doc_tokens, row.offset) == (0, 1, 1, 0)


def test_a_length_that_fits_badly_is_cut(spark):
    docs = spark.createDataFrame([(i, "a " * 2499, "", 1, "") for i in range(60)], SCHEMA)
    got = packing.pack(docs, PATH).collect()
    assert check(got, [(i, tuple(expected("a " * 2499))) for i in range(60)], 4096) <= 4096


def of(ids, given, end=None):
    return [x for part in ids.of(pa.array(given, pa.string()), end) for x in part.to_pylist()]


def test_word_cache_starts_anew_between_calls(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 5)
    monkeypatch.setattr(tokens, "SLICE", 4000)
    ids, given = tokens.WordIds(PATH), texts()
    for _ in range(2):
        assert of(ids, given) == [np.array(expected(t)[:-1], "<u4").tobytes() for t in given]
        assert of(ids, given, 2) == [np.array(expected(t), "<u4").tobytes() for t in given]
    assert of(ids, []) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abst'.,1 É"), st.characters(blacklist_categories=["Cs"])),
                        max_size=30), max_size=6))
def test_ids_are_those_of_the_file(texts_):
    want = [np.array(expected(t)[:-1], "<u4").tobytes() for t in texts_]
    assert of(tokens.word_ids(PATH), texts_) == want


def test_merges_by_rank_are_those_of_the_file():
    pick, merges = random.Random(6), tokens.Merges(PATH)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "éèüßñøžλжя"
    words = sorted({"".join(pick.choice(letters) for _ in range(pick.randint(1, 14))) for _ in range(20_000)}
                   | {t.removesuffix("</w>") for t in TOKENIZER.get_vocab()})
    words = [w for w in words if w and merges.takes(w.encode())]
    assert merges.usable and len(words) > 30_000
    got = merges.of([w.encode() for w in words])
    assert got == [np.array(e.ids, "<u4").tobytes() for e in TOKENIZER.encode_batch(words, add_special_tokens=False)]


def brute_pattern(sizes, prices, capacity):
    best = [0.0] * (capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max([best[room - s] + p for s, p in zip(sizes, prices) if s <= room], default=0.0)
    return best[capacity]


def test_pricing_matches_brute_force():
    pick = random.Random(1)
    for _ in range(40):
        sizes = np.array(sorted(pick.sample(range(1, 60), pick.randint(1, 9))))
        prices = np.array([pick.choice([0, pick.random()]) for _ in sizes])
        value, pattern = packing.best_pattern(sizes, prices, 100)
        assert (pattern * sizes).sum() <= 100
        assert value == pytest.approx((pattern * prices).sum()) == pytest.approx(brute_pattern(sizes, prices, 100))


def test_program_reaches_known_optima():
    # 10 of 50 and 20 of 25 fill sequences of 100 wholly; halves alone need one each
    patterns, uses = packing.solve(np.array([25, 50]), np.array([20, 10]), 100)
    assert uses.sum() == pytest.approx(10, rel=packing.CLOSE)
    patterns, uses = packing.solve(np.array([51]), np.array([7]), 100)
    assert uses.sum() == pytest.approx(7)
    # 44 + 33 + 22 fits 99; material bound is no plan
    patterns, uses = packing.solve(np.array([22, 33, 44]), np.array([60, 60, 60]), 99)
    assert (patterns @ np.array([22, 33, 44]) <= 99).all() and uses.sum() <= 60 * (1 + packing.CLOSE)
    assert (uses @ patterns >= 60 - 1e-6).all()


@pytest.mark.parametrize("capacity", [1, 2, 64, 4096])
def test_plans_place_every_piece(capacity):
    sizes = packing.class_sizes(capacity)
    assert sizes[-1] == capacity and (np.diff(sizes) > 0).all()
    pick = np.random.default_rng(capacity)
    for high in (1, 3, 400):
        counts = pick.integers(0, high + 1, len(sizes)) * pick.integers(0, 2, len(sizes))
        made = packing.plan(counts, capacity)
        assert ((made.patterns * made.uses[:, None]).sum(axis=0) == counts).all()
        assert (made.patterns @ sizes <= capacity).all() and (made.uses > 0).all()


def test_short_pieces_alone_fill_sequences():
    counts = np.zeros(len(packing.class_sizes(4096)), np.int64)
    counts[:60] = np.random.default_rng(3).integers(0, 3000, 60)
    made = packing.plan(counts, 4096)
    assert made.sequences <= 1.01 * (counts * made.sizes).sum() / 4096 + 1


def test_class_rule_matches_sizes(spark):
    sizes = packing.class_sizes(4096)
    frame = spark.range(1, 4097).select("id", packing._class_of(packing.F.col("id"), sizes).alias("c"))
    assert [r.c for r in frame.orderBy("id").collect()] == np.searchsorted(sizes, np.arange(1, 4097)).tolist()
