"""Token groups, links and their counts against brute force with the tokenizers themselves."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm import cross_tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOOL_A, TOOL_B = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
TOOL_A.encode_special_tokens = True
OF_A = {i: t for t, i in TOOL_A.get_vocab().items()}
SCHEMA = "doc_id bigint, text string, block string, cells int, id string"


def byte_of(c):
    """The byte-level alphabet, counted out: printable bytes are themselves, the others follow U+0100 in order."""
    if not hasattr(byte_of, "table"):
        printable = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
        rest = (chr(0x100 + k) for k in range(256))
        byte_of.table = {chr(b) if b in printable else next(rest): b for b in range(256)}
    return byte_of.table[c]


def spell_b(i):
    piece = TOOL_B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if TOOL_B.is_byte(i) else piece.replace("▁", " ").encode()


def brute(text):
    """(ids of A, ids of B, groups, linked pairs) by walking both sides."""
    raw = (" " + (text or "")).encode()
    a = [(i, bytes(map(byte_of, OF_A[i]))) for i in TOOL_A.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = [(i, spell_b(i)) for i in TOOL_B.encode(text or "")]
    if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return [], [], "", []
    ends = lambda side: np.cumsum([len(x) for _, x in side]).tolist()
    ends_a, ends_b = ends(a), ends(b)
    links = [(a[i][0], b[j][0]) for i in range(len(a)) for j in range(len(b))
             if max(ends_a[i] - len(a[i][1]), ends_b[j] - len(b[j][1])) < min(ends_a[i], ends_b[j])] \
        if len(a) * len(b) < 400_000 else None
    groups, x, y = [], 0, 0
    after_a, after_b = ({e: k for k, e in enumerate(ends, 1)} for ends in (ends_a, ends_b))
    for e in sorted(after_a.keys() & after_b.keys()):
        i, j = after_a[e], after_b[e]
        groups.append(",".join(str(t) for t, _ in a[x:i]) + "|" + ",".join(str(t) for t, _ in b[y:j]))
        x, y = i, j
    return a, b, ";".join(groups), links


def texts():
    pick = random.Random(8)
    words = ["the", "training", "École", "日本語テキスト", "don't", "12345", "...", "a\nb", " ", "🙂🙃", "x" * 30, "ﬁ", "\x1c", "",
             "\t", "é", "<s>", "</s>", "<|endoftext|>", "<0x41>", "'ll", "ΣΑΣ"]
    out = [" ".join(pick.choice(words) for _ in range(pick.randint(1, 40))) for _ in range(80)]
    return out + [None, "", " ", "  ", " a", "a ", "a  b", "\n", "a \n b", "▁x", "one ▁ two", "\x00", "﻿a", out[0], out[0],
                  "q" * 900, "ab" * 400 + " c"]


def test_documents_and_counts_match_brute_force(spark):
    rows = [(None if i % 30 == 29 else i // 2, t, "clash", 1, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = [brute(r[1]) for r in rows]
    holders = Counter(pair for *_, links in found for pair in set(links))
    highest = Counter()
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    want = Counter((r[0], len(a), len(b), groups.count("|"), len(links), groups,
                    sum(holders[p] == highest[p[0]] for p in links), sum(holders[p] for p in links))
                   for r, (a, b, groups, links) in zip(rows, found))
    assert any(r[1] and not f[0] for r, f in zip(rows, found))  # a text that B does not spell
    for most in (2_000_000, 3):  # one block a task, and many
        aligned = cross_tokenizer.align(docs, A, B, max_pairs=most).withColumn("text_of_groups", F.col("groups"))
        got = cross_tokenizer.link_statistics(aligned).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "text_of_groups", "n_best", "count_sum").collect()
        assert Counter(map(tuple, got)) == want


def test_a_very_long_text(spark):
    pick = random.Random(2)
    text = "".join(pick.choice(["word ", "Ünïcode ", "日本", "9 ", "\n"]) for _ in range(60_000))
    row, = cross_tokenizer.align(spark.createDataFrame([(1, text, "", 1, "")], SCHEMA), A, B).filter("pairs IS NULL").collect()
    a, b, groups, _ = brute(text)
    assert (row.n_a, row.n_b, row.groups) == (len(a), len(b), groups)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cross_tokenizer.link_statistics(cross_tokenizer.align(empty, A, B)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab 1.'\n\t é"), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_ids_are_those_of_the_files(text):
    tools = cross_tokenizer.tokenizers(A, B)
    (a, b), = tools.ids([text])
    want_a, want_b, *_ = brute(text)
    assert (a.tolist(), b.tolist()) == ([i for i, _ in want_a], [i for i, _ in want_b])


ascending = st.lists(st.integers(1, 60), unique=True, max_size=40).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ascending, ascending, st.integers(1, 50))
def test_pieces_cover_the_merge(x, y, size):
    a, b = np.array([*x, 61]), np.array([*y, 61])
    cut = list(cross_tokenizer.pieces(a, b, size))
    assert [p[0] for p in cut] + [len(a)] == [0] + [p[1] for p in cut]
    assert [p[2] for p in cut] + [len(b)] == [0] + [p[3] for p in cut]
    assert all(abs(p[1] - p[0] + p[3] - p[2] - size) <= 1 for p in cut[:-1])
    i, j, common = cross_tokenizer.overlaps(a, b, size)
    ends = sorted(set(a.tolist()) | set(b.tolist()))
    assert i.tolist() == [int((a < e).sum()) for e in ends]
    assert j.tolist() == [int((b < e).sum()) for e in ends]
    assert common.tolist() == [e in a and e in b for e in ends]


def test_planes_round_trip():
    numbers = np.array([0, 1, 255, 256, 70_000, 2 ** 32 - 1])
    assert cross_tokenizer.from_planes(cross_tokenizer.planes(numbers)).tolist() == numbers.tolist()
    assert cross_tokenizer.from_planes(b"").tolist() == []


@pytest.mark.parametrize("text", ["▁", "a ▁b"])
def test_a_text_that_is_not_spelled_has_no_tokens(text):
    (a, b), = cross_tokenizer.tokenizers(A, B).ids([text])
    assert len(a) == len(b) == 0
