import hashlib
import random
import re

import numpy as np

from cartwheel.llm import pii
from cartwheel.llm.crf import Crf

FIELD = pii.train(pii.labelled_table(rows=500), rounds=60)


def brute_base(text):
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_match_brute_force():
    pick = random.Random(11)
    bits = ["a@b", "@", ".", "co", "x.y", "_", "1", "12", "255", "256", ".7", "+1", " ", "-", "(", ")", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "é", "\n", "+49 30 123456", "u_v@w.de", "10.0.0.1"]
    for _ in range(3000):
        text = "".join(pick.choice(bits) for _ in range(pick.randint(0, 25)))
        assert [(a, pii.ORDER[k], b) for k, a, b in pii.base_spans(text)] == brute_base(text), text


def test_field_on_rows_it_has_not_seen():
    tagger = pii.Tagger(FIELD)
    right, table = 0, pii.labelled_table(rows=300, seed=1234)
    for words, tags in table:
        text = " ".join(words)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        want = {(t[2:], int(starts[i])) for i, t in enumerate(tags) if t.startswith("B-")}
        got = {(k, a) for k, a, _ in tagger.find([text.encode()])[0] if k in pii.FIELD_KINDS}
        right += got == want
    assert right >= 0.95 * len(table)


def test_viterbi_and_expectations_match_enumeration():
    from itertools import product
    field = Crf(["O", "B-x", "I-x"])
    rng = np.random.default_rng(1)
    field.moves = rng.normal(size=(3, 3))
    sequences = [rng.normal(size=(n, 3)) for n in (1, 2, 4, 5, 1, 3)]

    def value(emit, path):
        return sum(emit[t, p] for t, p in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))

    for emit, tags in zip(sequences, field.viterbi(sequences, batch=2)):
        best = max(product(range(3), repeat=len(emit)), key=lambda p: value(emit, p))
        assert tuple(tags) == best
    emit = sequences[2]
    node, _ = field._expected(emit[None], np.ones((1, 4), bool))
    weights = {p: np.exp(value(emit, p)) for p in product(range(3), repeat=4)}
    for t in range(4):
        for c in range(3):
            share = sum(w for p, w in weights.items() if p[t] == c) / sum(weights.values())
            assert abs(node[0, t, c] - share) < 1e-9


def test_lines_left_out_decode_to_nothing():
    tagger = pii.Tagger(FIELD)
    for words, _ in pii.labelled_table(rows=200, seed=5):
        if not tagger.lines([" ".join(words).encode()]):
            votes = np.stack([FIELD.word_scores(w) for w in words])
            assert not FIELD.viterbi([FIELD.emissions(votes)])[0].any()


def test_columns_and_redaction(spark):
    rows = [(1, "mail bob@x.org or 10.0.0.1.", "a"), (2, None, "b"), (3, "", "c"), (4, "plain prose. At. Most.", "d"),
            (None, "mail bob@x.org or 10.0.0.1.", "e"), (1, "mail bob@x.org or 10.0.0.1.", "a"),
            (5, "é ssn 123-45-6789 ü\n" + "word " * 30_000 + "+49 30 1234567", "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    digest, cleaned = pii.find_pii(docs, field=FIELD)
    got = docs.select("doc_id", docs.spans.alias("own"), digest.alias("d"), cleaned.alias("text")).collect()
    by = {r.own: r for r in got}
    assert len(got) == 7
    assert by["a"].d.spans == "email:5:14,ip:18:26" and by["a"].text == "mail [EMAIL] or [IP]."
    assert by["a"].d.base_sha256 == hashlib.sha256(b"email:5:14,ip:18:26").hexdigest()
    assert by["b"].text is None and by["b"].d.spans == "" and by["c"].text == ""
    assert by["d"].d.spans == "" and by["d"].text == "plain prose. At. Most."
    assert by["f"].d.spans.startswith("crf_id:6:17,phone:150020:") and by["f"].d.n_phone == 1
    clean = pii.redact_documents(docs, field=FIELD)
    assert clean.columns == docs.columns
    assert pii.redact_documents(docs.limit(0), field=FIELD).count() == 0


def test_overlapping_spans_become_one_mark():
    assert pii.redact("abcdefgh", [("email", 1, 4), ("card", 3, 6), ("crf_id", 6, 7)]) == "a[EMAIL][ID]h"


def test_long_texts_of_distinct_shapes_and_a_full_cache(monkeypatch):
    pick = random.Random(77)
    odd = lambda n: " ".join("".join(pick.choice("aA1-/") for _ in range(pick.randint(5, 14))) for _ in range(n))
    tail = "\nplease contact Dr. Maria Hansen today\n"
    texts = [(odd(400) + tail + odd(400)).encode(), tail.encode(), odd(50).encode(), tail.encode()]
    want = pii.Tagger(FIELD).find(texts)
    monkeypatch.setattr(pii.Tagger, "CACHE", 6)
    for block in (1, 7, 100_000):
        monkeypatch.setattr(pii.Tagger, "BLOCK", block)
        tagger = pii.Tagger(FIELD)
        assert tagger.find(texts) == want and tagger.find(texts[::-1]) == want[::-1]


def test_features_see_the_whole_word():
    from cartwheel.llm.crf import shape, word_features
    word = "a" * 70 + "9" * 5 + "Z"
    assert shape(word) == "x" * 70 + "d" * 5 + "X"
    assert word_features(word) != word_features(word[:-1] + "z")


def test_field_from_a_labelled_table(spark):
    rows = [(list(w), list(t)) for w, t in pii.labelled_table(rows=500)] + [(["x"], []), (None, None), ([None], ["O"])]
    table = spark.createDataFrame(rows, "words array<string>, labels array<string>")
    field = pii.field_from(table, rounds=60)
    assert set(field.labels) == set(FIELD.labels)
    found = pii.Tagger(field).find([b"please contact Dr. Maria Hansen today"])
    assert found == pii.Tagger(FIELD).find([b"please contact Dr. Maria Hansen today"])
