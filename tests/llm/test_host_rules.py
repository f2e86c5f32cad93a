import random
import re
import time

from cartwheel.llm import host_rules as H

SCHEMA = "doc_id bigint, text string, source string, m string, host string, host_ok string"


def brute_repeats(words):
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "a", "b", "c") for i, t, s in rows], SCHEMA)


def brute(t):
    words, lines = [w for w in re.split("[\x20\x09-\x0D]+", t) if w], t.split("\n")
    filled = [x for x in lines if re.search("[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(filled) - len(set(filled)), "n_repeat_words": brute_repeats(words), "n_lines": len(filled)}


def test_measures(spark):
    pick = random.Random(2)
    texts = [" ".join(pick.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 4, 9, 40)]
    texts += ["a b c\na b c\n\n \nx", "é# ü*$ %%|<>", "\t\x0b", "q w e " * 3, "same\n" * 9, "a\x1cb \x85 \u2003 c",
              "\n\n", " lead", "trail ", "x\r\ny\r\nx\r\n", "🙂 🙂🙂 日本", "a b a b a b"]
    texts += ["".join(pick.choice("ab #%\n\t") for _ in range(pick.randint(1, 90))) for _ in range(60)]
    got = H.with_measures(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), "text", "out").collect()
    for r in got:
        assert r.out.asDict() == brute(texts[r.doc_id]), texts[r.doc_id]
        assert (r.m, r.host, r.text) == ("a", "b", texts[r.doc_id])


def test_a_very_long_text(spark):
    words = [f"w{i % 200_000}" for i in range(400_000)]
    text = " ".join(words) + "\nline" * 5
    row, = H.judge(frame(spark, [(1, text, "s")]), keep=["doc_id"]).collect()
    assert row.quality.n_words == 400_005 and row.quality.n_repeat_words >= 400_000 and row.quality.n_dup_lines == 4


def test_a_filter_on_the_verdict_is_not_spelled_out_below(spark):
    long = " ".join(f"w{i % 3000}" for i in range(20_000))
    rows = [(1, long, "s"), (2, " ".join(f"w{i}" for i in range(5000)), "s")]
    began = time.time()
    kept = H.judge(frame(spark, rows)).filter("quality.kept").drop("quality")
    assert [r.doc_id for r in kept.collect()] == [2] and time.time() - began < 60


def test_strict_rules_take_failing_documents_of_bad_hosts_only(spark):
    good = [" ".join(f"w{i}x{j}" for i in range(60)) for j in range(4)]
    noisy = " ".join(f"w{i}%%%" for i in range(60))
    rows = [(i, noisy if i % 5 == 0 else good[i % 4], "bad") for i in range(400)]
    rows += [(1000 + 1000 * h + i, noisy if i == 0 else good[i % 4], f"h{h}") for h in range(9) for i in range(400)]
    got = {r.doc_id: r.quality for r in H.judge(frame(spark, rows), keep=["doc_id"]).collect()}
    assert all(got[i].kept == (i % 5 != 0) for i in range(400))
    assert all(q.kept for i, q in got.items() if i >= 1000)  # one slip in 400 is no habit
    assert all(q.host_ok and not q.base_failed for q in got.values())


def test_strict_rules_change_rows_of_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r.quality for r in H.judge(docs, keep=["doc_id"]).collect()]
    fell = [q for q in got if not q.kept and not q.base_failed]
    assert fell and all(q.strict_failed and q.host_ok for q in fell)


def test_edge_rows(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good, "s"), (1, good, "s"), (2, None, "s"), (3, "", None), (None, good, None), (4, "a b c " * 30, "s")]
    got = H.judge(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.quality.n_words, r.quality.base_failed, r.quality.kept) for r in got) == sorted([
        ("1", 60, False, True), ("1", 60, False, True), ("2", 0, True, False), ("3", 0, True, False),
        ("None", 60, False, True), ("4", 90, True, False)])
    assert got[0].m == "a" and got[0].host_ok == "c"


def test_bad_host_falls_and_takes_its_good_document(spark):
    good = [" ".join(f"w{i}x{j}" for i in range(60)) for j in range(4)]
    rows = [(i, "junk", "bad") for i in range(200)] + [(900, good[0], "bad")]
    rows += [(1000 + 100 * h + i, good[i % 4] if i else "junk", f"h{h}") for h in range(20) for i in range(30)]
    got = H.judge(frame(spark, rows)).collect()
    ok = {r.source: r.quality.host_ok for r in got}
    assert not ok.pop("bad") and all(ok.values())
    assert not next(r for r in got if r.doc_id == 900).quality.kept
    assert H.judge(frame(spark, [])).count() == 0
    assert H.judge(frame(spark, [(1, good[0], None)])).first().quality.kept


def test_small_host_is_shrunk_towards_the_others(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(100 * h + i, "junk" if i < 3 + h % 3 else good, f"h{h}") for h in range(20) for i in range(30)]
    rows += [(5000, "junk", "tiny")]  # all of its documents fail, but there is one
    rates = {r.host: r for r in H.host_verdicts(frame(spark, rows), "source", "text").collect()}
    pooled = (sum(3 + h % 3 for h in range(20)) + 1) / 601
    assert pooled < rates["tiny"].short_rate < 0.8 and rates["tiny"].host_ok
    assert abs(rates["h0"].short_rate - 0.1) < 0.06
