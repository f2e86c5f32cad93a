"""Registered queries against DuckDB, and the pipeline against a brute force."""

import hashlib
import math
import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from cartwheel.llm import decontaminate, host_rules, pii
from cartwheel.llm.queries import ORACLE_SQL, QUERIES
from cartwheel.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def value(v):
    return float(f"{v:.12g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = Counter(tuple(map(value, r)) for r in df.select(*columns).collect())
    assert got == Counter(tuple(map(value, r)) for r in result.fetchall())


@pytest.mark.parametrize("name,columns,key", [
    ("op1_simhash", ["doc_id", "fingerprint", "component_id"], "documents"),
    ("op4_secrets", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], "documents"),
    ("op6_lm_score", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], "documents"),
    ("op7_html_text", ["page_id", "url", "text", "n_chars"], "pages"),
    ("op10_pii", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], "documents")])
def test_one_row_for_each_input_row(spark, name, columns, key):
    df = QUERIES[name](spark, SF)
    assert df.columns == columns
    ids = Counter(r[0] for r in df.select(columns[0]).collect())
    assert ids == Counter(r[0] for r in spark.read.parquet(f"{SF}/{key}.parquet").select(columns[0]).collect())


@pytest.mark.parametrize("name", ["op3_url_filter", "op4_secrets", "op9_perspectives"])
def test_native_queries_plan_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def corpus():
    pick = random.Random(21)
    vocabulary = [f"word{i}" for i in range(300)]
    prose = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    items = [(i, prose(14)) for i in range(6)]
    docs = [(i, prose(pick.randint(20, 130)), "en", f"s{i % 4}", 0) for i in range(60)]
    docs += [(60 + i, docs[i][1], "en", "s9", 0) for i in range(10)]  # copies
    docs += [(70 + i, prose(60) + " " + items[i][1] + " " + prose(30), "en", "s1", 0) for i in range(6)]
    docs += [(80 + i, prose(70) + f" mail a{i}@example.org or +49 30 123456{i}", "en", None, 0) for i in range(5)]
    docs += [(90, "a b c " * 40, "en", "s2", 0), (91, None, "en", "s2", 0), (92, "", "en", None, 0),
             (3, docs[3][1], "en", "s3", 0), (3, docs[3][1], "en", "s3", 0), (None, prose(80), "en", "s0", 0)]
    return docs, items


def brute(docs, items):
    from test_decontaminate import brute_align
    from test_host_rules import brute_repeats
    from test_simhash import brute_components
    # quality: no host fails four in five of its documents here
    kept = [d for d in docs if len((d[1] or "").split()) >= 50
            and 100 * brute_repeats(d[1].split()) <= 50 * len(d[1].split())]
    assert all(sum(k[3] == s for k in kept) > 0.4 * sum(d[3] == s for d in docs) for s in ("s0", "s1", "s2", "s3"))
    # near-duplicates: the least id of each group, once
    groups = brute_components([(d[0], d[1]) for d in kept])
    seen, once = set(), []
    for d, g in sorted(zip(kept, groups), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if (g[2] if g[2] is not None else g[1]) not in seen:
            seen.add(g[2] if g[2] is not None else g[1])
            once.append(d)
    # benchmark
    clean = [d for d in once if not any(brute_align(t.split(), d[1].lower().split()) >= len(t.split()) for _, t in items)]
    # personal data
    tagger = pii.Tagger(pii.train(pii.labelled_table()))
    safe = [(d[0], pii.redact(d[1], tagger.find([d[1].encode()])[0]), *d[2:]) for d in clean]
    # mixing
    sizes = Counter()
    for d in safe:
        sizes[d[3]] += len(d[1].split())
    from test_curriculum import brute_targets
    targets = brute_targets(dict(sizes))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    out = []
    for rank, s in enumerate(order):
        at, own = 0, [d for d in safe if d[3] == s]
        own.sort(key=lambda d: (hashlib.md5(b"" if d[0] is None else str(d[0]).encode()).hexdigest(), d[0] or 0))
        first, last = ((2.0, 1.0), (1.0, 1.0), (1.0, 2.0))[rank % 3]
        for d in own:
            n = len(d[1].split())
            for epoch in (0, 1):
                middle = epoch * sizes[s] + at + n / 2
                if middle < targets[s]:
                    area = middle / targets[s] * (first + last) / 2
                    slope = last - first
                    t = area / first if not slope else (math.sqrt(first ** 2 + 2 * slope * area) - first) / slope
                    out.append((d[0], d[1], d[3], round(t, 9)))
            at += n
    return out


def test_pipeline_matches_brute_force(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint") \
         .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [(r.position, r.doc_id) for r in got] == sorted(((r.position, r.doc_id) for r in got),
                                                         key=lambda x: (x[0], x[1] is not None, x[1] or 0))
    want = brute(docs, items)
    assert Counter((r.doc_id, r.text, r.source, round(r.position, 9)) for r in got) == Counter(want)
    texts = " ".join(t for _, t, *_ in want)
    assert "[EMAIL]" in texts and "[PHONE]" in texts and "@" not in texts


def test_pipeline_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    docs, items = corpus()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
        assert out.columns == empty.columns + ["position"] * (name == "source_mix")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination",
                                                      "personal_data", "source_mix"]
    assert host_rules.MIN_WORDS == 50 and decontaminate.MATCH == 2
