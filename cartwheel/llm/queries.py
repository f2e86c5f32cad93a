"""Registered queries over the training-data tables, with their SQL oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import (cross_tokenizer, curriculum, decontaminate, hard_negatives, host_rules, html_text, ngram_lm, oracles, packing, perspectives,
                           pii, secrets, simhash, url_filter)
from cartwheel.llm._common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, links at 3 bits or fewer."""
    found = simhash.simhash_components(read_table(spark, sf_dir, "documents"), shingle=3,
                                       max_distance=3, segments=2, seed=42)
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"),
                        "component_id")


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of all documents; a document's host is its source."""
    judged = host_rules.judge(read_table(spark, sf_dir, "documents"), host_col="source",
                              max_rate=0.8, doc_rate=0.02, keep=["doc_id"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])


# (verdict, host and path)
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url: its own rule, else its redirect and canonical aliases'."""
    pages = read_table(spark, sf_dir, "pages")
    judged = url_filter.judge_urls(pages.select("page_id", "url"), URL_RULES, url_filter.page_edges(pages))
    return judged.select("page_id", "filter.*")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: base patterns and linked credential parts."""
    found = secrets.scan(read_table(spark, sf_dir, "documents"), scope=300)
    return found.select("doc_id", *[secrets.count_of(F.col("base"), k).alias(f"n_{k}") for k in secrets.BASE],
                        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
                        secrets.joined(F.concat("base", "added")).alias("spans"))


def op5_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and where in training its first copy lies.

    Rows are in training order, by the place of the first copy in the mix; documents not taken come last.
    """
    mixed = curriculum.plan_mix(read_table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0),
                                share=1.5, max_repeat=2.0, schedules=CURRICULUM)
    ordered = mixed.orderBy(F.get("mix.places", F.lit(0)).asc_nulls_last(), "doc_id")
    return ordered.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken",
                          F.get("mix.positions", F.lit(0)).alias("position"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in any of the documents, with their alignment scores."""
    return decontaminate.contaminated_pairs(read_table(spark, sf_dir, "documents"),
                                            read_table(spark, sf_dir, "benchmark"),
                                            n=3, window=2, min_similarity=0.5)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base patterns and the field's spans."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", pii.find_pii(docs)[0].alias("pii")).select("doc_id", "pii.*")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under the trigram trie and the unigram base."""
    return ngram_lm.score(read_table(spark, sf_dir, "documents"), order=3)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's winning container paths."""
    found = html_text.extract(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as seen by each of its participants, with the mask as text."""
    seen = perspectives.rotate(read_table(spark, sf_dir, "conversations"), part_turns=64)
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws(
        ":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return seen.withColumn("mask", mask)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens, one row for each piece."""
    packed = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                          end_id=2, capacity=4096)
    return packed.select("doc_id", "start", "length", F.col("checksum").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of all documents under two tokenizers, with corpus-wide link counts."""
    aligned = cross_tokenizer.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = cross_tokenizer.link_statistics(aligned.withColumn("groups_sha256", digest))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh row's label is moved on by one first."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", moved),
                               F.col("vec_id") % 100 == 0, scale=256, n_positives=5, n_negatives=10,
                               low=30, high=90)


# Sources in turn: falling, steady and rising over the training run.
CURRICULUM = (((0.0, 2.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 2.0)))

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_host_rules": op2_host_rules,
    "op3_url_filter": op3_url_filter,
    "op4_secrets": op4_secrets,
    "op5_curriculum": op5_curriculum,
    "op8_decontaminate": op8_decontaminate,
    "op6_lm_score": op6_lm_score,
    "op7_html_text": op7_html_text,
    "op9_perspectives": op9_perspectives,
    "op10_pii": op10_pii,
    "op11_packing": op11_packing,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_hard_negatives": op13_hard_negatives,
}

# The others need a 64-bit hash, an alignment, a fitted model, an HTML parser, a
# tokenizer or look-around patterns; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_host_rules": oracles.OP2,
    "op3_url_filter": oracles.OP3,
    "op5_curriculum": oracles.OP5,
    "op9_perspectives": oracles.OP9,
    "op13_hard_negatives": oracles.OP13,
}
