"""Corpus pipeline: quality, near-duplicates, benchmark, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents.

Every stage takes nulls in any column, empty and very long texts, ties, repeated
rows, empty tables and further columns of any name, which it returns as they are;
what it does with them is said with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import curriculum, decontaminate, host_rules, pii, simhash
from cartwheel.llm._common import fresh, read_table, staged
from cartwheel.llm.queries import CURRICULUM


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their base rules and those that their host makes strict, on hosts not rejected.

    A null or empty text has no words and fails; a null source is no host and rejects nothing.  Equal
    rows are judged alike and stay together.
    """
    verdict, = fresh(docs.columns, "quality")
    judged = host_rules.judge(docs, host_col="source", max_rate=0.8, out=verdict)
    return judged.filter(f"{verdict}.kept").drop(verdict)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits): the least id.

    A null id comes last; of rows with one id the least by a hash of all columns stays, once.  Texts
    without words are near-duplicates of each other.
    """
    return simhash.keep_one_per_group(docs, shingle=3, max_distance=3, segments=2, seed=42)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found.

    Null and empty texts hold none and stay; null, empty and very short items are found nowhere.
    Repeated rows fall or stay together.
    """
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"),
                                           n=3, window=2, min_similarity=0.5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by [KIND] in the text; all rows stay.

    A null text stays null and an empty one empty.
    """
    return pii.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: one row for each copy taken, with its position.

    A null source is a source of its own and comes last; null and empty texts take no words, and their
    copies lie where the words before them end.  Ties of position go by id, nulls first.
    """
    return curriculum.mix(docs, weights=(5.0, 2.0, 1.0), share=1.5, max_repeat=2.0,
                          schedules=CURRICULUM)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

# The alignment and the field are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
