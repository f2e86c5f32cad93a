"""Format round trips and stored size."""

import datetime as dt
import itertools
import os

import pytest

from cartwheel.sources import io

EVENTS_SCHEMA = "id long, ts timestamp_ntz, tsz timestamp, d date, name string, v double"


@pytest.fixture
def table(spark):
    rows = [
        (1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 3, 1, 1, 2, 3, 999999),
         dt.date(2024, 1, 1), 'quote " and, comma', 6.55),
        (2, dt.datetime(1999, 12, 31, 23, 59, 59, 1), None, None, None, 1e-310),
        (3, dt.datetime(2024, 7, 4, 12, 0, 0, 0), dt.datetime(2024, 7, 4), dt.date(2000, 2, 29),
         "plain", -0.1),
    ]
    return spark.createDataFrame(rows, EVENTS_SCHEMA)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc"])
def test_roundtrip_is_lossless(spark, table, tmp_path, fmt):
    back = io.roundtrip(table, str(tmp_path / fmt), fmt)
    assert back.schema == table.schema
    assert sorted(back.collect()) == sorted(table.collect())


def test_csv_keeps_blanks_empty_strings_and_rows(spark, tmp_path):
    texts = ["  lead", "   ", "", None, "tail ", "\\N", "\\\\N", "N", '"', "a\nb", "\\", "\r\n", "\t", "#x", "\\N "]
    one = spark.createDataFrame([(t,) for t in texts], "s string")
    assert sorted(io.roundtrip(one, str(tmp_path / "one"), "csv").collect(), key=str) == sorted(one.collect(), key=str)
    rows = [(1, None, ""), (None, None, None), (2, " x ", "y\\"), (3, "\\N", "\\\\\\N")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    assert sorted(io.roundtrip(df, str(tmp_path / "csv"), "csv").collect(), key=str) == sorted(df.collect(), key=str)


def test_csv_text_keeps_to_its_line_and_files_split(spark, tmp_path):
    bits = ["\\", "n", "r", "e", "N", "\n", "\r", " ", "\t", '"', ",", "\x00", "é", "\u2028", "\\\\"]
    texts = ["".join(p) for k in (1, 2, 3) for p in itertools.product(bits, repeat=k)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, s string").coalesce(1)
    back = io.roundtrip(df, str(tmp_path / "csv"), "csv")
    assert sorted(back.collect()) == sorted(df.collect())
    alone = df.select("s")
    assert sorted(io.roundtrip(alone, str(tmp_path / "alone"), "csv").collect()) == sorted(alone.collect())
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        split = io.read_table(spark, str(tmp_path / "csv"), "csv", df.schema)
        assert len(split.inputFiles()) == 1 and split.rdd.getNumPartitions() > 5
        assert sorted(split.collect()) == sorted(df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "CSV_FILE_RECORDS", 10)
    df = spark.range(95).coalesce(1)
    assert io.roundtrip(df, str(tmp_path / "csv"), "csv").count() == 95
    assert len([f for f in os.listdir(tmp_path / "csv") if f.startswith("part-")]) == 10


def test_csv_needs_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        io.read_table(spark, str(tmp_path), "csv")


def test_csv_rejects_nested(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "id long, a array<long>")
    with pytest.raises(ValueError):
        io.write_table(df, str(tmp_path / "x"), "csv")


def test_unknown_format(spark, table, tmp_path):
    with pytest.raises(ValueError):
        io.write_table(table, str(tmp_path / "x"), "xlsx")


def test_stored_size(spark, table, tmp_path):
    path = str(tmp_path / "pq")
    io.write_table(table.repartition(3), path, "parquet")
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    expected = sum(os.path.getsize(os.path.join(path, f)) for f in parts)
    r = io.stored_size(spark, path, glob="part-*").collect()[0]
    assert r.files == len(parts) and r.size_bytes == expected
    assert r.size_mb == f"{expected / 1024 / 1024:.2f} MB"


def test_csv_roundtrip_tricky_strings(spark, tmp_path):
    rows = [(1, "line one\nline two"), (2, 'quote " and, comma'), (3, "back\\slash"),
            (4, "tab\there"), (5, "crlf\r\nend"), (6, '"fully quoted"')]
    df = spark.createDataFrame(rows, "id long, s string")
    back = io.roundtrip(df, str(tmp_path / "csv"), "csv")
    assert sorted(back.collect()) == sorted(df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc"])
def test_roundtrip_special_numbers(spark, tmp_path, fmt):
    import math
    rows = [(1, float("nan"), True, 2**63 - 1), (2, float("inf"), False, -2**63),
            (3, float("-inf"), None, 0), (4, -0.0, True, 1), (5, 1.7976931348623157e308, False, 2),
            (6, 5e-324, True, 3)]
    df = spark.createDataFrame(rows, "id long, x double, b boolean, big long")
    got = sorted(io.roundtrip(df, str(tmp_path / fmt), fmt).collect())
    for g, w in zip(got, sorted(df.collect())):
        assert (g.id, g.b, g.big) == (w.id, w.b, w.big)
        if math.isnan(w.x):
            assert math.isnan(g.x)
        else:
            assert g.x == w.x and math.copysign(1, g.x) == math.copysign(1, w.x)
