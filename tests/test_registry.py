"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_mod
from cartwheel.plans.registry import QUERIES
from cartwheel.sources.tables import TABLES

SF = "/root/testdata/sf0.001"

# Spark type name -> DuckDB type name, for the schema comparison.
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    return repr(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["customer_id", "total_revenue", "order_count", "avg_order_value"]
    assert 0 < len(rows) <= 10


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = entry_mod.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = duck.sql(sql)
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes} == otypes
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert _bag(cols, rows) == _bag(ocols, orows)
