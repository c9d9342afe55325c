"""Every registered query against its DuckDB oracle on the smallest tables,
plus the entry smoke check."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlens.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["ticker", "run_date", "period"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    names = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
             "boolean": "BOOLEAN"}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: names.get(t, t) for c, t in df.dtypes} == duck_types
    cur = duck.execute(ORACLE[name])
    d_cols, d_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
