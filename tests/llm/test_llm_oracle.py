"""The registered queries against their DuckDB SQL, and the promised columns
of all of them, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlens.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "pages", "labels", "benchmark")
PROMISED = {
    1: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    2: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    3: {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    4: {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint"},
    5: {"doc_id": "bigint", "n_tokens": "bigint"},
    6: {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
        "base_labels": "string", "labels": "string", "score": "double"},
    7: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    8: {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int"},
    9: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    10: {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    11: {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    12: {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
         "folded_root": "string", "verified": "boolean"},
    13: {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    df = QUERIES[name](spark, f"/root/testdata/{sf}")
    names = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}
    told = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: names[t] for c, t in df.dtypes} == told
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_promised_columns_and_one_row_per_row(spark, name):
    n = int(name[2:].split("_")[0])
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert {c: t for c, t in df.dtypes if c in PROMISED[n]} == PROMISED[n]
    source = spark.read.parquet(f"/root/testdata/sf0.001/{'pages' if n in (10, 13) else 'documents'}.parquet")
    if n not in (4, 11):
        assert df.count() == source.count()


def test_entry_registers_them():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
