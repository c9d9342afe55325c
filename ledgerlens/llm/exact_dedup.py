"""Exact de-duplication with a heavy-hitter split (DataFrame operations only).

1. Every text is reduced to its SHA-256 digest, once; the small (doc_id,
   digest) table is written to the shared folder.
2. ``DataFrame.freqItems`` (the Misra-Gries / Karp summary of Spark) names
   every digest that may hold more than ``support`` of the rows: at most
   1 / support of them, whatever the input.
3. Those candidates are counted exactly; their winners are a table of at most
   1 / support rows, broadcast, and resolve the rows of the frequent
   digests on the map side.
4. The remaining digests are grouped by ordinary shuffling (a partial
   aggregate, then a join that adaptive execution can split).

Cases: a null text counts as an empty one. The largest doc_id of equal
texts stays; a null doc_id loses against any other, and rows that all have
null ids keep themselves (keep_id null). A row repeated with the same id
and text is one document written twice: each copy is returned, is counted
in group_size and has the same ``kept``; ``keep_one`` returns one of the
copies, and one row of a text that only null ids have. An empty table gives
an empty result. Other columns are never looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.idset import without_repeats
from ledgerlens.session import materialize

SUPPORT = 0.002


def digest(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256 of every row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("text_sha256"))


def frequent_digests(table: DataFrame, support: float = SUPPORT) -> list[str]:
    """Digests that may hold more than ``support`` of the rows; contains all
    that do, and at most 1 / support entries."""
    row = table.stat.freqItems(["text_sha256"], support).first()
    found = (row[0] if row else None) or []
    if len(found) > math.ceil(1 / support):
        raise AssertionError("the summary is larger than its bound")
    return sorted(x for x in found if x is not None)


def _winners(table: DataFrame) -> DataFrame:
    return table.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def exact_dedup(
    docs: DataFrame, support: float = SUPPORT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    table = materialize(digests(docs, id_col, text_col), "digests")
    names = frequent_digests(table, support)
    # At most 1 / support names: a literal table, joined by broadcast.
    listed = F.broadcast(spark.createDataFrame([(x,) for x in names], "text_sha256 string"))
    hot = table.join(listed, "text_sha256", "left_semi")
    cold = table.join(listed, "text_sha256", "left_anti")
    hot = hot.join(F.broadcast(_winners(hot)), "text_sha256")
    cold = cold.join(_winners(cold), "text_sha256")
    return hot.unionByName(cold).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _row_key(doc_id: Column, digest: Column) -> Column:
    """One text per (doc_id, digest); a null id gives one as well."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest)


def keep_one(docs: DataFrame, support: float = SUPPORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each text of ``docs``, with all its columns: of rows with
    the largest doc_id of the text, any one. Rows are told apart by id and
    digest, so another text of the same id is not touched. Only keys are
    moved, and those rows whose key may go or be repeated."""
    found = materialize(exact_dedup(docs, support, id_col, text_col), "exact_dedup")
    keys = found.select(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("_key"), "kept")
    keys = materialize(
        keys.groupBy("_key", "kept").count().where("NOT kept OR count > 1").select("_key", "kept"), "keys"
    )
    names = docs.columns
    body = docs.toDF(*(f"_c{k}" for k in range(len(names))))
    at, text = (F.col(f"_c{names.index(c)}") for c in (id_col, text_col))
    keyed = body.withColumn("_key", _row_key(at.cast("long"), digest(text)))
    return without_repeats(keyed, keys, "_key").drop("_key").toDF(*names)
