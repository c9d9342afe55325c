"""Landed raw documents (S4): one JSON document per line of text.

The report API of the original system is replaced by a landing folder:
whatever fetched the documents writes them as text, and every job reads
them back with ``spark.read.text`` and parses them with an explicit
schema (``operators.flatten``). Text keeps a malformed document visible
instead of failing the whole read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def land(docs: DataFrame, path: str) -> str:
    """Write the documents of column ``value`` as text lines under
    ``path`` (other columns are not landed)."""
    docs.select("value").write.mode("overwrite").text(path)
    return path


def land_keyed(docs: DataFrame, path: str) -> str:
    """Documents that carry a key next to the text (ticker of a price page,
    offset of a list page) are landed as JSON lines of (key, value)."""
    docs.write.mode("overwrite").json(path)
    return path


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The landed documents: one row per line, column ``value``."""
    return spark.read.text(path)


def read_landed_keyed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
