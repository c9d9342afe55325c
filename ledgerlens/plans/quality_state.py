"""Suites over many run dates from stored, mergeable states (Q2-Q8).

The state of a run date holds, for each rule, how many values were checked and
how many failed, and for a uniqueness rule that does not name the run date
the number of rows of each key (by digest). Counts add up over run dates, and
so do the rows of a key, so the report of a suite over all run dates is the
merge of their states: it equals ``quality.run_suite`` over all their rows,
but only run dates that are new, were loaded again or were judged by other
rules are opened.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.expressions import nan_to_null
from ledgerlens.operators import quality
from ledgerlens.sources import lake

LAYER = "quality"
STATE = T.StructType([
    T.StructField("rule_id", T.IntegerType()), T.StructField("key", T.StringType()),
    T.StructField("checked", T.LongType()), T.StructField("failed", T.LongType()),
    T.StructField("of", T.StringType()), T.StructField("run_date", T.StringType()),
])


def _domain(layer: str, domain: str) -> str:
    return f"{layer}_{domain}"


def _across(rule: quality.Rule, column: str) -> bool:
    """A uniqueness rule whose keys may meet again in another run date."""
    return rule["rule"] == "unique_combination" and column not in rule["columns"]


def state_of(df: DataFrame, suite: Sequence[quality.Rule], of: str, column: str = "run_date") -> DataFrame:
    """rule_id, key, checked, failed: a row a rule (key NULL), and for the
    uniqueness rules across run dates a row a key with its rows as checked."""
    out = quality.run_suite(df, suite).select(
        "rule_id", F.lit(None).cast("string").alias("key"), "checked", "failed"
    )
    for i, rule in enumerate(suite):
        if _across(rule, column):
            kinds = {f.name: f.dataType for f in df.schema.fields}
            keys = [
                (nan_to_null(c) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else F.col(c)).alias(c)
                for c in rule["columns"]
            ]
            digest = F.sha2(F.to_json(F.struct(*keys)), 256)
            present = F.coalesce(*[F.col(c).cast("string") for c in rule["columns"]]).isNotNull()
            rows = df.select(*keys).where(present).groupBy(digest.alias("key")).agg(F.count(F.lit(1)).alias("checked"))
            out = out.where(F.col("rule_id") != i).unionByName(
                rows.select(F.lit(i).alias("rule_id"), "key", "checked", F.lit(0).cast("long").alias("failed"))
            )
    return out.withColumn("of", F.lit(of))


def refresh(
    spark: SparkSession, root: str, layer: str, domain: str, suite: Sequence[quality.Rule],
    schema: T.StructType | None = None, state_root: str | None = None,
) -> list[str]:
    """Bring the stored states of a domain up to date; returns the run dates
    that were opened for it."""
    state_root, rules = state_root or root, hashlib.sha256(repr(suite).encode()).hexdigest()[:16]
    have: dict[str, str] = {}
    known = lake.run_dates(spark, state_root, LAYER, _domain(layer, domain))
    if known:  # a row a run date
        states = lake.read_run_dates(spark, state_root, LAYER, _domain(layer, domain), known, STATE)
        have = {r["run_date"]: r["of"] for r in states.groupBy("run_date").agg(F.max("of").alias("of")).collect()}
    opened = []
    for d in lake.run_dates(spark, root, layer, domain):
        version = lake.current_version(spark, lake.partition_path(root, layer, domain, d))
        of = f"{rules}:{version.rpartition('=')[2]}"
        if have.get(d) != of:
            rows = lake.read_partition(spark, root, layer, domain, d, schema)
            lake.write_partition(state_of(rows, suite, of), state_root, LAYER, _domain(layer, domain), d)
            opened.append(d)
    return opened


def merge(states: DataFrame, suite: Sequence[quality.Rule], column: str = "run_date") -> DataFrame:
    """The report of a suite (as ``quality.run_suite``) over the run dates
    whose states are given."""
    zero = F.lit(0).cast("long")
    across = [i for i, r in enumerate(suite) if _across(r, column)]
    static = [i for i, r in enumerate(suite) if not quality.counts_rows(r)]
    is_key, is_static = F.col("rule_id").isin(across), F.col("rule_id").isin(static)
    counts = states.where(~is_key).groupBy("rule_id").agg(
        F.when(F.first(is_static), F.max("checked")).otherwise(F.sum("checked")).alias("checked"),
        F.when(F.first(is_static), F.max("failed")).otherwise(F.sum("failed")).alias("failed"),
    )
    keys = states.where(is_key).groupBy("rule_id", "key").agg(F.sum("checked").alias("n"))
    keyed = keys.groupBy("rule_id").agg(
        F.sum("n").alias("checked"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("failed")
    )
    told = counts.unionByName(keyed).withColumnRenamed("rule_id", "_id")
    rules = [(i, r["rule"], ",".join(r["columns"]) if r["rule"] == "unique_combination" else r.get("column")) for i, r in enumerate(suite)]
    named = states.sparkSession.createDataFrame(rules, "rule_id int, rule string, column string")
    out = named.join(F.broadcast(told), F.col("rule_id") == F.col("_id"), "left").select(  # a row a rule on both sides
        "rule_id", "rule", "column", F.coalesce("checked", zero).alias("checked"), F.coalesce("failed", zero).alias("failed")
    )
    success = F.lit(False)
    for i, r in enumerate(suite):
        success = F.when(F.col("rule_id") == i, quality.success(r, F.col("checked"), F.col("failed"))).otherwise(success)
    return out.withColumn("success", success).select(*[F.col(f.name).cast(f.dataType) for f in quality.REPORT_SCHEMA.fields])


def report(
    spark: SparkSession, root: str, layer: str, domain: str, suite: Sequence[quality.Rule],
    schema: T.StructType | None = None, state_root: str | None = None,
) -> DataFrame:
    """Q8 over every run date of a domain, from refreshed states."""
    refresh(spark, root, layer, domain, suite, schema, state_root)
    state_root = state_root or root
    dates = lake.run_dates(spark, root, layer, domain)
    return merge(lake.read_run_dates(spark, state_root, LAYER, _domain(layer, domain), dates, STATE), suite)
