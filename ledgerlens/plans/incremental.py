"""The screening of what changed since an earlier run date (K4).

A company's fact row is a function of its own silver rows: its statements of
all periods (growth looks back over them by LAG), its profile and its
valuations. The state of a run date holds one digest of those rows per ticker
and the thresholds they were scored with. At the next run an anti-join of the
two states names the tickers that are new or changed; only their silver rows
enter the windows, joins and scoring. Every other fact row is copied from the
earlier run date. The result equals the full screening of the run date.

A digest is the sum of three 64-bit hashes of each row (order does not matter,
repeated rows count), so it is a partial aggregate and no company's rows meet
in one list. States are kept in the lake's ``state`` layer: a row per ticker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.config import THRESHOLDS
from ledgerlens.operators import clean
from ledgerlens.plans import screening, warehouse
from ledgerlens.session import materialize
from ledgerlens.sources import lake

LAYER = "state"
STATE = "silver_digests"
STATE_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("run_date", T.StringType()),
])
_SEEDS = (1, 2, 3)


def digests(frames: Sequence[DataFrame], thresholds: Mapping[str, tuple[str, float]] = THRESHOLDS) -> DataFrame:
    """ticker, digest of its rows in all ``frames`` (without run_date) and of
    the thresholds."""
    rows = None
    for n, df in enumerate(frames):
        body = F.to_json(F.struct(F.lit(n).alias("_frame"), *[c for c in df.columns if c != "run_date"]))
        part = df.select("ticker", *[F.xxhash64(F.lit(s), body).cast("decimal(20,0)").alias(f"h{s}") for s in _SEEDS])
        rows = part if rows is None else rows.unionAll(part)
    sums = rows.groupBy("ticker").agg(*[F.sum(f"h{s}").alias(f"h{s}") for s in _SEEDS])
    scored = F.xxhash64(F.lit(repr(sorted(thresholds.items())))).cast("string")
    return sums.select("ticker", F.concat_ws(":", scored, *[F.col(f"h{s}").cast("string") for s in _SEEDS]).alias("digest"))


def write_state(root: str, run_date: str, fin: DataFrame, profile: DataFrame, val: DataFrame) -> str:
    """Keep the digests that the fact of a run date was computed from."""
    return lake.write_partition(digests((fin, profile, val)), root, LAYER, STATE, run_date)


def read_state(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    return lake.read_partition(spark, root, LAYER, STATE, run_date, STATE_SCHEMA).select("ticker", "digest")


def changed_tickers(now: DataFrame, before: DataFrame) -> DataFrame:
    """Tickers whose rows are new or differ."""
    same = (now.ticker.eqNullSafe(before.ticker)) & (now.digest == before.digest)
    return now.join(before, same, "left_anti").select("ticker")


def screening_since(
    spark: SparkSession, root: str, wh_root: str, run_date: str, previous: str,
    fin: DataFrame, profile: DataFrame, val: DataFrame,
) -> DataFrame:
    """The fact rows of ``run_date`` (K4) from silver frames of that run date
    (profile unique per ticker), computed for changed companies and copied
    for the others; also keeps the state of the run date. Without a stored
    state or fact of ``previous`` everything is computed."""
    val = clean.unique_valuation(val)
    write_state(root, run_date, fin, profile, val)
    try:
        before = read_state(spark, root, previous)
        old_fact = warehouse.fact_for_run(spark, wh_root, previous)
    except lake.MissingPartition:
        return screening.screening(fin, profile, val, run_date, profile_is_unique=True)
    now = read_state(spark, root, run_date)
    changed = materialize(changed_tickers(now, before), "changed").withColumnRenamed("ticker", "_changed")

    def affected(df: DataFrame) -> DataFrame:
        return df.join(changed, df.ticker.eqNullSafe(F.col("_changed")), "left_semi")

    fresh = screening.screening(affected(fin), affected(profile), affected(val), run_date, profile_is_unique=True)
    kept = now.join(before, ["ticker", "digest"], "left_semi").select(F.col("ticker").alias("_kept"))
    copied = old_fact.join(kept, F.col("ticker") == F.col("_kept"), "left_semi")
    copied = copied.withColumn("run_date", F.to_date(F.lit(run_date)))
    return fresh.unionByName(copied.select(*fresh.columns))
