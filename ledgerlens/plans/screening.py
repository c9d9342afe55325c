"""The whole screening (K4) as one lazy plan.

silver financials / profile / valuation -> M1-M5 -> K1 -> K2 -> fact rows.
Nothing is materialised between the steps; the only actions are the
writes of the warehouse step (``plans.warehouse``) and the quality gates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.config import RUN_DATE
from ledgerlens.functions.expressions import nan_to_null
from ledgerlens.operators import clean, metrics, scoring
from ledgerlens.schemas import SCREENING_COLUMNS
from ledgerlens.session import materialize
from ledgerlens.sources import fixtures

DOUBLE_FACT_COLUMNS = (
    "roe", "der", "fcf", "fcf_margin", "eps_growth_yoy", "eps_cagr_5y", "per", "pbv",
    "graham_combined",
)


def silver_inputs(
    spark: SparkSession,
    sf_dir: str,
    run_dates: Sequence[str] = (RUN_DATE,),
    dirty: bool = False,
    duplicates: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver financials, profile and valuation from the fixture tables.

    The three bronze domains come from one pass over lineitem and orders.
    That pass is written once to the shared checkpoint folder (it stands
    for the stored bronze layer): the three silver jobs then read it
    instead of each re-aggregating the line items, and a lost executor
    recomputes from the written table, not from the raw tables.
    """
    totals = materialize(fixtures.customer_year_totals(spark, sf_dir, run_dates), "bronze_totals")
    fin = clean.clean_financials(
        fixtures.bronze_financials(
            spark, sf_dir, run_dates, dirty=dirty, duplicates=duplicates, totals=totals
        )
    )
    prof = clean.clean_profile(
        fixtures.bronze_profile(spark, sf_dir, run_dates, dirty=dirty, duplicates=duplicates, totals=totals)
    )
    val = clean.clean_valuation(
        fixtures.bronze_valuation(spark, sf_dir, run_dates, dirty=dirty, duplicates=duplicates, totals=totals)
    )
    return fin, prof, val


def silver_financials(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,)
) -> DataFrame:
    """Silver financials alone: one consumer, so the bronze pass stays lazy
    (no stage written)."""
    return clean.clean_financials(fixtures.bronze_financials(spark, sf_dir, run_dates))


def silver_valuation(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,)
) -> DataFrame:
    """Silver valuation alone, lazily like ``silver_financials``."""
    return clean.clean_valuation(fixtures.bronze_valuation(spark, sf_dir, run_dates))


def silver_profile(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,)
) -> DataFrame:
    """Silver profile alone: it needs the orders' dates, not lineitem."""
    return clean.clean_profile(fixtures.bronze_profile(spark, sf_dir, run_dates))


def to_fact(scored: DataFrame) -> DataFrame:
    """Fact columns: NaN stored as NULL (E5), run_date as a DATE."""
    cols = []
    for c in SCREENING_COLUMNS:
        if c == "run_date":
            cols.append(F.to_date("run_date").alias("run_date"))
        elif c in DOUBLE_FACT_COLUMNS:
            cols.append(nan_to_null(c).alias(c))
        else:
            cols.append(F.col(c))
    return scored.select(*cols)


def screening(
    fin: DataFrame, profile: DataFrame, val: DataFrame, run_date: str | None = RUN_DATE,
    profile_is_unique: bool = False,
) -> DataFrame:
    """Scored fact rows for one run date (or every run date when None)."""
    profile = profile if profile_is_unique else clean.unique_profile(profile)
    candidates = metrics.screening_candidates(fin, profile, clean.unique_valuation(val), run_date)
    return to_fact(scoring.score(candidates))


def screening_from_tables(
    spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE, run_dates: Sequence[str] | None = None,
    dirty: bool = False, duplicates: bool = False,
) -> DataFrame:
    fin, prof, val = silver_inputs(spark, sf_dir, run_dates or (run_date,), dirty, duplicates)
    return screening(fin, prof, val, run_date)
