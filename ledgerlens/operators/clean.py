"""Silver jobs: ticker normalisation, typed measures, de-duplication.

De-duplication is a grouped ``max(struct(...))`` rather than a
``row_number`` window: struct ordering compares field by field with NULL
as the smallest value, which is exactly "order by every measure
descending, nulls last, keep the first". As an aggregate it gets a
map-side partial step, so even a group of copies holding a large share of
all rows is collapsed before the shuffle instead of being sorted in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import FINANCIAL_MEASURES, VALUATION_MEASURES
from ledgerlens.functions.expressions import nan_to_null, normalize_ticker


def keep_greatest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` columns
    (descending, nulls last, column by column). Other columns ride along
    after the ordered ones and only break full ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in (*order, *rest)])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col("_best")[c].alias(c) for c in (*order, *rest)]).select(
        *df.columns
    )


def _measure(name: str) -> Column:
    """A measure as a double; NaN (a missing number in a frame) is NULL, so
    it never wins a de-duplication."""
    return nan_to_null(F.col(name).cast("double"))


def dedup_financials(df: DataFrame, keys: Sequence[str] = ("run_date", "ticker", "period")) -> DataFrame:
    """One row per (run_date, ticker, period); largest measures win."""
    return keep_greatest(df, keys, FINANCIAL_MEASURES)


def clean_financials(bronze: DataFrame) -> DataFrame:
    """Normalise ticker, cast the nine measures, one row per key."""
    typed = bronze.select(
        normalize_ticker("ticker").alias("ticker"),
        F.col("period").cast("string").alias("period"),
        *[_measure(m).alias(m) for m in FINANCIAL_MEASURES],
        F.col("run_date").cast("string").alias("run_date"),
    )
    return dedup_financials(typed)


def clean_profile(bronze: DataFrame) -> DataFrame:
    """Normalise ticker, cast market_cap. No de-duplication (as stored)."""
    return bronze.select(
        normalize_ticker("ticker").alias("ticker"),
        "company_name",
        "sector",
        "sub_sector",
        _measure("market_cap").alias("market_cap"),
        "listing_date",
        F.col("run_date").cast("string").alias("run_date"),
    )


def clean_valuation(bronze: DataFrame) -> DataFrame:
    """Normalise ticker, cast four ratios, keep per > 0 and pbv > 0.

    The filter runs on the raw columns (P2), so it is pushed to the scan
    when the bronze table is read from Parquet; NULLs fail it, and so does a
    NaN (it would compare as the largest number).
    """
    kept = bronze.where((F.col("per") > 0) & (F.col("pbv") > 0))
    kept = kept.where(~F.isnan(F.col("per").cast("double")) & ~F.isnan(F.col("pbv").cast("double")))
    return kept.select(
        normalize_ticker("ticker").alias("ticker"),
        F.col("period").cast("string").alias("period"),
        *[_measure(m).alias(m) for m in VALUATION_MEASURES],
        F.col("run_date").cast("string").alias("run_date"),
    )


def unique_profile(silver: DataFrame) -> DataFrame:
    """One profile row per (run_date, ticker) before joining."""
    return keep_greatest(silver, ("run_date", "ticker"), ("company_name",))


def unique_valuation(silver: DataFrame) -> DataFrame:
    """One valuation row per (run_date, ticker, period) before joining."""
    return keep_greatest(silver, ("run_date", "ticker", "period"), VALUATION_MEASURES)
