"""Ratios per company and fiscal period (M1-M5), latest period (A1) and
the candidate join (K1).

M1-M4 come from the same financial rows, so they are computed in one
projection over one window; the window is keyed by (run_date, ticker),
which lets Catalyst push a run_date filter below it (N7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.config import CAGR_DIGITS
from ledgerlens.functions.expressions import nan_to_null, safe_div

COMPANY = ("run_date", "ticker")


def _for_run(df: DataFrame, run_date: str | None) -> DataFrame:
    return df if run_date is None else df.where(F.col("run_date") == F.lit(run_date))


def roe(fin: DataFrame, run_date: str | None = None) -> DataFrame:
    """M1: net_income / NULLIF(total_equity, 0)."""
    return _for_run(fin, run_date).select(
        "ticker", "period", safe_div("net_income", "total_equity").alias("roe")
    )


def der(fin: DataFrame, run_date: str | None = None) -> DataFrame:
    """M2: total_debt / NULLIF(total_equity, 0)."""
    return _for_run(fin, run_date).select(
        "ticker", "period", safe_div("total_debt", "total_equity").alias("der")
    )


def fcf(fin: DataFrame, run_date: str | None = None) -> DataFrame:
    """M3: operating_cash_flow - capex and its margin on revenue."""
    f = F.col("operating_cash_flow") - F.col("capex")
    return _for_run(fin, run_date).select(
        "ticker", "period", f.alias("fcf"), safe_div(f, "revenue").alias("fcf_margin")
    )


def _growth_columns() -> list:
    w = Window.partitionBy(*COMPANY).orderBy("period")
    prev1 = F.lag("eps", 1).over(w)
    prev5 = F.lag("eps", 5).over(w)
    yoy = safe_div(F.col("eps") - prev1, F.abs(prev1))
    cagr = F.pow(safe_div("eps", F.abs(prev5)), F.lit(0.2)) - F.lit(1.0)
    return [
        yoy.alias("eps_growth_yoy"),
        F.round(nan_to_null(cagr), CAGR_DIGITS).alias("eps_cagr_5y"),
    ]


def eps_growth(fin: DataFrame, run_date: str | None = None) -> DataFrame:
    """M4 with W2, W3: LAG 1 and LAG 5 of eps by period (rows, not years)."""
    grown = fin.select("run_date", "ticker", "period", *_growth_columns())
    return _for_run(grown, run_date).select("ticker", "period", "eps_growth_yoy", "eps_cagr_5y")


def valuation_metrics(val: DataFrame, run_date: str | None = None) -> DataFrame:
    """M5: per * pbv as graham_combined; price and ev_ebitda passed on."""
    return _for_run(val, run_date).select(
        "ticker",
        "period",
        "per",
        "pbv",
        (F.col("per") * F.col("pbv")).alias("graham_combined"),
        "price",
        "ev_ebitda",
    )


def latest_period(fin: DataFrame, run_date: str | None = None) -> DataFrame:
    """A1: MAX(period) per ticker (string order)."""
    return (
        _for_run(fin, run_date)
        .groupBy(*COMPANY)
        .agg(F.max("period").alias("period"))
        .select("ticker", "period")
    )


def financial_metrics(fin: DataFrame, run_date: str | None = None) -> DataFrame:
    """M1-M4 plus the latest-period flag in one window pass.

    Columns: run_date, ticker, period, roe, der, fcf, fcf_margin,
    eps_growth_yoy, eps_cagr_5y, is_latest.
    """
    f = F.col("operating_cash_flow") - F.col("capex")
    latest = F.max("period").over(Window.partitionBy(*COMPANY))
    out = fin.select(
        "run_date",
        "ticker",
        "period",
        safe_div("net_income", "total_equity").alias("roe"),
        safe_div("total_debt", "total_equity").alias("der"),
        f.alias("fcf"),
        safe_div(f, "revenue").alias("fcf_margin"),
        *_growth_columns(),
        (F.col("period") == latest).alias("is_latest"),
    )
    return _for_run(out, run_date)


CANDIDATE_COLUMNS = (
    "ticker", "company_name", "sector", "period", "roe", "der", "fcf", "fcf_margin",
    "eps_growth_yoy", "eps_cagr_5y", "per", "pbv", "graham_combined",
)


def screening_candidates(
    fin: DataFrame, profile: DataFrame, val: DataFrame, run_date: str | None = None
) -> DataFrame:
    """K1: profile INNER JOIN latest period, LEFT JOIN the metric sets.

    ``fin``, ``profile`` and ``val`` are silver frames; profile and
    valuation must already be unique per key (``unique_profile``,
    ``unique_valuation``). A company without financials disappears; a
    latest period without a surviving valuation keeps NULL ratios (N14).
    Output keeps run_date as the first column.
    """
    metrics = financial_metrics(fin, run_date).where("is_latest").drop("is_latest")
    prof = _for_run(profile, run_date).select("run_date", "ticker", "company_name", "sector")
    vals = _for_run(val, run_date).select(
        "run_date",
        "ticker",
        "period",
        "per",
        "pbv",
        (F.col("per") * F.col("pbv")).alias("graham_combined"),
    )
    joined = prof.join(metrics, ["run_date", "ticker"], "inner").join(
        vals, ["run_date", "ticker", "period"], "left"
    )
    return joined.select("run_date", *CANDIDATE_COLUMNS)
