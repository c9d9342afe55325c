"""Schemas of raw report sections, lake tables and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw report sections (landed JSON). Measures are read as STRING and
# cast once while flattening, so a number written as text survives like it
# does up to the silver CAST.
OVERVIEW_SECTION = _struct(
    ("sector", S), ("sub_sector", S), ("market_cap", S), ("listing_date", S)
)
FINANCIAL_YEAR = _struct(
    ("year", S),
    ("revenue", S),
    ("gross_profit", S),
    ("earnings", S),
    ("total_assets", S),
    ("total_equity", S),
    ("total_debt", S),
    ("operating_cash_flow", S),
    ("free_cash_flow", S),
    ("eps", S),
)
FINANCIALS_SECTION = _struct(
    ("historical_eps", T.MapType(S, _struct(("eps", S)))),
    ("historical_financials", T.ArrayType(FINANCIAL_YEAR)),
)
VALUATION_YEAR = _struct(("year", S), ("pe", S), ("pb", S), ("enterprise_to_ebitda", S))
VALUATION_SECTION = _struct(
    ("last_close_price", S), ("historical_valuation", T.ArrayType(VALUATION_YEAR))
)
# Sections without a dedicated flattener: the types of the keys that are
# known; the flattener reads every value as text first and keeps other keys.
DIVIDEND_SECTION = _struct(
    ("period", S), ("dividend_per_share", D), ("dividend_yield", D), ("payout_ratio", D)
)
MANAGEMENT_SECTION = _struct(
    ("ceo_name", S), ("insider_ownership_pct", D), ("institutional_ownership_pct", D)
)
# a document that is no report, and why
REJECTED = _struct(("section", S), ("ticker", S), ("reason", S), ("document", S))
SCHEDULED_SECTIONS = {
    "overview": OVERVIEW_SECTION, "financials": FINANCIALS_SECTION, "valuation": VALUATION_SECTION,
}
GENERIC_SECTIONS = {"dividend": DIVIDEND_SECTION, "management": MANAGEMENT_SECTION}


def report_schema(section: str, section_type: T.DataType) -> T.StructType:
    """A landed report: ticker, company_name and one named section."""
    return _struct(("ticker", S), ("company_name", S), (section, section_type))


COMPANY_PAGE = _struct(
    ("results", T.ArrayType(_struct(("symbol", S)))),
    (
        "pagination",
        _struct(("has_next", B), ("next_offset", L), ("total_count", L), ("showing", L)),
    ),
)
PRICE_RECORD = _struct(("date", S), ("close", D))
PRICE_PAGE = T.ArrayType(PRICE_RECORD)

# ---- lake tables (bronze and silver carry run_date as a string partition)
PROFILE_COLUMNS = ("ticker", "company_name", "sector", "sub_sector", "market_cap", "listing_date")
BRONZE_PROFILE = _struct(
    ("ticker", S), ("company_name", S), ("sector", S), ("sub_sector", S),
    ("market_cap", D), ("listing_date", S), ("run_date", S),
)
BRONZE_FINANCIALS = _struct(
    ("ticker", S), ("period", S),
    *[(m, D) for m in (
        "revenue", "gross_profit", "net_income", "total_assets", "total_equity",
        "total_debt", "operating_cash_flow", "capex", "eps",
    )],
    ("run_date", S),
)
BRONZE_VALUATION = _struct(
    ("ticker", S), ("period", S), ("per", D), ("pbv", D), ("price", D), ("ev_ebitda", D),
    ("run_date", S),
)

# ---- warehouse (gold)
DIM_COMPANY = _struct(
    ("ticker", S), ("company_name", S), ("sector", S), ("sub_sector", S),
    ("market_cap", D), ("listing_date", T.DateType()),
    ("created_at", T.TimestampType()), ("updated_at", T.TimestampType()),
)
DIM_DATE = _struct(
    ("run_date", T.DateType()), ("year", I), ("quarter", I), ("month", I),
    ("week_of_year", I), ("day_of_week", I), ("is_friday", B),
)
DIM_FISCAL_PERIOD = _struct(
    ("period_key", S), ("fiscal_year", I), ("fiscal_month", I), ("period_type", S)
)
FCT_FUNDAMENTALS_ANNUAL = _struct(
    ("ticker", S), ("period", S),
    *[(m, D) for m in (
        "revenue", "gross_profit", "net_income", "total_assets", "total_equity",
        "total_debt", "operating_cash_flow", "capex", "eps",
    )],
    ("loaded_at", T.TimestampType()),
)
FCT_VALUATION_SNAPSHOT = _struct(
    ("ticker", S), ("run_date", T.DateType()), ("period", S), ("per", D), ("pbv", D),
    ("price", D), ("ev_ebitda", D), ("loaded_at", T.TimestampType()),
)
# --- fixed values: the columns of the screening fact
SCREENING_COLUMNS = (
    "ticker", "run_date", "period", "company_name", "sector", "roe", "der", "fcf",
    "fcf_margin", "eps_growth_yoy", "eps_cagr_5y", "per", "pbv", "graham_combined",
    "criteria_passed", "status",
)
FCT_SCREENING = _struct(
    ("ticker", S), ("run_date", T.DateType()), ("period", S), ("company_name", S),
    ("sector", S), ("roe", D), ("der", D), ("fcf", D), ("fcf_margin", D),
    ("eps_growth_yoy", D), ("eps_cagr_5y", D), ("per", D), ("pbv", D),
    ("graham_combined", D), ("criteria_passed", I), ("status", S),
    ("loaded_at", T.TimestampType()),
)

WAREHOUSE_TABLES: dict[str, T.StructType] = {
    "dim_company": DIM_COMPANY,
    "dim_date": DIM_DATE,
    "dim_fiscal_period": DIM_FISCAL_PERIOD,
    "fct_fundamentals_annual": FCT_FUNDAMENTALS_ANNUAL,
    "fct_valuation_snapshot": FCT_VALUATION_SNAPSHOT,
    "fct_screening": FCT_SCREENING,
}
