"""Fixed values that results depend on.

Everything in this module must keep the values written here: thresholds,
status words, default run-date and the ticker pattern are part of the
published semantics of the screening.
"""

from __future__ import annotations

# --- fixed values: screening thresholds (criterion -> (operator, bound)) ---
# roe >= 0.15; der <= 0.5; fcf > 0; eps_growth_yoy >= 0.10; per <= 15;
# pbv <= 1.5; per * pbv <= 22.5
THRESHOLDS: dict[str, tuple[str, float]] = {
    "roe": (">=", 0.15),
    "der": ("<=", 0.5),
    "fcf": (">", 0.0),
    "eps_growth_yoy": (">=", 0.10),
    "per": ("<=", 15.0),
    "pbv": ("<=", 1.5),
    "graham_combined": ("<=", 22.5),
}

# --- fixed values: status words stored in the fact ---
STATUS_PASS = "LOLOS"
STATUS_FAIL = "TIDAK"

# --- fixed values: ticker suffix removed during normalisation, ticker pattern ---
TICKER_SUFFIX = ".JK"
TICKER_PATTERN = "^[A-Z]{2,5}$"

# --- fixed values: default run date of the test fixture (a last Friday) ---
RUN_DATE = "2001-12-28"
# The second run date of the two-run-date fixture.
PREVIOUS_RUN_DATE = "2000-12-29"

# Years kept before the run year when flattening reports (run year - 1).
CUTOFF_YEARS_BACK = 1
# Years of last-Friday prices loaded on a first (full) price load.
PRICE_YEARS_BACK = 1

# Digits kept for eps_cagr_5y: POWER differs in the last bit between engines.
CAGR_DIGITS = 9

# Domains of the lake.
FINANCIALS = "financial_statements"
PROFILE = "company_profile"
VALUATION = "valuation_ratios"
DAILY_PRICES = "daily_prices"
DIVIDENDS = "dividend_history"
MANAGEMENT = "management_info"

# The measures of a financial statement, in table order.
FINANCIAL_MEASURES = (
    "revenue",
    "gross_profit",
    "net_income",
    "total_assets",
    "total_equity",
    "total_debt",
    "operating_cash_flow",
    "capex",
    "eps",
)
VALUATION_MEASURES = ("per", "pbv", "price", "ev_ebitda")

# --- fixed values: default range of the calendar dimension seed ---
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2030-12-31"
