from ledgerlens.functions.expressions import (  # noqa: F401
    cutoff_year,
    is_last_friday,
    nan_to_null,
    normalize_ticker,
    past_run_date,
    safe_div,
)
