"""Column expressions shared by the jobs (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.config import TICKER_SUFFIX


# Every character of Unicode's White_Space property, and the four separators
# U+001C..U+001F that a string strip removes as well.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
)))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ticker(c: Column | str) -> Column:
    """Upper case first, then drop the exchange suffix, then strip
    surrounding whitespace (any whitespace, like a string strip, not only
    spaces).

    Upper-casing before the replace also strips a lower-case suffix
    ('byan.jk' -> 'BYAN').
    """
    upper = F.replace(F.upper(_c(c)), F.lit(TICKER_SUFFIX), F.lit(""))
    return F.btrim(upper, F.lit(WHITESPACE))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / NULLIF(den, 0): NULL instead of an error or infinity."""
    return _c(num) / F.nullif(_c(den), F.lit(0.0))


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL (NaN compares as the largest double in Spark)."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def cutoff_year(run_date: Column | str, years_back: int = 1) -> Column:
    """First year kept for a run date: year(run_date) - years_back."""
    return F.year(F.to_date(_c(run_date))) - F.lit(years_back)


def past_run_date(run_date: Column | str, years: Column | int) -> Column:
    """The same day ``years`` years earlier; 29 February becomes 28 February."""
    n = F.lit(years) if isinstance(years, int) else years
    return F.add_months(F.to_date(_c(run_date)), n * F.lit(-12))


def is_last_friday(d: Column | str) -> Column:
    """A Friday whose date one week later falls in another month."""
    day = _c(d)
    return (F.weekday(day) == F.lit(4)) & (F.month(F.date_add(day, 7)) != F.month(day))
