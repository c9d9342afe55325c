"""Monthly closing prices (P1, P6, P10) and the full-or-incremental load."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import PRICE_YEARS_BACK
from ledgerlens.functions.expressions import is_last_friday


# Forms of a date text besides ISO (2001-01-26, 2001-1-26, 2001-01-26T16:00:00
# and the like) and the shape of each: a text is parsed by the first whose
# shape it has, since a parse that fails is slow. A day and month given by two
# numbers only are taken as month/day.
DATE_PATTERNS = (
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}-[A-Z][a-z]{2}-\d{4}$", "d-MMM-yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,8} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Z][a-z]{3,8} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
)


def parse_date(text: Column, patterns: Sequence[tuple[str, str]] = DATE_PATTERNS) -> Column:
    """The DATE that a text means, NULL where no pattern fits."""
    trimmed = F.trim(text)
    other = F.lit(None).cast("date")
    for shape, pattern in reversed(patterns):
        other = F.when(trimmed.rlike(shape), F.try_to_date(trimmed, pattern)).otherwise(other)
    return F.coalesce(F.try_to_date(trimmed), other)


def parsed_dates(prices: DataFrame) -> DataFrame:
    """Keep rows whose date text parses; adds _date (DATE). The date comes
    out of a generator, so that filters on it do not parse it again for each
    of their conditions."""
    parsed = prices.select("*", F.explode(F.array(parse_date(F.col("date")))).alias("_date"))
    return parsed.where(F.col("_date").isNotNull())


def run_date_of(text: Column) -> Column:
    """The run date of a date text: how the lake names that day, whatever
    form it was written in."""
    return F.date_format(parse_date(text), "yyyy-MM-dd")


def last_friday_prices(prices: DataFrame, run_date: str, years_back: int = PRICE_YEARS_BACK) -> DataFrame:
    """Last Friday of each month, from 1 January of (run year -
    years_back) up to run_date. Keeps the input columns (date as text)."""
    start = F.make_date(F.year(F.lit(run_date).cast("date")) - years_back, F.lit(1), F.lit(1))
    rows = parsed_dates(prices)
    kept = rows.where(
        is_last_friday("_date") & F.col("_date").between(start, F.lit(run_date).cast("date"))
    )
    return kept.drop("_date")


def is_last_friday_date(run_date: str) -> bool:
    """P10 on the driver: one scalar decision about the run date itself."""
    d = _dt.date.fromisoformat(run_date)
    return d.weekday() == 4 and (d + _dt.timedelta(days=7)).month != d.month


def incremental_prices(prices: DataFrame, run_date: str) -> DataFrame:
    """The incremental branch: rows of run_date only, and only when it is
    a last Friday (otherwise an empty frame with the same columns)."""
    if not is_last_friday_date(run_date):
        return prices.where(F.lit(False))
    return parsed_dates(prices).where(F.col("_date") == F.lit(run_date).cast("date")).drop("_date")
