"""Calendar dimension (S7) and insert-if-new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day between each (start, end) pair of ``bounds``.

    Columns: run_date, year, quarter, month, week_of_year (ISO week),
    day_of_week (0 = Sunday .. 6 = Saturday), is_friday.
    """
    days = bounds.select(
        F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY"))).alias(
            "run_date"
        )
    )
    return days.select("run_date", *date_attributes(F.col("run_date")))


def date_attributes(d: Column) -> list[Column]:
    dow = F.dayofweek(d) - F.lit(1)
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        dow.cast("int").alias("day_of_week"),
        (dow == F.lit(5)).alias("is_friday"),
    ]


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows plus the incoming rows whose key is new
    (ON CONFLICT DO NOTHING). Incoming keys are de-duplicated first."""
    new = incoming.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(new.select(*existing.columns))
