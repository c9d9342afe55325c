"""Scoring against the value-investing thresholds (K2, K3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import STATUS_FAIL, STATUS_PASS, THRESHOLDS
from ledgerlens.functions.expressions import nan_to_null

_OPS = {
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
}


def _metric(name: str) -> Column:
    # graham_combined is always recomputed from per and pbv (the stored
    # column is not trusted, and may be absent).
    if name == "graham_combined":
        return nan_to_null(F.col("per")) * nan_to_null(F.col("pbv"))
    return nan_to_null(F.col(name))


def criteria(thresholds: Mapping[str, tuple[str, float]] = THRESHOLDS) -> dict[str, Column]:
    """One 0/1 column per criterion; NULL and NaN count as not passed."""
    return {
        name: F.coalesce(_OPS[op](_metric(name), F.lit(bound)).cast("int"), F.lit(0))
        for name, (op, bound) in thresholds.items()
    }


def criteria_flags(df: DataFrame, thresholds: Mapping[str, tuple[str, float]] = THRESHOLDS) -> DataFrame:
    """Adds pass_<criterion> columns (int 0/1)."""
    return df.select("*", *[c.alias(f"pass_{n}") for n, c in criteria(thresholds).items()])


def score(
    df: DataFrame,
    thresholds: Mapping[str, tuple[str, float]] = THRESHOLDS,
    pass_word: str = STATUS_PASS,
    fail_word: str = STATUS_FAIL,
) -> DataFrame:
    """K2: criteria_passed (0..n) and status (pass word only when all pass).

    Returns a new frame; the input is untouched (DataFrames are immutable).
    """
    flags = list(criteria(thresholds).values())
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    passed = total.cast("int")
    # Re-scoring replaces an earlier result instead of duplicating columns.
    return df.drop("criteria_passed", "status").select(
        "*",
        passed.alias("criteria_passed"),
        F.when(passed == F.lit(len(flags)), F.lit(pass_word)).otherwise(F.lit(fail_word)).alias(
            "status"
        ),
    )
