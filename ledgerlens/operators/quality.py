"""Declarative data-quality rules (Q1-Q7) and suite runs (Q8).

All row-level rules of a suite are folded into ONE aggregate over the
data; the uniqueness rule is a second job (a grouped count). The result is
a small DataFrame: rule_id, rule, column, checked, failed, success.
``enforce`` raises one error that lists every failure.

Definitions: a NaN counts as NULL; Q3 (not null) counts every row; Q4-Q6 leave NULLs out of
the denominator; bounds are inclusive; an empty denominator passes; with
``mostly`` a rule passes when the share of good values is >= mostly. Q7
counts rows: every row of a key combination seen more than once fails,
and rows whose key columns are all NULL are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.config import STATUS_FAIL, STATUS_PASS, TICKER_PATTERN
from ledgerlens.functions.expressions import nan_to_null

Rule = Mapping[str, Any]

# --- fixed values: the two suites of the screening, as defaults of their
# parameters. The row bounds and the ticker pattern fit the universe the
# screening was made for; other universes pass their own.
def bronze_suite(
    min_rows: int | None = 50, max_rows: int | None = 500, ticker_pattern: str = TICKER_PATTERN
) -> tuple[Rule, ...]:
    """financial_statements of one run date."""
    return (
        {"rule": "columns_present", "columns": (
            "ticker", "period", "revenue", "gross_profit", "net_income", "total_assets",
            "total_equity", "total_debt", "operating_cash_flow", "capex", "eps")},
        {"rule": "row_count_between", "min": min_rows, "max": max_rows},
        {"rule": "not_null", "column": "ticker"},
        {"rule": "not_null", "column": "period"},
        {"rule": "matches_regex", "column": "ticker", "regex": ticker_pattern},
        {"rule": "not_null", "column": "net_income", "mostly": 0.7},
        {"rule": "not_null", "column": "total_equity", "mostly": 0.7},
        {"rule": "not_null", "column": "revenue", "mostly": 0.6},
    )


def gold_suite(
    min_rows: int | None = 1, roe_bounds: tuple[float, float] = (-5.0, 10.0), mostly: float = 0.9,
    present: float = 0.5,
) -> tuple[Rule, ...]:
    """fct_screening of one run date."""
    return (
        {"rule": "row_count_between", "min": min_rows},
        {"rule": "not_null", "column": "ticker"},
        {"rule": "not_null", "column": "status"},
        {"rule": "not_null", "column": "criteria_passed"},
        {"rule": "in_set", "column": "status", "values": (STATUS_PASS, STATUS_FAIL)},
        {"rule": "between", "column": "criteria_passed", "min": 0, "max": 7},
        {"rule": "not_null", "column": "roe", "mostly": present},
        {"rule": "not_null", "column": "der", "mostly": present},
        {"rule": "not_null", "column": "fcf", "mostly": present},
        {"rule": "between", "column": "roe", "min": roe_bounds[0], "max": roe_bounds[1], "mostly": mostly},
        {"rule": "between", "column": "der", "min": 0, "mostly": mostly},
        {"rule": "unique_combination", "columns": ("ticker", "run_date")},
    )


BRONZE_SUITE, GOLD_SUITE = bronze_suite(), gold_suite()
# dim_company: its key and its NOT NULL column.
DIM_COMPANY_SUITE: tuple[Rule, ...] = (
    {"rule": "not_null", "column": "ticker"},
    {"rule": "not_null", "column": "company_name"},
    {"rule": "unique_combination", "columns": ("ticker",)},
)

REPORT_SCHEMA = T.StructType([
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("rule", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("checked", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("success", T.BooleanType()),
])


class QualityError(ValueError):
    pass


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def _bad_in_checked(rule: Rule) -> tuple[Column, Column] | None:
    """(checked, failed) aggregate expressions of a row-level rule."""
    kind = rule["rule"]
    if kind == "row_count_between":
        return F.count(F.lit(1)), F.lit(0).cast("long")
    c = F.col(rule["column"])
    if kind == "not_null":
        return F.count(F.lit(1)), _count_if(c.isNull())
    present = c.isNotNull()
    if kind == "matches_regex":
        return _count_if(present), _count_if(present & ~c.rlike(rule["regex"]))
    if kind == "in_set":
        return _count_if(present), _count_if(present & ~c.isin(*rule["values"]))
    if kind == "between":
        ok = F.lit(True)
        if rule.get("min") is not None:
            ok = ok & (c >= F.lit(rule["min"]))
        if rule.get("max") is not None:
            ok = ok & (c <= F.lit(rule["max"]))
        return _count_if(present), _count_if(present & ~ok)
    return None


def counts_rows(rule: Rule) -> bool:
    """Whether a rule's counts grow with the rows (those of columns_present
    and of an unknown rule do not)."""
    kind = rule["rule"]
    return kind == "unique_combination" or (kind != "columns_present" and _bad_in_checked(rule) is not None)


def _any_present(keys: Sequence[str]) -> Column:
    """Rows whose key columns are all NULL are left out of uniqueness."""
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNotNull()
    return cond


def success(rule: Rule, checked: Column, failed: Column) -> Column:
    """Whether a rule passes by its counts."""
    if rule["rule"] == "row_count_between":
        ok = F.lit(True)
        if rule.get("min") is not None:
            ok = ok & (checked >= F.lit(rule["min"]))
        if rule.get("max") is not None:
            ok = ok & (checked <= F.lit(rule["max"]))
        return ok
    mostly = rule.get("mostly")
    if mostly is None:
        return failed == F.lit(0)
    share = (checked - failed).cast("double") / checked.cast("double")
    return (checked == F.lit(0)) | (share >= F.lit(float(mostly)))


def run_suite(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """Q8: evaluate every rule; one row per rule.

    One pass over the data: when the suite has a uniqueness rule, the
    row-level counts are first summed per key combination (the grouping a
    uniqueness check needs anyway, with a map-side partial step, so a hot
    key collapses before the shuffle) and a second, tiny aggregate adds
    the groups up and counts the keys seen more than once.
    """
    spark: SparkSession = df.sparkSession
    df = df.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])
    static: list[tuple] = []
    row_rules: list[tuple[int, Rule, Column, Column]] = []
    unique: list[tuple[int, Rule]] = []
    for i, rule in enumerate(suite):
        kind = rule["rule"]
        if kind == "columns_present":
            missing = [c for c in rule["columns"] if c not in df.columns]
            static.append((i, kind, None, len(rule["columns"]), len(missing), not missing))
        elif kind == "unique_combination":
            unique.append((i, rule))
        else:
            pair = _bad_in_checked(rule)
            if pair is None:  # an unknown rule is a failure, like a missing method
                static.append((i, kind, rule.get("column"), 0, 1, False))
            else:
                row_rules.append((i, rule, *pair))

    zero = F.lit(0).cast("long")
    parts: list[DataFrame] = []
    keyed, *other_unique = unique or [None]
    inner = [c.alias(f"c{i}") for i, _, c, _ in row_rules] + [f.alias(f"f{i}") for i, _, _, f in row_rules]
    outer = [F.coalesce(F.sum(f"c{i}"), zero).alias(f"c{i}") for i, *_ in row_rules] + [
        F.coalesce(F.sum(f"f{i}"), zero).alias(f"f{i}") for i, *_ in row_rules
    ]
    if keyed is not None:
        ki, krule = keyed
        keys = list(krule["columns"])
        any_key = _any_present(keys)
        grouped = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_rows"), *inner,
        ).withColumn("_n", F.when(any_key, F.col("_rows")).otherwise(F.lit(0)))
        one = grouped.agg(
            *outer,
            F.coalesce(F.sum("_n"), zero).cast("long").alias(f"c{ki}"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), zero)
            .cast("long").alias(f"f{ki}"),
        )
        row_rules.append((ki, krule, None, None))
    elif row_rules:
        one = df.agg(*[F.coalesce(c, zero).alias(f"c{i}") for i, _, c, _ in row_rules],
                     *[F.coalesce(f, zero).alias(f"f{i}") for i, _, _, f in row_rules])
    else:
        one = None
    if one is not None:
        rows = []
        for i, r, *_ in row_rules:
            c, f = F.col(f"c{i}"), F.col(f"f{i}")
            is_unique = r["rule"] == "unique_combination"
            rows.append(F.struct(
                F.lit(i).alias("rule_id"), F.lit(r["rule"]).alias("rule"),
                (F.lit(",".join(r["columns"])) if is_unique else F.lit(r.get("column")).cast("string")).alias("column"),
                c.alias("checked"), f.alias("failed"),
                ((f == F.lit(0)) if is_unique else success(r, c, f)).alias("success"),
            ))
        parts.append(one.select(F.explode(F.array(*rows)).alias("x")).select("x.*"))
    for i, rule in other_unique:
        keys = list(rule["columns"])
        dup = (
            df.where(_any_present(keys))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(
                F.coalesce(F.sum("_n"), zero).cast("long").alias("checked"),
                F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), zero)
                .cast("long").alias("failed"),
            )
        )
        parts.append(dup.select(
            F.lit(i).alias("rule_id"), F.lit(rule["rule"]).alias("rule"),
            F.lit(",".join(keys)).alias("column"), "checked", "failed",
            (F.col("failed") == 0).alias("success"),
        ))
    if static:
        parts.append(spark.createDataFrame(static, REPORT_SCHEMA))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in REPORT_SCHEMA.fields])


def enforce_rows(rows: Sequence[Row], label: str) -> None:
    failed = [r for r in rows if not r.success]
    if failed:
        lines = [f"  x {r.rule} column={r.column} checked={r.checked} failed={r.failed}" for r in failed]
        raise QualityError(f"[{label}] data quality failed, {len(failed)} rule(s):\n" + "\n".join(lines))


def enforce(report: DataFrame, label: str) -> None:
    """Raise one error listing every failed rule (the gate of a step)."""
    enforce_rows(report.where(~F.col("success")).orderBy("rule_id").collect(), label)
