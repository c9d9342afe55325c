import pytest

from ledgerlens.config import FINANCIAL_MEASURES
from ledgerlens.operators import quality


def test_suite_reports_every_rule(spark):
    df = spark.createDataFrame(
        [("BYAN", "2024", 1.0), ("PTBA", "2024", None), ("bad1", None, 2.0)],
        "ticker string, period string, revenue double",
    )
    suite = (
        {"rule": "columns_present", "columns": ("ticker", "period", "eps")},
        {"rule": "row_count_between", "min": 1, "max": 2},
        {"rule": "not_null", "column": "period"},
        {"rule": "matches_regex", "column": "ticker", "regex": "^[A-Z]{2,5}$"},
        {"rule": "not_null", "column": "revenue", "mostly": 0.6},
        {"rule": "between", "column": "revenue", "min": 0, "max": 1.5, "mostly": 0.5},
        {"rule": "unique_combination", "columns": ("ticker",)},
        {"rule": "no_such_rule", "column": "x"},
    )
    rep = {r.rule_id: r for r in quality.run_suite(df, suite).collect()}
    assert [rep[i].success for i in range(8)] == [False, False, False, False, True, True, True, False]
    assert (rep[3].checked, rep[3].failed) == (3, 1)
    assert (rep[5].checked, rep[5].failed) == (2, 1)
    assert (rep[6].checked, rep[6].failed) == (3, 0)
    with pytest.raises(quality.QualityError) as err:
        quality.enforce(quality.run_suite(df, suite), "bronze")
    assert "5 rule(s)" in str(err.value)


def test_empty_frame(spark):
    df = spark.createDataFrame([], "ticker string, run_date date, status string, criteria_passed int, "
                               "roe double, der double, fcf double")
    rep = {r.rule_id: r.success for r in quality.run_suite(df, quality.GOLD_SUITE).collect()}
    assert rep[0] is False and all(v for k, v in rep.items() if k != 0)


def test_unique_counts_rows_and_skips_all_null_keys(spark):
    df = spark.createDataFrame(
        [("A", 1), ("A", 1), ("A", 1), ("B", 1), (None, None), (None, None)], "t string, d int"
    )
    suite = ({"rule": "unique_combination", "columns": ("t", "d")},)
    r = quality.run_suite(df, suite).first()
    assert (r.checked, r.failed, r.success) == (4, 3, False)
    suite2 = ({"rule": "not_null", "column": "t"},) + suite
    r2 = {x.rule_id: x for x in quality.run_suite(df, suite2).collect()}[1]
    assert (r2.checked, r2.failed, r2.success) == (4, 3, False)


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    suite = ({"rule": "not_null", "column": "x"}, {"rule": "between", "column": "x", "min": 0, "max": 9})
    rep = {r.rule_id: (r.checked, r.failed) for r in quality.run_suite(df, suite).collect()}
    assert rep == {0: (3, 2), 1: (1, 0)}


def test_bounds_are_parameters(spark):
    rows = [("ABCDE", "2024", *[1.0] * 9)] * 600
    cols = "ticker string, period string, " + ", ".join(f"{m} double" for m in FINANCIAL_MEASURES)
    df = spark.createDataFrame(rows, cols)
    assert not all(r.success for r in quality.run_suite(df, quality.BRONZE_SUITE).collect())
    assert all(r.success for r in quality.run_suite(df, quality.bronze_suite(1, None, "^[A-Z]{5}$")).collect())
    assert not all(r.success for r in quality.run_suite(df, quality.bronze_suite(1, None, "^[a-z]+$")).collect())
