"""Ticker normalisation (A10), cutoff year (A11), dates."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import expressions as E
from ledgerlens.operators import prices
from ledgerlens.plans.calendar_dim import calendar
from ledgerlens.sources.lake import backfill_run_dates


def test_normalize_ticker(spark):
    df = spark.createDataFrame([("byan.jk",), ("PTBA",), ("itmg.JK",), ("medc",), (" adro.JK ",)], "t string")
    got = [r[0] for r in df.select(E.normalize_ticker("t")).collect()]
    assert got == ["BYAN", "PTBA", "ITMG", "MEDC", "ADRO"]


def test_cutoff_year(spark):
    df = spark.createDataFrame([("2026-06-18",), ("2025-01-01",), ("2024-12-31",)], "d string")
    assert [r[0] for r in df.select(E.cutoff_year("d")).collect()] == [2025, 2024, 2023]


def test_past_run_date_feb_29(spark):
    df = spark.createDataFrame([("2024-02-29",)], "d string")
    assert df.select(E.past_run_date("d", 1)).first()[0] == dt.date(2023, 2, 28)
    assert backfill_run_dates("2024-02-29", 2) == ("2023-02-28", "2024-02-29")


def test_safe_div_never_raises(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(E.safe_div("a", "b")).collect()] == [None, None, 1.5]


def test_last_friday(spark):
    days = [dt.date(2001, 12, 28), dt.date(2001, 12, 21), dt.date(2001, 11, 30), dt.date(2024, 5, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(E.is_last_friday("d")).collect()]
    assert got == [True, False, True, True]
    assert prices.is_last_friday_date("2001-12-28") and not prices.is_last_friday_date("2001-12-21")


def test_last_friday_prices_window_and_bad_dates(spark):
    rows = [("AAA", "2001-12-28", 1.0), ("AAA", "n/a", 2.0), ("AAA", "1999-12-31", 3.0),
            ("AAA", "2000-01-28", 4.0), ("AAA", "2002-01-25", 5.0), ("AAA", "2000-01-21", 6.0)]
    df = spark.createDataFrame(rows, "ticker string, date string, close double")
    got = sorted(r.date for r in prices.last_friday_prices(df, "2001-12-28").collect())
    assert got == ["2000-01-28", "2001-12-28"]


def test_calendar_attributes(spark):
    b = spark.createDataFrame([("2024-12-30", "2024-12-30"), ("2027-01-01", "2027-01-01")], "start string, end string")
    r = {x.run_date: x for x in calendar(b).collect()}
    a = r[dt.date(2024, 12, 30)]
    assert (a.year, a.quarter, a.month, a.week_of_year, a.day_of_week, a.is_friday) == (2024, 4, 12, 1, 1, False)
    f = r[dt.date(2027, 1, 1)]
    assert (f.week_of_year, f.day_of_week, f.is_friday) == (53, 5, True)


def test_metric_sql_binds_the_run_date(spark):
    from ledgerlens.operators import metrics
    from ledgerlens.plans.metric_sql import metric_sql
    from ledgerlens.registry import EPS_GROWTH_STATEMENT

    fin = spark.createDataFrame(
        [("2019-03-29", "LARK", str(y), float(y - 2009)) for y in range(2010, 2020)]
        + [("2019-03-29", "WREN", str(2010 + k), e) for k, e in enumerate((-1.0, 0.0, 3.0, None, 2.0, -32.0, 4.0))]
        + [("2019-06-28", "LARK", "2019", 1.0)],
        "run_date string, ticker string, period string, eps double",
    )
    for d in ("2019-03-29", "2019-06-28", "2001-01-26"):
        got = metric_sql(spark, EPS_GROWTH_STATEMENT, d, silver=fin).collect()
        assert sorted(map(str, got)) == sorted(map(str, metrics.eps_growth(fin, d).collect()))
    hostile = metric_sql(spark, "SELECT count(*) AS n FROM {rows} WHERE run_date = :run_date", "x' OR '1'='1", rows=fin)
    assert hostile.first().n == 0
