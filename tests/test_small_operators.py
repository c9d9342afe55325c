"""Direct cases for operators otherwise covered by the oracle only."""

import datetime as dt

from ledgerlens.operators import flatten
from ledgerlens.plans import warehouse


def test_company_page_offset_limit_and_tie_break(spark):
    rows = [("D", "X", 5.0), ("B", "X", 5.0), ("C", "X", 7.0), ("A", "Y", 9.0), ("E", "X", 1.0)]
    df = spark.createDataFrame(rows, "ticker string, sub_sector string, market_cap double")
    page = [r.ticker for r in flatten.company_page(df, "X", 1, 2).collect()]
    assert page == ["B", "D"]  # C first (7.0), then the 5.0 tie broken by ticker


def test_summaries_on_empty_and_mixed_facts(spark):
    fact = spark.createDataFrame(
        [("A", dt.date(2024, 1, 5), "S1", "LOLOS"), ("B", dt.date(2024, 1, 5), "S1", "TIDAK"),
         ("C", dt.date(2024, 1, 5), "S2", "TIDAK")],
        "ticker string, run_date date, sector string, status string",
    )
    assert tuple(warehouse.run_summary(fact, "2024-01-05").first()) == (3, 1, 2)
    assert tuple(warehouse.run_summary(fact, "2030-01-04").first()) == (0, 0, 0)
    by_sector = {r.sector: tuple(r)[1:] for r in warehouse.sector_summary(fact, "2024-01-05").collect()}
    assert by_sector == {"S1": (2, 1, 1), "S2": (1, 0, 1)}


def test_reserved_tables(spark):
    fin = spark.createDataFrame(
        [("2024-12-27", "A", "2023", 1.0), ("2024-12-27", "A", "2024", 2.0), ("2024-12-27", "B", "2024", 3.0)],
        "run_date string, ticker string, period string, revenue double",
    )
    periods = sorted(tuple(r) for r in warehouse.dim_fiscal_period(fin).collect())
    assert periods == [("2023", 2023, 12, "annual"), ("2024", 2024, 12, "annual")]
    assert warehouse.fundamentals_annual(fin, "2024-12-27").count() == 3
    val = spark.createDataFrame(
        [("2024-12-27", "A", "2023", 9.0, 1.0, 5.0, 2.0), ("2024-12-27", "A", "2024", 8.0, 1.1, 5.0, 2.0),
         ("2024-12-27", "A", "2024", 8.0, 1.1, 5.0, 2.0)],
        "run_date string, ticker string, period string, per double, pbv double, price double, ev_ebitda double",
    )
    snap = warehouse.valuation_snapshot(val, "2024-12-27").collect()
    assert len(snap) == 1 and snap[0].period == "2024" and snap[0].run_date == dt.date(2024, 12, 27)
