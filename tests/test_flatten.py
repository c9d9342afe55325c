"""Flatteners: renames, cutoffs, defaults, and reports that are not as they
should be."""

import json

import pytest
from pyspark.sql import Observation

from ledgerlens import schemas
from ledgerlens.operators import flatten


def landed(spark, *documents):
    lines = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in documents]
    return spark.createDataFrame(lines, "value string")


def financials(rows, by_year=None, ticker="ORCH"):
    section = {"historical_financials": rows}
    if by_year is not None:
        section["historical_eps"] = by_year
    return {"ticker": ticker, "company_name": "Orchard Works", "financials": section}


def test_yearly_rows(spark):
    doc = financials([
        {"year": 1997, "revenue": 61, "earnings": 6},
        {"year": 1999, "revenue": 80, "gross_profit": 33, "earnings": 9, "total_assets": 410, "total_equity": 260,
         "total_debt": 150, "operating_cash_flow": 14, "free_cash_flow": 3.5, "eps": 0.9},
        {"year": 1998, "operating_cash_flow": 12},
        {"revenue": 5},
    ])
    out = {r.period: r for r in flatten.flatten_financials(landed(spark, doc), "1999-11-26").collect()}
    assert sorted(out) == ["1998", "1999"]
    r = out["1999"]
    assert (r.ticker, r.revenue, r.gross_profit, r.net_income) == ("ORCH", 80.0, 33.0, 9.0)
    assert (r.total_assets, r.total_equity, r.total_debt) == (410.0, 260.0, 150.0)
    assert (r.operating_cash_flow, r.capex, r.eps) == (14.0, 10.5, 0.9)
    assert (out["1998"].operating_cash_flow, out["1998"].capex, out["1998"].revenue) == (12.0, None, None)


def test_eps_by_year_comes_first_even_as_null(spark):
    rows = [{"year": y, "eps": 0.25} for y in (2010, 2011, 2012)]
    doc = financials(rows, {"2010": {"eps": 0.75}, "2011": {"eps": None}})
    out = flatten.flatten_financials(landed(spark, doc), "2012-06-29", years_back=2).collect()
    assert {r.period: r.eps for r in out} == {"2010": 0.75, "2011": None, "2012": 0.25}


@pytest.mark.parametrize("year", [2016, "2016", 2016.0, "2016.0"])
def test_years_in_any_form(spark, year):
    doc = financials([{"year": year, "eps": 0.5}], {"2016": {"eps": 2.5}})
    out = flatten.flatten_financials(landed(spark, doc), "2016-01-29").collect()
    assert [(r.period, r.eps) for r in out] == [("2016", 2.5)]


@pytest.mark.parametrize("year", [None, "soon", 2016.5, "", True, -3, 1e300])
def test_no_years(spark, year):
    assert flatten.flatten_financials(landed(spark, financials([{"year": year}])), "2016-01-29").count() == 0


def test_numbers_as_text_and_no_numbers(spark):
    doc = '{"ticker":"QUAY","financials":{"historical_financials":[{"year":2005,"revenue":"12.5","earnings":"n/a",' \
          '"total_assets":NaN,"total_debt":"","eps":"NaN"}]}}'
    r = flatten.flatten_financials(landed(spark, doc, financials([{"year": 2005, "revenue": 3}])), "2005-02-25")
    rows = {x.ticker: x for x in r.collect()}
    bad = rows["QUAY"]
    assert bad.revenue == 12.5
    assert (bad.net_income, bad.total_assets, bad.total_debt, bad.eps) == (None,) * 4
    assert rows["ORCH"].revenue == 3.0


@pytest.mark.parametrize("flat", ["overview", "financials", "valuation", "management"])
def test_what_is_no_report_costs_itself_only(spark, flat):
    good = {"ticker": "PIER", "company_name": "Pier", "overview": {"sector": "Port"}, "management": {"ceo_name": "Ada"},
            "financials": {"historical_financials": [{"year": 2003}]}, "valuation": {"historical_valuation": [{"year": 2003}]}}
    docs = landed(spark, good, "", "   ", "{broken", None, "[]", "17")
    seen = Observation(f"seen_{flat}")
    out = {
        "overview": lambda: flatten.flatten_overview(docs, seen),
        "financials": lambda: flatten.flatten_financials(docs, "2003-05-30", observation=seen),
        "valuation": lambda: flatten.flatten_valuation(docs, "2003-05-30", observation=seen),
        "management": lambda: flatten.flatten_section(docs, "management", schemas.MANAGEMENT_SECTION, seen),
    }[flat]()
    assert [r.ticker for r in out.collect()] == ["PIER"]
    assert (seen.get["documents"], seen.get["malformed"]) == (7, 6)


def test_valuation_rows(spark):
    doc = {"ticker": "MOLE", "valuation": {"last_close_price": 42, "historical_valuation": [
        {"year": 2007, "pe": 11, "pb": 0.5, "enterprise_to_ebitda": 4}, {"year": 2008.0, "pe": "x"}, {"year": 2006}]}}
    out = sorted(tuple(r) for r in flatten.flatten_valuation(landed(spark, doc), "2008-08-29").collect())
    assert out == [("MOLE", "2007", 11.0, 0.5, 42.0, 4.0), ("MOLE", "2008", None, None, 42.0, None)]


def test_overview_defaults(spark):
    docs = landed(spark, {"ticker": "FERN", "company_name": None, "overview": {"market_cap": "77"}}, {"ticker": "MOSS"},
                  {"ticker": "REED", "company_name": "Reed", "overview": {"sector": "Wool", "sub_sector": "Yarn",
                                                                         "market_cap": 5, "listing_date": "1981-03-02"}})
    out = {r.ticker: tuple(r)[1:] for r in flatten.flatten_overview(docs).collect()}
    assert out == {"FERN": ("", None, None, 77.0, None), "MOSS": ("", None, None, None, None),
                   "REED": ("Reed", "Wool", "Yarn", 5.0, "1981-03-02")}


def test_section_keys_all_stay_and_win(spark):
    docs = landed(
        spark,
        {"ticker": "A", "company_name": "Out", "management": {"company_name": "In", "ceo_name": "Ada", "seats": 9}},
        {"ticker": "B", "company_name": "Out", "management": {"company_name": None, "insider_ownership_pct": "0.25"}},
        {"ticker": "C", "company_name": "Out", "management": {"ticker": "C2", "Seats": [1, 2], "insider_ownership_pct": "-"}},
        {"ticker": "D", "company_name": "Out", "management": ["no", "object"]},
        {"ticker": "E"},
    )
    out = flatten.flatten_section(docs, "management", schemas.MANAGEMENT_SECTION)
    assert out.columns == ["ticker", "company_name", "ceo_name", "insider_ownership_pct", "institutional_ownership_pct",
                           "Seats", "seats_2"]
    rows = {r.ticker: tuple(r)[1:] for r in out.collect()}
    assert rows == {
        "A": ("In", "Ada", None, None, None, 9), "B": (None, None, 0.25, None, None, None),
        "C2": ("Out", None, None, None, [1, 2], None), "D": ("Out", None, None, None, None, None),
        "E": ("", None, None, None, None, None),
    }


def test_undeclared_keys_have_the_type_of_their_values(spark):
    docs = landed(
        spark,
        {"ticker": "A", "management": {"n": 1, "x": 1, "mixed": 1, "o": {"c": [1, 2.5], "VARIANT": "v"}, "odd `key`": True,
                                       "none": None, "empty": {}, "insider_ownership_pct": 3, "OBJECT": 2}},
        {"ticker": "B", "management": {"n": 2**40, "x": 2.5, "mixed": "t", "o": {"d": {"e": "f"}}, "odd `key`": False}},
        '{"ticker": "C", "management": {"x": NaN, "mixed": [1, {"a": "b: NaN,"}], "n": -Infinity}}',
        '{"ticker": "D", "management": {"n": 1, "n": 2}}',
    )
    out = flatten.flatten_section(docs, "management", schemas.MANAGEMENT_SECTION)
    kinds = dict(out.dtypes)
    assert (kinds["n"], kinds["x"], kinds["mixed"], kinds["odd `key`"], kinds["none"], kinds["empty"], kinds["OBJECT"]) == (
        "bigint", "double", "string", "boolean", "string", "string", "bigint")
    assert kinds["o"] == "struct<VARIANT:string,c:array<double>,d:struct<e:string>>"
    rows = {r.ticker: r.asDict(recursive=True) for r in out.collect()}
    assert set(rows) == {"A", "B", "C"}  # a repeated key is malformed
    assert rows["A"]["o"] == {"VARIANT": "v", "c": [1.0, 2.5], "d": None} and rows["A"]["mixed"] == "1"
    assert (rows["B"]["n"], rows["B"]["x"], rows["B"]["o"]["d"]) == (2**40, 2.5, {"e": "f"})
    assert (rows["C"]["x"], rows["C"]["n"]) == (None, None)
    assert rows["A"]["insider_ownership_pct"] == 3.0 and rows["A"]["empty"] == "{}"


def test_a_section_of_ten_thousand_keys_loads(spark):
    docs = landed(spark, {"ticker": "A", "management": {f"k{n}": n for n in range(10_000)}},
                  {"ticker": "B", "management": {"k9999": 1.5, "k3": "t"}})
    out = flatten.flatten_section(docs, "management", schemas.MANAGEMENT_SECTION)
    assert len(out.columns) == 10_000 + 5
    some = {r.ticker: tuple(r)[1:] for r in out.select("ticker", "k0", "k3", "k9999").collect()}
    assert some == {"A": (0, "3", 9999.0), "B": (None, "t", 1.5)}


def test_rejected_documents_are_kept_with_their_reason(spark):
    docs = landed(spark, {"ticker": "A", "overview": {"sector": "s"}}, "", " ", None, "[]", "17", '{"ticker": "Q", "overview": {',
                  {"ticker": "B"})
    seen = Observation("split")
    good, bad = flatten.split_reports(docs, "overview", schemas.OVERVIEW_SECTION, seen)
    assert sorted(r.ticker for r in flatten.overview_rows(good).collect()) == ["A", "B"]
    want = [("overview", None, "blank", ""), ("overview", None, "blank", " "), ("overview", None, "blank", None),
            ("overview", None, "no JSON object", "[]"), ("overview", None, "no JSON object", "17"),
            ("overview", "Q", "broken JSON", '{"ticker": "Q", "overview": {')]
    assert sorted(map(tuple, bad.collect()), key=str) == sorted(want, key=str)
    assert seen.get["documents"] == 8 and seen.get["malformed"] == 6
    sections, keys, rejected = flatten.split_section(docs, "overview")
    assert sorted(map(tuple, rejected.collect()), key=str) == sorted(want, key=str) and keys.fieldNames() == ["sector"]


def test_price_pages(spark):
    pages = spark.createDataFrame(
        [("KELP", '[{"date":"2011-04-29","close":2.5,"volume":10},{"date":"2011-05-27","close":"3"},null]'),
         ("SAND", ' {"date":"2011-04-29","close":7,"ticker":"ELSE"}'), ("SAND", "[]"), ("SAND", "[{"), ("SAND", ""), ("SAND", None),
         ("SAND", "{bad")],
        "ticker string, value string",
    )
    seen = Observation("pages")
    out = flatten.flatten_prices(pages, observation=seen)
    assert out.columns == ["ticker", "date", "close", "volume"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == [
        ("KELP", "2011-04-29", 2.5, 10), ("KELP", "2011-05-27", 3.0, None), ("SAND", "2011-04-29", 7.0, None)]
    assert seen.get == {"documents": 7, "malformed": 4}


def test_universe_pages_beyond_an_int(spark):
    far = 2**31
    pages = spark.createDataFrame(
        [(0, json.dumps({"results": [{"symbol": " kelp.jk "}, {"symbol": ".JK"}]})),
         (far, json.dumps({"results": [{"symbol": "Sand"}], "pagination": {"has_next": False, "total_count": far + 1}}))],
        "offset long, value string",
    )
    out = flatten.company_universe(pages).orderBy("position").collect()
    assert [(r.position, r.ticker) for r in out] == [(0, "KELP"), (far, "SAND")]


def test_union_fills_missing_columns(spark):
    old = spark.createDataFrame([("P", 4.0, "note")], "ticker string, close double, remark string")
    new = spark.createDataFrame([("Q", 6.0)], "ticker string, close double")
    assert sorted(map(tuple, flatten.union_pages([old, new]).collect())) == [("P", 4.0, "note"), ("Q", 6.0, None)]
