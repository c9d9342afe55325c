"""Metric formulas on literal values (M1-M5), one case per formula."""

import math

from ledgerlens.operators import metrics

RD = "2024-12-27"
FIN = ("run_date string, ticker string, period string, revenue double, net_income double, "
       "total_equity double, total_debt double, operating_cash_flow double, capex double, eps double")


def fin(spark, *rows):
    return spark.createDataFrame([(RD, "T", *r) for r in rows], FIN)


def test_roe_and_der(spark):
    df = fin(spark, ("2024", 1000.0, 150.0, 1000.0, 400.0, 0.0, 0.0, 1.0),
             ("2023", 1000.0, 150.0, 0.0, 400.0, 0.0, 0.0, 1.0))
    roe = {r.period: r.roe for r in metrics.roe(df, RD).collect()}
    der = {r.period: r.der for r in metrics.der(df, RD).collect()}
    assert roe == {"2024": 0.15, "2023": None}          # zero equity -> NULL, not an error
    assert der == {"2024": 0.4, "2023": None}


def test_fcf_and_margin(spark):
    df = fin(spark, ("2024", 2000.0, 0.0, 1.0, 0.0, 500.0, 200.0, 1.0),
             ("2023", 0.0, 0.0, 1.0, 0.0, 500.0, 700.0, 1.0))
    got = {r.period: (r.fcf, r.fcf_margin) for r in metrics.fcf(df, RD).collect()}
    assert got == {"2024": (300.0, 0.15), "2023": (-200.0, None)}


def test_eps_growth_yoy_and_cagr(spark):
    eps = [1.0, 1.2, 1.4, 1.6, 1.8, 2.0]
    df = fin(spark, *[(str(2019 + i), 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, e) for i, e in enumerate(eps)])
    got = {r.period: (r.eps_growth_yoy, r.eps_cagr_5y) for r in metrics.eps_growth(df, RD).collect()}
    yoy, cagr = got["2024"]
    assert math.isclose(yoy, (2.0 - 1.8) / 1.8)
    assert math.isclose(cagr, round((2.0 / 1.0) ** 0.2 - 1, 9))
    assert got["2019"] == (None, None) and got["2023"][1] is None  # LAG 5 needs six periods


def test_eps_growth_against_negative_base(spark):
    df = fin(spark, ("2023", 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, -2.0), ("2024", 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 1.0))
    got = {r.period: r.eps_growth_yoy for r in metrics.eps_growth(df, RD).collect()}
    assert got["2024"] == (1.0 - (-2.0)) / 2.0            # divided by |previous eps|


def test_graham_combined(spark):
    val = spark.createDataFrame([(RD, "T", "2024", 14.0, 1.7, 100.0, 6.0)],
                                "run_date string, ticker string, period string, per double, pbv double, "
                                "price double, ev_ebitda double")
    r = metrics.valuation_metrics(val, RD).first()
    assert math.isclose(r.graham_combined, 23.8) and (r.price, r.ev_ebitda) == (100.0, 6.0)
