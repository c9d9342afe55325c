"""Scoring: every criterion around its bound, and the score against a
literal reading of the seven rules on random rows."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.config import STATUS_FAIL, STATUS_PASS
from ledgerlens.operators.scoring import criteria_flags, score

SCHEMA = "id int, roe double, der double, fcf double, eps_growth_yoy double, per double, pbv double"
FIELDS = ("roe", "der", "fcf", "eps_growth_yoy", "per", "pbv")
# per * pbv is far from its own bound here, so one field moves one flag.
SOUND = {"roe": 0.31, "der": 0.22, "fcf": 7.5e6, "eps_growth_yoy": 0.4, "per": 6.25, "pbv": 0.75}

# criterion, value just below the bound, at it, just above it -> flags
TABLE = [
    ("roe", (0.1499, 0.15, 0.1501), (0, 1, 1)),
    ("der", (0.4999, 0.5, 0.5001), (1, 1, 0)),
    ("fcf", (-1e-6, 0.0, 1e-6), (0, 0, 1)),
    ("eps_growth_yoy", (0.0999, 0.1, 0.1001), (0, 1, 1)),
    ("per", (14.999, 15.0, 15.001), (1, 1, 0)),
    ("pbv", (1.4999, 1.5, 1.5001), (1, 1, 0)),
]


def frame(spark, rows):
    return spark.createDataFrame([(k, *[r[f] for f in FIELDS]) for k, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("field, values, flags", TABLE, ids=[t[0] for t in TABLE])
def test_around_the_bound(spark, field, values, flags):
    rows = [{**SOUND, field: v} for v in values]
    out = criteria_flags(frame(spark, rows)).orderBy("id").collect()
    assert tuple(r[f"pass_{field}"] for r in out) == flags
    total = score(frame(spark, rows)).orderBy("id").collect()
    assert [r.criteria_passed for r in total] == [6 + x for x in flags]
    assert [r.status for r in total] == [STATUS_PASS if x else STATUS_FAIL for x in flags]


@pytest.mark.parametrize("per, pbv, flag", [(15.0, 1.5, 1), (18.0, 1.25, 1), (18.0, 1.2501, 0), (4.5, 5.0, 1), (-3.0, 2.0, 1)])
def test_product_of_the_two_ratios(spark, per, pbv, flag):
    out = criteria_flags(frame(spark, [{**SOUND, "per": per, "pbv": pbv}])).first()
    assert out.pass_graham_combined == flag


def test_the_stored_product_is_not_used(spark):
    from pyspark.sql import functions as F

    df = frame(spark, [SOUND]).withColumn("graham_combined", F.lit(1e9))
    assert score(df).first().criteria_passed == 7


@pytest.mark.parametrize("missing", [None, math.nan])
@pytest.mark.parametrize("field", FIELDS)
def test_a_missing_value_fails_its_criteria_only(spark, field, missing):
    out = score(frame(spark, [{**SOUND, field: missing}])).first()
    assert out.criteria_passed == (5 if field in ("per", "pbv") else 6) and out.status == STATUS_FAIL


def test_nothing_known(spark):
    out = score(frame(spark, [dict.fromkeys(FIELDS)])).first()
    assert (out.criteria_passed, out.status) == (0, STATUS_FAIL)


number = st.one_of(st.none(), st.just(math.nan), st.floats(-40, 40), st.sampled_from([0.15, 0.5, 0.0, 0.1, 15.0, 1.5]))


def literal(r):
    def known(*xs):
        return all(x is not None and not math.isnan(x) for x in xs)

    return sum((
        known(r["roe"]) and r["roe"] >= 0.15, known(r["der"]) and r["der"] <= 0.5, known(r["fcf"]) and r["fcf"] > 0,
        known(r["eps_growth_yoy"]) and r["eps_growth_yoy"] >= 0.1, known(r["per"]) and r["per"] <= 15,
        known(r["pbv"]) and r["pbv"] <= 1.5, known(r["per"], r["pbv"]) and r["per"] * r["pbv"] <= 22.5,
    ))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.fixed_dictionaries({f: number for f in FIELDS}), min_size=1, max_size=40))
def test_score_is_the_number_of_rules_met(spark, rows):
    out = score(frame(spark, rows)).orderBy("id").collect()
    assert [r.criteria_passed for r in out] == [literal(r) for r in rows]
    assert [r.status for r in out] == [STATUS_PASS if literal(r) == 7 else STATUS_FAIL for r in rows]
