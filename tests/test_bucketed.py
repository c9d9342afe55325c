import pytest

from ledgerlens.config import FINANCIALS, PROFILE, RUN_DATE, VALUATION
from ledgerlens.plans import bucketed, screening

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return dict(zip((FINANCIALS, PROFILE, VALUATION), screening.silver_inputs(spark, SF, duplicates=True)))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_screening_in_place(spark, scratch, silver):
    """Window, de-duplications and joins need no exchange at all."""
    bucketed.publish_silver(spark, scratch, silver, buckets=4, database="bucketed_a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed.in_place(spark):
            out = bucketed.screening_of(spark, database="bucketed_a")
            plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[-1]
            assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 3
            got = rows(out)
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows(screening.screening(*silver.values())) and got


def test_one_file_a_bucket(spark, scratch, silver):
    bucketed.publish_silver(spark, scratch, {FINANCIALS: silver[FINANCIALS]}, buckets=3, database="bucketed_b")
    files = bucketed.silver_of(spark, FINANCIALS, database="bucketed_b").inputFiles()
    assert len(files) == 3


def test_a_rerun_replaces_and_a_failed_one_does_not(spark, scratch, silver):
    fin = {FINANCIALS: silver[FINANCIALS]}
    bucketed.publish_silver(spark, scratch, fin, buckets=2, database="bucketed_c")
    before = rows(bucketed.silver_of(spark, FINANCIALS, database="bucketed_c"))
    bucketed.publish_silver(spark, scratch, fin, buckets=2, database="bucketed_c")
    assert rows(bucketed.silver_of(spark, FINANCIALS, database="bucketed_c")) == before
    broken = {FINANCIALS: silver[FINANCIALS].selectExpr("*", "raise_error('broken') AS x")}
    with pytest.raises(Exception, match="broken"):
        bucketed.publish_silver(spark, scratch, broken, buckets=2, database="bucketed_c")
    assert rows(bucketed.silver_of(spark, FINANCIALS, database="bucketed_c")) == before


def test_a_run_date_without_rows(spark, scratch, silver):
    bucketed.publish_silver(spark, scratch, silver, run_date="1999-01-01", buckets=2, database="bucketed_d")
    assert bucketed.screening_of(spark, "1999-01-01", "bucketed_d").count() == 0
