"""The weekly tasks through the command line, on landed sf0.001 documents."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlens import cli
from ledgerlens.config import RUN_DATE
from ledgerlens.operators import quality
from ledgerlens.plans import warehouse
from ledgerlens.sources import fixtures as fx
from ledgerlens.sources import lake, raw

SF = "/root/testdata/sf0.001"


def test_weekly_tasks(spark, scratch, capsys):
    landing, lake_root, wh = f"{scratch}/landing", f"{scratch}/lake", f"{scratch}/wh"
    for section, docs in (
        ("overview", fx.overview_documents(spark, SF)),
        ("financials", fx.financial_documents(spark, SF)),
        ("valuation", fx.valuation_documents(spark, SF)),
    ):
        raw.land(docs, f"{landing}/{section}/run_date={RUN_DATE}")
    raw.land_keyed(fx.price_pages(spark, SF), f"{landing}/prices")
    raw.land(fx.management_documents(spark, SF), f"{landing}/management/run_date={RUN_DATE}")

    keys = [r.c_custkey for r in spark.read.parquet(f"{SF}/customer.parquet").collect()]
    junk = sum((k % fx.BLANK_LINE_EVERY == 0) + (k % fx.BROKEN_EVERY == 0) for k in keys)
    assert junk > 0

    def run(*args):
        assert cli.main(list(args)) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert run("land", "--landing", landing, "--lake", lake_root, "--run-date", RUN_DATE)["skipped"] == {
        "overview": junk, "financials": junk, "valuation": junk}
    assert lake.has_data(spark, lake_root, "bronze", "financial_statements")
    assert run("land", "--landing", landing, "--lake", lake_root, "--run-date", RUN_DATE,
               "--sections", "management")["skipped"] == {"management": 0}
    mgmt = lake.read_partition(spark, lake_root, "bronze", "management_info", RUN_DATE)
    assert mgmt.count() == 150 and "ceo_name" in mgmt.columns
    created = run("init", "--warehouse", wh)
    assert {t["table"] for t in created} >= {"dim_company", "fct_screening", "dim_date"}
    summary = run("week", "--lake", lake_root, "--warehouse", wh, "--run-date", RUN_DATE, "--no-enforce")
    with pytest.raises(quality.QualityError):  # the default bounds fit 50 to 500 rows
        cli.main(["week", "--lake", lake_root, "--warehouse", wh, "--run-date", RUN_DATE, "--min-rows", "100000"])
    assert summary["total"] == warehouse.fact_for_run(spark, wh, RUN_DATE).count() > 0
    assert summary["total"] == summary["passed"] + summary["not_passed"]
    assert run("calendar", "--warehouse", wh, "--start", "2024-01-01", "--end", "2024-01-31")["dim_date"] == 31
    assert run("calendar", "--warehouse", wh, "--start", "2024-01-15", "--end", "2024-02-29")["dim_date"] == 60
    assert run("calendar", "--warehouse", wh)["dim_date"] == 2557  # 2024-01-01 .. 2030-12-31
    assert run("prices", "--pages", f"{landing}/prices", "--lake", lake_root, "--run-date", "2000-12-29")["load"] == "full"
    assert run("prices", "--pages", f"{landing}/prices", "--lake", lake_root, "--run-date", "2001-02-02")["load"] == "skipped"


def test_backfill_loads_what_it_can_and_tells(spark, scratch, capsys):
    landing, lake_root = f"{scratch}/landing", f"{scratch}/lake"
    raw.land(fx.overview_documents(spark, SF), f"{landing}/overview/run_date={RUN_DATE}")
    raw.land(fx.financial_documents(spark, SF), f"{landing}/financials/run_date={RUN_DATE}")
    args = ["backfill", "--landing", landing, "--lake", lake_root, "--run-date", RUN_DATE]
    assert cli.main(args) == 1  # no valuation has landed
    status = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [d for d, x in sorted(status.items()) if x == "ok"] == ["company_profile", "financial_statements"]
    raw.land(fx.valuation_documents(spark, SF), f"{landing}/valuation/run_date={RUN_DATE}")
    assert cli.main(args) == 0
    for domain in ("company_profile", "financial_statements", "valuation_ratios"):
        assert lake.run_dates(spark, lake_root, "bronze", domain) == ["2000-12-28", "2001-12-28"]
    fin = lake.read_domain(spark, lake_root, "bronze", "financial_statements")
    assert {(r.run_date, min(r.p)) for r in fin.groupBy("run_date").agg(F.collect_set("period").alias("p")).collect()} == {
        ("2000-12-28", "1999"), ("2001-12-28", "2000")}
    capsys.readouterr()
    assert cli.main(["prune", "--lake", lake_root, "--warehouse", f"{scratch}/wh", "--hours", "0"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["removed"] == 4  # replaced by the second run
