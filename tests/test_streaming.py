import json

from ledgerlens.session import scratch_path
from ledgerlens.streaming import landing


def _doc(ticker, year):
    return json.dumps({"ticker": ticker, "financials": {"historical_financials": [
        {"year": year, "revenue": 1.0, "earnings": 2.0, "operating_cash_flow": 3.0, "free_cash_flow": 1.0,
         "eps": 0.5}]}})


def test_only_new_files_are_processed(spark):
    land = scratch_path(spark, "landing")
    root = scratch_path(spark, "lake")
    ckpt = scratch_path(spark, "ckpt")
    spark.createDataFrame([(_doc("AAA", 2024),), (_doc("BBB", 2024),)], "value string") \
        .write.mode("append").text(land)
    landing.ingest_financial_reports(spark, land, root, "2024-12-27", ckpt)
    assert landing.read_ingested(spark, root).count() == 2
    assert landing.ingest_financial_reports(spark, land, root, "2024-12-27", ckpt) == (0, 0)
    spark.createDataFrame([(_doc("CCC", 2024),), (_doc("DDD", 2020),)], "value string") \
        .write.mode("append").text(land)
    landing.ingest_financial_reports(spark, land, root, "2024-12-27", ckpt)
    rows = sorted((r.ticker, r.capex) for r in landing.read_ingested(spark, root).collect())
    assert rows == [("AAA", 2.0), ("BBB", 2.0), ("CCC", 2.0)]


def test_overview_reports_stream(spark):
    from ledgerlens.config import PROFILE

    land = scratch_path(spark, "landing")
    root = scratch_path(spark, "lake")
    docs = [json.dumps({"ticker": "AAA", "company_name": "A Co", "overview": {"sector": "S"}}),
            json.dumps({"ticker": "BBB"})]
    spark.createDataFrame([(d,) for d in docs], "value string").write.mode("append").text(land)
    assert landing.ingest_reports(spark, "overview", land, root, "2024-12-27", scratch_path(spark, "ck")) == (2, 0)
    rows = sorted((r.ticker, r.company_name, r.sector) for r in landing.read_ingested(spark, root, PROFILE).collect())
    assert rows == [("AAA", "A Co", "S"), ("BBB", "", None)]


def test_a_backlog_runs_in_bounded_batches_and_is_counted_whole(spark):
    land, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    for k in range(6):
        lines = [(_doc(f"T{k}{x}", 2024),) for x in "AB"] + [("{broken",), ("",)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(land)
    out = landing.ingest_reports(spark, "financials", land, root, "2024-12-27", scratch_path(spark, "ck"), files_per_batch=2)
    assert out == (24, 12)
    assert landing.read_ingested(spark, root).count() == 12


def test_a_replayed_batch_changes_nothing(spark):
    root, day = scratch_path(spark, "lake"), "2024-12-27"
    docs = spark.createDataFrame([(_doc("AAA", 2024),), ("{broken",), (_doc("BBB", 2024),)], "value string")
    assert landing.land_batch(docs, "s-0", "financials", root, day) == (3, 1)
    landing.publish_batches(spark, "financials", root, day)
    once = sorted(landing.read_ingested(spark, root).collect())
    landing.land_batch(docs, "s-0", "financials", root, day)  # after a crash before its commit
    landing.publish_batches(spark, "financials", root, day)
    assert sorted(landing.read_ingested(spark, root).collect()) == once and len(once) == 2


def test_silver_reads_what_the_stream_published(spark):
    from ledgerlens.config import FINANCIALS
    from ledgerlens.plans import weekly_run
    from ledgerlens.sources import lake

    root, day = scratch_path(spark, "lake"), "2024-12-27"
    for section, doc in (
        ("financials", _doc("aaa.jk", 2024)), ("overview", json.dumps({"ticker": "AAA", "overview": {"sector": "S"}})),
        ("valuation", json.dumps({"ticker": "AAA", "valuation": {"historical_valuation": [{"year": 2024, "pe": 5, "pb": 1}]}})),
    ):
        land = scratch_path(spark, "landing")
        spark.createDataFrame([(doc,), ("17",)], "value string").write.text(land)
        assert landing.ingest_reports(spark, section, land, root, day, scratch_path(spark, "ck")) == (2, 1)
    weekly_run.silver_step(spark, root, day, enforce_gate=False)
    silver = lake.read_partition(spark, root, "silver", FINANCIALS, day, weekly_run.SILVER_SCHEMAS[FINANCIALS])
    assert [(r.ticker, r.capex) for r in silver.collect()] == [("AAA", 2.0)]
    bad = weekly_run.quarantined(spark, root, day).collect()
    assert sorted((r.section, r.reason) for r in bad) == [
        ("financials", "no JSON object"), ("overview", "no JSON object"), ("valuation", "no JSON object")]
