"""Lake and warehouse invariants: reruns, empty reloads, upsert, view order."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.plans import calendar_dim, warehouse
from ledgerlens.sources import lake


def fin_rows(spark, n, run_date):
    rows = [(f"T{i:03d}", "2024", float(i), run_date) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, period string, revenue double, run_date string")


def test_has_data_missing_store(spark, scratch):
    assert lake.has_data(spark, scratch, "bronze", "financial_statements") is False


def test_write_partition_rerun_is_idempotent(spark, scratch):
    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    lake.write_partition(fin_rows(spark, 5, "2024-01-12"), scratch, "bronze", "fs", "2024-01-12")
    lake.write_partition(fin_rows(spark, 5, "2024-01-12"), scratch, "bronze", "fs", "2024-01-12")
    df = lake.read_domain(spark, scratch, "bronze", "fs")
    got = {r.run_date: r.n for r in df.groupBy("run_date").agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-05": 3, "2024-01-12": 5}
    assert lake.has_data(spark, scratch, "bronze", "fs") is True
    one = lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05")
    assert one.count() == 3
    assert all("run_date=2024-01-05" in f for f in one.inputFiles())


def test_empty_write_clears_partition(spark, scratch):
    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    lake.write_partition(fin_rows(spark, 0, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    assert lake.read_domain(spark, scratch, "bronze", "fs").count() == 0


def _fact(spark, run_date, rows):
    data = [
        (t, dt.date.fromisoformat(run_date), "2024", "Co", "S", roe, 0.1, 1.0, 0.1, 0.2, None, 10.0, 1.0, 10.0, c,
         "LOLOS" if c == 7 else "TIDAK")
        for t, roe, c in rows
    ]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FCT_SCREENING.fields[:-1])
    return spark.createDataFrame(data, schema)


def test_reload_fact_rerun_and_empty(spark, scratch):
    f1 = _fact(spark, "2024-01-05", [("A", 0.2, 7), ("B", 0.1, 3)])
    warehouse.reload_fact(f1, scratch, "2024-01-05")
    warehouse.reload_fact(f1, scratch, "2024-01-05")
    f2 = _fact(spark, "2024-01-12", [("A", 0.3, 7)])
    warehouse.reload_fact(f2, scratch, "2024-01-12")
    fact = warehouse.read_fact(spark, scratch)
    assert fact.count() == 3
    assert fact.groupBy("ticker", "run_date").count().where("count > 1").count() == 0
    warehouse.reload_fact(f2.where("false"), scratch, "2024-01-12")  # N6
    assert warehouse.fact_for_run(spark, scratch, "2024-01-12").count() == 0
    assert warehouse.fact_for_run(spark, scratch, "2024-01-05").count() == 2


def test_upsert_keeps_created_at(spark, scratch):
    p1 = spark.createDataFrame([("A", "Old", "S", "X", 1.0, "2001-01-01"), ("B", "Bee", "S", "X", 2.0, None)],
                               "ticker string, company_name string, sector string, sub_sector string, "
                               "market_cap double, listing_date string")
    warehouse.write_dim_company(spark, scratch, p1)
    first = {r.ticker: r for r in warehouse.read_dim_company(spark, scratch).collect()}
    p2 = spark.createDataFrame([("A", "New", "S", "X", 3.0, "2001-01-01"), ("C", "Cee", "S", "X", 4.0, None)],
                               p1.schema)
    warehouse.write_dim_company(spark, scratch, p2)
    after = {r.ticker: r for r in warehouse.read_dim_company(spark, scratch).collect()}
    assert set(after) == {"A", "B", "C"}
    assert (after["A"].company_name, after["A"].market_cap) == ("New", 3.0)
    assert after["A"].created_at == first["A"].created_at
    assert after["A"].updated_at >= first["A"].updated_at
    assert after["B"].updated_at == first["B"].updated_at
    assert after["A"].listing_date == dt.date(2001, 1, 1)


def test_latest_screening_order_nulls_first(spark, scratch):
    warehouse.reload_fact(_fact(spark, "2024-01-05", [("OLD", 0.9, 7)]), scratch, "2024-01-05")
    warehouse.reload_fact(
        _fact(spark, "2024-01-12", [("A", 0.2, 5), ("B", None, 5), ("C", 0.5, 5), ("D", 0.1, None)]),
        scratch, "2024-01-12")
    dim = spark.createDataFrame([(t, dt.date(2001, 1, 1)) for t in "ABCD"] + [("OLD", None)],
                                "ticker string, listing_date date")
    got = [r.ticker for r in warehouse.latest_screening(warehouse.read_fact(spark, scratch), dim).collect()]
    assert got == ["D", "B", "C", "A"]


def test_insert_ignore_no_duplicates(spark):
    b1 = spark.createDataFrame([("2024-01-01", "2024-01-10")], "start string, end string")
    b2 = spark.createDataFrame([("2024-01-05", "2024-01-20")], "start string, end string")
    out = calendar_dim.insert_ignore(calendar_dim.calendar(b1), calendar_dim.calendar(b2), ["run_date"])
    assert out.count() == 20 and out.select("run_date").distinct().count() == 20


def test_ensure_warehouse_is_idempotent(spark, scratch):
    first = {r.table: r.created for r in warehouse.ensure_warehouse(spark, scratch).collect()}
    again = {r.table: r.created for r in warehouse.ensure_warehouse(spark, scratch).collect()}
    assert all(first.values()) and not any(again.values())
    assert warehouse.read_fact(spark, scratch).count() == 0


def test_failed_write_keeps_the_published_partition(spark, scratch):
    import pytest

    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    bad = fin_rows(spark, 4, "2024-01-05").withColumn("revenue", F.col("ticker").cast("double"))  # ANSI error
    with pytest.raises(Exception):
        lake.write_partition(bad, scratch, "bronze", "fs", "2024-01-05")
    df = lake.read_domain(spark, scratch, "bronze", "fs")
    assert df.count() == 3
    assert df.select("run_date").distinct().collect()[0][0] == "2024-01-05"


def test_insert_ignore_rerun_is_idempotent(spark):
    b = spark.createDataFrame([("2024-01-01", "2024-01-10")], "start string, end string")
    once = calendar_dim.insert_ignore(calendar_dim.calendar(b), calendar_dim.calendar(b), ["run_date"])
    twice = calendar_dim.insert_ignore(once, calendar_dim.calendar(b), ["run_date"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_no_nan_in_gold_and_one_row_per_key(spark):
    import math

    import __spark_entry__ as entry

    fact = entry.entry(spark)
    assert fact.groupBy("ticker", "run_date").count().where("count > 1").count() == 0
    doubles = [c for c, t in fact.dtypes if t == "double"]
    assert fact.where(" OR ".join(f"isnan({c})" for c in doubles)).count() == 0
    for r in fact.collect():
        assert r.criteria_passed is not None and 0 <= r.criteria_passed <= 7
        assert all(not (isinstance(r[c], float) and math.isnan(r[c])) for c in doubles)


def test_partitioned_write_replaces_only_present_partitions(spark, scratch):
    first = fin_rows(spark, 3, "2024-01-05").unionByName(fin_rows(spark, 2, "2024-01-12"))
    lake.write_partitioned(first, scratch, "bronze", "fs")
    lake.write_partitioned(fin_rows(spark, 4, "2024-01-12"), scratch, "bronze", "fs")
    got = {r.run_date: r.n for r in lake.read_domain(spark, scratch, "bronze", "fs")
           .groupBy("run_date").agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-05": 3, "2024-01-12": 4}


def test_backfill_domains_skips_a_failing_unit(spark, scratch):
    good = spark.createDataFrame(
        [("A", "2023", 1.0, "2024-01-05"), ("A", "2021", 1.0, "2024-01-05"), ("A", "2023", 2.0, "2023-01-05")],
        "ticker string, period string, revenue double, run_date string",
    )
    bad = good.withColumn("revenue", F.col("ticker").cast("double"))  # fails at run time (ANSI)
    status = lake.backfill_domains({"fs": good, "broken": bad, "vr": good}, scratch)
    assert status["fs"] == "ok" and status["vr"] == "ok" and status["broken"] != "ok"
    got = sorted((r.run_date, r.period) for r in lake.read_domain(spark, scratch, "bronze", "fs").collect())
    assert got == [("2023-01-05", "2023"), ("2024-01-05", "2023")]


COMPANY_SCHEMA = ("ticker string, company_name string, sector string, sub_sector string, market_cap double, "
                  "listing_date string")


def test_prune_is_by_age(spark, scratch):
    for i in range(5):
        lake.write_partition(fin_rows(spark, i + 1, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    folder = lake.partition_path(scratch, "bronze", "fs", "2024-01-05")
    oldest = lake.folder_names(spark, folder)[0]
    reader = spark.read.parquet(f"{folder}/{oldest}")
    assert lake.prune(spark, folder, dt.timedelta(hours=1)) == 0  # replaced just now: readers may be at work
    assert reader.count() == 1
    half = lake.stage(fin_rows(spark, 1, "2024-01-05").drop("run_date"), folder)  # a write that never ended
    assert lake.prune(spark, folder, dt.timedelta(0)) == 5
    assert lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05").count() == 5
    assert len(lake.folder_names(spark, folder)) == 1 and half.split("/")[-1] not in lake.folder_names(spark, folder)


def test_a_merge_rewrites_touched_buckets_only(spark, scratch):
    from ledgerlens.plans import dimension

    rows = [(f"T{k:03d}", f"Co {k}", "S", "X", float(k), "2001-01-01") for k in range(200)]
    assert warehouse.write_dim_company(spark, scratch, spark.createDataFrame(rows, COMPANY_SCHEMA)) == list(range(dimension.BUCKETS))
    before = set(warehouse.read_dim_company(spark, scratch).inputFiles())
    held = warehouse.read_dim_company(spark, scratch)
    new = [("T003", "New", "S", "X", 0.5, None), ("ZZZ", "Zed", "S", "X", 1.0, None)]
    touched = warehouse.write_dim_company(spark, scratch, spark.createDataFrame(new, COMPANY_SCHEMA))
    after = set(warehouse.read_dim_company(spark, scratch).inputFiles())
    assert 1 <= len(touched) <= 2 and before != after
    for f in before ^ after:
        assert int(f.split("bucket=")[1].split("/")[0]) in touched
    got = {r.ticker: r for r in warehouse.read_dim_company(spark, scratch).collect()}
    assert len(got) == 201 and got["T003"].company_name == "New" and got["ZZZ"].market_cap == 1.0
    assert all(got[t].market_cap == m for t, _, _, _, m, _ in rows if t != "T003")
    assert held.where("ticker = 'T003'").first().company_name == "Co 3"  # a reader keeps what it has
    assert warehouse.write_dim_company(spark, scratch, spark.createDataFrame([], COMPANY_SCHEMA)) == []
    folder = warehouse.table_path(scratch, "dim_company")
    assert dimension.prune(spark, folder, dt.timedelta(hours=1)) == 0
    assert dimension.prune(spark, folder, dt.timedelta(0)) == 2  # the empty and the first manifest
    assert {r.ticker: r.market_cap for r in warehouse.read_dim_company(spark, scratch).collect()} == {t: r.market_cap for t, r in got.items()}


def test_writes_that_no_manifest_names_are_pruned(spark, scratch):
    from ledgerlens.plans import dimension

    p = spark.createDataFrame([("A", "Co", "S", "X", 1.0, None)], COMPANY_SCHEMA)
    for i in range(3):
        warehouse.write_dim_company(spark, scratch, p.withColumn("market_cap", F.lit(float(i))))
    folder = warehouse.table_path(scratch, "dim_company")
    assert dimension.prune(spark, folder, dt.timedelta(0)) == 3 + 2
    assert warehouse.read_dim_company(spark, scratch).first().market_cap == 2.0


def test_newest_profiles_is_what_two_merges_leave(spark):
    rows = [("A", "Zeta", 1.0, "2024-01-05"), ("A", "Alpha", 2.0, "2024-01-12"), ("B", "Bee", 3.0, "2024-01-05")]
    df = spark.createDataFrame(rows, "ticker string, company_name string, market_cap double, run_date string")
    assert sorted((r.ticker, r.company_name) for r in warehouse.newest_profiles(df).collect()) == [("A", "Alpha"), ("B", "Bee")]


def test_calendar_merges_one_at_a_time(spark, scratch):
    import pytest

    days = calendar_dim.calendar(spark.createDataFrame([("2024-01-01", "2024-01-10")], "start string, end string"))
    assert warehouse.write_dim_date(spark, scratch, days).count() == 10
    current = lake.current_version(spark, warehouse.table_path(scratch, "dim_date"))
    unlock = warehouse._lock(spark, current, warehouse.MERGE_LIMIT)
    with pytest.raises(warehouse.ConcurrentMerge):
        warehouse.write_dim_date(spark, scratch, days)
    unlock()
    more = calendar_dim.calendar(spark.createDataFrame([("2024-01-08", "2024-01-12")], "start string, end string"))
    assert warehouse.write_dim_date(spark, scratch, more).count() == 12


def test_upsert_with_duplicate_incoming_keys(spark, scratch):
    p = spark.createDataFrame([("A", "Co", "S", "X", 1.0, None), ("A", "Co", "S", "X", 5.0, None)],
                              "ticker string, company_name string, sector string, sub_sector string, "
                              "market_cap double, listing_date string")
    warehouse.write_dim_company(spark, scratch, p)
    rows = warehouse.read_dim_company(spark, scratch).collect()
    assert len(rows) == 1 and rows[0].market_cap == 5.0


def _rows(spark, scratch):
    return sorted((r.run_date, r.ticker) for r in lake.read_domain(spark, scratch, "bronze", "fs").collect())


def test_readers_see_the_old_rows_until_a_write_is_published(spark, scratch):
    """A complete but unpublished version (a gate at work, or a driver that
    died before publishing) changes nothing for any reader."""
    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    before = _rows(spark, scratch)
    folder = lake.partition_path(scratch, "bronze", "fs", "2024-01-05")
    staged = lake.stage(fin_rows(spark, 5, "2024-01-05").drop("run_date"), folder)
    assert _rows(spark, scratch) == before
    assert lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05").count() == 3
    lake.publish(spark, staged)
    assert lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05").count() == 5


def test_a_crash_between_write_and_publish_keeps_the_old_rows(spark, scratch, monkeypatch):
    import pytest

    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    before = _rows(spark, scratch)

    def crash(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(lake, "publish", crash)
    for write in (
        lambda: lake.write_partition(fin_rows(spark, 5, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05"),
        lambda: lake.write_partitioned(fin_rows(spark, 5, "2024-01-05"), scratch, "bronze", "fs"),
    ):
        with pytest.raises(OSError):
            write()
        assert _rows(spark, scratch) == before


def test_a_reader_keeps_its_version_while_it_is_replaced(spark, scratch):
    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    reader = lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05")
    lake.write_partition(fin_rows(spark, 9, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    assert reader.count() == 3


def test_missing_run_date_is_an_error(spark, scratch):
    import pytest

    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    with pytest.raises(lake.MissingPartition):
        lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-12")
    with pytest.raises(lake.MissingPartition):
        lake.read_domain(spark, scratch, "bronze", "never")


def test_empty_write_of_prices_publishes_nothing(spark, scratch):
    rows = fin_rows(spark, 2, "2024-01-05")
    assert lake.write_nonempty_partition(rows.where("false"), scratch, "bronze", "p", "2024-01-05") is False
    assert not lake.has_data(spark, scratch, "bronze", "p")
    assert lake.write_nonempty_partition(rows, scratch, "bronze", "p", "2024-01-05") is True
    assert lake.run_dates(spark, scratch, "bronze", "p") == ["2024-01-05"]


def test_newest_fact_opens_one_run_date(spark, scratch):
    for d in ("2024-01-05", "2024-01-12", "2024-01-19"):
        warehouse.reload_fact(_fact(spark, d, [("A", 0.2, 7)]), scratch, d)
    latest = warehouse.newest_fact(spark, scratch)
    assert [f for f in latest.inputFiles() if "2024-01-19" not in f] == []
    assert [str(r.run_date) for r in latest.collect()] == ["2024-01-19"]
    plan = warehouse.latest_screening_of(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "2024-01-12" not in plan


def test_two_merges_of_one_version_do_not_lose_one(spark, scratch):
    import pytest

    p = spark.createDataFrame([("A", "Co", "S", "X", 1.0, None)],
                              "ticker string, company_name string, sector string, sub_sector string, "
                              "market_cap double, listing_date string")
    warehouse.write_dim_company(spark, scratch, p)
    current = lake.current_version(spark, warehouse.table_path(scratch, "dim_company"))
    unlock = warehouse._lock(spark, current, warehouse.MERGE_LIMIT)  # another run is at work
    with pytest.raises(warehouse.ConcurrentMerge):
        warehouse.write_dim_company(spark, scratch, p)
    warehouse.write_dim_company(spark, scratch, p.withColumn("market_cap", F.lit(2.0)), dt.timedelta(seconds=-1))
    unlock()
    assert warehouse.read_dim_company(spark, scratch).first().market_cap == 2.0


def test_backfill_of_a_domain_without_periods(spark, scratch):
    prof = spark.createDataFrame([("A", "Co", "2024-01-05"), ("A", "Co", "2023-01-05")],
                                 "ticker string, company_name string, run_date string")
    assert lake.backfill_domains({"company_profile": prof}, scratch) == {"company_profile": "ok"}
    assert lake.run_dates(spark, scratch, "bronze", "company_profile") == ["2023-01-05", "2024-01-05"]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    import pytest

    from ledgerlens import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[3,2,1]")


def test_the_version_published_last_is_read(spark, scratch):
    """Whichever write began first, and whatever the drivers' clocks say."""
    folder = lake.partition_path(scratch, "bronze", "fs", "2024-01-05")
    began_first = lake.stage(fin_rows(spark, 5, "2024-01-05").drop("run_date"), folder)
    lake.write_partition(fin_rows(spark, 7, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    lake.publish(spark, began_first)
    assert lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05").count() == 5
    lake.write_partition(fin_rows(spark, 2, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    assert lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05").count() == 2


def test_prune_counts_from_the_publication_of_the_replacement(spark, scratch):
    """A write longer than the age does not doom the version it replaces."""
    lake.write_partition(fin_rows(spark, 3, "2024-01-05"), scratch, "bronze", "fs", "2024-01-05")
    folder = lake.partition_path(scratch, "bronze", "fs", "2024-01-05")
    reader = lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05")
    long_write = lake.version_path(folder, f"{1:020d}-abcdef01")  # began long ago
    fin_rows(spark, 4, "2024-01-05").drop("run_date").write.parquet(long_write)
    assert lake.prune(spark, folder, dt.timedelta(hours=1)) == 0  # it may still be at work
    lake.publish(spark, long_write)
    assert lake.prune(spark, folder, dt.timedelta(hours=1)) == 0
    assert reader.count() == 3
    assert lake.prune(spark, folder, dt.timedelta(0)) == 1
    assert lake.read_partition(spark, scratch, "bronze", "fs", "2024-01-05").count() == 4


def test_price_partitions_are_named_by_the_day(spark, scratch):
    from ledgerlens.plans import ingest

    texts = ["2001-01-26", "2001-01-26T00:00:00", "2001-1-26", "26 Jan 2001", "20010126", "1/26/2001", "2001/1/26", "January 26, 2001",
             "26-Jan-2001", " 2001-01-26 ", "n/a", None, "2001-01-27"]
    rows = spark.createDataFrame([(f"T{k}", t) for k, t in enumerate(texts)], "ticker string, date string")
    assert ingest.load_prices(spark, rows, scratch, "2001-02-02") == "full"
    assert [tuple(r) for r in ingest.price_partitions(spark, scratch).collect()] == [("2001-01-26", 10)]
    assert ingest.load_prices(spark, rows, scratch, "2001-01-26") == "incremental"
    assert [tuple(r) for r in ingest.price_partitions(spark, scratch).collect()] == [("2001-01-26", 10)]


def test_a_bad_run_date_leaves_the_others_loaded(spark, scratch):
    rows = spark.createDataFrame(
        [("A", "2023", "1.0", "2024-01-05"), ("B", "2023", "oops", "2023-06-05"), ("A", "2022", "2.0", "2023-01-05")],
        "ticker string, period string, revenue string, run_date string",
    ).withColumn("revenue", F.col("revenue").cast("double"))  # fails at run time for one date (ANSI)
    status = lake.backfill_domains({"fs": rows}, scratch)["fs"]
    assert status.startswith("2023-06-05: ") and "2024-01-05" not in status
    assert lake.run_dates(spark, scratch, "bronze", "fs") == ["2023-01-05", "2024-01-05"]


def test_catalog_views_follow_the_loads(spark, scratch):
    import uuid

    from ledgerlens.plans import catalog

    db = f"wh_{uuid.uuid4().hex[:8]}"
    catalog.publish_views(spark, scratch, db)
    assert spark.sql(f"SELECT * FROM {db}.v_latest_screening").count() == 0
    assert spark.table(f"{db}.fct_screening").schema.fieldNames() == schemas.FCT_SCREENING.fieldNames()
    people = spark.createDataFrame([(t, f"Co {t}", "S", "X", 1.0, "2001-01-01") for t in "ABCD"], COMPANY_SCHEMA)
    warehouse.write_dim_company(spark, scratch, people)
    warehouse.reload_fact(_fact(spark, "2024-01-05", [("A", 0.9, 7)]), scratch, "2024-01-05")
    catalog.publish_views(spark, scratch, db)
    assert [r.ticker for r in spark.sql(f"SELECT ticker FROM {db}.v_latest_screening").collect()] == ["A"]
    warehouse.reload_fact(
        _fact(spark, "2024-01-12", [("A", 0.2, 5), ("B", None, 5), ("C", 0.5, 5), ("D", 0.1, None)]), scratch, "2024-01-12")
    assert [r.ticker for r in spark.sql(f"SELECT ticker FROM {db}.v_latest_screening").collect()] == ["A"]  # until it is replaced
    catalog.publish_views(spark, scratch, db)
    latest = spark.sql(f"SELECT * FROM {db}.v_latest_screening")
    assert [r.ticker for r in latest.collect()] == ["D", "B", "C", "A"]
    assert {str(r.run_date) for r in latest.collect()} == {"2024-01-12"} and latest.first().listing_date == dt.date(2001, 1, 1)
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-05" not in plan
    rows = spark.sql(f"SELECT run_date, count(*) AS n FROM {db}.fct_screening GROUP BY run_date ORDER BY run_date").collect()
    assert [(str(r.run_date), r.n) for r in rows] == [("2024-01-05", 1), ("2024-01-12", 4)]
