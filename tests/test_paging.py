import random

import pytest

from ledgerlens.operators import flatten, paging

SIZE = 50


def companies(n):
    rng = random.Random(4)
    caps = [None, *[float(k) for k in range(40)]]  # many ties
    return [(f"T{k:05d}", rng.choice(["X", "Y", None]), rng.choice(caps)) for k in range(n)]


@pytest.fixture(scope="module")
def stored(spark):
    from ledgerlens.session import scratch_path

    df = spark.createDataFrame(companies(6000), "ticker string, sub_sector string, market_cap double").repartition(5)
    return df, paging.write_list(df, scratch_path(spark, "list"), SIZE)


def tickers(df):
    return [r.ticker for r in df.collect()]


def ordered(sub_sector):
    rows = [r for r in companies(6000) if r[1] == sub_sector]
    return [t for t, _, _ in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))]


def test_pages_equal_offset_and_scan_little(spark, stored):
    df, path = stored
    want = ordered("X")
    last = paging.last_page(spark, path, "X")
    assert last == (len(want) - 1) // SIZE
    for page in (0, last // 2, last, last + 1):
        got = paging.read_page(spark, path, "X", page, SIZE)
        assert tickers(got) == want[page * SIZE : (page + 1) * SIZE] == tickers(
            flatten.company_page(df, "X", page * SIZE, SIZE))


def test_a_page_is_a_bounded_scan(spark, stored):
    _, path = stored
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the scan's own metrics
    try:
        for page in (0, 20, 39):
            rows = paging.read_page(spark, path, "X", page, SIZE)
            assert len(rows.collect()) > 0
            scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
            assert scan.metrics().apply("numOutputRows").value() <= 10 * SIZE  # a few column pages, of 6000 rows
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reading_on_after_a_key_gives_the_whole_list(spark, stored):
    _, path = stored
    caps = {t: c for t, _, c in companies(6000)}
    want = ordered("Y")
    for at in (0, 49, 50, 777, len(want) - 30, len(want) - 1):
        got = paging.read_after(spark, path, "Y", caps[want[at]], want[at], SIZE)
        assert tickers(got) == want[at + 1 : at + 1 + SIZE]


def test_unknown_and_empty(spark, stored):
    from ledgerlens.session import scratch_path

    df, path = stored
    assert paging.last_page(spark, path, "none") is None
    assert tickers(paging.read_page(spark, path, "none", 0, SIZE)) == []
    empty = paging.write_list(df.limit(0), scratch_path(spark, "list"), SIZE)
    assert tickers(paging.read_page(spark, empty, "X", 0, SIZE)) == [] and paging.last_page(spark, empty, "X") is None
