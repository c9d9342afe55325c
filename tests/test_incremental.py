"""Work that grows with what changed: the screening and the quality suites."""

import random

import pytest

from ledgerlens import schemas
from ledgerlens.config import FINANCIALS, PROFILE, VALUATION
from ledgerlens.operators import clean, quality
from ledgerlens.plans import incremental, quality_state, screening, warehouse, weekly_run
from ledgerlens.sources import lake

D1, D2, D3 = "2024-01-05", "2024-01-12", "2024-01-19"


def silver(spark, companies, run_date):
    """ticker -> seed of its numbers."""
    fin, prof, val = [], [], []
    for ticker, seed in companies.items():
        rng = random.Random(f"{ticker}{seed}")
        for year in range(2015, 2015 + rng.randrange(1, 9)):
            fin.append((ticker, str(year), *[rng.choice([None, rng.uniform(-5, 50)]) for _ in range(9)], run_date))
            if rng.random() < 0.8:
                val.append((ticker, str(year), rng.uniform(1, 30), rng.uniform(0.2, 3), 10.0, None, run_date))
        prof.append((ticker, f"Co {ticker}", "S", "X", 1.0, None, run_date))
    return tuple(
        spark.createDataFrame(rows, s) for rows, s in
        ((fin, schemas.BRONZE_FINANCIALS), (prof, schemas.BRONZE_PROFILE), (val, schemas.BRONZE_VALUATION))
    )


def store(spark, root, frames, run_date):
    for domain, df in zip((FINANCIALS, PROFILE, VALUATION), frames):
        lake.write_partition(df, root, "silver", domain, run_date)


def facts(df):
    return sorted((tuple(r)[:16] for r in df.select(*schemas.SCREENING_COLUMNS).collect()), key=str)


def full(frames, run_date):
    fin, prof, val = frames
    return facts(screening.screening(fin, prof, val, run_date))


def test_only_changed_companies_are_computed(spark, scratch, monkeypatch):
    first = {f"T{k}": 0 for k in range(40)}
    second = {t: s for t, s in first.items() if t not in ("T1", "T2")} | {"T5": 1, "T6": 2, "NEW": 0}
    one, two = silver(spark, first, D1), silver(spark, second, D2)
    store(spark, scratch, one, D1)
    store(spark, scratch, two, D2)
    weekly_run.gold_step(spark, scratch, scratch, D1, previous="2000-01-07")  # nothing stored: all are computed
    assert facts(warehouse.fact_for_run(spark, scratch, D1)) == full(one, D1)

    computed = []
    plain = screening.screening

    def watched(fin, prof, val, *args, **kwargs):
        computed.append([{r.ticker for r in df.select("ticker").distinct().collect()} for df in (fin, prof, val)])
        return plain(fin, prof, val, *args, **kwargs)

    monkeypatch.setattr(incremental.screening, "screening", watched)
    total = weekly_run.gold_step(spark, scratch, scratch, D2, previous=D1).total
    monkeypatch.undo()
    ((fin, prof, val),) = computed
    assert fin == prof == {"T5", "T6", "NEW"} and val <= fin
    assert facts(warehouse.fact_for_run(spark, scratch, D2)) == full(two, D2) and total == len(full(two, D2))
    store(spark, scratch, silver(spark, second, D3), D3)  # nothing changed
    weekly_run.gold_step(spark, scratch, scratch, D3, previous=D2)
    assert [r[2:] for r in facts(warehouse.fact_for_run(spark, scratch, D3))] == [r[2:] for r in full(two, D2)]


def test_digests_see_every_column_row_and_threshold(spark):
    fin, prof, val = silver(spark, {"A": 0, "B": 0, "C": 0}, D1)
    base = {r.ticker: r.digest for r in incremental.digests((fin, prof, val)).collect()}
    same = silver(spark, {"C": 0, "B": 0, "A": 0}, D2)  # the run date is not part of it
    assert {r.ticker: r.digest for r in incremental.digests([f.repartition(3) for f in same]).collect()} == base
    for n, changed in enumerate((fin.withColumn("eps", fin.eps + 1e-9), prof.withColumn("sector", prof.ticker), val.unionAll(val))):
        frames = [fin, prof, val]
        frames[n] = changed
        now = {r.ticker: r.digest for r in incremental.digests(frames).collect()}
        assert any(now[t] != base[t] for t in base)
    other = incremental.digests((fin, prof, val), {"roe": (">=", 0.2)})
    assert all(r.digest != base[r.ticker] for r in other.collect())


SUITE = (
    {"rule": "columns_present", "columns": ("ticker", "x")},
    {"rule": "row_count_between", "min": 3, "max": 7},
    {"rule": "not_null", "column": "x", "mostly": 0.5},
    {"rule": "between", "column": "x", "min": 0, "mostly": 0.7},
    {"rule": "unique_combination", "columns": ("ticker", "run_date")},
    {"rule": "unique_combination", "columns": ("ticker", "x")},
    {"rule": "unknown", "column": "x"},
)
SCHEMA = "ticker string, x double, run_date string"


def report(df):
    return sorted(map(tuple, df.collect()))


def test_merged_states_equal_a_suite_over_all_rows(spark, scratch):
    nan = float("nan")
    days = {
        D1: [("A", 1.0), ("B", -1.0), (None, None)], D2: [("A", 1.0), ("A", 2.0), (None, nan)], D3: [],
    }
    typed = spark.createDataFrame([], SCHEMA).schema
    rows = []
    for d, some in days.items():
        part = [(t, x, d) for t, x in some]
        rows += part
        lake.write_partition(spark.createDataFrame(part, typed), scratch, "gold", "f", d)
        assert quality_state.refresh(spark, scratch, "gold", "f", SUITE, typed) == [d]
        want = quality.run_suite(spark.createDataFrame(rows, typed), SUITE)
        assert report(quality_state.report(spark, scratch, "gold", "f", SUITE, typed)) == report(want)
    assert quality_state.refresh(spark, scratch, "gold", "f", SUITE, typed) == []
    lake.write_partition(spark.createDataFrame([("A", 9.0, D2)], typed), scratch, "gold", "f", D2)  # loaded again
    assert quality_state.refresh(spark, scratch, "gold", "f", SUITE, typed) == [D2]
    assert quality_state.refresh(spark, scratch, "gold", "f", SUITE[:3], typed) == [D1, D2, D3]  # other rules


@pytest.mark.parametrize("rows", [[], [("A", 1.0, D1)]])
def test_small_domains(spark, scratch, rows):
    typed = spark.createDataFrame([], SCHEMA).schema
    lake.write_partition(spark.createDataFrame(rows, typed), scratch, "gold", "f", D1)
    want = quality.run_suite(spark.createDataFrame(rows, typed), SUITE)
    assert report(quality_state.report(spark, scratch, "gold", "f", SUITE, typed)) == report(want)


def test_summaries_hold_the_run_and_sector_summaries(spark):
    fin, prof, val = silver(spark, {f"T{k}": k for k in range(30)}, D1)
    fact = screening.screening(fin, prof, val, D1).withColumn("sector", clean.F.substring("ticker", 2, 1))
    got = [r.asDict() for r in warehouse.summaries(fact).collect()]
    run = warehouse.run_summary(fact).first().asDict()
    assert [{k: r[k] for k in run} for r in got if r["level"] == "run"] == [run]
    sectors = sorted((tuple(r) for r in warehouse.sector_summary(fact).collect()))
    assert sorted((r["sector"], r["total"], r["passed"], r["not_passed"]) for r in got if r["level"] == "sector") == sectors
    assert sum(r["total"] for r in got if r["level"] == "status") == run["total"]
    assert warehouse.summaries(fact)._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1
