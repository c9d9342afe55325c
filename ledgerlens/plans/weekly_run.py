"""One weekly run through the lake and the warehouse, step by step:

landed reports -> bronze (``bronze_from_landing``); bronze gate, then the
silver jobs of the run date; gold screening read back from silver (that run
date's folders only); dim_company upsert and fact reload with the run summary
observed on the load; gold gate.

Each step is a Spark job over stored tables, so a failed step is rerun on
its own and a rerun of the whole week rewrites the same partitions.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.config import (
    CUTOFF_YEARS_BACK, DIVIDENDS, FINANCIALS, MANAGEMENT, PROFILE, VALUATION,
)
from ledgerlens.operators import clean, flatten, quality
from ledgerlens.plans import incremental, screening, warehouse
from ledgerlens.session import concurrently, materialize
from ledgerlens.sources import lake, raw

SILVER_SCHEMAS = {
    FINANCIALS: schemas.BRONZE_FINANCIALS,
    PROFILE: schemas.BRONZE_PROFILE,
    VALUATION: schemas.BRONZE_VALUATION,
}


log = logging.getLogger(__name__)
QUARANTINE = "quarantine"


@dataclass
class WeekResult:
    """Rule-sized results of one week (a few rows each)."""

    bronze_gate: list[Row]
    gold_gate: list[Row]
    summary: Row
    company_gate: list[Row]


# landed section -> bronze domain (the three scheduled ones first)
LANDED_SECTIONS = {"overview": PROFILE, "financials": FINANCIALS, "valuation": VALUATION}
# sections that are mapped but not scheduled: flattened generically
GENERIC_SECTIONS = {"dividend": DIVIDENDS, "management": MANAGEMENT}


def bronze_from_landing(
    spark: SparkSession, landing_root: str, root: str, run_date: str,
    years_back: int = CUTOFF_YEARS_BACK, sections: tuple[str, ...] = tuple(LANDED_SECTIONS),
) -> dict[str, int]:
    """The extract step after the fetch: landed report documents of one
    run date (``<landing_root>/<section>/run_date=<d>/``, JSON text) are
    parsed once and split: good reports are flattened and written as that run
    date's bronze partition of each domain, malformed documents go to the
    domain's partition of the ``quarantine`` layer with the reason, are
    counted (returned per section) and stop nothing."""
    skipped = {}
    for section in sections:
        domain = LANDED_SECTIONS.get(section) or GENERIC_SECTIONS[section]
        docs = raw.read_landed(spark, f"{landing_root.rstrip('/')}/{section}/run_date={run_date}")
        seen = Observation(f"landed_{section}_{uuid.uuid4().hex}")
        if section in GENERIC_SECTIONS:
            reports, keys, rejected = flatten.split_section(docs, section, seen)
            rows = flatten.section_rows(reports, keys, schemas.GENERIC_SECTIONS[section])
        else:
            reports, rejected = flatten.split_reports(docs, section, schemas.SCHEDULED_SECTIONS[section], seen)
            rows = flatten.report_rows(section, reports, run_date, years_back)
        concurrently(
            partial(lake.write_partition, rows, root, "bronze", domain, run_date),
            partial(lake.write_partition, rejected, root, QUARANTINE, domain, run_date),
        )
        skipped[section] = int(seen.get.get("malformed") or 0)
        if skipped[section]:
            log.warning("skipped %d malformed %s reports for %s", skipped[section], section, run_date)
    return skipped


def quarantined(spark: SparkSession, root: str, run_date: str, sections: Sequence[str] = tuple(LANDED_SECTIONS)) -> DataFrame:
    """The rejected documents of a run date: section, ticker, reason, document."""
    domains = [LANDED_SECTIONS.get(s) or GENERIC_SECTIONS[s] for s in sections]
    parts = [lake.read_partition(spark, root, QUARANTINE, d, run_date, schemas.REJECTED) for d in domains]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def backfill_from_landing(
    spark: SparkSession, landing_root: str, root: str, run_date: str, years: int = 2,
    years_back: int = CUTOFF_YEARS_BACK,
) -> dict[str, str]:
    """S13 from the landed reports of one run date: the three scheduled
    domains, each for that day of ``years`` years, one job per domain. A
    domain that fails is reported, the others still load."""
    dates = lake.backfill_run_dates(run_date, years)
    reach = years_back + years - 1  # the oldest run date's cutoff

    def rows(section: str) -> DataFrame:
        docs = raw.read_landed(spark, f"{landing_root.rstrip('/')}/{section}/run_date={run_date}")
        if section == "overview":
            flat = flatten.flatten_overview(docs)
        elif section == "financials":
            flat = flatten.flatten_financials(docs, run_date, reach)
        else:
            flat = flatten.flatten_valuation(docs, run_date, reach)
        return flat.select("*", F.explode(F.array(*[F.lit(d) for d in dates])).alias("run_date"))

    status = {}
    for section, domain in LANDED_SECTIONS.items():
        try:
            frame = rows(section)
        except Exception as exc:  # noqa: BLE001 - nothing landed for this section
            status[domain] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}"
            continue
        status |= lake.backfill_domains({domain: frame}, root, "bronze", years_back)
    return status


def bronze_gate(
    spark: SparkSession, root: str, run_date: str, suite: Sequence[quality.Rule] = quality.BRONZE_SUITE
) -> DataFrame:
    """The bronze suite: one aggregate over the few columns its rules name."""
    fin = lake.read_partition(spark, root, "bronze", FINANCIALS, run_date, SILVER_SCHEMAS[FINANCIALS])
    return quality.run_suite(fin, suite)


def silver_step(
    spark: SparkSession, root: str, run_date: str, enforce_gate: bool = True,
    suite: Sequence[quality.Rule] = quality.BRONZE_SUITE,
) -> list[Row]:
    """C1-C3 on one run date of bronze, each written to its silver partition.

    All three bronze domains must have the run date, and the bronze gate
    must pass (unless it is not enforced), before any silver partition
    changes. The gate is a job of its own, so its counts are exact whatever
    tasks are repeated; the silver versions are written meanwhile and
    published together when it has passed. Returns the gate's report rows.
    """
    bronze = {
        d: lake.read_partition(spark, root, "bronze", d, run_date, SILVER_SCHEMAS[d])
        for d in (FINANCIALS, PROFILE, VALUATION)
    }
    label = f"bronze/{FINANCIALS}/{run_date}"
    jobs = {FINANCIALS: clean.clean_financials, PROFILE: clean.clean_profile, VALUATION: clean.clean_valuation}
    staged: list[str] = []

    def silver(domain: str) -> None:
        rows = jobs[domain](bronze[domain]).drop("run_date")
        staged.append(lake.stage(rows, lake.partition_path(root, "silver", domain, run_date)))

    try:
        gate, *_ = concurrently(
            lambda: bronze_gate(spark, root, run_date, suite).orderBy("rule_id").collect(),
            *[partial(silver, d) for d in jobs],
        )
        _log_gate(gate, label, len(SILVER_SCHEMAS[FINANCIALS].fields))
        if enforce_gate:
            quality.enforce_rows(gate, label)
    except Exception:
        for path in staged:
            lake.discard(spark, path)
        raise
    for path in staged:
        lake.publish(spark, path)
    return gate


def gold_step(
    spark: SparkSession, root: str, wh_root: str, run_date: str, previous: str | None = None
) -> Row:
    """K4: silver (one partition each) -> scored fact; S9 then S10.
    Returns the run summary (A2), observed while the fact is loaded.

    With ``previous``, an earlier run date whose fact and state are stored,
    only companies whose silver rows differ from that run's are computed;
    the others' fact rows are copied (``plans.incremental``)."""
    fin, prof, val = (
        lake.read_partition(spark, root, "silver", d, run_date, SILVER_SCHEMAS[d])
        for d in (FINANCIALS, PROFILE, VALUATION)
    )
    companies = materialize(clean.unique_profile(prof), "companies")  # used twice
    seen = Observation(f"summary_{uuid.uuid4().hex}")
    if previous is None:
        fact = screening.screening(fin, companies, val, run_date, profile_is_unique=True)
    else:
        fact = incremental.screening_since(spark, root, wh_root, run_date, previous, fin, companies, val)
    concurrently(
        lambda: warehouse.write_dim_company(spark, wh_root, companies, stored=True),
        lambda: warehouse.reload_fact(fact, wh_root, run_date, seen),
    )
    total, passed = int(seen.get.get("total") or 0), int(seen.get.get("passed") or 0)
    return Row(total=total, passed=passed, not_passed=total - passed)


def run_week(
    spark: SparkSession, root: str, wh_root: str, run_date: str, enforce_gates: bool = True,
    bronze_suite: Sequence[quality.Rule] = quality.BRONZE_SUITE,
    gold_suite: Sequence[quality.Rule] = quality.GOLD_SUITE, previous: str | None = None,
) -> WeekResult:
    """The week after bronze has landed. With ``enforce_gates`` a failed
    suite stops the run with one error listing every failed rule. The
    suites are parameters: their default bounds fit a small universe. With
    ``previous`` gold computes what changed since that run date only."""
    gate_b = silver_step(spark, root, run_date, enforce_gates, bronze_suite)
    summary = gold_step(spark, root, wh_root, run_date, previous)
    checks = (
        (f"gold/{warehouse.FACT}/{run_date}", warehouse.fact_for_run(spark, wh_root, run_date), gold_suite),
        ("gold/dim_company", warehouse.read_dim_company(spark, wh_root), quality.DIM_COMPANY_SUITE),
    )
    gates = concurrently(*[
        lambda df=df, suite=suite: quality.run_suite(df, suite).orderBy("rule_id").collect() for _, df, suite in checks
    ])
    for (label, df, _), rows in zip(checks, gates):
        _log_gate(rows, label, len(df.columns))
        if enforce_gates:
            quality.enforce_rows(rows, label)
    log.info("run %s: total=%s passed=%s not_passed=%s", run_date, *summary)
    return WeekResult(gate_b, gates[0], summary, gates[1])


def _log_gate(rows: list[Row], label: str, columns: int) -> None:
    failed = [r for r in rows if not r.success]
    counted = [r.checked for r in rows if r.rule == "row_count_between"]
    if counted:  # A7: row count (from the suite's own counts) and column count
        log.info("[%s] %d rows, %d columns", label, counted[0], columns)
    log.info("[%s] %d/%d rules passed", label, len(rows) - len(failed), len(rows))
