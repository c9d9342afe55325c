"""Incremental ingestion of landed reports.

The weekly extract lands new report documents in a landing folder. Here that
step is a Structured Streaming query over the folder with an ``availableNow``
trigger: each run takes exactly the files landed since the previous run
(tracked in the query's checkpoint). ``foreachBatch`` splits a batch's
documents in one pass and writes its rows and its rejected documents to a
folder named by the batch, so a batch that is replayed after a crash replaces
what it wrote. When the batches of a run are done, the run date is published
from all its batches in ``bronze`` (and ``quarantine``), where the silver jobs
read it. Publishing again gives the same rows, so a run that died before it is
mended by the next one.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerlens import schemas
from ledgerlens.config import CUTOFF_YEARS_BACK, FINANCIALS, PROFILE, VALUATION
from ledgerlens.operators import flatten
from ledgerlens.session import concurrently
from ledgerlens.sources import lake

SECTION_DOMAINS = {"overview": PROFILE, "financials": FINANCIALS, "valuation": VALUATION}
BRONZE_SCHEMAS = {
    PROFILE: schemas.BRONZE_PROFILE, FINANCIALS: schemas.BRONZE_FINANCIALS, VALUATION: schemas.BRONZE_VALUATION,
}
# Files of one micro-batch: a backlog of any length runs in bounded steps.
FILES_PER_BATCH = 1000
BATCHES = "landed_batches"  # layer of the batches that run dates are published from


class Ingested(NamedTuple):
    """Documents a run read, and how many of them were no reports."""

    documents: int
    malformed: int


def batch_folder(root: str, layer: str, domain: str, run_date: str) -> str:
    return f"{lake.partition_path(root, BATCHES, domain, run_date)}/{layer}"


def land_batch(
    docs: DataFrame, batch: str, section: str, root: str, run_date: str, years_back: int = CUTOFF_YEARS_BACK
) -> Ingested:
    """Write the rows and the rejected documents of one batch of documents;
    the same batch again replaces them."""
    domain, seen = SECTION_DOMAINS[section], Observation(f"batch_{uuid.uuid4().hex}")
    reports, rejected = flatten.split_reports(docs, section, schemas.SCHEDULED_SECTIONS[section], seen)
    rows = flatten.report_rows(section, reports, run_date, years_back)
    concurrently(*[
        partial(df.write.mode("overwrite").parquet, f"{batch_folder(root, layer, domain, run_date)}/batch={batch}")
        for layer, df in (("bronze", rows), ("quarantine", rejected))
    ])
    return Ingested(int(seen.get.get("documents") or 0), int(seen.get.get("malformed") or 0))


def publish_batches(spark: SparkSession, section: str, root: str, run_date: str) -> None:
    """Publish a run date from all batches landed for it (none: nothing)."""
    domain = SECTION_DOMAINS[section]
    for layer, schema in (("bronze", BRONZE_SCHEMAS[domain]), ("quarantine", schemas.REJECTED)):
        folder = batch_folder(root, layer, domain, run_date)
        batches = [n for n in lake.folder_names(spark, folder) if n.startswith("batch=")]
        if batches:
            body = [c for c in schema.fieldNames() if c != "run_date"]
            rows = spark.read.schema(schema).parquet(*[f"{folder}/{b}" for b in batches]).select(*body)
            lake.write_partition(rows, root, layer, domain, run_date)


def ingest_reports(
    spark: SparkSession,
    section: str,
    landing_dir: str,
    root: str,
    run_date: str,
    checkpoint_location: str,
    years_back: int = CUTOFF_YEARS_BACK,
    files_per_batch: int = FILES_PER_BATCH,
) -> Ingested:
    """Flatten every newly landed report of one section into the run date's
    bronze partition. Returns the numbers of documents and malformed ones
    of this run. Batches are named by the checkpoint and their number."""
    stream = hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:12]
    read: dict[int, Ingested] = {}

    def land(docs: DataFrame, number: int) -> None:
        read[number] = land_batch(docs, f"{stream}-{number}", section, root, run_date, years_back)

    docs = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(landing_dir)
    query = (
        docs.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    publish_batches(spark, section, root, run_date)
    return Ingested(sum(r.documents for r in read.values()), sum(r.malformed for r in read.values()))


def ingest_financial_reports(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    run_date: str,
    checkpoint_location: str,
    years_back: int = CUTOFF_YEARS_BACK,
) -> Ingested:
    """``ingest_reports`` for the financials section."""
    return ingest_reports(spark, "financials", landing_dir, root, run_date, checkpoint_location, years_back)


def read_ingested(spark: SparkSession, root: str, domain: str = FINANCIALS) -> DataFrame:
    """The bronze rows published by the stream, as the silver jobs read them."""
    return lake.read_domain(spark, root, "bronze", domain, BRONZE_SCHEMAS[domain])
