"""The lake: one Parquet dataset per layer and domain, partitioned by
run_date (S1-S3, S6, S13).

A partition's versions are folders, ``<layer>/<domain>/run_date=<d>/v=<version>``.
A write goes to a version of its own; publishing it creates one marker file
beside it, ``_published-<number>-<version>``, whose number is one more than
the last, so readers take the version that was published last, whichever
write began first and whatever the drivers' clocks say. The marker is one
atomic step: before it readers see the older version, afterwards the new one,
and a write that fails or whose driver dies leaves nothing that a reader
looks at. No write deletes or renames anything. ``prune`` removes versions
that were replaced long enough ago.

Paths are plain Spark paths (a shared file system or object store). The driver
lists folder names only, one listing a run date. Readers name the version
folders and pass a schema where one is known, so run_date stays text, nothing
is inferred and only the run dates asked for are opened.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import concurrently

MARKER = "_published-"
VERSION = "v"


class MissingPartition(LookupError):
    """A run date (or a whole domain) that was never written."""


def domain_path(root: str, layer: str, domain: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{domain}"


def partition_path(root: str, layer: str, domain: str, run_date: str, column: str = "run_date") -> str:
    return f"{domain_path(root, layer, domain)}/{column}={run_date}"


# ---------------------------------------------------------------- versions --
def file_system(spark: SparkSession, path: str):
    """(Hadoop Path, FileSystem) of a Spark path: metadata operations without
    a Spark job."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if it is missing)."""
    base, fs = file_system(spark, path)
    if not fs.exists(base):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(base) if st.isDirectory())


def new_version() -> str:
    """A version name, unlike any other; it starts with the time the write began."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def version_path(folder: str, version: str) -> str:
    return f"{folder.rstrip('/')}/{VERSION}={version}"


class Published(NamedTuple):
    """A marker; markers sort by the order of publishing (two that were
    published at the same moment share a number and sort by version)."""

    number: int
    version: str
    at: int  # the file system's time, in milliseconds


def _listed(spark: SparkSession, folder: str) -> tuple[dict[str, int], list[Published]]:
    """(version -> modification time, markers in order) from one listing."""
    base, fs = file_system(spark, folder)
    versions, markers = {}, []
    if fs.exists(base):
        for st in fs.listStatus(base):
            name, at = st.getPath().getName(), st.getModificationTime()
            if name.startswith(f"{VERSION}="):
                versions[name.split("=", 1)[1]] = at
            elif name.startswith(MARKER):
                number, version = name[len(MARKER):].split("-", 1)
                markers.append(Published(int(number), version, at))
    return versions, sorted(markers)


def _marker(folder: str, p: Published) -> str:
    return f"{folder}/{MARKER}{p.number:012d}-{p.version}"


def publish(spark: SparkSession, path: str) -> str:
    """Make a completely written version the one that readers see."""
    folder, _, name = path.rstrip("/").rpartition("/")
    _, before = _listed(spark, folder)
    mine = Published(before[-1].number + 1 if before else 1, name.split("=", 1)[1], 0)
    marker, fs = file_system(spark, _marker(folder, mine))
    fs.create(marker, True).close()
    return path


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Path of the version of a folder that was published last."""
    versions, markers = _listed(spark, folder)
    return next((version_path(folder, m.version) for m in reversed(markers) if m.version in versions), None)


def stage(df: DataFrame, folder: str) -> str:
    """Write ``df`` as a new version that is not published yet (an empty
    frame gives one empty file, so it replaces old rows too, N6)."""
    path = version_path(folder, new_version())
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a version (never one that readers may hold) or a marker."""
    target, fs = file_system(spark, path)
    fs.delete(target, True)


def replace(df: DataFrame, folder: str) -> str:
    """Write ``df`` as the new version of ``folder`` and publish it."""
    return publish(df.sparkSession, stage(df, folder))


def prune(spark: SparkSession, folder: str, older_than: dt.timedelta) -> int:
    """Delete the versions of a folder that a newer one replaced more than
    ``older_than`` ago, counted from the moment the newer one was published,
    and unpublished ones that nothing was written to since then (a task of
    its own: choose an age beyond the longest read or write). Returns the
    number of versions removed."""
    limit = int((time.time() - older_than.total_seconds()) * 1000)
    versions, markers = _listed(spark, folder)
    told = {m.version: m for m in markers}
    replaced_at = {m.version: after.at for m, after in zip(markers, markers[1:])}
    doomed = [
        v for v, at in versions.items()
        if (replaced_at.get(v, limit + 1) if v in told else max(at, int(v.split("-", 1)[0]) // 1_000_000)) <= limit
    ]
    for v in doomed:
        discard(spark, version_path(folder, v))
        if v in told:
            discard(spark, _marker(folder.rstrip("/"), told[v]))
    return len(doomed)


def prune_domain(spark: SparkSession, root: str, layer: str, domain: str, older_than: dt.timedelta) -> int:
    """``prune`` for every run date of a domain."""
    base = domain_path(root, layer, domain)
    return sum(prune(spark, f"{base}/{n}", older_than) for n in folder_names(spark, base) if "=" in n)


# -------------------------------------------------------------------- reads --
def run_dates(spark: SparkSession, root: str, layer: str, domain: str, column: str = "run_date") -> list[str]:
    """The published run dates of a domain, from folder names, oldest first."""
    base = domain_path(root, layer, domain)
    names = [n for n in folder_names(spark, base) if n.startswith(f"{column}=")]
    return [n.split("=", 1)[1] for n in names if current_version(spark, f"{base}/{n}") is not None]


def newest_run_date(
    spark: SparkSession, root: str, layer: str, domain: str, column: str = "run_date"
) -> str | None:
    """The newest published run date, without opening a data file."""
    base = domain_path(root, layer, domain)
    for name in reversed(folder_names(spark, base)):
        if name.startswith(f"{column}=") and current_version(spark, f"{base}/{name}") is not None:
            return name.split("=", 1)[1]
    return None


def read_run_dates(
    spark: SparkSession, root: str, layer: str, domain: str, dates: Iterable[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """The given run dates of a domain (run_date as a string column unless
    the schema says otherwise). A date without a published version is an
    error."""
    base = domain_path(root, layer, domain)
    paths = []
    for d in dates:
        path = current_version(spark, partition_path(root, layer, domain, d))
        if path is None:
            raise MissingPartition(f"{base} has no run date {d}")
        paths.append(path)
    if not paths:
        raise MissingPartition(f"{base} has no run date")
    reader = spark.read.option("basePath", base)
    if schema is not None:
        return reader.schema(schema).parquet(*paths).select(*schema.fieldNames())
    # Without a schema (pass-through columns) the file schemas are merged and
    # the partition value is inferred (a DATE); the lake contract is text.
    df = reader.option("mergeSchema", "true").parquet(*paths).drop(VERSION)
    return df.withColumn("run_date", F.col("run_date").cast("string"))


def read_domain(
    spark: SparkSession, root: str, layer: str, domain: str, schema: T.StructType | None = None
) -> DataFrame:
    """Every run date of a domain."""
    return read_run_dates(spark, root, layer, domain, run_dates(spark, root, layer, domain), schema)


def read_partition(
    spark: SparkSession, root: str, layer: str, domain: str, run_date: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One run date of one domain; nothing else is listed or opened. A
    run date that was never written is an error."""
    return read_run_dates(spark, root, layer, domain, (run_date,), schema)


def has_data(spark: SparkSession, root: str, layer: str, domain: str) -> bool:
    """S3: does the domain hold any published run date? A missing folder is
    'no'. Stops at the first."""
    return newest_run_date(spark, root, layer, domain) is not None


# ------------------------------------------------------------------- writes --
def write_partition(df: DataFrame, root: str, layer: str, domain: str, run_date: str) -> str:
    """Replace exactly one run_date partition (others are not touched)."""
    body = df.drop("run_date") if "run_date" in df.columns else df
    return replace(body, partition_path(root, layer, domain, run_date))


def write_nonempty_partition(df: DataFrame, root: str, layer: str, domain: str, run_date: str) -> bool:
    """``write_partition``, unless ``df`` turns out to have no rows: then
    nothing is published. One pass: the write counts its own rows."""
    spark = df.sparkSession
    body = df.drop("run_date") if "run_date" in df.columns else df
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    path = stage(
        body.observe(seen, F.count(F.lit(1)).alias("n")), partition_path(root, layer, domain, run_date)
    )
    if seen.get.get("n"):
        publish(spark, path)
        return True
    discard(spark, path)
    return False


def write_partitioned(
    df: DataFrame, root: str, layer: str, domain: str, column: str = "run_date"
) -> list[str]:
    """Fan rows out to one partition per value of ``column``; only
    the values present in ``df`` get a new version. Returns those values.

    The REBALANCE hint lets AQE cluster rows by ``column`` while splitting
    a value that holds a large share of the rows over several writers and
    merging small ones, from runtime sizes: neither one task per hot date
    nor one tiny file per task and date.
    """
    spark = df.sparkSession
    path, version = domain_path(root, layer, domain), new_version()
    (
        df.withColumn(VERSION, F.lit(version))
        .hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")  # a staging folder of the job's own
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .partitionBy(column, VERSION)
        .parquet(path)
    )
    written = []
    for name in folder_names(spark, path):
        part = version_path(f"{path}/{name}", version)
        target, fs = file_system(spark, part)
        if name.startswith(f"{column}=") and fs.exists(target):
            publish(spark, part)
            written.append(name.split("=", 1)[1])
    return written


# ----------------------------------------------------------------- backfill --
def backfill_run_dates(run_date: str, years: int) -> tuple[str, ...]:
    """One run date per past year: the same day, 29 February -> 28."""
    d = dt.date.fromisoformat(run_date)
    out = []
    for n in range(years):
        y = d.year - n
        day = min(d.day, 28) if (d.month == 2 and d.day == 29) and not _leap(y) else d.day
        out.append(dt.date(y, d.month, day).isoformat())
    return tuple(sorted(out))


def _leap(y: int) -> bool:
    return y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)


def backfill(rows: DataFrame, root: str, layer: str, domain: str, years_back: int = 1) -> list[str]:
    """Many run dates of one domain in one job.

    ``rows`` carries run_date; where it has a period, each run date keeps
    the periods from its own cutoff year (year(run_date) - years_back) on.
    A domain without periods (the company profile) is written as it is.
    """
    if "period" in rows.columns:
        year = F.floor(F.col("period").try_cast("double"))
        rows = rows.where(year >= F.year(F.to_date("run_date")) - F.lit(years_back))
    return write_partitioned(rows, root, layer, domain)


def backfill_domains(
    frames: dict[str, DataFrame], root: str, layer: str = "bronze", years_back: int = 1
) -> dict[str, str]:
    """S13 over several domains, at the same time: one job per domain writes
    all its run dates at once. Where that job fails, its run dates are
    written one by one, so a bad run date is reported and skipped and the
    others load. Returns domain -> 'ok' or the errors by run date."""
    def load(domain: str, rows: DataFrame) -> str:
        try:
            backfill(rows, root, layer, domain, years_back)
            return "ok"
        except Exception:  # noqa: BLE001 - find out which run dates it is
            try:
                # Its own columns only: what fails is not evaluated for the dates.
                dates = sorted(r[0] for r in rows.select("run_date").distinct().collect())
            except Exception as exc:  # noqa: BLE001 - nothing of the domain can be read
                return _told(exc)
        failed = {}
        for d in dates:
            try:
                backfill(rows.where(F.col("run_date") == d), root, layer, domain, years_back)
            except Exception as exc:  # noqa: BLE001 - report the unit, keep going
                failed[d] = _told(exc)
        return "; ".join(f"{d}: {x}" for d, x in failed.items()) or "ok"

    done = concurrently(*[partial(load, domain, rows) for domain, rows in frames.items()]) if frames else []
    return dict(zip(frames, done))


def _told(exc: Exception) -> str:
    return f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}"
