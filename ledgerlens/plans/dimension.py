"""A dimension stored in key buckets, so that a merge rewrites only the buckets
that its rows fall in (S9).

``<folder>/data-<write>/bucket=<b>/`` holds rows, ``<folder>/v=<version>/`` the
manifest: a JSON list with an entry per bucket, the write that has its current
rows (null while it has none). A manifest is published like any version of the lake, so a merge becomes visible
in one step whatever number of buckets it touched, and a reader keeps the
files of the manifest it has read. A merge reads, joins and writes the touched
buckets only; the others keep their files.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import materialize
from ledgerlens.sources import lake

BUCKETS = 16  # of a new table, kept in its manifest; choose some 100 MB of rows a bucket
DATA = "data-"
MANIFEST = "manifest.json"
# A merge that holds the lock of a version for longer than this is taken for dead.
MERGE_LIMIT = dt.timedelta(hours=6)


class ConcurrentMerge(RuntimeError):
    """Another run is merging the same version of the table."""


def _lock(spark: SparkSession, path: str, limit: dt.timedelta):
    """Take the merge lock of a version: a file that only one run can create.
    A lock older than ``limit`` is left over from a dead run."""
    target, fs = lake.file_system(spark, f"{path}/_merging")
    if not fs.createNewFile(target):
        age = dt.datetime.now().timestamp() - fs.getFileStatus(target).getModificationTime() / 1000
        if age < limit.total_seconds():
            raise ConcurrentMerge(f"another run is merging {path}")
        fs.create(target, True).close()
    return lambda: fs.delete(target, False)


@contextmanager
def merging(
    spark: SparkSession, folder: str, create: Callable[[], str], limit: dt.timedelta = MERGE_LIMIT
) -> Iterator[str]:
    """The current version of a table (``create`` makes the first), held for
    a merge: two runs cannot merge the same version, the second one gets
    ``ConcurrentMerge`` and can be rerun, so no merge is lost."""
    current = lake.current_version(spark, folder) or create()
    unlock = _lock(spark, current, limit)
    try:
        if lake.current_version(spark, folder) != current:
            raise ConcurrentMerge(f"another run has replaced {current}")
        yield current
    finally:
        unlock()


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def publish_manifest(spark: SparkSession, folder: str, writes: Sequence[str | None]) -> str:
    """Write and publish a manifest: the write of each bucket."""
    version = lake.version_path(folder, lake.new_version())
    path, fs = lake.file_system(spark, f"{version}/{MANIFEST}")
    out = fs.create(path, False)
    out.write(bytearray(json.dumps(list(writes)), "utf-8"))
    out.close()
    return lake.publish(spark, version)


def create(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> str:
    return publish_manifest(spark, folder, [None] * buckets)


def _writes(spark: SparkSession, version: str) -> list[str | None]:
    path, fs = lake.file_system(spark, f"{version}/{MANIFEST}")
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _paths(folder: str, writes: Sequence[str | None], some: Sequence[int]) -> list[str]:
    return [f"{folder}/{writes[b]}/bucket={b}" for b in some if writes[b] is not None]


def paths(spark: SparkSession, folder: str) -> list[str]:
    """The folders that hold the table's current rows, one a bucket."""
    current = lake.current_version(spark, folder)
    writes = _writes(spark, current) if current else []
    return _paths(folder, writes, range(len(writes)))


def _rows(
    spark: SparkSession, folder: str, schema: T.StructType, writes: Sequence[str | None], only: Sequence[int] | None = None
) -> DataFrame:
    paths = _paths(folder, writes, range(len(writes)) if only is None else only)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The table's rows (none before the first merge)."""
    current = lake.current_version(spark, folder)
    return _rows(spark, folder, schema, _writes(spark, current)) if current else spark.createDataFrame([], schema)


def merge(
    spark: SparkSession, folder: str, schema: T.StructType, key: str, incoming: DataFrame,
    merged: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS, limit: dt.timedelta = MERGE_LIMIT,
    stored: bool = False,
) -> list[int]:
    """Publish ``merged(existing, incoming)`` for the buckets that the keys of
    ``incoming`` fall in; returns these buckets. ``merged`` must not move a
    row to another key. ``stored`` says that ``incoming`` is read from a
    written table; else it is written first, as it is read twice: for its
    buckets and for the merge."""
    with merging(spark, folder, lambda: create(spark, folder, buckets), limit) as current:
        writes = _writes(spark, current)
        n = len(writes)
        incoming = incoming if stored else materialize(incoming, "merge_incoming")
        touched = sorted(r[0] for r in incoming.select(bucket_of(key, n)).distinct().collect())  # n at most
        if not touched:
            return []
        existing = _rows(spark, folder, schema, writes, touched)
        name = f"{DATA}{lake.new_version()}"
        rows = merged(existing, incoming).select(*schema.fieldNames()).withColumn("bucket", bucket_of(key, n))
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/{name}")
        publish_manifest(spark, folder, [name if b in touched else w for b, w in enumerate(writes)])
        return touched


def prune(spark: SparkSession, folder: str, older_than: dt.timedelta) -> int:
    """Delete manifests by age (``lake.prune``), then the writes that no
    remaining manifest names and that are older than that. Returns the
    number of manifests and writes removed."""
    n = lake.prune(spark, folder, older_than)
    names = lake.folder_names(spark, folder)
    kept = {
        w for v in names if v.startswith(f"{lake.VERSION}=") for w in _writes(spark, f"{folder.rstrip('/')}/{v}")
    }
    limit = (time.time() - older_than.total_seconds()) * 1e9
    for name in names:
        if name.startswith(DATA) and name not in kept and int(name[len(DATA):].split("-", 1)[0]) <= limit:
            lake.discard(spark, f"{folder.rstrip('/')}/{name}")
            n += 1
    return n
