"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 4 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests, the bench and local runs.

    On a cluster the session comes from the platform; everything in the
    library only relies on a few SQL settings, which are set here.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName("ledgerlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """A master that runs everything in the driver's own process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Only where nothing is set on a local master
    (a bare session, as in tests) a folder of our own is chosen; on a
    cluster a local folder would be invisible to the executors, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if current:
        return configured or current
    if not configured and not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    target = configured or tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(target)
    return target


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint folder.

    Lake and warehouse folders of one registered query live here, so that
    every executor of a cluster can read what another one wrote.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "ledgerlens", uuid.uuid4().hex, *parts])


def bound_arrow_batches(spark: SparkSession, most: int = ARROW_BYTES) -> None:
    """Hand rows to Python in batches of about ``most`` bytes (one row at
    least). Both the executor and its worker hold a batch outside the heap,
    the executor in a buffer that doubles as it grows. A limit that the
    session already has stays."""
    if spark.conf.get(ARROW_LIMIT, None) is None:
        spark.conf.set(ARROW_LIMIT, str(most))


def concurrently(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs at the same time from driver threads and
    return their results in order. All of them end before the first error,
    if any, is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
    return [f.result() for f in futures]


def materialize(df: DataFrame, name: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: a lineage cut that computes the plan exactly once (an
    RDD checkpoint of an unpersisted Dataset computes it twice) and
    survives a lost executor. With ``partition_by`` a filter on that column
    opens the files of the value only."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage", name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
