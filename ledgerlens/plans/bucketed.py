"""Silver as bucketed catalog tables: the screening without a shuffle
(J1, J2, W1 to W3, K1).

``publish_silver`` deals each silver table of one run date by ticker into the
same number of buckets, one sorted file a bucket: one shuffle of each table,
paid once at the write. Every reader by company then finds its rows together:
the de-duplications, the growth window and both joins of the screening
(``screening_of`` under ``in_place``) run bucket by bucket. It pays where a run date's
silver is read several times; a single weekly run reads it once, so the weekly
job itself does not write it.

A publication writes into a folder of its own and then points the table's name
to it, so a failed write changes no table and a rerun gives the same rows; the
folders before it go by age, as scratch data do. ``run_date`` stays a column.
A run date without rows gives empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.config import FINANCIALS, PROFILE, RUN_DATE, VALUATION
from ledgerlens.plans.screening import screening
from ledgerlens.session import concurrently

DATABASE = "ledgerlens_silver"
DOMAINS = (FINANCIALS, PROFILE, VALUATION)
BUCKETS = 64
# By default a join shuffles both sides unless they are dealt by all its keys.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _quoted(text: str) -> str:
    return f"`{text.replace('`', '``')}`"


def table_name(domain: str, run_date: str, database: str = DATABASE) -> str:
    return f"{_quoted(database)}.{_quoted(f'{domain}_{run_date}'.replace('-', '_'))}"


def publish_silver(
    spark: SparkSession, root: str, silver: dict[str, DataFrame], run_date: str = RUN_DATE,
    buckets: int = BUCKETS, database: str = DATABASE,
) -> list[str]:
    """Write the silver frames (by domain) of one run date under ``root`` and
    name the tables; returns their names. Tables that are read together must
    have the same number of buckets."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    version = uuid.uuid4().hex

    def publish(domain: str, frame: DataFrame) -> str:
        path = f"{root.rstrip('/')}/{domain}/run_date={run_date}/{version}"
        fresh = f"{_quoted(database)}.{_quoted(f'new_{version}_{domain}')}"
        # Dealt like the buckets, so that each bucket is one file.
        rows = frame.where(frame["run_date"] == run_date).repartition(buckets, "ticker")
        rows.write.format("parquet").bucketBy(buckets, "ticker").sortBy("ticker").option("path", path).saveAsTable(fresh)
        name = table_name(domain, run_date, database)
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the name only: the files are external
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        return name

    return concurrently(*(lambda d=d, f=f: publish(d, f) for d, f in silver.items()))


def silver_of(spark: SparkSession, domain: str, run_date: str = RUN_DATE, database: str = DATABASE) -> DataFrame:
    """One published silver table."""
    return spark.table(table_name(domain, run_date, database))


@contextmanager
def in_place(spark: SparkSession) -> Iterator[None]:
    """Plans made inside may join tables dealt by some of the join's keys (the
    ticker) as they lie. Run the action inside, as plans are made late."""
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, before)


def screening_of(spark: SparkSession, run_date: str = RUN_DATE, database: str = DATABASE) -> DataFrame:
    """The scored fact rows of a run date from its bucketed silver."""
    fin, prof, val = (silver_of(spark, d, run_date, database) for d in DOMAINS)
    return screening(fin, prof, val, run_date)
