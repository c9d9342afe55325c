"""Pages of a sorted company list by seeking, not by OFFSET.

An OFFSET brings all skipped rows into one task. Here the list is sorted once
over the cluster and stored with each row's position in its sub-sector, in
that order, so a page is a range of positions that Parquet's own statistics
(of files, row groups and column pages) lead to. A small table of page bounds
holds the first key of each page; with it a reader who knows the last row he
saw (market cap, ticker) continues from there. Each page is one bounded scan.

Order: market cap descending, missing last, then ticker. Rows that are equal in
both keep the order they were stored in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.fixtures import with_row_index

GROUP = "sub_sector"


def write_list(companies: DataFrame, path: str, page_size: int) -> str:
    """Store ``companies`` (sub_sector, market_cap, ticker, ...) for paging:
    the sorted rows under ``rows``, the page bounds under ``bounds``."""
    spark = companies.sparkSession
    order = [F.col(GROUP).asc_nulls_first(), F.col("market_cap").desc_nulls_last(), F.col("ticker").asc()]
    ranked = with_row_index(companies, order, "_place")
    firsts = ranked.groupBy(GROUP).agg(F.min("_place").alias("_first")).withColumnRenamed(GROUP, "_group")
    placed = ranked.join(firsts, F.col(GROUP).eqNullSafe(F.col("_group")))
    placed = placed.withColumn("position", F.col("_place") - F.col("_first")).drop("_group", "_first", "_place")
    (
        placed.orderBy(F.col(GROUP).asc_nulls_first(), "position")
        .write.option("parquet.page.row.count.limit", str(page_size))
        .option("parquet.page.size.row.check.min", str(page_size)).parquet(f"{path}/rows")
    )
    stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    bounds = stored.where(F.col("position") % page_size == 0).select(
        GROUP, F.floor(F.col("position") / page_size).alias("page"), "market_cap", "ticker"
    )
    bounds.orderBy(F.col(GROUP).asc_nulls_first(), "page").write.parquet(f"{path}/bounds")
    return path


def _range(spark: SparkSession, path: str, sub_sector: str, start: int, end: int) -> DataFrame:
    rows = spark.read.parquet(f"{path}/rows")
    here = (F.col(GROUP) == F.lit(sub_sector)) & (F.col("position") >= F.lit(start)) & (F.col("position") < F.lit(end))
    return rows.where(here)


def read_page(spark: SparkSession, path: str, sub_sector: str, page: int, page_size: int) -> DataFrame:
    """Page ``page`` (from 0) of a sub-sector, in order."""
    return _range(spark, path, sub_sector, page * page_size, (page + 1) * page_size).orderBy("position")


def last_page(spark: SparkSession, path: str, sub_sector: str) -> int | None:
    """Number of a sub-sector's last page, None where it has no rows."""
    bounds = spark.read.parquet(f"{path}/bounds").where(F.col(GROUP) == F.lit(sub_sector))
    return bounds.agg(F.max("page")).head()[0]


def read_after(
    spark: SparkSession, path: str, sub_sector: str, market_cap: float | None, ticker: str, page_size: int
) -> DataFrame:
    """The ``page_size`` rows that follow a key, in order: its page is found
    among the bounds, and two pages are scanned at most."""
    cap, name = F.col("market_cap"), F.col("ticker")
    if market_cap is None:
        after = cap.isNull() & (name > F.lit(ticker))
    else:
        same = (cap == F.lit(market_cap)) & (name > F.lit(ticker))
        after = cap.isNull() | (cap < F.lit(market_cap)) | same
    bounds = spark.read.parquet(f"{path}/bounds").where((F.col(GROUP) == F.lit(sub_sector)) & ~F.coalesce(after, F.lit(False)))
    page = bounds.agg(F.coalesce(F.max("page"), F.lit(0))).head()[0]
    rows = _range(spark, path, sub_sector, page * page_size, (page + 2) * page_size).where(after)
    return rows.orderBy("position").limit(page_size)  # a page: the limit is the feature
