"""Price ingestion: full history on the first run, then incremental.

The branch is chosen on the driver from two scalars: whether the price
domain holds any run date (S3, a listing) and whether the run date is a last
Friday (P10). The data work itself is one Spark job either way: the write
itself tells whether there was a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.config import DAILY_PRICES, PRICE_YEARS_BACK
from ledgerlens.operators import prices as P
from ledgerlens.sources import lake

LAYER = "bronze"


def load_prices(
    spark: SparkSession, prices: DataFrame, root: str, run_date: str,
    years_back: int = PRICE_YEARS_BACK,
) -> str:
    """Load price rows (ticker, date text, ...) into bronze/daily_prices.

    No partition yet: every last-Friday row from 1 January of (run year -
    years_back) to run_date, one partition per date, named by the date itself,
    however the rows write it. Otherwise: the rows
    of run_date only, and only when run_date is a last Friday. An empty
    result writes nothing. Returns 'full', 'incremental' or 'skipped'.
    """
    if not lake.has_data(spark, root, LAYER, DAILY_PRICES):
        rows = P.last_friday_prices(prices, run_date, years_back)
        rows = rows.withColumn("run_date", P.run_date_of(F.col("date")))
        return "full" if lake.write_partitioned(rows, root, LAYER, DAILY_PRICES) else "skipped"
    if not P.is_last_friday_date(run_date):
        return "skipped"
    rows = P.incremental_prices(prices, run_date)
    wrote = lake.write_nonempty_partition(rows, root, LAYER, DAILY_PRICES, run_date)
    return "incremental" if wrote else "skipped"


def price_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Rows per date partition of the price domain."""
    schema = T.StructType([T.StructField("date", T.StringType()), T.StructField("run_date", T.StringType())])
    df = lake.read_domain(spark, root, LAYER, DAILY_PRICES, schema)
    return df.groupBy("run_date").agg(F.count(F.lit(1)).alias("n_rows"))
