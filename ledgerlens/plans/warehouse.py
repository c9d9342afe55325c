"""The warehouse: dimensions, the screening fact and its views
(S9-S12, S14, V1, A2-A4).

Tables are Parquet folders under one warehouse root, in the version layout of
``sources.lake``: the fact has a version per run date, so reloading a run date
replaces that date and nothing else and a rerun gives the same rows; the other
tables are replaced as a whole. Publishing is one step, a failed load leaves
the rows that were published, and a plan never writes to a folder it reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.config import STATUS_PASS
from ledgerlens.operators.clean import keep_greatest
from ledgerlens.plans import dimension
from ledgerlens.plans.calendar_dim import insert_ignore
from ledgerlens.plans.dimension import MERGE_LIMIT, ConcurrentMerge, _lock  # noqa: F401
from ledgerlens.schemas import SCREENING_COLUMNS, WAREHOUSE_TABLES
from ledgerlens.sources import lake

LAYER = "gold"
FACT = "fct_screening"
COMPANY = "dim_company"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/gold/{name}"


def ensure_warehouse(spark: SparkSession, root: str) -> DataFrame:
    """Create every table that does not exist yet (IF NOT EXISTS),
    with its declared schema; returns (table, n_columns, created)."""
    rows = []
    for name, schema in WAREHOUSE_TABLES.items():
        path = table_path(root, name)
        if name == FACT:  # it gets its first version with the first run date
            target, fs = lake.file_system(spark, path)
            created = bool(not fs.exists(target) and fs.mkdirs(target))
        else:
            created = lake.current_version(spark, path) is None
            if created:
                if name == COMPANY:
                    dimension.create(spark, path)
                else:
                    lake.replace(spark.createDataFrame([], schema), path)
        rows.append((name, len(schema.fields), created))
    return spark.createDataFrame(rows, "table string, n_columns int, created boolean")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table's published rows (none, with the declared columns, before the
    first load)."""
    schema = WAREHOUSE_TABLES[name]
    if name == FACT:
        dates = lake.run_dates(spark, root, LAYER, FACT)
        return lake.read_run_dates(spark, root, LAYER, FACT, dates, schema) if dates else spark.createDataFrame([], schema)
    if name == COMPANY:
        return dimension.read(spark, table_path(root, name), schema)
    path = lake.current_version(spark, table_path(root, name))
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)


# ----------------------------------------------------------------- S9 ----
# --- fixed values: the attributes of the company dimension
DIM_COMPANY_ATTRS = ("company_name", "sector", "sub_sector", "market_cap", "listing_date")


def upsert_company(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert new tickers, update the five attributes of known ones,
    refresh updated_at, keep created_at; listing_date is cast to DATE.
    Incoming rows are first reduced to one per ticker (N8; duplicate keys
    in one upsert would otherwise duplicate the dimension's key)."""
    now = F.current_timestamp()
    incoming = keep_greatest(incoming.select("ticker", *DIM_COMPANY_ATTRS), ("ticker",), DIM_COMPANY_ATTRS)
    inc = incoming.select(
        "ticker",
        *[
            (F.to_date(F.col(c)) if c == "listing_date" else F.col(c)).alias(f"_n_{c}")
            for c in DIM_COMPANY_ATTRS
        ],
        F.lit(True).alias("_in"),
    )
    j = existing.withColumn("_ex", F.lit(True)).join(inc, "ticker", "full_outer")
    has_incoming, is_new = F.col("_in").isNotNull(), F.col("_ex").isNull()
    return j.select(
        "ticker",
        *[
            F.when(has_incoming, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
            for c in DIM_COMPANY_ATTRS
        ],
        F.when(is_new, now).otherwise(F.col("created_at")).alias("created_at"),
        F.when(has_incoming, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def newest_profiles(profile: DataFrame) -> DataFrame:
    """Of profiles of several run dates, each company's newest: what merging
    the run dates one after another would leave, in one merge."""
    return keep_greatest(profile, ("ticker",), ("run_date", "company_name"))


def write_dim_company(
    spark: SparkSession, root: str, incoming: DataFrame, limit: dt.timedelta = MERGE_LIMIT, stored: bool = False
) -> list[int]:
    """Merge ``incoming`` into dim_company; returns the key buckets that were
    rewritten, the only ones that are read (``dimension.merge``). Two runs
    cannot merge the same version: the second one gets ``ConcurrentMerge``
    and can be rerun, so no merge is lost."""
    schema = WAREHOUSE_TABLES[COMPANY]
    return dimension.merge(
        spark, table_path(root, COMPANY), schema, "ticker", incoming, upsert_company, limit=limit, stored=stored
    )


def write_dim_date(
    spark: SparkSession, root: str, days: DataFrame, limit: dt.timedelta = MERGE_LIMIT
) -> DataFrame:
    """Insert the days that dim_date lacks, as a merge of its current
    version; returns the table."""
    folder, schema = table_path(root, "dim_date"), WAREHOUSE_TABLES["dim_date"]
    with dimension.merging(spark, folder, lambda: lake.replace(spark.createDataFrame([], schema), folder), limit) as current:
        existing = spark.read.schema(schema).parquet(current)
        merged = insert_ignore(existing, days, ["run_date"])
        return spark.read.schema(schema).parquet(lake.replace(merged.select(*schema.fieldNames()), folder))


def read_dim_company(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "dim_company")


# ---------------------------------------------------------------- S10 ----
def reload_fact(
    fact: DataFrame, root: str, run_date: str, summary: Observation | None = None
) -> str:
    """Replace the fact rows of one run date (delete + insert).

    The new rows are a version of their own, published when they are all
    written, also when ``fact`` is empty (N6): like the original delete +
    insert in one transaction, a failed load leaves the previous rows.
    loaded_at is stamped here.
    """
    body = fact.where(F.col("run_date") == F.to_date(F.lit(run_date))).select(
        *[c for c in SCREENING_COLUMNS if c != "run_date"], F.current_timestamp().alias("loaded_at")
    )
    if summary is not None:  # A2 observed by the load itself, no pass of its own
        body = body.observe(
            summary,
            F.count(F.lit(1)).alias("total"),
            F.sum(F.when(F.col("status") == STATUS_PASS, 1).otherwise(0)).alias("passed"),
        )
    return lake.write_partition(body, root, LAYER, FACT, run_date)


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, FACT)


def fact_for_run(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """The fact of one run date (only that date's folder is opened)."""
    return lake.read_partition(spark, root, LAYER, FACT, run_date, WAREHOUSE_TABLES[FACT])


def newest_fact(spark: SparkSession, root: str) -> DataFrame:
    """P9 on the stored fact: the newest run date, found by folder names."""
    newest = lake.newest_run_date(spark, root, LAYER, FACT)
    return fact_for_run(spark, root, newest) if newest else read_fact(spark, root)


# ------------------------------------------------------------ V1, A2-A4 --
def latest_screening(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    """V1: the newest run date only, with the company's listing_date,
    criteria_passed then roe descending, NULLs first (as in the warehouse
    the view was defined for, N5).

    For any fact frame: MAX(run_date) is an uncorrelated scalar subquery.
    Over the stored fact use ``latest_screening_of``, which needs no scan to
    find the newest date.
    """
    newest = fact.agg(F.max("run_date").alias("_max"))
    return _with_listing_date(fact.where(F.col("run_date") == newest.select("_max").scalar()), dim_company)


def latest_screening_of(spark: SparkSession, root: str) -> DataFrame:
    """V1 over a warehouse: one run date of the fact is opened."""
    return _with_listing_date(newest_fact(spark, root), read_dim_company(spark, root))


def _with_listing_date(latest: DataFrame, dim_company: DataFrame) -> DataFrame:
    out = latest.alias("s").join(dim_company.select("ticker", "listing_date").alias("c"), "ticker")
    return out.select("s.*", "c.listing_date").orderBy(
        F.col("criteria_passed").desc_nulls_first(), F.col("roe").desc_nulls_first()
    )


def run_summary(fact: DataFrame, run_date: str | None = None) -> DataFrame:
    """A2: total, passed and not passed of a run date (NULL sums -> 0)."""
    f = fact if run_date is None else fact.where(F.col("run_date") == F.to_date(F.lit(run_date)))
    total = F.count(F.lit(1))
    passed = F.coalesce(F.sum(F.when(F.col("status") == STATUS_PASS, 1).otherwise(0)), F.lit(0))
    return f.agg(total.alias("total"), passed.cast("long").alias("passed")).select(
        "total", "passed", (F.col("total") - F.col("passed")).alias("not_passed")
    )


def sector_summary(fact: DataFrame, run_date: str | None = None) -> DataFrame:
    """A3: the same per sector."""
    f = fact if run_date is None else fact.where(F.col("run_date") == F.to_date(F.lit(run_date)))
    passed = F.sum(F.when(F.col("status") == STATUS_PASS, 1).otherwise(0)).cast("long")
    return f.groupBy("sector").agg(F.count(F.lit(1)).alias("total"), passed.alias("passed")).select(
        "sector", "total", "passed", (F.col("total") - F.col("passed")).alias("not_passed")
    )


def summaries(fact: DataFrame, run_date: str | None = None) -> DataFrame:
    """A2 and A3 at every level in one grouped pass (GROUPING SETS): the whole
    run, each sector, each status of a sector. Columns: level, sector, status,
    total, passed, not_passed."""
    f = fact if run_date is None else fact.where(F.col("run_date") == F.to_date(F.lit(run_date)))
    sets = [[], [F.col("sector")], [F.col("sector"), F.col("status")]]
    passed = F.coalesce(F.sum(F.when(F.col("status") == STATUS_PASS, 1).otherwise(0)), F.lit(0)).cast("long")
    level = F.when(F.grouping("sector") == 1, "run").when(F.grouping("status") == 1, "sector").otherwise("status")
    out = f.groupingSets(sets, "sector", "status").agg(
        level.alias("level"), F.count(F.lit(1)).alias("total"), passed.alias("passed")
    )
    return out.select("level", "sector", "status", "total", "passed", (F.col("total") - F.col("passed")).alias("not_passed"))


def metric_counts(fin: DataFrame, val: DataFrame, run_date: str) -> DataFrame:
    """A4: rows per metric set. roe, der, fcf and growth are projections
    of the same financial rows, so one count serves four; one pass each."""
    nf = fin.where(F.col("run_date") == run_date).agg(F.count(F.lit(1)).alias("n"))
    nv = val.where(F.col("run_date") == run_date).agg(F.count(F.lit(1)).alias("n"))
    four = nf.select(
        F.explode(F.array(*[F.lit(m) for m in ("roe", "der", "fcf", "growth")])).alias("metric"), "n"
    )
    return four.unionByName(nv.select(F.lit("valuation").alias("metric"), "n")).withColumnRenamed(
        "n", "n_rows"
    )


# ---------------------------------------------------------------- S14 ----
def dim_fiscal_period(fin: DataFrame) -> DataFrame:
    """Fiscal periods seen in the financials: annual, month 12."""
    return fin.select("period").distinct().select(
        F.col("period").alias("period_key"),
        F.col("period").try_cast("int").alias("fiscal_year"),
        F.lit(12).alias("fiscal_month"),
        F.lit("annual").alias("period_type"),
    )


def fundamentals_annual(fin: DataFrame, run_date: str) -> DataFrame:
    """Annual fundamentals, key (ticker, period), from one run date."""
    return fin.where(F.col("run_date") == run_date).drop("run_date")


def valuation_snapshot(val: DataFrame, run_date: str) -> DataFrame:
    """Valuation per (ticker, run_date): the row of the latest period.

    A grouped "greatest row" (period first, then the ratios for ties), so
    one row per key even with duplicated input, and no window that would
    put a hot ticker's rows in one task.
    """
    v = val.where(F.col("run_date") == run_date).select(
        "run_date", "ticker", "period", "per", "pbv", "price", "ev_ebitda"
    )
    latest = keep_greatest(v, ("run_date", "ticker"), ("period", "per", "pbv", "price", "ev_ebitda"))
    return latest.select(
        "ticker", F.to_date("run_date").alias("run_date"), "period", "per", "pbv", "price", "ev_ebitda"
    )
