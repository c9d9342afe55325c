"""Registered queries: one per operator of the inventory.

Each query takes (spark, sf_dir) and returns a DataFrame computed from the
driver's tables; ``ORACLE`` holds the DuckDB SQL that must give the same
rows. Queries that need a lake or warehouse write to a fresh folder under
the shared checkpoint folder (``session.scratch_path``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import oracle as o
from ledgerlens import schemas
from ledgerlens.config import DAILY_PRICES, FINANCIALS, PREVIOUS_RUN_DATE, PROFILE, RUN_DATE, VALUATION
from ledgerlens.functions import expressions as E
from ledgerlens.operators import clean, flatten, metrics, paging, prices, quality, scoring
from ledgerlens.plans import bucketed, calendar_dim, catalog, ingest, quality_state, warehouse, weekly_run
from ledgerlens.plans.metric_sql import metric_sql
from ledgerlens.plans import screening as scr
from ledgerlens.session import concurrently, materialize, scratch_path
from ledgerlens.sources import fixtures as fx
from ledgerlens.sources import lake, raw
from ledgerlens.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TWO_RUNS = (PREVIOUS_RUN_DATE, RUN_DATE)
# The tables' ratios spread far more than those of listed companies, so the
# share of them that must lie within the gold bounds is lower here.
GOLD_MOSTLY = 0.5


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _silver(spark: SparkSession, sf_dir: str, run_dates=(RUN_DATE,)):
    return scr.silver_inputs(spark, sf_dir, run_dates)


M = ", ".join(o.MEASURES)
L = o.letters("k")

# ------------------------------------------------------- expressions (E) --
@register(
    "normalize_ticker",
    f"SELECT raw_ticker, {o.norm('raw_ticker')} AS ticker FROM "
    f"(SELECT {o.dirty('c_custkey')} AS raw_ticker FROM customer)",
)
def q_normalize_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_t = fx.dirty_ticker("c_custkey")
    return fx.table(spark, sf_dir, "customer").select(
        raw_t.alias("raw_ticker"), E.normalize_ticker(raw_t).alias("ticker")
    )


def _order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()


@register(
    "cutoff_year",
    "SELECT DISTINCT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS run_date, "
    "CAST(year(o_orderdate) - 1 AS INTEGER) AS cutoff_year FROM orders",
)
def q_cutoff_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _order_dates(spark, sf_dir)
    return d.select(
        F.date_format("d", "yyyy-MM-dd").alias("run_date"),
        E.cutoff_year(F.date_format("d", "yyyy-MM-dd")).alias("cutoff_year"),
    )


@register(
    "run_dates",
    "SELECT d AS run_date, CAST(n AS INTEGER) AS years_back, CAST(d - to_years(n) AS DATE) AS past_run_date "
    "FROM (SELECT d, unnest([0, 1]) AS n FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))",
)
def q_run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _order_dates(spark, sf_dir)
    n = d.select("d", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("years_back"))
    return n.select(
        F.col("d").alias("run_date"),
        F.col("years_back").cast("int").alias("years_back"),
        E.past_run_date(F.col("d"), F.col("years_back")).alias("past_run_date"),
    )


# ------------------------------------------------------------ silver (C) --
@register(
    "dedup_financials",
    o.with_ctes(o.base_ctes() + ",\n" + o.bronze_fin_cte(L, True), o.dedup_sql("bfin", "ticker")),
)
def q_dedup_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze_financials(spark, sf_dir, duplicates=True)
    return clean.dedup_financials(b)


@register(
    "clean_financials",
    o.with_ctes(
        o.base_ctes() + ",\n" + o.bronze_fin_cte(o.dirty("k"), True),
        o.dedup_sql("bfin", o.norm("ticker")),
    ),
)
def q_clean_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_financials(fx.bronze_financials(spark, sf_dir, dirty=True, duplicates=True))


@register(
    "clean_profile",
    o.with_ctes(
        o.base_ctes(),
        f"SELECT {o.norm(o.dirty('k'))} AS ticker, company_name, sector, sub_sector, market_cap, "
        "listing_date, run_date FROM prof",
    ),
)
def q_clean_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_profile(fx.bronze_profile(spark, sf_dir, dirty=True))


@register(
    "clean_valuation",
    o.with_ctes(
        o.base_ctes(),
        f"SELECT {o.norm(o.dirty('k'))} AS ticker, period, per, pbv, price, ev_ebitda, run_date "
        "FROM val WHERE per > 0 AND pbv > 0",
    ),
)
def q_clean_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_valuation(fx.bronze_valuation(spark, sf_dir, dirty=True))


# ----------------------------------------------------------- metrics (M) --
@register(
    "roe",
    o.with_ctes(o.silver_ctes(), "SELECT ticker, period, net_income / NULLIF(total_equity, 0) AS roe "
                f"FROM sfin WHERE run_date = '{RUN_DATE}'"),
)
def q_roe(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return metrics.roe(fin, RUN_DATE)


@register(
    "der",
    o.with_ctes(o.silver_ctes(), "SELECT ticker, period, total_debt / NULLIF(total_equity, 0) AS der "
                f"FROM sfin WHERE run_date = '{RUN_DATE}'"),
)
def q_der(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return metrics.der(fin, RUN_DATE)


@register(
    "fcf",
    o.with_ctes(
        o.silver_ctes(),
        "SELECT ticker, period, operating_cash_flow - capex AS fcf, "
        "(operating_cash_flow - capex) / NULLIF(revenue, 0) AS fcf_margin "
        f"FROM sfin WHERE run_date = '{RUN_DATE}'",
    ),
)
def q_fcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return metrics.fcf(fin, RUN_DATE)


@register(
    "eps_growth",
    o.with_ctes(o.metric_ctes(), f"SELECT ticker, period, eps_growth_yoy, eps_cagr_5y FROM gm "
                f"WHERE run_date = '{RUN_DATE}'"),
)
def q_eps_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return metrics.eps_growth(fin, RUN_DATE)


@register(
    "valuation_metrics",
    o.with_ctes(
        o.silver_ctes(),
        "SELECT ticker, period, per, pbv, per * pbv AS graham_combined, price, ev_ebitda "
        f"FROM sval WHERE run_date = '{RUN_DATE}'",
    ),
)
def q_valuation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.valuation_metrics(scr.silver_valuation(spark, sf_dir), RUN_DATE)


@register(
    "latest_period",
    o.with_ctes(o.metric_ctes(), f"SELECT ticker, period FROM latest WHERE run_date = '{RUN_DATE}'"),
)
def q_latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return metrics.latest_period(fin, RUN_DATE)


CAND = ", ".join(metrics.CANDIDATE_COLUMNS)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin, prof, val = _silver(spark, sf_dir)
    return metrics.screening_candidates(
        fin, clean.unique_profile(prof), clean.unique_valuation(val), RUN_DATE
    ).drop("run_date")


@register("screening_candidates", o.with_ctes(o.metric_ctes(), f"SELECT {CAND} FROM cand"))
def q_screening_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


_FLAG_SQL = {
    "roe": "roe >= 0.15", "der": "der <= 0.5", "fcf": "fcf > 0",
    "eps_growth_yoy": "eps_growth_yoy >= 0.1", "per": "per <= 15", "pbv": "pbv <= 1.5",
    "graham_combined": "per * pbv <= 22.5",
}


@register(
    "criteria_flags",
    o.with_ctes(
        o.metric_ctes(),
        "SELECT ticker, "
        + ", ".join(f"COALESCE(CAST(({e}) AS INTEGER), 0) AS pass_{n}" for n, e in _FLAG_SQL.items())
        + " FROM cand",
    ),
)
def q_criteria_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = scoring.criteria_flags(_candidates(spark, sf_dir))
    return flags.select("ticker", *[f"pass_{n}" for n in _FLAG_SQL])


@register(
    "score",
    o.with_ctes(o.metric_ctes(), f"SELECT {CAND}, criteria_passed, status FROM scored"),
)
def q_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(_candidates(spark, sf_dir))


# ---------------------------------------------------------------- K4 -----
@register("screening", o.with_ctes(o.metric_ctes(dirty_input=True), "SELECT * FROM fact"))
def q_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole screening from bronze with dirty tickers and repeated rows
    in all three domains."""
    return scr.screening_from_tables(spark, sf_dir, RUN_DATE, dirty=True, duplicates=True)


@register("screening_bucketed", o.with_ctes(o.metric_ctes(), "SELECT * FROM fact"))
def q_screening_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The screening over silver in buckets by ticker: no shuffle after the
    tables are written."""
    database = f"ledgerlens_{uuid.uuid4().hex[:12]}"
    silver = dict(zip((FINANCIALS, PROFILE, VALUATION), _silver(spark, sf_dir)))
    bucketed.publish_silver(spark, scratch_path(spark, "silver"), silver, database=database, buckets=8)
    with bucketed.in_place(spark):
        return materialize(bucketed.screening_of(spark, database=database), "fact")


# ------------------------------------------------------- flatten (F, S5) --
def _landed(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    path = raw.land(docs, scratch_path(spark, "landing", name))
    return raw.read_landed(spark, path)


def _landed_keyed(spark: SparkSession, docs: DataFrame, name: str, schema: str) -> DataFrame:
    path = raw.land_keyed(docs, scratch_path(spark, "landing", name))
    return raw.read_landed_keyed(spark, path, schema)


@register(
    "flatten_overview",
    o.with_ctes(
        o.base_ctes(),
        f"SELECT {L} AS ticker, CASE WHEN k % {fx.NO_COMPANY_NAME_EVERY} = 0 THEN '' ELSE company_name END "
        "AS company_name, "
        + ", ".join(
            f"CASE WHEN k % {fx.NO_SECTION_EVERY} = 0 THEN NULL ELSE {c} END AS {c}"
            for c in ("sector", "sub_sector", "market_cap", "listing_date")
        )
        + " FROM prof",
    ),
)
def q_flatten_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _landed(spark, fx.overview_documents(spark, sf_dir), "overview")
    return flatten.flatten_overview(docs)


_CUT = int(RUN_DATE[:4]) - 1
# A revenue that the report writes as 'n/a' is NULL.
_TOLD_REVENUE = f"CASE WHEN k % {fx.TEXT_MEASURE_EVERY} <> 0 THEN revenue END"


@register(
    "flatten_financials",
    o.with_ctes(
        o.base_ctes(),
        f"SELECT {L} AS ticker, period, {_TOLD_REVENUE} AS revenue, gross_profit, net_income, total_assets, "
        "total_equity, total_debt, operating_cash_flow, "
        "operating_cash_flow - (operating_cash_flow - capex) AS capex, "
        "CASE (k + CAST(period AS INTEGER)) % 3 WHEN 0 THEN eps WHEN 1 THEN gross_profit / "
        f"{fx.EPS_PER_SHARE_DIVISOR} ELSE NULL END AS eps "
        f"FROM fin WHERE k % {fx.NO_SECTION_EVERY} <> 0 AND CAST(period AS INTEGER) >= {_CUT}",
    ),
)
def q_flatten_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _landed(spark, fx.financial_documents(spark, sf_dir), "financials")
    return flatten.flatten_financials(docs, RUN_DATE)


@register(
    "flatten_valuation",
    o.with_ctes(
        o.base_ctes(),
        f"SELECT {L} AS ticker, period, per, pbv, price, ev_ebitda FROM val "
        f"WHERE k % {fx.NO_SECTION_EVERY} <> 0 AND CAST(period AS INTEGER) >= {_CUT}",
    ),
)
def q_flatten_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _landed(spark, fx.valuation_documents(spark, sf_dir), "valuation")
    return flatten.flatten_valuation(docs, RUN_DATE)


_KC = "c_custkey"
_OBJ = f"{_KC} % {fx.NON_OBJECT_SECTION_EVERY} <> 0"


@register(
    "flatten_section",
    f"SELECT {o.letters(_KC)} AS ticker, "
    f"CASE WHEN {_OBJ} AND {_KC} % 2 = 0 THEN 'Board of ' || c_name "
    f"WHEN {_OBJ} AND {_KC} % 6 = 1 THEN NULL "
    f"WHEN {_KC} % {fx.NO_COMPANY_NAME_EVERY} = 0 THEN '' ELSE c_name END AS company_name, "
    f"CASE WHEN {_OBJ} THEN c_name END AS ceo_name, "
    f"CASE WHEN {_OBJ} THEN c_acctbal / 100.0 END AS insider_ownership_pct, "
    f"CASE WHEN {_OBJ} THEN CAST(c_nationkey AS DOUBLE) END AS institutional_ownership_pct, "
    f"CASE WHEN {_OBJ} AND {_KC} % 4 = 1 THEN CAST(c_nationkey + 3 AS BIGINT) END AS board_size, "
    f"CASE WHEN {_OBJ} AND {_KC} % 5 = 2 THEN CAST({_KC} % 8 AS BIGINT) END AS committee_seats, "
    f"CASE WHEN {_OBJ} AND {_KC} % 5 = 2 THEN c_name || ',chair' END AS committee_members, "
    f"CASE WHEN {_OBJ} AND {_KC} % 3 = 0 THEN {_KC} % 2 = 0 END AS listed "
    "FROM customer",
)
def q_flatten_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared keys become columns of their own type: a number, a flag and
    a nested object with a list."""
    docs = _landed(spark, fx.management_documents(spark, sf_dir), "management")
    rows = flatten.flatten_section(docs, "management", schemas.MANAGEMENT_SECTION)
    return rows.select(
        *[c for c in rows.columns if c != "committee"], F.col("committee.seats").alias("committee_seats"),
        F.array_join("committee.members", ",").alias("committee_members"),
    )


_BROKEN = '{"ticker":"X","financials":{'


def _bad_documents_sql(section: str, companies: str) -> str:
    return (
        f"SELECT '{section}' AS section, CAST(NULL AS VARCHAR) AS ticker, 'blank' AS reason, '' AS document FROM {companies} "
        f"WHERE k % {fx.BLANK_LINE_EVERY} = 0 UNION ALL SELECT '{section}' AS section, 'X' AS ticker, 'broken JSON' AS reason, "
        f"'{_BROKEN}' AS document FROM {companies} WHERE k % {fx.BROKEN_EVERY} = 0"
    )


@register(
    "quarantine",
    o.with_ctes(o.base_ctes(), " UNION ALL ".join([
        _bad_documents_sql("overview", "(SELECT c_custkey AS k FROM customer)"),
        _bad_documents_sql("financials", "(SELECT DISTINCT k FROM fin)"),
        _bad_documents_sql("valuation", "(SELECT DISTINCT k FROM val)"),
    ])),
)
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the extract step rejects, with the reason; the
    others are in bronze."""
    root, landing_root = scratch_path(spark, "lake"), scratch_path(spark, "landing")
    for section, docs in (
        ("overview", fx.overview_documents(spark, sf_dir)), ("financials", fx.financial_documents(spark, sf_dir)),
        ("valuation", fx.valuation_documents(spark, sf_dir)),
    ):
        raw.land(docs, f"{landing_root}/{section}/run_date={RUN_DATE}")
    weekly_run.bronze_from_landing(spark, landing_root, root, RUN_DATE)
    return weekly_run.quarantined(spark, root, RUN_DATE)


_PRICE_ROWS = (
    f"SELECT {o.letters('o_custkey')} AS ticker, "
    f"CASE WHEN o_orderkey % {fx.BAD_PRICE_DATE_EVERY} = 0 THEN 'n/a' "
    "WHEN o_orderkey % 7 = 3 THEN strftime(o_orderdate, '%-d %b %Y') WHEN o_orderkey % 7 = 4 THEN strftime(o_orderdate, '%Y%m%d') "
    "WHEN o_orderkey % 7 = 5 THEN strftime(o_orderdate, '%-m/%-d/%Y') "
    "WHEN o_orderkey % 7 = 6 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, o_totalprice AS close, "
    "CAST(o_orderdate AS DATE) AS d, o_orderpriority AS priority FROM orders"
)


@register("flatten_prices", f"SELECT ticker, date, close, priority FROM ({_PRICE_ROWS})")
def q_flatten_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed_keyed(spark, fx.price_pages(spark, sf_dir), "prices", "ticker string, value string")
    return flatten.flatten_prices(pages)


@register(
    "company_universe",
    f"SELECT position, {o.letters('k')} AS ticker FROM ("
    "SELECT c_custkey AS k, CAST(ROW_NUMBER() OVER (ORDER BY c_acctbal * 1000.0 DESC, "
    f"{o.letters('c_custkey')} ASC) - 1 AS BIGINT) AS position FROM customer "
    f"WHERE c_mktsegment = '{fx.UNIVERSE_SUB_SECTOR}') WHERE k % {fx.JUNK_SYMBOL_EVERY} <> 0",
)
def q_company_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed_keyed(
        spark, fx.company_list_pages(spark, sf_dir), "companies", "offset long, value string"
    )
    return flatten.company_universe(pages)


@register(
    "company_page",
    o.with_ctes(
        o.silver_ctes(),
        f"SELECT ticker, market_cap FROM sprof WHERE sub_sector = '{fx.UNIVERSE_SUB_SECTOR}' "
        f"ORDER BY market_cap DESC, ticker LIMIT {fx.PAGE_SIZE} OFFSET {fx.PAGE_SIZE}",
    ),
)
def q_company_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = scr.silver_profile(spark, sf_dir)
    page = flatten.company_page(prof, fx.UNIVERSE_SUB_SECTOR, fx.PAGE_SIZE, fx.PAGE_SIZE)
    return page.select("ticker", "market_cap")


@register(
    "company_pages_by_key",
    o.with_ctes(
        o.silver_ctes(),
        "SELECT ticker, market_cap, position FROM (SELECT ticker, market_cap, CAST(ROW_NUMBER() OVER (ORDER BY market_cap DESC, "
        "ticker) - 1 AS BIGINT) AS position, COUNT(*) OVER () AS n FROM sprof "
        f"WHERE sub_sector = '{fx.UNIVERSE_SUB_SECTOR}') "
        f"WHERE position // {fx.PAGE_SIZE} IN (0, ((n - 1) // {fx.PAGE_SIZE}) // 2, (n - 1) // {fx.PAGE_SIZE})",
    ),
)
def q_company_pages_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First, middle and last page of a sub-sector, each by seeking; the list
    of all companies is stored once."""
    path = paging.write_list(scr.silver_profile(spark, sf_dir), scratch_path(spark, "list"), fx.PAGE_SIZE)
    last = paging.last_page(spark, path, fx.UNIVERSE_SUB_SECTOR) or 0
    pages = [paging.read_page(spark, path, fx.UNIVERSE_SUB_SECTOR, p, fx.PAGE_SIZE) for p in sorted({0, last // 2, last})]
    return flatten.union_pages(pages).select("ticker", "market_cap", "position")


_OLD_API_BEFORE = "1998-01-01"


@register(
    "union_pages",
    f"SELECT ticker, date, close, CASE WHEN d < DATE '{_OLD_API_BEFORE}' THEN priority END AS priority "
    f"FROM ({_PRICE_ROWS})",
)
def q_union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.daily_price_rows(spark, sf_dir)
    old = F.coalesce(F.col("o_date") < F.lit(_OLD_API_BEFORE).cast("date"), F.lit(False))
    old_api = rows.where(old).select("ticker", "date", "close", "priority")
    new_api = rows.where(~old).select("ticker", "date", "close")
    return flatten.union_pages([old_api, new_api])


# ------------------------------------------------------------ prices (P) --
def _last_friday_sql(start: str, end: str, columns: str = "ticker, date, close") -> str:
    return (
        f"SELECT {columns} FROM ({_PRICE_ROWS}) WHERE date <> 'n/a' AND dayofweek(d) = 5 "
        f"AND month(d + INTERVAL 7 DAY) <> month(d) AND d BETWEEN DATE '{start}' AND DATE '{end}'"
    )


def _price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.daily_price_rows(spark, sf_dir).select("ticker", "date", "close")


_PRICE_START = f"{int(RUN_DATE[:4]) - 1}-01-01"
_DAY = "strftime(d, '%Y-%m-%d') AS run_date"


@register("last_friday_prices", _last_friday_sql(_PRICE_START, RUN_DATE))
def q_last_friday_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.last_friday_prices(_price_rows(spark, sf_dir), RUN_DATE)


@register(
    "price_partitions",
    f"SELECT run_date, COUNT(*) AS n_rows FROM ({_last_friday_sql(_PRICE_START, RUN_DATE, _DAY)}) GROUP BY run_date",
)
def q_price_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    rows = prices.last_friday_prices(_price_rows(spark, sf_dir), RUN_DATE)
    rows = rows.withColumn("run_date", prices.run_date_of(F.col("date")))
    lake.write_partitioned(rows, root, "bronze", DAILY_PRICES)
    return ingest.price_partitions(spark, root)


# Full load on a first run at the previous run date, then an incremental
# run on the next last Friday, then a Friday that is not a last Friday.
LOAD_SEQUENCE = (PREVIOUS_RUN_DATE, "2001-01-26", "2001-02-02")


@register(
    "load_dates",
    "SELECT run_date, COUNT(*) AS n_rows FROM ("
    + _last_friday_sql(f"{int(LOAD_SEQUENCE[0][:4]) - 1}-01-01", LOAD_SEQUENCE[0], _DAY)
    + f" UNION ALL SELECT {_DAY} FROM ({_PRICE_ROWS}) WHERE date <> 'n/a' AND d = DATE '{LOAD_SEQUENCE[1]}'"
    + ") GROUP BY run_date",
)
def q_load_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    rows = _price_rows(spark, sf_dir)
    for d in LOAD_SEQUENCE:
        ingest.load_prices(spark, rows, root, d)
    return ingest.price_partitions(spark, root)


# -------------------------------------------------------------- lake (S) --
FIN2 = o.base_ctes(TWO_RUNS) + ",\n" + o.bronze_fin_cte(L, False)


@register("read_partition", o.with_ctes(FIN2, f"SELECT {o.FIN_COLS} FROM bfin WHERE run_date = '{RUN_DATE}'"))
def q_read_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    lake.write_partitioned(fx.bronze_financials(spark, sf_dir, TWO_RUNS), root, "bronze", FINANCIALS)
    return lake.read_partition(spark, root, "bronze", FINANCIALS, RUN_DATE, schemas.BRONZE_FINANCIALS)


@register("write_partition_roundtrip", o.with_ctes(FIN2, f"SELECT {o.FIN_COLS} FROM bfin"))
def q_write_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    rows = materialize(fx.bronze_financials(spark, sf_dir, TWO_RUNS), "bronze_rows")  # written three times
    for d in (*TWO_RUNS, RUN_DATE):  # the last write is a rerun of the same run date
        lake.write_partition(rows.where(F.col("run_date") == d), root, "bronze", FINANCIALS, d)
    return lake.read_domain(spark, root, "bronze", FINANCIALS, schemas.BRONZE_FINANCIALS)


BACKFILL_RUNS = lake.backfill_run_dates(RUN_DATE, 2)


_KEPT = "CAST(period AS INTEGER) >= year(CAST(run_date AS DATE)) - 1"


@register(
    "backfill",
    o.with_ctes(
        o.base_ctes(BACKFILL_RUNS),
        f"SELECT '{FINANCIALS}' AS domain, run_date, {L} AS ticker, period, net_income AS amount, CAST(NULL AS VARCHAR) "
        f"AS name FROM fin WHERE {_KEPT} UNION ALL "
        f"SELECT '{VALUATION}' AS domain, run_date, {L} AS ticker, period, pbv AS amount, CAST(NULL AS VARCHAR) AS name "
        f"FROM val WHERE {_KEPT} UNION ALL "
        f"SELECT '{PROFILE}' AS domain, run_date, {L} AS ticker, CAST(NULL AS VARCHAR) AS period, market_cap AS amount, "
        "company_name AS name FROM prof",
    ),
)
def q_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three scheduled domains over two run dates, read back as one
    frame: a measure of each, and the company name."""
    root = scratch_path(spark, "lake")
    totals = materialize(fx.customer_year_totals(spark, sf_dir, BACKFILL_RUNS), "bronze_totals")  # three consumers
    status = lake.backfill_domains({
        PROFILE: fx.bronze_profile(spark, sf_dir, BACKFILL_RUNS, totals=totals),
        FINANCIALS: fx.bronze_financials(spark, sf_dir, BACKFILL_RUNS, totals=totals),
        VALUATION: fx.bronze_valuation(spark, sf_dir, BACKFILL_RUNS, totals=totals),
    }, root)
    failed = {d: x for d, x in status.items() if x != "ok"}
    if failed:
        raise RuntimeError(f"backfill failed: {failed}")

    def part(domain: str, schema, period: str | None, amount: str, name: str | None) -> DataFrame:
        df = lake.read_domain(spark, root, "bronze", domain, schema)
        null = F.lit(None).cast("string")
        return df.select(
            F.lit(domain).alias("domain"), "run_date", "ticker", (F.col(period) if period else null).alias("period"),
            F.col(amount).alias("amount"), (F.col(name) if name else null).alias("name"),
        )

    return (
        part(FINANCIALS, schemas.BRONZE_FINANCIALS, "period", "net_income", None)
        .unionAll(part(VALUATION, schemas.BRONZE_VALUATION, "period", "pbv", None))
        .unionAll(part(PROFILE, schemas.BRONZE_PROFILE, None, "market_cap", "company_name"))
    )


# -------------------------------------------------- warehouse (S7-S14) --
_CAL = (
    "SELECT CAST(d AS DATE) AS run_date, CAST(year(d) AS INTEGER) AS year, "
    "CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, "
    "CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofweek(d) AS INTEGER) AS day_of_week, "
    "dayofweek(d) = 5 AS is_friday FROM generate_series("
    "(SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders), (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders), "
    "INTERVAL 1 DAY) t(d)"
)


def _order_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return fx.table(spark, sf_dir, "orders").agg(F.min(d).alias("start"), F.max(d).alias("end"))


@register("dim_date", _CAL)
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_dim.calendar(_order_span(spark, sf_dir))


@register("insert_ignore", _CAL)
def q_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = _order_span(spark, sf_dir)
    existing = calendar_dim.calendar(span.select("start", F.lit(PREVIOUS_RUN_DATE).cast("date").alias("end")))
    return calendar_dim.insert_ignore(existing, calendar_dim.calendar(span), ["run_date"])


_PROFILE_ATTRS = ("company_name", "sector", "sub_sector", "market_cap", "listing_date")
_UPSERT_SQL = o.with_ctes(
    o.base_ctes(TWO_RUNS)
    + f""",
act AS (SELECT DISTINCT k FROM fin WHERE run_date = '{RUN_DATE}' AND period = '{RUN_DATE[:4]}'),
p1 AS (SELECT * FROM prof WHERE run_date = '{PREVIOUS_RUN_DATE}'),
p2 AS (SELECT * FROM prof WHERE run_date = '{RUN_DATE}')""",
    f"SELECT {o.letters('p1.k')} AS ticker, "
    f"CASE WHEN act.k IS NOT NULL THEN p2.company_name WHEN p1.k % {fx.NO_COMPANY_NAME_EVERY} = 0 THEN '' "
    "ELSE p1.company_name END AS company_name, "
    + ", ".join(
        f"{'CAST(' if c == 'listing_date' else ''}CASE WHEN act.k IS NOT NULL THEN p2.{c} "
        f"WHEN p1.k % {fx.NO_SECTION_EVERY} = 0 THEN NULL ELSE p1.{c} END"
        f"{' AS DATE)' if c == 'listing_date' else ''} AS {c}"
        for c in _PROFILE_ATTRS[1:]
    )
    + " FROM p1 JOIN p2 ON p1.k = p2.k LEFT JOIN act ON act.k = p1.k",
)


@register("upsert_company", _UPSERT_SQL)
def q_upsert_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_company after two loads: first from the landed overview reports
    of the previous run date, then from the clean profile of the run date
    for the companies that reported financials in the run year."""
    root = scratch_path(spark, "warehouse")
    docs = _landed(spark, fx.overview_documents(spark, sf_dir, PREVIOUS_RUN_DATE), "overview")
    warehouse.write_dim_company(spark, root, flatten.flatten_overview(docs))
    fin, prof = scr.silver_financials(spark, sf_dir), scr.silver_profile(spark, sf_dir)
    reported = fin.where(F.col("period") == RUN_DATE[:4]).select("run_date", "ticker")
    incoming = clean.unique_profile(prof).join(reported, ["run_date", "ticker"], "left_semi")
    warehouse.write_dim_company(spark, root, incoming)
    return warehouse.read_dim_company(spark, root).select("ticker", *_PROFILE_ATTRS)


FACT2 = o.metric_ctes(TWO_RUNS)
FACT_COLS = ", ".join(schemas.SCREENING_COLUMNS)


def _loaded_warehouse(spark: SparkSession, sf_dir: str, with_dim: bool = False) -> str:
    """Fact reloaded for both run dates (the second one twice), and
    optionally dim_company upserted from both profiles in one merge."""
    root = scratch_path(spark, "warehouse")
    fin, prof, val = _silver(spark, sf_dir, TWO_RUNS)
    # One computation of both run dates; each reload then reads it back.
    fact = materialize(scr.screening(fin, prof, val, run_date=None), "fact")

    def load_facts() -> None:
        for d in (*TWO_RUNS, RUN_DATE):
            warehouse.reload_fact(fact, root, d)

    def load_companies() -> None:
        warehouse.write_dim_company(spark, root, warehouse.newest_profiles(prof))

    concurrently(load_facts, *[load_companies] * with_dim)
    return root


@register("reload_fact", o.with_ctes(FACT2, f"SELECT {FACT_COLS} FROM fact"))
def q_reload_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _loaded_warehouse(spark, sf_dir)
    return warehouse.read_fact(spark, root).select(*schemas.SCREENING_COLUMNS)


@register(
    "fact_for_run",
    o.with_ctes(FACT2, f"SELECT {FACT_COLS} FROM fact WHERE run_date = DATE '{PREVIOUS_RUN_DATE}'"),
)
def q_fact_for_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _loaded_warehouse(spark, sf_dir)
    return warehouse.fact_for_run(spark, root, PREVIOUS_RUN_DATE).select(*schemas.SCREENING_COLUMNS)


@register(
    "latest_screening",
    o.with_ctes(
        FACT2,
        f"SELECT {', '.join('s.' + c for c in schemas.SCREENING_COLUMNS)}, CAST(p.listing_date AS DATE) "
        f"AS listing_date FROM fact s JOIN sprof p ON p.ticker = s.ticker AND p.run_date = '{RUN_DATE}' "
        "WHERE s.run_date = (SELECT MAX(run_date) FROM fact)",
    ),
)
def q_latest_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _loaded_warehouse(spark, sf_dir, with_dim=True)
    v = warehouse.latest_screening_of(spark, root)
    return v.select(*schemas.SCREENING_COLUMNS, "listing_date")


@register("latest_screening_view", ORACLE["latest_screening"])
def q_latest_screening_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a user's SQL on the catalog view, replaced after the loads."""
    database = f"ledgerlens_{uuid.uuid4().hex[:12]}"
    root = _loaded_warehouse(spark, sf_dir, with_dim=True)
    catalog.publish_views(spark, root, database)
    return spark.sql(f"SELECT * FROM {database}.{catalog.LATEST}")


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scr.screening_from_tables(spark, sf_dir, RUN_DATE)


@register(
    "run_summary",
    o.with_ctes(
        o.metric_ctes(),
        "SELECT COUNT(*) AS total, CAST(COALESCE(SUM(CASE WHEN status = 'LOLOS' THEN 1 ELSE 0 END), 0) AS BIGINT) "
        "AS passed, COUNT(*) - CAST(COALESCE(SUM(CASE WHEN status = 'LOLOS' THEN 1 ELSE 0 END), 0) AS BIGINT) "
        f"AS not_passed FROM fact WHERE run_date = DATE '{RUN_DATE}'",
    ),
)
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.run_summary(_fact(spark, sf_dir), RUN_DATE)


@register(
    "sector_summary",
    o.with_ctes(
        o.metric_ctes(),
        "SELECT sector, COUNT(*) AS total, CAST(SUM(CASE WHEN status = 'LOLOS' THEN 1 ELSE 0 END) AS BIGINT) "
        "AS passed, COUNT(*) - CAST(SUM(CASE WHEN status = 'LOLOS' THEN 1 ELSE 0 END) AS BIGINT) AS not_passed "
        f"FROM fact WHERE run_date = DATE '{RUN_DATE}' GROUP BY sector",
    ),
)
def q_sector_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.sector_summary(_fact(spark, sf_dir), RUN_DATE)


@register(
    "summaries",
    o.with_ctes(
        o.metric_ctes(),
        "SELECT CASE WHEN GROUPING(sector) = 1 THEN 'run' WHEN GROUPING(status) = 1 THEN 'sector' ELSE 'status' END AS level, "
        "sector, status, COUNT(*) AS total, CAST(COALESCE(SUM(CASE WHEN status = 'LOLOS' THEN 1 ELSE 0 END), 0) AS BIGINT) "
        "AS passed, COUNT(*) - CAST(COALESCE(SUM(CASE WHEN status = 'LOLOS' THEN 1 ELSE 0 END), 0) AS BIGINT) AS not_passed "
        f"FROM fact WHERE run_date = DATE '{RUN_DATE}' GROUP BY GROUPING SETS ((), (sector), (sector, status))",
    ),
)
def q_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.summaries(_fact(spark, sf_dir), RUN_DATE)


@register(
    "metric_counts",
    o.with_ctes(
        o.silver_ctes(),
        "SELECT m AS metric, (SELECT COUNT(*) FROM sfin) AS n_rows FROM (VALUES ('roe'), ('der'), ('fcf'), "
        "('growth')) t(m) UNION ALL SELECT 'valuation' AS metric, (SELECT COUNT(*) FROM sval) AS n_rows",
    ),
)
def q_metric_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin, _, val = _silver(spark, sf_dir)
    return warehouse.metric_counts(fin, val, RUN_DATE)


@register(
    "dim_fiscal_period",
    o.with_ctes(
        o.silver_ctes(),
        "SELECT DISTINCT period AS period_key, CAST(period AS INTEGER) AS fiscal_year, 12 AS fiscal_month, "
        "'annual' AS period_type FROM sfin",
    ),
)
def q_dim_fiscal_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return warehouse.dim_fiscal_period(fin)


@register("fundamentals_annual", o.with_ctes(o.silver_ctes(), f"SELECT ticker, period, {M} FROM sfin"))
def q_fundamentals_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = scr.silver_financials(spark, sf_dir)
    return warehouse.fundamentals_annual(fin, RUN_DATE)


@register(
    "valuation_snapshot",
    o.with_ctes(
        o.silver_ctes(),
        "SELECT ticker, CAST(run_date AS DATE) AS run_date, period, per, pbv, price, ev_ebitda FROM sval v "
        "WHERE period = (SELECT MAX(period) FROM sval w WHERE w.ticker = v.ticker AND w.run_date = v.run_date)",
    ),
)
def q_valuation_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.valuation_snapshot(scr.silver_valuation(spark, sf_dir), RUN_DATE)


# ----------------------------------------------------------- quality (Q) --
_BRONZE_COLS = [c for c in o.FIN_COLS.split(", ")]


@register(
    "quality_bronze",
    o.with_ctes(
        o.base_ctes() + ",\n" + o.bronze_fin_cte(L, False),
        o.suite_sql(
            quality.BRONZE_SUITE,
            "(SELECT * REPLACE (CASE WHEN total_debt > 0 THEN total_equity END AS total_equity) FROM bfin)", _BRONZE_COLS,
        ),
    ),
)
def q_quality_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing number in a frame can be a NaN; the suite counts it as NULL."""
    rows = fx.bronze_financials(spark, sf_dir)
    equity = F.when(F.col("total_debt") > 0, F.col("total_equity")).otherwise(F.lit(float("nan")))
    return quality.run_suite(rows.withColumn("total_equity", equity), quality.BRONZE_SUITE)


@register(
    "quality_gold",
    o.with_ctes(
        o.metric_ctes(), o.suite_sql(quality.GOLD_SUITE, "fact", list(schemas.SCREENING_COLUMNS))
    ),
)
def q_quality_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(_fact(spark, sf_dir), quality.GOLD_SUITE)


@register(
    "quality_over_dates",
    o.with_ctes(FACT2, o.suite_sql(quality.GOLD_SUITE, "fact", list(schemas.SCREENING_COLUMNS))),
)
def q_quality_over_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold suite over two run dates: the state of the first is stored
    before the second is loaded, whose rows alone are opened then."""
    root, suite = scratch_path(spark, "warehouse"), quality.GOLD_SUITE
    fin, prof, val = _silver(spark, sf_dir, TWO_RUNS)
    fact = materialize(scr.screening(fin, prof, val, run_date=None), "fact")
    for d in TWO_RUNS:
        warehouse.reload_fact(fact, root, d)
        opened = quality_state.refresh(spark, root, warehouse.LAYER, warehouse.FACT, suite, schemas.FCT_SCREENING)
        if opened != [d]:
            raise RuntimeError(f"opened {opened} instead of {d}")
    return quality_state.report(spark, root, warehouse.LAYER, warehouse.FACT, suite, schemas.FCT_SCREENING)


# --------------------------------------------------------- streaming -----
@register(
    "stream_financials",
    o.with_ctes(
        o.base_ctes(),
        f"SELECT {L} AS ticker, period, {_TOLD_REVENUE} AS revenue, gross_profit, net_income, total_assets, "
        "total_equity, total_debt, operating_cash_flow, "
        "operating_cash_flow - (operating_cash_flow - capex) AS capex, "
        "CASE (k + CAST(period AS INTEGER)) % 3 WHEN 0 THEN eps WHEN 1 THEN gross_profit / "
        f"{fx.EPS_PER_SHARE_DIVISOR} ELSE NULL END AS eps, run_date "
        f"FROM fin WHERE k % {fx.NO_SECTION_EVERY} <> 0 AND CAST(period AS INTEGER) >= {_CUT}",
    ),
)
def q_stream_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed financials reports -> bronze through the incremental stream;
    a second run with nothing new landed adds nothing."""
    root = scratch_path(spark, "lake")
    landing_dir = raw.land(fx.financial_documents(spark, sf_dir), scratch_path(spark, "landing"))
    ckpt = scratch_path(spark, "stream-checkpoint")
    landing.ingest_financial_reports(spark, landing_dir, root, RUN_DATE, ckpt)
    landing.ingest_financial_reports(spark, landing_dir, root, RUN_DATE, ckpt)
    out = landing.read_ingested(spark, root)
    return out.select(*[c for c in o.FIN_COLS.split(", ")])


# A year's growth is measured against the size of the year before it, the
# five-year rate against the size five reported years back.
EPS_GROWTH_STATEMENT = """
    WITH history AS (
        SELECT ticker, period, eps, try_element_at(past, -2) AS last_year, try_element_at(past, -6) AS base
        FROM (SELECT ticker, period, eps,
                     collect_list(named_struct('eps', eps)) OVER
                         (PARTITION BY ticker ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS past
              FROM {silver} WHERE run_date = :run_date))
    SELECT ticker, period, try_divide(eps - last_year.eps, abs(last_year.eps)) AS eps_growth_yoy,
           round(nanvl(power(try_divide(eps, abs(base.eps)), 0.2D) - 1D, NULL), 9) AS eps_cagr_5y
    FROM history"""


@register("eps_growth_sql", ORACLE["eps_growth"])
def q_eps_growth_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 as a user's statement with a bound :run_date parameter (F8)."""
    return metric_sql(spark, EPS_GROWTH_STATEMENT, RUN_DATE, silver=scr.silver_financials(spark, sf_dir))


# ------------------------------------------------- K4 through the lake ---
@register(
    "weekly_run",
    o.with_ctes(o.metric_ctes(TWO_RUNS, dirty_input=True), f"SELECT {FACT_COLS} FROM fact"),
)
def q_weekly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of two run dates landed in one job, dirty and with repeated
    rows, then one weekly run per run date with all gates enforced (their
    bounds are parameters, chosen here for any number of companies), the
    last one rerun."""
    root, wh = scratch_path(spark, "lake"), scratch_path(spark, "warehouse")
    totals = materialize(fx.customer_year_totals(spark, sf_dir, TWO_RUNS), "bronze_totals")
    given = {"dirty": True, "duplicates": True, "totals": totals}
    concurrently(*[
        lambda domain=domain, frame=frame: lake.write_partitioned(frame, root, "bronze", domain)
        for domain, frame in (
            (FINANCIALS, fx.bronze_financials(spark, sf_dir, TWO_RUNS, **given)),
            (PROFILE, fx.bronze_profile(spark, sf_dir, TWO_RUNS, **given)),
            (VALUATION, fx.bronze_valuation(spark, sf_dir, TWO_RUNS, **given)),
        )
    ])
    for d in (*TWO_RUNS, RUN_DATE):
        weekly_run.run_week(
            spark, root, wh, d,
            bronze_suite=quality.bronze_suite(1, None, r"^(?i)[A-Z]{4,14}(\.JK)?$"),
            gold_suite=quality.gold_suite(mostly=GOLD_MOSTLY),
        )
    return warehouse.read_fact(spark, wh).select(*schemas.SCREENING_COLUMNS)


@register("screening_incremental", o.with_ctes(FACT2, f"SELECT {FACT_COLS} FROM fact"))
def q_screening_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two run dates of silver; the second one's fact is computed for the
    companies whose rows changed and copied for the others."""
    root, wh = scratch_path(spark, "lake"), scratch_path(spark, "warehouse")
    fin, prof, val = _silver(spark, sf_dir, TWO_RUNS)
    concurrently(*[
        lambda domain=domain, frame=frame: lake.write_partitioned(frame, root, "silver", domain)
        for domain, frame in ((FINANCIALS, fin), (PROFILE, prof), (VALUATION, val))
    ])
    weekly_run.gold_step(spark, root, wh, PREVIOUS_RUN_DATE, previous="none yet")
    weekly_run.gold_step(spark, root, wh, RUN_DATE, previous=PREVIOUS_RUN_DATE)
    return warehouse.read_fact(spark, wh).select(*schemas.SCREENING_COLUMNS)
