"""Screening inputs shaped from the driver's TPC-H style tables.

FIXTURES.md part B (and part C for the landed documents) define the
mapping: a customer is a company, an order year is a fiscal period and the
order/line sums are the statement measures. Everything here is a lazy
DataFrame plan over the given tables, so the work grows with them.

Plan shape at scale: lineitem is reduced to one row per order before it
meets orders (a map-side partial aggregate on ``l_orderkey``, and that
exchange also serves the join), orders are read once, and a single
aggregate on (run_date, customer, year) produces both the line and the
order totals. Small dimensions (nation, region) are left to AQE, which
broadcasts them after measuring them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.config import RUN_DATE
from ledgerlens.session import materialize

# --- fixed values: fixture rules of FIXTURES.md part B and part C ---
MONEY = T.DecimalType(18, 2)
NULL_REVENUE_EVERY = 37        # revenue forced NULL when k % 37 = 0
DUPLICATE_EVERY = 5            # k % 5 = 0 rows repeated with revenue + 1
BAD_PRICE_DATE_EVERY = 97      # price date 'n/a' when o_orderkey % 97 = 0
# Forms a price date is written in by o_orderkey % 7 (ISO otherwise).
PRICE_DATE_FORMS = {3: "d MMM yyyy", 4: "yyyyMMdd", 5: "M/d/yyyy", 6: "yyyy-MM-dd'T'HH:mm:ss"}
NO_COMPANY_NAME_EVERY = 11     # report without company_name when k % 11 = 0
NO_SECTION_EVERY = 13          # report without its section when k % 13 = 0
NON_OBJECT_SECTION_EVERY = 7   # generic section is a list when k % 7 = 0
JUNK_SYMBOL_EVERY = 29         # company list symbol ' .jk' when k % 29 = 0
EPS_PER_SHARE_DIVISOR = 1000   # eps = net_income / 1000; market_cap = c_acctbal * 1000
LETTERS = 14                   # base-26 digits of the largest BIGINT
FRACTION_YEAR_EVERY = 17       # years written like 2000.0 when k % 17 = 0
TEXT_MEASURE_EVERY = 19        # revenue 'n/a' in the report when k % 19 = 0
BLANK_LINE_EVERY = 23          # a blank line is landed as well when k % 23 = 0
BROKEN_EVERY = 31              # a broken document is landed as well when k % 31 = 0
UNIVERSE_SUB_SECTOR = "BUILDING"
PAGE_SIZE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def letters(k: Column | str) -> Column:
    """Capitals, base 26, most significant first: at least four, and more
    where the key needs them, so every BIGINT key has a ticker of its own."""
    key = (F.col(k) if isinstance(k, str) else k).cast("long")

    def digit(place: int) -> Column:
        return F.char(F.call_function("div", key, F.lit(26**place)) % 26 + F.lit(65))

    leading = [F.when(key >= F.lit(26**p), digit(p)).otherwise(F.lit("")) for p in range(LETTERS - 1, 3, -1)]
    return F.concat(*leading, *[digit(p) for p in range(3, -1, -1)])


def dirty_ticker(k: Column | str, plain: Column | None = None) -> Column:
    """Lower case + '.jk' when k % 3 = 0, '.JK' when k % 3 = 1, plain otherwise."""
    key = F.col(k) if isinstance(k, str) else k
    t = letters(key) if plain is None else plain
    return (
        F.when(key % 3 == 0, F.concat(F.lower(t), F.lit(".jk")))
        .when(key % 3 == 1, F.concat(t, F.lit(".JK")))
        .otherwise(t)
    )


def _cents(c: Column) -> Column:
    """Exact cents of CAST(c AS DECIMAL(18,2)) as a long.

    Sums of these longs equal the DECIMAL sums exactly, but stay on the
    fast fixed-width aggregation path (a DECIMAL(18,2) sum is 28 digits
    wide and would aggregate through BigDecimal buffers).

    The cast itself is skipped where it cannot change the result: when
    |c| < 1e10 and c * 100 lies within 0.25 of an integer, rounding c to
    cents (HALF_UP on its decimal form) gives that integer, because the
    gap between c's decimal form and the double is below 1e-3 cents in
    that range. Every other value (a half-cent tie, NaN, out of range)
    goes through the DECIMAL cast, with its errors.
    """
    y = c * F.lit(100.0)
    near_whole = (F.abs(c) < F.lit(1e10)) & (F.abs(y - F.rint(y)) < F.lit(0.25))
    exact = (c.cast(MONEY) * F.lit(100)).cast("long")
    return F.when(near_whole, F.rint(y).cast("long")).otherwise(exact)


def _zero() -> Column:
    return F.lit(0).cast("long")


def _run_dates(run_dates: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.lit(d) for d in run_dates]))


def _with_band(df: DataFrame, run_dates: Sequence[str], date_col: str) -> DataFrame:
    """Rows up to the last run date, with ``band``: the place of the first
    run date that sees the row. Rows are aggregated per band and only then
    repeated for the run dates (``_seen_by``), so what is shuffled does
    not grow with the number of run dates."""
    dates = sorted(set(run_dates))
    day = F.col(date_col)
    band = F.lit(0)
    for d in dates[:-1]:
        band = band + (day > F.to_date(F.lit(d))).cast("int")
    return df.where(day <= F.to_date(F.lit(dates[-1]))).withColumn("band", band)


def _seen_by(df: DataFrame, run_dates: Sequence[str]) -> DataFrame:
    """Banded rows once for every run date that sees them."""
    dates = sorted(set(run_dates))
    every = F.array(*[F.lit(d) for d in dates])
    later = F.slice(every, F.col("band") + 1, F.lit(len(dates)))
    return df.select("*", F.explode(later).alias("run_date")).drop("band")


def customer_year_totals(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,)
) -> DataFrame:
    """Exact sums per (run_date, customer, order year), in cents.

    A run date sees the orders up to that day. Columns: run_date, k, year,
    first_date, rev, gp, ni, ta, td, ocf, capex (long cents).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        _cents(F.col("l_extendedprice")).alias("amt"),
        "l_returnflag",
        "l_linestatus",
    )
    flag, status, amt = F.col("l_returnflag"), F.col("l_linestatus"), F.col("amt")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(amt).alias("o_rev"),
        F.sum(F.when(flag != "R", amt).otherwise(_zero())).alias("o_gp"),
        F.sum(F.when(flag == "N", amt).otherwise(_zero())).alias("o_n"),
        F.sum(F.when(flag == "R", amt).otherwise(_zero())).alias("o_r"),
        F.sum(F.when(status == "F", amt).otherwise(_zero())).alias("o_ocf"),
        F.sum(F.when((status == "F") & (flag == "R"), amt).otherwise(_zero())).alias("o_capex"),
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("k"),
        F.to_date("o_orderdate").alias("o_date"),
        _cents(F.col("o_totalprice")).alias("o_ta"),
        F.when(F.col("o_orderstatus") == "O", _cents(F.col("o_totalprice")))
        .otherwise(_zero())
        .alias("o_td"),
    )
    orders = _with_band(orders, run_dates, "o_date")
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    sums = ("rev", "gp", "n", "r", "ta", "td", "ocf", "capex")
    banded = joined.groupBy("k", F.year("o_date").alias("year"), "band").agg(
        F.min("o_date").alias("first_date"), *[F.sum(f"o_{c}").alias(c) for c in sums]
    )
    seen = _seen_by(banded, run_dates)
    if len(set(run_dates)) > 1:
        seen = seen.groupBy("run_date", "k", "year").agg(
            F.min("first_date").alias("first_date"), *[F.sum(c).alias(c) for c in sums]
        )
    return seen.select(
        "run_date", "k", "year", "first_date", "rev", "gp", (F.col("n") - F.col("r")).alias("ni"),
        "ta", "td", "ocf", "capex",
    )


def _d(c: str | Column) -> Column:
    """Cents -> DOUBLE, the same value as CAST(decimal sum AS DOUBLE)."""
    return (F.col(c) if isinstance(c, str) else c).cast("double") / F.lit(100.0)


def financial_rows(totals: DataFrame) -> DataFrame:
    """Statement measures per (run_date, k, period) as doubles."""
    ni = _d("ni")
    return totals.select(
        "run_date",
        "k",
        F.col("year").cast("string").alias("period"),
        F.when(F.col("k") % NULL_REVENUE_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(_d("rev"))
        .alias("revenue"),
        _d("gp").alias("gross_profit"),
        ni.alias("net_income"),
        _d("ta").alias("total_assets"),
        _d(F.col("ta") - F.col("td")).alias("total_equity"),
        _d("td").alias("total_debt"),
        _d("ocf").alias("operating_cash_flow"),
        _d("capex").alias("capex"),
        (ni / F.lit(EPS_PER_SHARE_DIVISOR)).alias("eps"),
        _d("rev").alias("revenue_unforced"),
    )


def valuation_rows(fin: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """per, pbv, price, ev_ebitda per (run_date, k, period)."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    return fin.join(cust, "k", "left").select(
        "run_date",
        "k",
        "period",
        (F.col("revenue_unforced") / F.nullif(F.col("net_income"), F.lit(0.0))).alias("per"),
        (F.col("total_assets") / F.nullif(F.col("total_equity"), F.lit(0.0))).alias("pbv"),
        F.col("c_acctbal").alias("price"),
        (F.col("total_debt") / F.nullif(F.col("operating_cash_flow"), F.lit(0.0))).alias(
            "ev_ebitda"
        ),
    )


def _with_letters(df: DataFrame) -> DataFrame:
    """The letters in a projection of their own, so that generated code holds
    them once: inlined three times, its method is too long to be compiled."""
    return df.withColumn("_letters", letters("k"))


def _ticker(dirty: bool) -> Column:
    return dirty_ticker("k", F.col("_letters")) if dirty else F.col("_letters")


FIN_OUT = (
    "ticker", "period", "revenue", "gross_profit", "net_income", "total_assets",
    "total_equity", "total_debt", "operating_cash_flow", "capex", "eps", "run_date",
)


def bronze_financials(
    spark: SparkSession,
    sf_dir: str,
    run_dates: Sequence[str] = (RUN_DATE,),
    dirty: bool = False,
    duplicates: bool = False,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Bronze financial_statements rows (FIXTURES.md A7 shape + run_date)."""
    fin = financial_rows(_totals(spark, sf_dir, run_dates, totals))
    out = _with_letters(fin).select(_ticker(dirty).alias("ticker"), "k", *FIN_OUT[1:])
    if duplicates:
        again = out.where(F.col("k") % DUPLICATE_EVERY == 0).withColumn(
            "revenue", F.col("revenue") + F.lit(1.0)
        )
        out = out.unionByName(again)
    return out.select(*FIN_OUT)


def bronze_valuation(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,), dirty: bool = False,
    duplicates: bool = False, totals: DataFrame | None = None,
) -> DataFrame:
    """Bronze valuation_ratios rows (FIXTURES.md A8 shape + run_date)."""
    fin = financial_rows(_totals(spark, sf_dir, run_dates, totals))
    val = valuation_rows(fin, spark, sf_dir)
    if duplicates:  # the larger ratio is the one that stays
        val = val.unionByName(
            val.where(F.col("k") % DUPLICATE_EVERY == 0).withColumn("per", F.col("per") + F.lit(1.0))
        )
    return _with_letters(val).select(
        _ticker(dirty).alias("ticker"), "period", "per", "pbv", "price", "ev_ebitda", "run_date"
    )


def _totals(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str], totals: DataFrame | None
) -> DataFrame:
    return totals if totals is not None else customer_year_totals(spark, sf_dir, run_dates)


def first_order_dates(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,),
    totals: DataFrame | None = None,
) -> DataFrame:
    """First order date per (run_date, customer).

    From the yearly totals when they are already at hand (one row per
    customer and year, so the aggregate is small); otherwise straight
    from orders, without touching lineitem."""
    if totals is not None:
        return totals.groupBy("run_date", "k").agg(F.min("first_date").alias("first_date"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("o_date")
    )
    banded = _with_band(orders, run_dates, "o_date").groupBy("k", "band").agg(F.min("o_date").alias("first_date"))
    return _seen_by(banded, run_dates).groupBy("run_date", "k").agg(F.min("first_date").alias("first_date"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer with its region name (nation and region are tiny dimensions)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("k"), "c_name", "r_name", "c_mktsegment", "c_acctbal"
        )
    )


def bronze_profile(
    spark: SparkSession, sf_dir: str, run_dates: Sequence[str] = (RUN_DATE,), dirty: bool = False,
    duplicates: bool = False, totals: DataFrame | None = None,
) -> DataFrame:
    """Bronze company_profile rows (FIXTURES.md A6 shape + run_date)."""
    cust = customers(spark, sf_dir).select("*", _run_dates(run_dates).alias("run_date"))
    first = first_order_dates(spark, sf_dir, run_dates, totals)
    if duplicates:  # the greater name is the one that stays
        again = cust.where(F.col("k") % DUPLICATE_EVERY == 0)
        cust = cust.unionByName(again.withColumn("c_name", F.concat("c_name", F.lit(" II"))))
    return _with_letters(cust.join(first, ["run_date", "k"], "left")).select(
        _ticker(dirty).alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("r_name").alias("sector"),
        F.col("c_mktsegment").alias("sub_sector"),
        (F.col("c_acctbal") * F.lit(float(EPS_PER_SHARE_DIVISOR))).alias("market_cap"),
        F.date_format("first_date", "yyyy-MM-dd").alias("listing_date"),
        "run_date",
    )


# --------------------------------------------------------------------------
# Landed documents (FIXTURES.md part C): the nested JSON a report API
# returns, one document per company and section, built from the rows above.


def _report(k: Column, section: str, body: Column) -> Column:
    """{"ticker", "company_name"?, section?} with the fixture's omissions."""
    return F.to_json(
        F.struct(
            letters(k).alias("ticker"),
            F.when(k % NO_COMPANY_NAME_EVERY != 0, F.col("c_name")).alias("company_name"),
            F.when(k % NO_SECTION_EVERY != 0, body).alias(section),
        )
    )


def _with_junk(docs: DataFrame) -> DataFrame:
    """(k, value) documents -> value, with blank and broken lines added."""
    k = F.col("k")
    junk = F.array_compact(F.array(
        F.when(k % BLANK_LINE_EVERY == 0, F.lit("")), F.when(k % BROKEN_EVERY == 0, F.lit('{"ticker":"X","financials":{'))
    ))
    return docs.select(F.explode(F.concat(F.array("value"), junk)).alias("value"))


def overview_documents(spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE) -> DataFrame:
    first = first_order_dates(spark, sf_dir, (run_date,)).drop("run_date")
    base = customers(spark, sf_dir).join(first, "k", "left")
    body = F.struct(
        F.col("r_name").alias("sector"),
        F.col("c_mktsegment").alias("sub_sector"),
        (F.col("c_acctbal") * F.lit(float(EPS_PER_SHARE_DIVISOR))).alias("market_cap"),
        F.date_format("first_date", "yyyy-MM-dd").alias("listing_date"),
    )
    return _with_junk(base.select("k", _report(F.col("k"), "overview", body).alias("value")))


def financial_documents(spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE) -> DataFrame:
    """One financials report per company: yearly array + eps map by year.

    The eps map holds a year when (k + year) % 3 = 1 (value gross_profit /
    1000) and holds it with a null eps when (k + year) % 3 = 2; otherwise
    the year is missing and the array element's eps applies.
    """
    fin = financial_rows(customer_year_totals(spark, sf_dir, (run_date,)))
    sel = (F.col("k") + F.col("period").cast("int")) % 3
    year_row = F.struct(
        F.col("period").cast("int").alias("year"),
        F.col("revenue"),
        F.col("gross_profit"),
        F.col("net_income").alias("earnings"),
        F.col("total_assets"),
        F.col("total_equity"),
        F.col("total_debt"),
        F.col("operating_cash_flow"),
        (F.col("operating_cash_flow") - F.col("capex")).alias("free_cash_flow"),
        F.col("eps"),
    )
    eps_entry = F.when(
        sel != 0,
        F.struct(
            F.when(sel == 1, F.col("gross_profit") / F.lit(EPS_PER_SHARE_DIVISOR)).alias("eps")
        ),
    )
    per_company = fin.groupBy("k").agg(
        F.sort_array(F.collect_list(F.struct(F.col("period"), year_row.alias("row")))).alias(
            "years"
        ),
        F.map_from_entries(
            F.collect_list(F.when(sel != 0, F.struct(F.col("period"), eps_entry)))
        ).alias("eps_map"),
    )
    names = customers(spark, sf_dir).select("k", "c_name")
    body = F.struct(
        F.col("eps_map").alias("historical_eps"),
        F.transform("years", lambda y: y["row"]).alias("historical_financials"),
    )
    value = _report(F.col("k"), "financials", body)
    value = F.when(F.col("k") % FRACTION_YEAR_EVERY == 0, F.regexp_replace(value, r'"year":(\d+)', r'"year":$1.0')).otherwise(value)
    value = F.when(F.col("k") % TEXT_MEASURE_EVERY == 0, F.regexp_replace(value, r'"revenue":[^,}]*', '"revenue":"n/a"')).otherwise(value)
    return _with_junk(per_company.join(names, "k", "left").select("k", value.alias("value")))


def valuation_documents(spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE) -> DataFrame:
    fin = financial_rows(customer_year_totals(spark, sf_dir, (run_date,)))
    val = valuation_rows(fin, spark, sf_dir)
    per_company = val.groupBy("k").agg(
        F.max("price").alias("price"),  # one price per company
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("period"),
                    F.struct(
                        F.col("period").cast("int").alias("year"),
                        F.col("per").alias("pe"),
                        F.col("pbv").alias("pb"),
                        F.col("ev_ebitda").alias("enterprise_to_ebitda"),
                    ).alias("row"),
                )
            )
        ).alias("years"),
    )
    names = customers(spark, sf_dir).select("k", "c_name")
    body = F.struct(
        F.col("price").alias("last_close_price"),
        F.transform("years", lambda y: y["row"]).alias("historical_valuation"),
    )
    value = _report(F.col("k"), "valuation", body)
    value = F.when(F.col("k") % FRACTION_YEAR_EVERY == 0, F.regexp_replace(value, r'"year":(\d+)', r'"year":$1.0')).otherwise(value)
    return _with_junk(per_company.join(names, "k", "left").select("k", value.alias("value")))


def management_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section without a dedicated flattener (FIXTURES.md A12).

    ceo_name = c_name; insider_ownership_pct = c_acctbal / 100;
    institutional_ownership_pct = c_nationkey; company_name repeated inside
    the section as 'Board of ' || c_name when k % 2 = 0 (a name clash the
    section wins) and as null when k % 6 = 1; a key without a declared type,
    board_size, when k % 4 = 1; a nested one, committee, with a number and a
    list when k % 5 = 2; a flag, listed, when k % 3 = 0; insider_ownership_pct written as text when
    k % 9 = 4; a list instead of an object when k % 7 = 0.
    """
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_name", "c_acctbal", "c_nationkey"
    )
    k = F.col("k")
    fields = F.struct(
        F.when(k % 2 == 0, F.concat(F.lit("Board of "), F.col("c_name"))).alias("company_name"),
        F.col("c_name").alias("ceo_name"),
        (F.col("c_acctbal") / F.lit(100.0)).alias("insider_ownership_pct"),
        F.col("c_nationkey").cast("double").alias("institutional_ownership_pct"),
        F.when(k % 4 == 1, F.col("c_nationkey") + 3).alias("board_size"),
        F.when(
            k % 5 == 2, F.struct((k % 8).alias("seats"), F.array(F.col("c_name"), F.lit("chair")).alias("members"))
        ).alias("committee"),
        F.when(k % 3 == 0, k % 2 == 0).alias("listed"),
    )
    obj = F.when(k % 6 == 1, F.to_json(fields, {"ignoreNullFields": "false"})).otherwise(F.to_json(fields))
    as_text = F.regexp_replace(obj, r'"insider_ownership_pct":([^,}]*)', r'"insider_ownership_pct":"$1"')
    obj = F.when(k % 9 == 4, as_text).otherwise(obj)
    section = F.when(k % NON_OBJECT_SECTION_EVERY == 0, F.lit('["not", "an", "object"]')).otherwise(
        obj
    )
    name = F.when(k % NO_COMPANY_NAME_EVERY != 0, F.to_json(F.struct(F.col("c_name").alias("n"))))
    # A report is assembled as text so that the section may be any JSON value.
    return cust.select(
        F.concat(
            F.lit('{"ticker":"'),
            letters(k),
            F.lit('"'),
            F.coalesce(
                F.concat(F.lit(',"company_name":'), F.regexp_extract(name, r'^\{"n":(.*)\}$', 1)),
                F.lit(""),
            ),
            F.lit(',"management":'),
            section,
            F.lit("}"),
        ).alias("value")
    )


def daily_price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price record per order: ticker, date text (in several forms, 'n/a'
    sometimes), close."""
    o = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    for rest, form in PRICE_DATE_FORMS.items():
        written = F.date_format(F.col("o_orderdate").cast("date").cast("timestamp"), form)
        day = F.when(F.col("o_orderkey") % (len(PRICE_DATE_FORMS) + 3) == rest, written).otherwise(day)
    return o.select(
        F.col("o_custkey").alias("k"),
        letters("o_custkey").alias("ticker"),
        F.when(F.col("o_orderkey") % BAD_PRICE_DATE_EVERY == 0, F.lit("n/a"))
        .otherwise(day)
        .alias("date"),
        F.col("o_totalprice").alias("close"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderkey",
        F.to_date("o_orderdate").alias("o_date"),
    )


def price_pages(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Landed price pages: a JSON list of at most ``page_size`` records
    of one company, or one bare record when a page holds a single one.
    Columns: ticker, value. A page that does not parse is added for some
    companies, and every fifth page writes its closes as text.

    Pages are cut from a global row index over (ticker, order key), so
    a company with a huge share of all orders still gives bounded pages.
    """
    rows = daily_price_rows(spark, sf_dir)
    ranked = with_row_index(
        rows.select("k", "ticker", "o_orderkey", "date", "close", "priority"),
        [F.col("ticker").asc(), F.col("o_orderkey").asc()],
    )
    rec = F.struct("row_index", F.struct("date", "close", "priority").alias("r"))
    block = F.floor(F.col("row_index") / F.lit(page_size))
    pages = ranked.groupBy("k", "ticker", block.alias("block")).agg(
        F.sort_array(F.collect_list(rec)).alias("recs")
    )
    records = F.transform("recs", lambda x: x["r"])
    value = F.when(F.size("recs") == 1, F.to_json(F.element_at(records, 1))).otherwise(F.to_json(records))
    value = F.when(
        F.col("block") % 5 == 0, F.regexp_replace(value, r'"close":([^,}]*)', r'"close":"$1"')
    ).otherwise(value)
    broken = F.when(F.col("k") % BROKEN_EVERY == 0, F.lit('[{"date":"2001-01-'))
    return pages.select("ticker", F.explode(F.array_compact(F.array(value, broken))).alias("value"))


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """A dense 0-based position in a total order, computed without one task.

    The rows are range-partitioned and sorted; each row gets its partition
    id and in-partition position, the result is written once (so both
    passes see the same ids), and a table of per-partition counts (one row
    per partition, so its size is bounded) gives the offsets.
    """
    tagged = materialize(
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()),
        "row_index",
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
        .drop("_pid", "_mid", "_off")
    )


def company_list_pages(
    spark: SparkSession, sf_dir: str, sub_sector: str = UNIVERSE_SUB_SECTOR, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Landed company-list pages for one sub-sector, by market cap descending.

    Columns: offset (the request offset), value (the page JSON). Symbols
    are dirty tickers; k % 29 = 0 gives a junk symbol that normalises to ''.
    """
    cust = customers(spark, sf_dir).where(F.col("c_mktsegment") == sub_sector)
    cust = cust.select(
        "k",
        (F.col("c_acctbal") * F.lit(float(EPS_PER_SHARE_DIVISOR))).alias("market_cap"),
        letters("k").alias("ticker"),
        F.when(F.col("k") % JUNK_SYMBOL_EVERY == 0, F.lit(" .jk"))
        .otherwise(dirty_ticker("k"))
        .alias("symbol"),
    )
    ranked = with_row_index(cust, [F.col("market_cap").desc(), F.col("ticker").asc()])
    total = ranked.count()  # one scalar; the row_index pass already materialised the rows
    pages = ranked.groupBy(F.floor(F.col("row_index") / page_size).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("row_index", "symbol"))).alias("entries")
    )
    offset = (F.col("page") * page_size).cast("long")
    shown = F.size("entries")
    body = F.struct(
        F.transform("entries", lambda e: F.struct(e["symbol"].alias("symbol"))).alias("results"),
        F.struct(
            (offset + shown < F.lit(total)).alias("has_next"),
            (offset + shown).alias("next_offset"),
            F.lit(total).cast("long").alias("total_count"),
            shown.alias("showing"),
        ).alias("pagination"),
    )
    return pages.select(offset.alias("offset"), F.to_json(body).alias("value"))
