"""Nested report JSON -> flat domain rows (F1-F5), company universe
and the union of pages with differing columns (U1).

The scheduled sections are parsed with an explicit schema, any other one and
price records as VARIANT (no inference pass over the text). Measures are read
as text and cast once here, so a number written as a string survives like it
does in a dict; a value that is no number is NULL and does not end the job. A document that is not a JSON object (a blank line
included) is dropped and counted with an ``Observation``: one bad report
costs that report only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.config import CUTOFF_YEARS_BACK
from ledgerlens.functions.expressions import cutoff_year, nan_to_null, normalize_ticker
from ledgerlens.session import materialize

CORRUPT = "_corrupt_record"


def parse_reports(
    raw: DataFrame, section: str, section_type: T.DataType, observation: Observation | str | None = None
) -> DataFrame:
    """value (JSON text) -> ticker, company_name, <section>.

    A document that is not a JSON object is dropped (the original skips such
    a report with a warning). With ``observation`` (a name, on a stream) the
    numbers of documents and of malformed ones are collected by the same job
    that reads them, without an extra pass.
    """
    schema = schemas.report_schema(section, section_type).add(CORRUPT, T.StringType())
    parsed = raw.select(
        F.from_json(
            "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        ).alias("r")
    )
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    if observation is not None:
        parsed = parsed.observe(observation, *_counted(bad))
    return parsed.where(~bad).select("r.*").drop(CORRUPT)


REASONS = ("blank", "no JSON object", "broken JSON")


def reject_reason(value: Column, bad: Column) -> Column:
    """Why a document is no report; NULL for one that is."""
    text = F.trim(F.coalesce(value, F.lit("")))
    blank, other, broken = map(F.lit, REASONS)
    return F.when(bad, F.when(text == "", blank).when(text.startswith("{"), broken).otherwise(other))


def _split(
    read: DataFrame, bad: Column, fields: Sequence[Column], section: str, metrics: Sequence[Column] = (),
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents (value and whatever ``fields`` need) -> (their fields, the
    rejected ones). Both are read back from one write, partitioned by which
    they are, so the text is parsed once and each side opens its own files."""
    tagged = read.select(
        *fields, F.when(bad, F.col("value")).alias("_document"), reject_reason(F.col("value"), bad).alias("_reason"),
        F.coalesce(bad, F.lit(False)).alias("_rejected"),
    )
    if observation is not None:
        tagged = tagged.observe(observation, *_counted(F.col("_rejected")), *metrics)
    both = materialize(tagged, f"split_{section}", partition_by="_rejected")
    ticker = F.regexp_extract("_document", r'"ticker"\s*:\s*"([^"]*)"', 1)
    rejected = both.where("_rejected").select(
        F.lit(section).alias("section"), F.nullif(ticker, F.lit("")).alias("ticker"),
        F.col("_reason").alias("reason"), F.col("_document").alias("document"),
    )
    return both.where("NOT _rejected").drop("_document", "_reason", "_rejected"), rejected


def split_reports(
    raw: DataFrame, section: str, section_type: T.DataType, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """One pass over landed documents: (the parsed reports, the rejected
    documents). Rejected: section, ticker (as far as the text names one),
    reason, document."""
    schema = schemas.report_schema(section, section_type)
    parse = F.from_json("value", T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    fields = [F.when(~bad, F.col("r")[f.name]).alias(f.name) for f in schema.fields]
    return _split(raw.select("value", parse.alias("r")), bad, fields, section, observation=observation)


def _counted(bad: Column) -> tuple[Column, Column]:
    return (
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("malformed"),
    )


def _name() -> Column:
    # A missing company_name key defaults to '' (a JSON null does as well).
    return F.coalesce(F.col("company_name"), F.lit(""))


def _year(c: Column) -> Column:
    """A year written as a whole number, in any form (2024, "2024", 2024.0)."""
    y = nan_to_null(c.try_cast("double"))
    return F.when((y >= 0) & (y <= F.lit(float(2**53))) & (y == F.floor(y)), F.floor(y).cast("long"))


def _year_rows(df: DataFrame, array_field: str, run_date: str, years_back: int) -> DataFrame:
    """Explode the yearly array and keep years >= run year - years_back."""
    rows = df.select("*", F.explode(array_field).alias("h"))
    return rows.withColumn("_year", _year(F.col("h.year"))).where(
        F.col("_year").isNotNull() & (F.col("_year") >= cutoff_year(F.lit(run_date), years_back))
    )


def _num(c: str | Column) -> Column:
    return nan_to_null((F.col(c) if isinstance(c, str) else c).try_cast("double"))


def flatten_overview(raw: DataFrame, observation: Observation | None = None) -> DataFrame:
    """one row per report; a missing section gives NULL attributes."""
    return overview_rows(parse_reports(raw, "overview", schemas.OVERVIEW_SECTION, observation))


def overview_rows(reports: DataFrame) -> DataFrame:
    """F1 of parsed reports."""
    return reports.select(
        "ticker",
        _name().alias("company_name"),
        F.col("overview.sector").alias("sector"),
        F.col("overview.sub_sector").alias("sub_sector"),
        _num("overview.market_cap").alias("market_cap"),
        F.col("overview.listing_date").alias("listing_date"),
    )


def flatten_financials(
    raw: DataFrame, run_date: str, years_back: int = CUTOFF_YEARS_BACK,
    observation: Observation | None = None,
) -> DataFrame:
    """one row per reported year from the cutoff on.

    earnings -> net_income; capex = operating_cash_flow - free_cash_flow;
    eps from the by-year map when the year key exists (even with a NULL
    value, N4), else the array element's eps.
    """
    return financial_rows(parse_reports(raw, "financials", schemas.FINANCIALS_SECTION, observation), run_date, years_back)


def financial_rows(reports: DataFrame, run_date: str, years_back: int = CUTOFF_YEARS_BACK) -> DataFrame:
    """F2 of parsed reports."""
    r = reports.select("ticker", F.col("financials.historical_eps").alias("m"),
                 F.col("financials.historical_financials").alias("hf"))
    rows = _year_rows(r, "hf", run_date, years_back)
    period = F.col("_year").cast("string")
    eps = F.when(F.map_contains_key("m", period), F.try_element_at("m", period)["eps"]).otherwise(
        F.col("h.eps")
    )
    ocf, free = _num("h.operating_cash_flow"), _num("h.free_cash_flow")
    return rows.select(
        "ticker",
        period.alias("period"),
        _num("h.revenue").alias("revenue"),
        _num("h.gross_profit").alias("gross_profit"),
        _num("h.earnings").alias("net_income"),
        _num("h.total_assets").alias("total_assets"),
        _num("h.total_equity").alias("total_equity"),
        _num("h.total_debt").alias("total_debt"),
        ocf.alias("operating_cash_flow"),
        (ocf - free).alias("capex"),
        _num(eps).alias("eps"),
    )


def flatten_valuation(
    raw: DataFrame, run_date: str, years_back: int = CUTOFF_YEARS_BACK,
    observation: Observation | None = None,
) -> DataFrame:
    """one row per reported year; last close price repeated per year."""
    return valuation_rows(parse_reports(raw, "valuation", schemas.VALUATION_SECTION, observation), run_date, years_back)


def valuation_rows(reports: DataFrame, run_date: str, years_back: int = CUTOFF_YEARS_BACK) -> DataFrame:
    """F3 of parsed reports."""
    r = reports.select("ticker", F.col("valuation.last_close_price").alias("lcp"),
                 F.col("valuation.historical_valuation").alias("hv"))
    rows = _year_rows(r, "hv", run_date, years_back)
    return rows.select(
        "ticker",
        F.col("_year").cast("string").alias("period"),
        _num("h.pe").alias("per"),
        _num("h.pb").alias("pbv"),
        _num("lcp").alias("price"),
        _num("h.enterprise_to_ebitda").alias("ev_ebitda"),
    )


def report_rows(section: str, reports: DataFrame, run_date: str, years_back: int = CUTOFF_YEARS_BACK) -> DataFrame:
    """F1-F3 of parsed reports of a scheduled section."""
    if section == "overview":
        return overview_rows(reports)
    return (financial_rows if section == "financials" else valuation_rows)(reports, run_date, years_back)


# ------------------------------------------------- sections as VARIANT ----
# A bare NaN or infinity is no JSON; it means a missing number.
_NO_NUMBER = r"([:\[,]\s*)-?(?:NaN|Infinity)(?=\s*[,}\]])"
# Types of VARIANT keys as columns: decimals are doubles, a key whose values
# have no common type (or none at all) is text.
_TYPES = {"OBJECT": "struct", "ARRAY": "array", "VARIANT": "string", "VOID": "string", "FLOAT": "double"}
_TOKEN = re.compile(r"`(?:``|[^`])*`|\w+(?:\(\d+,\d+\))?")


def _variant(text: Column) -> Column:
    """A JSON text as VARIANT, NULL where it is none."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_replace(text, _NO_NUMBER, "$1null")))


def _object(v: Column) -> Column:
    """A VARIANT that is an object, NULL for any other."""
    return F.when(v.try_cast("map<string,variant>").isNotNull(), v)


def key_types(told: str | None) -> T.StructType:
    """The result of ``schema_of_variant_agg`` over objects as a struct."""
    if told is None or not told.startswith("OBJECT<") or told == "OBJECT<>":
        return T.StructType()

    def as_sql(m: re.Match) -> str:
        word = m.group()
        if told.startswith(": ", m.end()):  # a key
            return word if word.startswith("`") else f"`{word}`"
        return "double" if word.startswith("DECIMAL") else _TYPES.get(word, word)

    keys = T.DataType.fromDDL(_TOKEN.sub(as_sql, told).replace("struct<>", "string"))
    return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in keys.fields])


def _readable(kind: T.DataType) -> T.DataType:
    """Nested objects whose keys differ by case only are text."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    if isinstance(kind, T.StructType):
        if len({n.lower() for n in kind.fieldNames()}) < len(kind.fields):
            return T.StringType()
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind.fields])
    return kind


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(_field(f) for f in kind.fields)}>"
    return kind.simpleString()


def _field(f: T.StructField) -> str:
    return f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}"


def _with_columns(
    rows: DataFrame, v: str, declared: Sequence[T.StructField], extra: Sequence[T.StructField], own: Mapping[str, Column]
) -> DataFrame:
    """``own`` columns, then the declared fields of the objects in ``v``, then
    the other keys. All keys are read in one cast; a value that does not fit
    is NULL, and so is a declared double that is no number. A key whose name
    another column has in other letters' case gets a suffix and comes last."""
    def cast(fields: Sequence[T.StructField]) -> Column:
        return F.try_variant_get(v, "$", _ddl(T.StructType(list(fields))))

    taken = {c.lower() for c in (*own, *(f.name for f in declared))}
    plain, clashing = [], []
    for f in extra:
        (clashing if f.name.lower() in taken else plain).append(f)
        taken.add(f.name.lower())
    out = [c.alias(name) for name, c in own.items()]
    for f in declared:
        value = F.col("_declared").getField(f.name)
        out.append((nan_to_null(value) if isinstance(f.dataType, T.DoubleType) else value).alias(f.name))
    rows = rows.withColumn("_declared", cast(declared)) if declared else rows
    if plain:  # a star: no expression per key has to be built
        rows = rows.withColumn("_plain", cast(plain))
        out.append(F.col("_plain.*"))
    for f in clashing:
        n = 2
        while f"{f.name}_{n}".lower() in taken:
            n += 1
        taken.add(f"{f.name}_{n}".lower())
        out.append(cast([f]).getField(f.name).alias(f"{f.name}_{n}"))
    return rows.select(*out)


OUTER = ("ticker", "company_name")


def split_section(
    raw: DataFrame, section: str, observation: Observation | None = None
) -> tuple[DataFrame, T.StructType, DataFrame]:
    """One pass over landed documents of a section without a declared schema:
    (ticker, company_name and the section as VARIANT, its keys with their
    types, the rejected documents as in ``split_reports``). Keys and types
    are one aggregate, taken while the parsed documents are written."""
    inner = _object(F.try_variant_get("_d", f"$['{section}']", "variant"))
    fields = [
        F.try_variant_get("_d", "$.ticker", "string").alias("ticker"),
        F.coalesce(F.try_variant_get("_d", "$.company_name", "string"), F.lit("")).alias("company_name"),
        inner.alias("_s"),
    ]
    seen = observation or Observation(f"keys_{uuid.uuid4().hex}")
    read = raw.select("value", _object(_variant(F.col("value"))).alias("_d"))
    rows, rejected = _split(
        read, F.col("_d").isNull(), fields, section, [F.schema_of_variant_agg("_s").alias("keys")], seen
    )
    return rows, key_types(seen.get.get("keys")), rejected


def section_rows(sections: DataFrame, keys: T.StructType, section_schema: T.StructType) -> DataFrame:
    """F4 of sections as VARIANT (``split_section``) whose keys are known."""
    declared = [f for f in section_schema.fields if f.name not in OUTER]
    extra = [f for f in keys.fields if f.name not in {*OUTER, *section_schema.fieldNames()}]
    own = {
        c: F.when(
            F.try_variant_get("_s", f"$.{c}", "variant").isNotNull(), F.try_variant_get("_s", f"$.{c}", "string")
        ).otherwise(F.col(c))
        for c in OUTER
    }
    return _with_columns(sections, "_s", declared, extra, own)


def flatten_section(
    raw: DataFrame, section: str, section_schema: T.StructType, observation: Observation | None = None,
) -> DataFrame:
    """ticker, company_name, then every key of the section, however many.

    The text is parsed once into VARIANT, so a section that is not an object
    (a list, a string) adds nothing instead of spoiling the row. Section keys
    win over ticker / company_name on a clash, also with a null. Keys that
    the schema does not declare become columns of the type that their values
    have in common (nested objects and lists included; text where they have
    none). An object that repeats a key is a malformed document.
    """
    sections, keys, _ = split_section(raw, section, observation)
    return section_rows(sections, keys, section_schema)


def flatten_prices(
    pages: DataFrame, record: T.StructType = schemas.PRICE_RECORD, observation: Observation | None = None,
) -> DataFrame:
    """a price page (a list of records, or one bare record) -> rows,
    stamped with the page's ticker. Columns: ticker, the declared record
    fields, then every other field of the records by its type. Pages are
    parsed once: the fields and their types are learned while the records are
    written. A page that does not parse is dropped and counted."""
    page = pages.select("ticker", _variant(F.col("value")).alias("_d"))
    bare = _object(F.col("_d"))
    records = F.coalesce(F.col("_d").try_cast("array<variant>"), F.when(bare.isNotNull(), F.array(bare)))
    parsed = page.select("ticker", records.alias("_l"))
    if observation is not None:
        parsed = parsed.observe(observation, *_counted(F.col("_l").isNull()))
    rows = parsed.select("ticker", F.explode("_l").alias("_r"))
    rows = rows.select("ticker", _object(F.col("_r")).alias("_r")).where(F.col("_r").isNotNull())
    seen = Observation(f"keys_{uuid.uuid4().hex}")
    rows = materialize(rows.observe(seen, F.schema_of_variant_agg("_r").alias("keys")), "prices")
    fields = [f for f in record.fields if f.name != "ticker"]
    told = {"ticker", *(f.name for f in fields)}
    extra = [f for f in key_types(seen.get.get("keys")).fields if f.name not in told]
    return _with_columns(rows, "_r", fields, extra, {"ticker": F.col("ticker")})


def company_universe(pages: DataFrame) -> DataFrame:
    """S5 on landed list pages: symbols in API order, normalised, no empties.

    Columns: position (0-based place in the full ordered list), ticker.
    """
    parsed = pages.select("offset", F.from_json("value", schemas.COMPANY_PAGE).alias("p"))
    rows = parsed.select("offset", F.posexplode("p.results").alias("pos", "e"))
    out = rows.select(
        (F.col("offset") + F.col("pos")).cast("long").alias("position"),
        normalize_ticker(F.col("e.symbol")).alias("ticker"),
    )
    return out.where(F.length("ticker") > 0)


def company_page(companies: DataFrame, sub_sector: str, offset: int, limit: int) -> DataFrame:
    """O2: one API page: sub-sector filter, market cap descending (ticker
    breaks ties), then OFFSET / LIMIT. A top-k, so the limit is the feature."""
    return (
        companies.where(F.col("sub_sector") == sub_sector)
        .orderBy(F.col("market_cap").desc(), F.col("ticker").asc())
        .offset(offset)
        .limit(limit)
    )


def union_pages(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames whose columns differ; missing columns are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
