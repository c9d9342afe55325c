"""URL allow and block lists by hashed expressions (DataFrame operations only).

Each distinct (host, path) is expanded into host suffixes x path prefixes
(suffixes only with as many labels, prefixes only of the lengths that occur in
the rules: no others can equal a rule, and a host of any number of labels costs
no more than its length). The expressions meet the rules in an equi-join on the
first 32 bits of their SHA-256 digest; a match counts when the whole digest
agrees. Of the rules that fit, the longest wins, and block wins over allow
between equal rules.

The rule table is broadcast only up to ``BROADCAST_RULES`` rules (a count of
it decides); a larger one takes a shuffled join. Hot hosts cost nothing
extra: equal (host, path) pairs are resolved once, and rows without a host,
which no rule fits, are not joined at all.

Cases: a null url or one without '://' has an empty host and path and takes
the default verdict; a repeated page row is returned as often as it occurs;
a null page_id stays null; an empty table or an empty rule list works; other
columns are never looked at. Rules with an empty host never fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_RULES = 100_000
DEFAULT_VERDICT = "allow"


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a DataFrame."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _digest(expression: Column) -> Column:
    return F.sha2(F.encode(expression, "UTF-8"), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """rule text, verdict, digest and its 32-bit prefix, path length and the
    host's labels; one row per rule text, block before allow."""
    text = F.concat(F.translate("host", UPPER, LOWER), F.col("path"))
    return (
        rules.where((F.col("host") != "") & F.col("path").isNotNull())
        .select(text.alias("rule"), F.length("path").alias("path_length"), _n_labels("host").alias("labels"), "verdict")
        .groupBy("rule", "path_length", "labels")
        .agg(F.max("verdict").alias("rule_verdict"))  # 'block' > 'allow'
        .withColumn("digest", _digest(F.col("rule")))
        .withColumn("short", _short(F.col("digest")))
    )


def _n_labels(host: str) -> Column:
    return F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1


def expressions(urls: DataFrame, lengths: Sequence[int], labels: Sequence[int]) -> DataFrame:
    """(host, path) rows -> one row per host suffix of one of the numbers of
    ``labels`` and path prefix of one of the ``lengths``."""
    suffixes = F.array_compact(F.array(*[
        F.when(_n_labels("host") >= k, F.substring_index("host", ".", -k)) for k in sorted(set(labels))
    ]).cast("array<string>"))
    wanted = F.array(*[F.lit(n) for n in sorted(set(lengths))]).cast("array<int>")
    prefixes = F.transform(
        F.filter(wanted, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    return (
        urls.where(F.col("host") != "")
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", F.concat("suffix", "prefix").alias("expression"))
    )


def url_filter(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    host, path = url_host_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    table = prepared_rules(rules)
    bounds = table.agg(
        F.count("*").alias("n"), F.collect_set("path_length").alias("lengths"), F.collect_set("labels").alias("labels")
    ).first()
    keyed = table.select("short", "digest", "rule", "rule_verdict")
    keyed = F.broadcast(keyed) if bounds["n"] <= BROADCAST_RULES else keyed
    tried = expressions(rows.select("host", "path").distinct(), bounds["lengths"], bounds["labels"])
    tried = tried.withColumn("full", _digest(F.col("expression"))).withColumn("short", _short(F.col("full")))
    fits = tried.join(keyed, "short").where(F.col("full") == F.col("digest"))
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("length"), "rule_verdict", "rule")).alias("best")
    )
    hostless = rows.where("host = ''").withColumn("best", F.lit(None).cast(best.schema["best"].dataType))
    judged = rows.where("host <> ''").join(best, ["host", "path"], "left")
    return judged.unionByName(hostless).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
