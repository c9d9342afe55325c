"""Registered queries of the training-data operators: each applies its
operator, with the parameters below, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    byte_bpe, exact_dedup, html_extract, jaccard_join, lexical_search, license_scan, merkle, packing, quality, sharding,
    token_counts, toxicity, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

WORD_TOKENIZER = "word_bpe_49k.json"
END_OF_TEXT = 49407  # <|endoftext|> of that vocabulary
RANKS = "byte_bpe_50k.tiktoken"
SHARDS = 24
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_RULES = quality.Rules()
_GRAMS = [n for n, _ in _RULES.max_gram_chars]
_GRAM_COLUMNS = ", ".join(f"coalesce(max(chars) FILTER (WHERE n = {n}), 0) AS dup_{n}gram_chars" for n in _GRAMS)
_AHEAD = ", ".join(f"lead(w0, {k}) OVER o AS w{k}" for k in range(1, max(_GRAMS)))


def _gram(n: int) -> str:
    """The n words from a place as one text; NULL where the text ends."""
    return " || ' ' || ".join(f"w{k}" for k in range(n))


_WITHIN = " AND ".join(
    f"dup_{n}gram_chars <= CAST({most} AS DOUBLE) * word_chars" for n, most in _RULES.max_gram_chars
)


@register(
    "op1_quality_rules",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
    base AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT)
                    AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM d),
    line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
    lines AS (SELECT doc_id, line, count(*) AS n,
                     list_sum(list_transform({_WORDS.replace("coalesce(text, '')", "line")}, lambda x: length(x))) AS chars
              FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
    dup AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines,
                   CAST(sum(CASE WHEN n > 1 THEN n * chars ELSE 0 END) AS BIGINT) AS dup_line_chars FROM lines GROUP BY doc_id),
    word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS w0 FROM d),
    ahead AS (SELECT doc_id, p, w0, {_AHEAD} FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
    place AS (SELECT doc_id, p, unnest({[3, *_GRAMS]}) AS n, unnest([{", ".join(_gram(n) for n in (3, *_GRAMS))}]) AS g
              FROM ahead),
    hit AS (SELECT doc_id, n, p FROM place WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, n, g) > 1),
    covered AS (SELECT DISTINCT doc_id, n, p FROM (SELECT doc_id, n, unnest(range(p, p + n)) AS p FROM hit)),
    held AS (SELECT doc_id, n, count(*) AS words, CAST(sum(length(w0)) AS BIGINT) AS chars
             FROM covered JOIN word USING (doc_id, p) GROUP BY doc_id, n),
    gram AS (SELECT doc_id, coalesce(max(words) FILTER (WHERE n = 3), 0) AS n_repeat_words, {_GRAM_COLUMNS}
             FROM d LEFT JOIN held USING (doc_id) GROUP BY doc_id),
    found AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, n_repeat_words,
                     coalesce(dup_line_chars, 0) AS dup_line_chars, {", ".join(f"dup_{n}gram_chars" for n in _GRAMS)},
                     n_words < {_RULES.min_words} OR n_repeat_words > {_RULES.max_repeat_words} * n_words AS base_failed
              FROM base JOIN gram USING (doc_id) LEFT JOIN dup USING (doc_id))
    SELECT *, NOT base_failed AND dup_line_chars <= CAST({_RULES.max_line_chars} AS DOUBLE) * word_chars AND {_WITHIN} AS kept
    FROM found
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@register(
    "op3_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, text_sha256
    FROM d JOIN g USING (text_sha256)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    return packing.pack(table(spark, sf_dir, "documents"), path, cache_words=800_000)


@register("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS)


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)


@register(
    "op10_url_filters",
    f"""
    WITH rules(verdict, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
    cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END
            AS rest FROM pages),
    parsed AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
    p AS (SELECT page_id, lower(raw) AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parsed),
    best AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                    arg_max(verdict, length(rule_host || rule_path)) AS verdict
             FROM p JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host)
                              AND starts_with(path, rule_path) GROUP BY page_id)
    SELECT p.page_id, host, path, best.rule, coalesce(best.verdict, 'allow') AS verdict
    FROM p LEFT JOIN best USING (page_id)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules)


@register("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


@register(
    "op2_ngram_jaccard_join",
    f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, {_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')")}
               AS w FROM documents),
    word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS w0 FROM d),
    s AS (SELECT DISTINCT doc_id, {_gram(5)} AS g
          FROM (SELECT *, {", ".join(f"lead(w0, {k}) OVER o AS w{k}" for k in range(1, 5))} FROM word
                WINDOW o AS (PARTITION BY doc_id ORDER BY p)) WHERE w4 IS NOT NULL
          UNION ALL SELECT doc_id, array_to_string(w, ' ') AS g FROM d WHERE len(w) BETWEEN 1 AND 4),
    n AS (SELECT doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id),
    meet AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g)
             WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    half AS (SELECT x, y FROM meet JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
             WHERE 100 * c >= 80 * (p.n + q.n - c)),
    link AS (SELECT x, y FROM half UNION ALL SELECT y, x FROM half),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
    SELECT doc_id, n AS n_shingles, c AS component_id
    FROM n JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) USING (doc_id)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_toxic_tokens"))


@register("op6_license_scans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@register("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), END_OF_TEXT
    )


_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), "
    f"'{lexical_search.TERM}')"
)


@register(
    "op11_ranked_lexical_search",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
    c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM d WHERE len(w) > 0),
    f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
          GROUP BY r, doc_id, n, term),
    q AS (SELECT item_id, term, count(*) AS again FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
          GROUP BY item_id, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
          FROM f, c GROUP BY term, n_docs),
    s AS (SELECT item_id, r, doc_id, CAST(sum(again * weight
                 * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_all)))) AS BIGINT) AS score
          FROM q JOIN w USING (term) JOIN f USING (term), c GROUP BY item_id, r, doc_id)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
    WHERE rank <= 20
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def _sql_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _sql_leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_sql_field(n_chars if c == 'n_chars' else c) for c in merkle.FIELDS)})"


# CRC-32 bit by bit: a byte is taken in, then shifted out over eight steps.
_SQL_CRC = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                           lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, 4294967295))"""
_SQL_UP = "sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2)"
_SQL_FOLD = "sha256(CASE WHEN u.i % 2 = 0 THEN u.h || coalesce(s.h, '') ELSE s.h || u.h END), u.proof || coalesce(s.h, '')"


@register(
    "op12_merkle_manifest",
    f"""
    WITH RECURSIVE d AS (SELECT *, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("n_chars + 1")} AS other,
                                {_SQL_CRC} % 7 = 0 AS altered FROM documents),
    p AS (SELECT doc_id, leaf, CASE WHEN altered THEN other ELSE leaf END AS claimed,
                 row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                 dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM d),
    tree AS (SELECT t, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY t) AS n FROM p
             UNION ALL SELECT t, level + 1, i // 2, {_SQL_UP} FROM tree WHERE n > 1 GROUP BY t, level, i // 2),
    sub AS (SELECT t, level AS height, h AS subroot FROM tree WHERE n = 1),
    top AS (SELECT 0 AS level, t AS i, subroot AS h, count(*) OVER () AS n FROM sub
            UNION ALL SELECT level + 1, i // 2, {_SQL_UP} FROM top WHERE n > 1 GROUP BY level, i // 2),
    root AS (SELECT level AS height, h AS root FROM top WHERE n = 1),
    low AS (SELECT doc_id, leaf, t, i, 0 AS level, claimed AS h, '' AS proof FROM p
            UNION ALL
            SELECT u.doc_id, u.leaf, u.t, u.i // 2, u.level + 1, {_SQL_FOLD}
            FROM low u JOIN sub ON u.t = sub.t AND u.level < sub.height
            LEFT JOIN tree s ON s.t = u.t AND s.level = u.level AND s.i = xor(u.i, 1)),
    high AS (SELECT doc_id, leaf, subroot, u.t AS i, 0 AS level, h, proof
             FROM low u JOIN sub ON u.t = sub.t AND u.level = sub.height
             UNION ALL
             SELECT u.doc_id, u.leaf, u.subroot, u.i // 2, u.level + 1, {_SQL_FOLD}
             FROM high u JOIN root ON u.level < root.height LEFT JOIN top s ON s.level = u.level AND s.i = xor(u.i, 1))
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
    FROM high JOIN root ON level = height
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = [F.try_add("n_chars", F.lit(1)) if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    proved = merkle.proofs(
        table(spark, sf_dir, "documents"), carry={"claimed": F.when(chosen, merkle.leaf_digest(altered))}
    )
    return merkle.audit(proved, F.col("claimed")).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof_sha256"), "folded_root", "verified"
    )


@register("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))
