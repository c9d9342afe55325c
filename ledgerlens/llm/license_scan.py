"""Licence scans by ordered signature rules (DataFrame functions only).

Each text is normalised to lower-case words parted by one space. A text in
which no rule's keyword occurs is done after that. Otherwise the rules whose
keyword occurs are matched everywhere in the text; each match is a detection
with its interval. Detections are gone through from left to right, longer
ones first: one that lies inside the interval of another goes unless its
rule is strictly stronger, and of two that overlap in part the stronger
stays (the earlier one, between equals). What remains gives labels and a
score, 1 - product of (1 - weight) over the labels.

Besides the rules, a few base phrases are counted at all their places.

All of it is an expression over one row: nothing is shuffled, and a text of
any length is scanned whole, in time linear in its words and detections (but
for sorting the detections).

Cases: a null, empty or wordless text has no words, places or labels (empty
strings, score 0, null places); repeated rows give equal rows; a null doc_id
stays null; an empty table gives an empty result; other columns are never
looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.license_rules import Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrase -> label; fixed values.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"  # normalised texts hold no control characters
_DETECTION = "struct<start:int,tail:int,priority:int,label:string,weight:double>"
_SURE = "array<struct<label:string,weight:double>>"


def normalised(text: Column) -> Column:
    """' word word word ': A-Z lower-cased, one space before, between and
    behind the words; ' ' without words."""
    low = F.translate(text, UPPER, LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), _BREAK, " ")


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _phrase_places(norm: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(places, first start, last start) of a phrase, starts in words from 0.

    Every word gets spaces of its own on both sides, so places that follow
    each other directly do not share a character; a piece between places
    then holds two spaces a word."""
    wide = F.replace(norm, F.lit(" "), F.lit("  "))
    mark = " " + phrase.replace(" ", "  ") + " "
    size = len(phrase.split())
    # The outermost spaces are single halves: ' ' + 'w' + ' ' per word.
    body = F.substring(wide, 2, 2_000_000_000)
    body = F.substr(body, F.lit(1), F.greatest(F.length(body) - 1, F.lit(0)))
    without = F.replace(body, F.lit(mark), F.lit(""))
    count = ((F.length(body) - F.length(without)) / len(mark)).cast("long")
    first = (_spaces(F.substring_index(body, mark, 1)) / 2).cast("long")
    last = (_spaces(body) / 2 - _spaces(F.substring_index(body, mark, -1)) / 2 - size).cast("long")
    some = F.contains(norm, F.lit(f" {phrase} "))
    return (
        F.when(some, count).otherwise(F.lit(0).cast("long")),
        F.when(some, first),
        F.when(some, last),
    )


def _rule_table(table: Sequence[Rule]) -> Column:
    """The rules as one constant array."""
    return F.array(*[
        F.struct(
            F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(f" {r.keyword}").alias("keyword"),
            F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"), F.lit(r.weight).alias("weight"),
        )
        for r in table
    ])


def _matches(norm: Column, rule: Column) -> Column:
    """The detections of one rule, as intervals of words. Its matches are
    marked in the text; the marked words give the places in one pass."""
    marked = F.regexp_replace(norm, rule["pattern"], F.lit(f"{MARK}$0{MARK}"))

    def places(words: Column, edge: Callable[[Column, str], Column]) -> Column:
        return F.filter(F.transform(words, lambda w, k: F.when(edge(w, MARK), k)), lambda k: k.isNotNull())

    def intervals(words: Column) -> Column:
        return F.zip_with(places(words, Column.startswith), places(words, Column.endswith), lambda first, last: F.struct(
            first.alias("start"), (-(last + 1)).alias("tail"), rule["priority"].alias("priority"),
            rule["label"].alias("label"), rule["weight"].alias("weight"),
        ))

    def of(text: Column) -> Column:
        found = F.flatten(F.transform(F.array(F.split(text, " ")), intervals))
        return F.when(F.contains(text, F.lit(MARK)), found).otherwise(F.array().cast(f"array<{_DETECTION}>"))

    return F.flatten(F.transform(F.array(marked), of))  # a lambda variable, so that it is marked once


def _resolved(found: Column) -> Column:
    """What the detections that are not suppressed amount to: their distinct
    (label, weight) and their number. ``tail`` is minus the end, so the
    natural order has the longer of equal starts first. ``cover`` is the one
    kept that reaches furthest, the only one that can still go; ``last`` is
    the one kept last. The state holds no list of detections, so the work is
    linear in them after the sort."""
    nothing = F.lit(None).cast(_DETECTION)
    begin = F.struct(
        F.array().cast(_SURE).alias("sure"), F.lit(0).alias("n"), nothing.alias("last"), nothing.alias("cover")
    )

    def told(d: Column) -> Column:
        return F.array(F.struct(d["label"].alias("label"), d["weight"].alias("weight")))

    def settled(state: Column, d: Column, last: Column, cover: Column) -> Column:
        """The next state, with ``d`` among those that stay (if any)."""
        return F.struct(
            F.when(d.isNull(), state["sure"]).otherwise(F.array_union(state["sure"], told(d))).alias("sure"),
            (state["n"] + F.when(d.isNull(), 0).otherwise(1)).alias("n"), last.alias("last"), cover.alias("cover"),
        )

    def add(state: Column, d: Column) -> Column:
        last, cover = state["last"], state["cover"]
        stronger = d["priority"] < cover["priority"]
        inside = d["tail"] >= cover["tail"]
        free = (d["start"] >= -last["tail"]) | (d["priority"] < last["priority"])
        new = F.when(cover.isNull() | (d["start"] >= -cover["tail"]), settled(state, cover, d, d))
        new = new.when(inside & stronger & free, settled(state, d, d, cover))
        new = new.when(~inside & stronger, settled(state, nothing, d, d))
        return new.otherwise(state)

    return F.aggregate(
        F.array_sort(found), begin, add,
        lambda s: F.struct(settled(s, s["cover"], nothing, nothing)["sure"].alias("sure"),
                           settled(s, s["cover"], nothing, nothing)["n"].alias("n")),
    )


def license_scan(
    docs: DataFrame, table: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, n_detections."""
    table = rules() if table is None else table
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(text).alias("norm"))
    norm = F.col("norm")

    places = [(_phrase_places(norm, phrase), label) for phrase, label in BASE_PHRASES]
    base = F.filter(
        F.array(*[F.when(F.contains(norm, F.lit(f" {phrase} ")), F.lit(label)) for phrase, label in BASE_PHRASES]),
        lambda x: x.isNotNull(),
    )
    gate = reduce(or_, [F.contains(norm, F.lit(f" {k}")) for k in sorted({r.keyword for r in table})], F.lit(False))
    wanted = F.filter(_rule_table(table), lambda r: F.contains(norm, r["keyword"])) if table else None
    none = F.struct(F.array().cast(_SURE).alias("sure"), F.lit(0).alias("n"))
    found = F.when(gate, _resolved(F.flatten(F.transform(wanted, lambda r: _matches(norm, r))))) if table else none
    rows = rows.select(
        "doc_id",
        F.greatest(_spaces(norm) - 1, F.lit(0)).cast("long").alias("n_words"),
        sum((p[0] for p, _ in places), F.lit(0).cast("long")).alias("n_base"),
        F.least(*[p[1] for p, _ in places]).alias("first_word"),
        F.greatest(*[p[2] for p, _ in places]).alias("last_word"),
        base.alias("base"),
        F.coalesce(found, none).alias("found"),
    )
    told = F.array_sort(F.array_distinct(F.transform("found.sure", lambda d: d["label"])))
    by_label = F.transform(
        told,
        lambda name: F.array_max(F.transform(F.filter("found.sure", lambda d: d["label"] == name), lambda d: d["weight"])),
    )
    score = F.lit(1.0) - F.aggregate(by_label, F.lit(1.0), lambda p, w: p * (1 - w))
    labels = F.array_union("base", told)
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        score.alias("score"),
        F.col("found.n").cast("long").alias("n_detections"),
    )
