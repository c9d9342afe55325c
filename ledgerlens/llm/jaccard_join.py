"""N-gram Jaccard join: which documents share at least ``threshold`` of
their word shingles, and the groups these links make.

1. Each text becomes the set of its distinct shingles (64-bit hashes, built
   in numpy over whole Arrow batches). Texts with equal sets are one class,
   named by a fingerprint of the set, so copies never meet in a join.
2. Shingles are ordered rare-first by a count sketch of the whole corpus
   (a fixed number of counters) and then by hash. Any total order is right;
   this one keeps common lines and passages out of the prefixes.
3. Two sets can only reach the threshold when their prefixes (the first
   n - ceil(t n) + 1 shingles) share a shingle. Prefix shingles held by one
   class only are dropped by a partial aggregate before anything is joined.
4. The classes of a shingle are first paired with one of them only, a star
   instead of all pairs: with the class that has the shingle earliest in its
   order, which is the one with the fewest rare shingles of its own (of a text
   and its edited copies, the text). Candidates pass the length filter, the
   positional filter and a suffix filter (shingle counts over fixed hash
   ranges bound the symmetric difference); each pair is then verified once
   on the whole sets.
5. What that links is one component. Where a shingle still holds classes of
   several components, exactly the pairs across components are filtered and
   verified too. A pair within a component cannot change the result, so no
   link between components is lost. The shorter set of a pair enters with its
   shorter, indexing prefix only (places that admit a partner at least as
   large), the longer one with the whole prefix, and the join key holds a band
   of the sizes besides the shingle: texts that share a passage but are not
   alike are not paired at all.

Cases: a text with fewer words than a shingle is one shingle; a null or
empty text, or one of white space, has none, links with nothing and is its
own component; equal rows are one class; a row with a null doc_id links
with nothing and gets a null component; an empty table gives an empty
result; other columns are never looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.caches import released
from ledgerlens.llm.graph import components
from ledgerlens.llm.idset import likely_in, without
from ledgerlens.llm.ship import ship
from ledgerlens.llm.words import LOWER, SPACE, ByteHash, gram_hashes, mix, spans, text_chunks
from ledgerlens.session import materialize

WORDS = 5
THRESHOLD = Fraction(8, 10)
COUNTERS = 1 << 20  # of the count sketch: 8 MB in all, whatever the input
BLOCK = 1 << 14
RANGES = 64  # hash ranges of the suffix filter
_CLASS = np.uint64(0xA0761D6478BD642F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, first): the sorted distinct shingles of each row are
    shingles[first[r]:first[r + 1]]."""
    rows = len(offsets) - 1
    w = spans(~SPACE[data], offsets)
    word = ByteHash(LOWER[data]).of(w.start, w.end)
    n_words = np.diff(w.first)
    left = w.first[w.row + 1] - np.arange(len(word))
    grams = gram_hashes(word, n)
    ok = np.flatnonzero(left[: len(grams)] >= n)
    hashes, row = grams[ok], w.row[ok]
    short = np.flatnonzero((n_words > 0) & (n_words < n))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for k in range(1, n):
            at = np.flatnonzero(n_words[short] == k)
            extra[at] = gram_hashes(word, k)[w.first[short[at]]] if len(at) else 0
        row = np.concatenate((row, short))
        order = np.argsort(row, kind="stable")
        row, hashes = row[order], np.concatenate((hashes, extra))[order]
    first = np.searchsorted(row, np.arange(rows + 1))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        hashes[a:b].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(rows + 1))


def class_ids(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each row's set (0 for the empty set)."""
    size = np.diff(first)
    total = np.zeros(len(shingles) + 1, dtype=np.uint64)
    np.cumsum(mix(shingles ^ _CLASS), dtype=np.uint64, out=total[1:])
    ids = mix(total[first[1:]] - total[first[:-1]] + size.astype(np.uint64))
    return np.where(size > 0, ids, np.uint64(0)).astype(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _class_rows(texts: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, n, class), and per task the counters of its shingles
    (block, counts, salt)."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "class", "block", "salt", "counts"]
        seen, any_row = np.zeros(COUNTERS, dtype=np.int64), False
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                shingles, first = shingle_sets(data, offsets, n)
                seen += np.bincount((shingles & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
                any_row, k = True, hi - lo
                none = pa.nulls(k, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, k), pa.array(np.diff(first).astype(np.int32)),
                     pa.array(class_ids(shingles, first)), none, none, pa.nulls(k, pa.binary())], names=names,
                )
        if any_row:
            k = COUNTERS // BLOCK
            body = [zlib.compress(seen[b * BLOCK : (b + 1) * BLOCK].tobytes(), 1) for b in range(k)]
            salt = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
                 pa.array(range(k), pa.int32()), pa.array([salt] * k, pa.int32()), pa.array(body, pa.binary())],
                names=names,
            )

    return texts.mapInArrow(run, "doc_id long, n int, class long, block int, salt int, counts binary")


def _add_counts(groups: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, dtype=np.int64)
    for body in groups["counts"]:
        total += np.frombuffer(zlib.decompress(body), dtype=np.int64)
    out = groups.iloc[:1].copy()
    out["counts"] = [zlib.compress(total.tobytes(), 1)]
    return out


def _sketch(rows: DataFrame) -> np.ndarray:
    """Counters of the whole corpus: added up in two steps, so that no task
    meets those of all other tasks."""
    part = rows.where("block IS NOT NULL").select("block", "salt", "counts")
    for keys in (("block", "salt"), ("block",)):
        part = part.groupBy(*keys).applyInPandas(_add_counts, "block int, salt int, counts binary")
    total = np.zeros(COUNTERS, dtype=np.int64)
    for r in part.collect():  # COUNTERS / BLOCK rows
        at = r["block"] * BLOCK
        total[at : at + BLOCK] = np.frombuffer(zlib.decompress(bytes(r["counts"])), dtype=np.int64)
    return total


def _prefixes(texts: DataFrame, counters: np.ndarray, n: int, t: Fraction) -> DataFrame:
    """class, n, ranges, prefix: one row per class and chunk of texts."""
    shared = texts.sparkSession.sparkContext.broadcast(counters)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(1)):
                shingles, first = shingle_sets(data, offsets, n)
                ids = class_ids(shingles, first)
                _, where = np.unique(ids, return_index=True)
                size = np.diff(first)
                often = count[(shingles & np.uint64(COUNTERS - 1)).astype(np.int64)]
                top = (shingles >> np.uint64(64 - 6)).astype(np.int64)
                out_n, prefix, ranges = [], [], []
                where = where[size[where] > 0]
                for r in where.tolist():
                    a, b = first[r], first[r + 1]
                    k = b - a
                    keep = int(k + (-(k * t.numerator) // t.denominator) + 1)
                    order = np.argsort(often[a:b], kind="stable")[:keep]  # equal counts stay in hash order
                    prefix.append(shingles[a:b][order].view(np.int64))
                    ranges.append(np.bincount(top[a:b], minlength=RANGES).astype(np.int32))
                    out_n.append(int(k))
                if len(where):
                    flat = pa.array(np.concatenate(prefix))
                    at = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32))
                    spread = pa.array(np.concatenate(ranges))
                    even = pa.array(np.arange(0, (len(where) + 1) * RANGES, RANGES, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[where]), pa.array(out_n, pa.int32()),
                         pa.ListArray.from_arrays(even, spread), pa.ListArray.from_arrays(at, flat)],
                        names=["class", "n", "ranges", "prefix"],
                    )

    return texts.mapInArrow(run, "class long, n int, ranges array<int>, prefix array<long>")


def _shared_entries(prefixes: DataFrame, t: Fraction) -> DataFrame:
    """token, class, n, pos of the prefix shingles that two classes hold, one
    of them in its indexing prefix: every pair that passes the filters meets
    in such a shingle."""
    entries = prefixes.select("class", "n", F.posexplode("prefix").alias("pos", "token"))
    held = entries.groupBy("token").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi"), F.max(_largest("n", "pos", t) >= F.col("n")).alias("indexed")
    )
    return entries.join(held.where("lo <> hi AND indexed").select("token"), "token", "left_semi").distinct()


def _largest(n: str, pos: str, t: Fraction) -> Column:
    """Size of the largest set that a set of ``n`` shingles may be linked
    with when they meet at its place ``pos`` (the positional filter, solved
    for the partner's size)."""
    p, q = t.numerator, t.denominator
    n, pos = F.col(n).cast("long"), F.col(pos).cast("long")
    return F.floor((n - pos) * (p + q) / p) - n


def _band(n: Column, t: Fraction) -> Column:
    """Band of a size, never falling as the size grows; sizes that the
    length filter lets meet lie in the same band or in neighbouring ones."""
    return n.cast("long") if t == 1 else F.floor(F.log(n.cast("double")) / math.log(1 / t))


def _met_across(known: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (a, b) of classes of different labels that share a token of
    ``known`` (token, class, n, pos, label) and may reach the threshold; a is
    the smaller set."""
    left = known.toDF("token", "a", "na", "pos_a", "label_a").withColumn("most_a", _largest("na", "pos_a", t))
    left = left.where("most_a >= na").withColumn(
        "band", F.explode(F.sequence(_band(F.col("na"), t), _band(F.col("most_a"), t)))
    )
    right = known.toDF("token", "b", "nb", "pos_b", "label_b").withColumn("most_b", _largest("nb", "pos_b", t))
    right = right.withColumn("band", _band(F.col("nb"), t))
    return left.join(right, ["token", "band"]).where(
        "label_a <> label_b AND na <= nb AND nb <= most_a AND na <= most_b AND (na < nb OR a < b)"
    )


def _needed(na: Column, nb: Column, t: Fraction) -> Column:
    """Smallest intersection that reaches the threshold, as a fraction's
    two sides: intersection * (p + q) >= p * (na + nb) with t = p / q."""
    return F.lit(t.numerator) * (na + nb)


def _may_reach(t: Fraction) -> Column:
    """Length and positional filter of a pair (a, b) that meets in a shingle
    at places pos_a and pos_b."""
    na, nb = F.col("na").cast("long"), F.col("nb").cast("long")
    p, q = t.numerator, t.denominator
    rest = 1 + F.least(na - F.col("pos_a") - 1, nb - F.col("pos_b") - 1)
    return (F.least(na, nb) * q >= F.greatest(na, nb) * p) & (rest * (p + q) >= _needed(na, nb, t))


def _pairs(met: DataFrame, t: Fraction) -> DataFrame:
    ordered = met.where(_may_reach(t)).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    return ordered.distinct()


def _verified(
    pairs: DataFrame, texts: DataFrame, classes: DataFrame, shapes: DataFrame, n: int, t: Fraction
) -> DataFrame:
    """The pairs (a, b) of classes that reach the threshold."""
    p, q = t.numerator, t.denominator
    for side in "ab":
        pairs = pairs.join(
            shapes.select(F.col("class").alias(side), F.col("n").alias(f"n{side}"), F.col("ranges").alias(f"r{side}")),
            side,
        )
    apart = F.aggregate(F.zip_with("ra", "rb", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    na, nb = F.col("na").cast("long"), F.col("nb").cast("long")
    # |A - B| + |B - A| >= apart, so the intersection is at most half of what is left.
    pairs = materialize(
        pairs.where((na + nb - apart) * (p + q) >= 2 * _needed(na, nb, t)).select("a", "b"), "pairs"
    )
    taking = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = materialize(classes.join(taking, "class").select("class", F.col("min_id").alias("doc_id")), "wanted")

    @released
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(1)):
                shingles, first = shingle_sets(data, offsets, n)
                ids = class_ids(shingles, first)
                at = first.tolist()
                body = [shingles[a:b].tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(body, pa.binary())], names=["class", "set"])

    found = likely_in(texts, wanted).mapInArrow(sets, "class long, set binary")
    found = found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])
    found = materialize(found, "sets")
    joined = pairs.join(found.withColumnsRenamed({"class": "a", "set": "set_a"}), "a").join(
        found.withColumnsRenamed({"class": "b", "set": "set_b"}), "b"
    )

    @released
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                u = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                v = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = np.sort(np.concatenate((u, v)), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(common * (p + q) >= p * (len(u) + len(v)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(good, pa.bool_())
            )

    return joined.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long")


def jaccard_join(
    docs: DataFrame, threshold: Fraction = THRESHOLD, words: int = WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    ship(spark)
    texts = _texts(docs, id_col, text_col)
    rows = materialize(_class_rows(texts, words), "classes")
    members = rows.where("block IS NULL").select("doc_id", "n", "class")
    linkable = texts.where("doc_id IS NOT NULL")
    prefixes = materialize(_prefixes(linkable, _sketch(rows), words, threshold), "prefixes")
    classes = members.where("n > 0 AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("min_id"))
    shapes = prefixes.select("class", "n", "ranges").dropDuplicates(["class"])

    entries = materialize(_shared_entries(prefixes, threshold), "entries")
    earliest = entries.groupBy("token").agg(F.min(F.struct("pos", "n", "class")).alias("lead"))
    star = entries.join(earliest, "token").where("class <> lead.class").select(
        F.col("lead.class").alias("a"), F.col("lead.n").alias("na"), F.col("lead.pos").alias("pos_a"),
        F.col("class").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pos_b"),
    )
    tried = materialize(_pairs(star, threshold), "star")
    links = materialize(_verified(tried, linkable, classes, shapes, words, threshold), "links")
    labels = components(links)

    label = F.coalesce("label", "class").alias("label")
    known = entries.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "token", "class", "n", "pos", label
    )
    mixed = known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    known = materialize(known.join(mixed.where("lo <> hi").select("token"), "token", "left_semi"), "mixed")
    rest = _pairs(_met_across(known, threshold), threshold).join(tried, ["a", "b"], "left_anti")
    more = _verified(rest, linkable, classes, shapes, words, threshold)
    labels = components(links.unionAll(more))

    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("class", "min_id", label)
    lowest = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    of_class = named.join(lowest, "label").select("class", "component_id")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return members.join(of_class, "class", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id")
    )


def keep_one(
    docs: DataFrame, threshold: Fraction = THRESHOLD, words: int = WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay, one row of each component, with all
    their columns: the one with the smallest doc_id, any one of several such
    and a null id only where there is no other. The rows are joined by a key
    of their own, so null, repeated and reused ids are rows like others."""
    names = docs.columns
    body = docs.toDF(*(f"_c{k}" for k in range(len(names))))
    # Written once, so that every later read sees the same keys.
    rows = materialize(body.withColumn("_row", F.monotonically_increasing_id()), "rows")
    at, text = (f"_c{names.index(c)}" for c in (id_col, text_col))
    found = jaccard_join(rows, threshold, words, "_row", text).select(F.col("doc_id").alias("_row"), "component_id")
    found = materialize(found, "jaccard")
    ids = rows.select("_row", F.col(at).cast("long").alias("id"))
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("_row"))
    sized = found.join(found.groupBy("component_id").count().where("count > 1"), "component_id", "left_semi")
    linked = materialize(sized.join(ids, "_row").select("component_id", order.alias("row")), "linked")
    best = linked.groupBy("component_id").agg(F.min("row").alias("best"))
    gone = materialize(linked.join(best, "component_id").where("row._row <> best._row").select("row._row"), "gone")
    return without(rows, gone, "_row").drop("_row").toDF(*names)
