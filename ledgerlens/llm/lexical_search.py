"""Ranked lexical search: the best documents for each of a set of queries, by
an exact integer form of BM25 over the whole corpus.

Terms are the maximal runs of digits, letters of ASCII and characters beyond
ASCII; only A-Z are lower-cased. With N documents that have a term, L terms in
all of them, n terms in a document, df documents that hold a term and tf its
occurrences in one, a term weighs w = floor(1000 ln((2N+2) / (2df+1))), a
document's length counts as m = 75 + (25 n N) div L, and its score is the sum of
w ((10^9 tf) div (1000 tf + 12 m)) over the query's terms, repeats included.

Method (presence-mask grouping). One pass over the texts keeps, of each
document, its length and the counts of those terms that some query has; it
also gives N, L and df. In blocks of documents a query's term bitmaps are
joined into one mask a document: documents with the same mask hold the same
terms. A mask's largest possible score follows from the block's largest
contribution of each term, so distinct masks are evaluated by descending
bound and the block is finished as soon as the next bound is below the worst
of the best documents so far. A bound that equals it is still evaluated, so
ties are exact. Each task keeps its best documents of a query over all its
blocks; these are merged in two steps.

Queries are taken in blocks of about ``BLOCK_BYTES`` of text, and only the
terms, weights and ids of a block go to the tasks. Texts of any length are read
in pieces. Nothing of a text is shuffled.

Cases: a null or empty text has no terms and is in no result; so has a query
without terms no rows. Every row is a document of its own, repeated ids
included, and every query row is answered on its own. Equal scores ascend by
id, a null id last. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.ship import ship
from ledgerlens.llm.words import CHUNK_BYTES, LOWER, row_chunks, spans, text_parts
from ledgerlens.session import materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 2 << 20  # of query text whose terms are looked for in one pass
BLOCK_COUNTS = 1 << 21  # term counts of one block of documents
SLICES = 64  # of tasks, merged before all

_IN_TERM = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _IN_TERM[_lo:_hi] = True
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(f"({TERM})"))


# ------------------------------------------------------- counting the terms --
def _packed(rows: np.ndarray) -> np.ndarray:
    """Byte strings of one length as comparable keys."""
    n, width = rows.shape
    if width <= 8:
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :width] = rows
        return wide.view(">u8").ravel().astype(np.uint64)
    return np.ascontiguousarray(rows).view(f"S{width}").ravel()


class Dictionary:
    """The queries' terms, sorted within each length in bytes."""

    def __init__(self, terms: Sequence[str]) -> None:
        by_length: dict[int, list[tuple[bytes, int]]] = {}
        for number, term in enumerate(terms):
            b = term.encode()
            by_length.setdefault(len(b), []).append((b, number))
        self.of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width, found in by_length.items():
            keys = _packed(np.frombuffer(b"".join(b for b, _ in found), dtype=np.uint8).reshape(-1, width))
            order = np.argsort(keys)
            self.of[width] = keys[order], np.array([n for _, n in found])[order]

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which words are terms, their numbers), comparing whole words."""
        length = end - start
        order = np.argsort(length, kind="stable")
        ranked = length[order]
        hits, numbers = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for width, (keys, number) in self.of.items():
            a, b = np.searchsorted(ranked, [width, width + 1])
            if a == b:
                continue
            at = order[a:b]
            word = _packed(data[start[at][:, None] + np.arange(width)])
            place = np.minimum(np.searchsorted(keys, word), len(keys) - 1)
            same = keys[place] == word
            hits.append(at[same])
            numbers.append(number[place[same]])
        return np.concatenate(hits), np.concatenate(numbers)


def _pieces(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of at most ``limit`` bytes each; a longer
    text is cut where no term is."""
    for lo, hi in row_chunks(offsets, limit):
        at, end = int(offsets[lo]), int(offsets[hi])
        if end - at <= limit:
            yield lo, data[at:end], offsets[lo : hi + 1] - at
            continue
        while at < end:
            cut = min(at + limit, end)
            while cut < end:  # to the end of the term at the cut
                gap = np.flatnonzero(~_IN_TERM[data[cut : min(cut + limit, end)]])
                if len(gap):
                    cut += int(gap[0])
                    break
                cut = min(cut + limit, end)
            yield lo, data[at:cut], np.array([0, cut - at])
            at = cut


def count_terms(texts, dictionary: Dictionary, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of texts: terms of each, and (row, term number, count) of
    the dictionary's, sorted."""
    data, offsets = text_parts(texts)
    length = np.zeros(len(offsets) - 1, dtype=np.int64)
    keys, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for row, part, at in _pieces(data, offsets):
        words = spans(_IN_TERM[part], at)
        length[row : row + len(at) - 1] += np.diff(words.first)
        hit, number = dictionary.find(LOWER[part], words.start, words.end)
        key, n = np.unique((words.row[hit] + row) * n_terms + number, return_counts=True)
        keys.append(key)
        counts.append(n)
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, back, np.concatenate(counts))
    return length, key // max(n_terms, 1), key % max(n_terms, 1), total


def _counter(terms: Sequence[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary(terms)
        for b in batches:
            length, row, term, tf = count_terms(b.column(1), dictionary, len(terms))
            at = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in ((term, pa.int32()), (tf, pa.int64()))]
            cols = [b.column(0), pa.array(length), *lists]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n", "terms", "tfs"]).filter(pa.array(length > 0))

    return count


# ------------------------------------------------------------------ ranking --
@dataclass
class Best:
    """The best documents of a query so far: scores, ids, ids that are null."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=bool))

    @property
    def floor(self) -> int:
        """A document below this score cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(p) for p in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.k]
        order = order[score[order] > 0]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


class Block:
    """Documents of one block with their contributions, term by term."""

    def __init__(self, doc, null, n, counts_at, term, tf, n_docs: int, n_all: int) -> None:
        self.doc, self.null, self.size = doc, null, len(doc)
        if 25 * int(n.max(initial=0)) * n_docs < 1 << 63:
            m = 75 + 25 * n * n_docs // n_all
        else:
            m = np.array([75 + 25 * int(x) * n_docs // n_all for x in n], dtype=np.int64)
        row = np.repeat(np.arange(self.size), np.diff(counts_at))
        order = np.argsort(term, kind="stable")
        self.row, tf = row[order], tf[order]
        self.part = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.row])
        ranked = term[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, dtype=np.int64)
        ends = [*first[1:], len(ranked)]
        self.at = {int(ranked[a]): (int(a), int(b)) for a, b in zip(first, ends)}
        most = np.maximum.reduceat(self.part, first) if len(first) else first
        self.most = {int(ranked[a]): int(x) for a, x in zip(first, most)}
        self._bits: dict[int, np.ndarray] = {}

    def _bitmap(self, term: int) -> np.ndarray:
        """One 0/1 entry a document; kept for frequent terms."""
        have = self._bits.get(term)
        if have is None:
            a, b = self.at[term]
            have = np.zeros(self.size, dtype=np.uint64)
            have[self.row[a:b]] = 1
            if (b - a) * 16 > self.size:
                self._bits[term] = have
        return have

    def masks(self, terms: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """(group of each document, presence bits of each group)."""
        group, bits = np.zeros(self.size, dtype=np.int64), np.zeros((1, 0), dtype=np.int64)
        for lo in range(0, len(terms), 64):
            some = terms[lo : lo + 64]
            word = np.zeros(self.size, dtype=np.uint64)
            for j, t in enumerate(some):
                a, b = self.at[t]
                if (b - a) * 16 > self.size:
                    word |= self._bitmap(t) << np.uint64(j)
                else:
                    word[self.row[a:b]] |= np.uint64(1 << j)
            values, code = np.unique(word, return_inverse=True)
            held = (values[:, None] >> np.arange(len(some), dtype=np.uint64) & np.uint64(1)).astype(np.int64)
            pair, group = np.unique(group * len(values) + code, return_inverse=True)
            bits = np.concatenate((bits[pair // len(values)], held[pair % len(values)]), axis=1)
        return group, bits

    def scores(self, docs: np.ndarray, terms: Sequence[int], weight: np.ndarray) -> np.ndarray:
        total = np.zeros(len(docs), dtype=np.int64)
        for t, w in zip(terms, weight):
            a, b = self.at[t]
            rows = self.row[a:b]
            place = np.minimum(np.searchsorted(rows, docs), b - a - 1)
            total += np.where(rows[place] == docs, w * self.part[a:b][place], 0)
        return total

    def rank(self, query: Sequence[tuple[int, int]], best: Best) -> int:
        """Add this block's best documents of a query ((term, weight), ...).
        Returns the number of documents whose score was computed."""
        here = [(t, w) for t, w in query if t in self.at]
        terms, weight = [t for t, _ in here], np.array([w for _, w in here], dtype=np.int64)
        most = weight * np.array([self.most[t] for t in terms], dtype=np.int64)
        if int(most.sum()) < best.floor:
            return 0
        group, bits = self.masks(terms)
        bound = bits @ most
        by_bound = np.argsort(-bound, kind="stable")
        members = np.argsort(group, kind="stable")
        start = np.searchsorted(group[members], np.arange(len(bound) + 1))
        done, seen, step = 0, 0, best.k
        while done < len(by_bound) and bound[by_bound[done]] >= best.floor:
            upto, taken = done, 0  # groups until enough documents are taken
            while upto < len(by_bound) and taken < step and bound[by_bound[upto]] >= best.floor:
                taken += start[by_bound[upto] + 1] - start[by_bound[upto]]
                upto += 1
            docs = np.concatenate([members[start[g] : start[g + 1]] for g in by_bound[done:upto]])
            best.add(self.scores(docs, terms, weight), self.doc[docs], self.null[docs])
            done, seen, step = upto, seen + len(docs), 2 * step
        return seen


def _ranker(queries: Sequence[Sequence[tuple[int, int]]], n_docs: int, n_all: int, k: int, most: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for b in batches:
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            doc = b.column(0).fill_null(0).to_numpy()
            n = b.column(1).to_numpy()
            at = b.column(2).offsets.to_numpy().astype(np.int64)
            term, tf = (b.column(c).values.to_numpy() for c in (2, 3))
            for lo, hi in row_chunks(at, most):
                a, z = at[lo], at[hi]
                block = Block(
                    doc[lo:hi], null[lo:hi], n[lo:hi], at[lo : hi + 1] - a, term[a:z], tf[a:z], n_docs, n_all
                )
                for query, kept in zip(queries, best):
                    block.rank(query, kept)
        for q, kept in enumerate(best):
            if len(kept.score):
                ids = pa.array(kept.doc, pa.int64(), mask=kept.null)
                cols = [pa.array([q] * len(ids), pa.int32()), ids, pa.array(kept.score)]
                yield pa.RecordBatch.from_arrays(cols, names=["q", "doc", "score"])

    return rank


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _top(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_block(spark: SparkSession, texts: DataFrame, rows: Sequence, k: int, item_type: str) -> DataFrame | None:
    counts = [Counter(r["terms"]) for r in rows]
    terms = sorted(set().union(*counts))
    if not terms:
        return None
    postings = materialize(texts.mapInArrow(_counter(terms), "id long, n long, terms array<int>, tfs array<long>"), "postings")
    n_docs, n_all = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).head()
    found = postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row a term at most
    weights = {r["t"]: weight(n_docs, r["count"]) for r in found}
    number = {t: i for i, t in enumerate(terms)}
    queries = [
        [(number[t], c * weights[number[t]]) for t, c in sorted(q.items()) if weights.get(number[t], 0) > 0] for q in counts
    ]
    hits = postings.mapInArrow(_ranker(queries, n_docs, n_all, k, BLOCK_COUNTS), "q int, doc long, score long")
    hits = hits.withColumn("slice", F.spark_partition_id() % SLICES)
    merged = _top(_top(hits, ["q", "slice"], k).drop("rank"), ["q"], k)
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"q int, item {item_type}")
    return merged.join(names, "q").select("item", "rank", "doc", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", query_col: str = "text",
) -> DataFrame:
    """Of each row of ``items`` the ``k`` best rows of ``docs`` with a score
    above 0: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(query_col).alias("text"))
    item_type = asked.schema["item"].dataType.simpleString()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    blocks = size // BLOCK_BYTES + 1
    asked = asked.select("item", terms_of(F.col("text")).alias("terms"), F.pmod(F.xxhash64("text"), F.lit(blocks)).alias("block"))
    out = None
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).collect()
        part = _search_block(spark, texts, rows, k, item_type)
        if part is not None:
            out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], f"item {item_type}, rank int, doc long, score long")
    return out.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
