"""Toxic spans and document scores by a linear-chain conditional random
field.

Tags: other / toxic. A token's emission score is a sum of hashed feature
weights (the word, its beginnings and end, both neighbours); a 2 x 2
transition matrix ties neighbours together. Forward and backward messages
run over the whole text, one step per token for all texts of a batch at
once; with two tags a message is one ratio. The marginals give the
offending character offsets and, through a small logistic model, the
document score.

Labels exist per document only. Tokens are labelled from them: a word or
word beginning that occurs in far more toxic than clean training documents
than chance allows (a likelihood-ratio test) is a marker; markers within
toxic documents are the toxic tokens.

Fitting uses a bounded sample, ``max_docs`` documents of each class, picked
by a hash of the id among the rows that may be learnt from; the driver holds
no more than that. The sampling rates are put right in the document model.
Scoring covers every row and whole texts.

Cases: a null text counts as empty; an empty text or one without words gets
the score of a document without any mark; equal texts get equal scores; a
null doc_id is scored (and is held out, as its remainder is unknown); a
label table without rows of both classes gives the share of toxic rows (0
without rows) as every score; a document labelled twice is toxic if any of
its rows says so; null labels are left out; an empty table gives an empty
result; columns besides id and text are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.caches import released
from ledgerlens.llm.ship import ship
from ledgerlens.llm.words import LOWER, ByteHash, Spans, spans, text_chunks

MAX_DOCS = 2000
MAX_BYTES = 8 << 20  # of the texts of a class's sample
UNMARKED = 4  # training chains without a marked token for each with one
BUCKETS = 1 << 18
WINDOW = 64  # tokens of a training chain
EPOCHS = 4
RUN_TOKENS = 700_000  # tokens whose messages are passed at once (one text at least)
MARKER_TEST = 30.0  # log-likelihood ratio a marker must reach
STARTS = (3, 4, 5, 6)  # bytes of the word beginnings
FOLDS, HELD_OUT = 5, 0

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _folded(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters of UTF-8 text."""
    out = LOWER[data]
    if len(out) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[second] += 0x20
    return out


def token_features(data: np.ndarray, offsets: np.ndarray) -> tuple[Spans, np.ndarray]:
    """(tokens, features): per token the bucket of each feature. The first
    columns describe the word alone, the last two its neighbours."""
    low = _folded(data)
    t = spans(_TOKEN[low], offsets)
    hashed = ByteHash(low)
    n = len(t.start)
    word = hashed.of(t.start, t.end)
    columns = [word]
    for k in STARTS:
        columns.append(hashed.of(t.start, np.minimum(t.start + k, t.end)))
    columns.append(hashed.of(np.maximum(t.end - 4, t.start), t.end))
    same = t.row[1:] == t.row[:-1] if n else np.zeros(0, dtype=bool)
    last, following = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    last[1:] = np.where(same, word[:-1], 0)
    following[:-1] = np.where(same, word[1:], 0)
    columns += [last, following]
    out = np.empty((n, len(columns)), dtype=np.int32)
    for k, c in enumerate(columns):
        salted = (c + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        out[:, k] = (salted >> np.uint64(64 - 18)).astype(np.int32)
    return t, out


N_FEATURES = len(STARTS) + 4
N_OWN = len(STARTS) + 1  # features that may be markers: the word and its beginnings


@dataclass
class Model:
    """weights: per bucket; step: log transition scores (other -> toxic,
    toxic -> other, toxic -> toxic; other -> other is 0); document: bias and
    weights of the document features."""

    weights: np.ndarray
    step: np.ndarray
    document: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros(len(features))
        for k in range(features.shape[1]):
            total += self.weights[features[:, k]]
        return np.exp(np.clip(total, -30, 30))


def messages(emission: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward message of every token, as ratios toxic : other.
    ``emission`` holds exp(score) of the chains one after another, chain c
    from first[c] to first[c + 1]."""
    ot, to, tt = np.exp(np.clip(step, -30, 30))
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, size = first[:-1][order], lengths[order]
    alive = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    forward, backward = np.empty(len(emission)), np.empty(len(emission))
    r = np.zeros(len(size))
    for t, k in enumerate(alive.tolist()):
        at = begin[:k] + t
        before = r[:k]
        r[:k] = np.clip(emission[at] * (ot + before * tt) / (1.0 + before * to), 1e-30, 1e30)
        forward[at] = r[:k]
    b = np.ones(len(size))
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        longer = alive[t + 1] if t + 1 < len(alive) else 0
        if longer:  # texts that go on behind this place
            e = emission[begin[:longer] + t + 1] * b[:longer]
            b[:longer] = np.clip((to + tt * e) / (1.0 + ot * e), 1e-30, 1e30)
        backward[begin[:k] + t] = b[:k]
    return forward, backward


def marginals(emission: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """P(toxic) of every token."""
    forward, backward = messages(emission, first, step)
    odds = forward * backward
    return odds / (1.0 + odds)


def document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: 1, the largest marginal's log-odds, and the logarithm of
    the expected number of toxic tokens."""
    rows = len(first) - 1
    out = np.zeros((rows, 3))
    out[:, 0] = 1.0
    some = np.flatnonzero(np.diff(first) > 0)
    best = np.full(rows, 1e-4)
    if len(some):
        best[some] = np.maximum.reduceat(p, first[some])
    best = np.clip(best, 1e-4, 1 - 1e-4)
    total = np.concatenate(([0.0], np.cumsum(p)))
    mass = total[first[1:]] - total[first[:-1]]
    out[:, 1] = np.log(best / (1 - best))
    out[:, 2] = np.log1p(np.maximum(mass, 0.0))
    return out


# ------------------------------------------------------------------ fitting
def _markers(features: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Mask of the buckets that mark toxic documents; ``toxic`` by row."""
    toxic = toxic[: int(row[-1]) + 1] if len(row) else toxic[:0]
    n_toxic, n_clean = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    share = n_toxic / (n_toxic + n_clean)
    found = np.zeros((2, BUCKETS))
    for k in range(N_OWN):
        pair = np.unique(row.astype(np.int64) * BUCKETS + features[:, k])
        bucket, of_toxic = pair % BUCKETS, toxic[pair // BUCKETS]
        found[0] += np.bincount(bucket[of_toxic], minlength=BUCKETS)
        found[1] += np.bincount(bucket[~of_toxic], minlength=BUCKETS)
    a, b = found
    n = np.maximum(a + b, 1)
    rate = np.clip(a / n, 1e-12, 1 - 1e-12)
    ratio = 2 * (a * np.log(rate / share) + b * np.log((1 - rate) / (1 - share)))
    # The larger share of the marker's documents must be toxic, with clear room.
    return (rate > (1 + share) / 2) & (ratio >= MARKER_TEST)


def _chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into training chains: (begin, length)."""
    begin = [np.arange(a, b, WINDOW) for a, b in zip(first[:-1], first[1:])]
    begin = np.concatenate(begin) if begin else np.zeros(0, dtype=np.int64)
    end = first[np.searchsorted(first, begin, side="right")]
    return begin, np.minimum(end - begin, WINDOW)


def _fit_field(
    features: np.ndarray, label: np.ndarray, first: np.ndarray, unmarked: int = UNMARKED, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by AdaGrad on the conditional likelihood, over
    all chains that hold a marked token and a random ``unmarked`` times as
    many of the others (of at least 50)."""
    rng = np.random.default_rng(seed)
    begin, length = _chains(first)
    total = np.concatenate(([0], np.cumsum(label)))
    marked = total[begin + length] > total[begin]
    plain = np.flatnonzero(~marked)
    plain = rng.permutation(plain)[: unmarked * max(int(marked.sum()), 50)]
    chosen = np.concatenate((np.flatnonzero(marked), plain))
    weights, step = np.zeros(BUCKETS), np.array([-2.0, 1.0, 0.0])
    seen_w, seen_s = np.full(BUCKETS, 1e-2), np.full(3, 1e-2)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // 512)):
            size = length[part]
            at = np.repeat(begin[part] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            f, y = features[at], label[at]
            edge = np.concatenate(([0], np.cumsum(size)))
            model = Model(weights, step, np.zeros(0))
            e = model.emissions(f)
            forward, backward = messages(e, edge, step)
            p = forward * backward / (1.0 + forward * backward)
            slope = np.bincount(f.ravel(), weights=np.repeat(y - p, f.shape[1]), minlength=BUCKETS)
            slope -= 1e-3 * weights * (slope != 0)
            seen_w += slope * slope
            weights = weights + 0.2 * slope / np.sqrt(seen_w)
            # Transitions: neighbouring labels against their pair marginals.
            inner = np.ones(len(y), dtype=bool)
            inner[edge[:-1][size > 0]] = False
            i = np.flatnonzero(inner)
            u, v = y[i - 1], y[i]
            ot, to, tt = np.exp(step)
            ahead = e[i] * backward[i]
            pair = np.array([ot * ahead, forward[i - 1] * to, forward[i - 1] * tt * ahead])
            pair /= 1.0 + pair.sum(axis=0)
            rise = np.array([(1 - u) * v, u * (1 - v), u * v]).sum(axis=1) - pair.sum(axis=1)
            seen_s += rise * rise
            step = np.clip(step + 0.1 * rise / np.sqrt(seen_s), -8, 8)
    return weights, step


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted, slightly regularised logistic regression by Newton steps."""
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [1e-2] * (x.shape[1] - 1)) * weight.sum() / max(len(y), 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        change = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge @ beta)
        beta = beta + change
        if np.abs(change).max() < 1e-8:
            break
    return beta


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray, unmarked: int = UNMARKED) -> Model:
    """A model from labelled documents; ``weight`` is how many documents of
    the corpus each stands for. Three of four fit the field, the rest the
    document model (all of them, where that would leave a class empty)."""
    n = len(texts)
    fold = np.arange(n) % 4
    order = np.argsort(fold == 3, kind="stable")  # those of the field come first
    toxic, weight, n_field = toxic[order], weight[order], int((fold != 3).sum())
    scored = slice(n_field, n)
    if min(toxic[scored].sum(), (~toxic[scored]).sum()) < 20:
        n_field, scored = n, slice(0, n)
    # Chunk by chunk: hashing takes many times the memory of its result.
    parts, lengths = [], []
    for _, _, data, offsets in text_chunks(pa.array([texts[k] for k in order], pa.string())):
        t, features = token_features(data, offsets)
        parts.append(features)
        lengths.append(np.diff(t.first))
    features, lengths = np.concatenate(parts), np.concatenate(lengths)
    del parts
    first = np.concatenate(([0], np.cumsum(lengths)))
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    used = slice(0, int(first[n_field]))
    marker = _markers(features[used], row[used], toxic)
    label = np.zeros(used.stop)
    for k in range(N_OWN):
        label[marker[features[used, k]] & toxic[row[used]]] = 1.0
    weights, step = _fit_field(features[used], label, first[: n_field + 1], unmarked)
    model = Model(weights, step, np.zeros(3))
    x = document_features(marginals(model.emissions(features), first, step), first)
    model.document = _fit_logistic(x[scored], toxic[scored].astype(float), weight[scored])
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    key = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(F.pmod(key, F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def _within(rows: list, budget: int) -> list:
    """Whole documents in the given order as long as their bytes fit; the
    smallest one where none does."""
    taken, used = [], 0
    for r in rows:
        if used + r["bytes"] <= budget:
            taken.append(r)
            used += r["bytes"]
    return taken or sorted(rows, key=lambda r: r["bytes"])[:1]


def train(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text",
    max_bytes: int = MAX_BYTES, unmarked: int = UNMARKED,
) -> Model:
    """Fit on a sample of the documents that are not held out: of each class
    the first ``max_docs`` by a hash of the id, whole ones as long as they
    fit into ``max_bytes``; ``unmarked`` as in ``_fit_field``."""
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("bytes"))
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
        .where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .join(ids.groupBy("doc_id").agg(F.max("bytes").alias("bytes")), "doc_id")
    )
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = counts.get(True, 0) / total if total else 0.0
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        return Model(np.zeros(BUCKETS), np.array([-30.0, 0.0, 0.0]), np.array([odds, 0.0, 0.0]))
    order = F.xxhash64("doc_id", F.lit("sample"))
    sample = [
        r for flag in (True, False)
        for r in _within(usable.where(F.col("toxic") == flag).orderBy(order, "doc_id").limit(max_docs).collect(), max_bytes)
    ]  # 2 * max_docs rows at most
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in sample], "doc_id long, toxic boolean")
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy("doc_id").collect()
    )
    toxic = np.array([r["toxic"] for r in rows], dtype=bool)
    weight = np.where(toxic, counts[True] / max(toxic.sum(), 1), counts[False] / max((~toxic).sum(), 1))
    return fit([r["text"] for r in rows], toxic, weight, unmarked)


# ------------------------------------------------------------------ scoring
def _scored(model: Model, column, with_spans: bool = True) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """(first row, end row, scores, toxic spans as character offsets) for
    runs of the texts of a column; without spans, their list is empty."""
    held: list[tuple[np.ndarray, ...]] = []
    begin, tokens = 0, 0

    def run() -> tuple[np.ndarray, list]:
        emission, lengths, *places = (np.concatenate(x) for x in zip(*held))
        first = np.concatenate(([0], np.cumsum(lengths)))
        p = marginals(emission, first, model.step)
        x = document_features(p, first)
        score = 1 / (1 + np.exp(-np.clip(x @ model.document, -30, 30)))
        if not with_spans:
            return score, []
        hit = np.flatnonzero(p >= 0.5)
        start, end = (x[hit].tolist() for x in places)
        cut = np.searchsorted(hit, first).tolist()
        return score, [[{"start": s, "end": e} for s, e in zip(start[a:b], end[a:b])] for a, b in zip(cut, cut[1:])]

    for lo, hi, data, offsets in text_chunks(column):
        t, features = token_features(data, offsets)
        places = ()
        if with_spans:
            point = np.zeros(len(data) + 1, dtype=np.int32)
            np.cumsum((data & 0xC0) != 0x80, dtype=np.int32, out=point[1:])
            base = point[offsets[:-1]][t.row]
            places = point[t.start] - base, point[t.end] - base
        held.append((model.emissions(features), np.diff(t.first), *places))
        tokens += len(t.start)
        if tokens >= RUN_TOKENS:
            yield begin, hi, *run()
            held, begin, tokens = [], hi, 0
    if held:
        yield begin, len(column), *run()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, spans (character offsets
    of the tokens that are toxic with probability 0.5 or more)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, s, found in _scored(shared.value, batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(s, pa.float64()), pa.array(found, kind)],
                    names=["doc_id", "score", "spans"],
                )

    return picked.mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,end:int>>")


def toxicity(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, spans."""
    model = train(docs, labels, max_docs, id_col, text_col)
    scored = score(docs, model, id_col, text_col)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans",
    )


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score under 0.5, with all their columns."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, s, _ in _scored(shared.value, batch.column(at), with_spans=False):
                yield batch.slice(lo, hi - lo).filter(pa.array(s < 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
