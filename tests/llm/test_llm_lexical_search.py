import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import lexical_search as L

TERM = re.compile(L.TERM)
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UP))


def expected(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c) for i, c in bags if c]
    n_docs, n_all = len(bags), sum(c.total() for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        q = Counter(terms(text))
        found = []
        for i, c in bags:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_all
            score = sum(
                again * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, again in q.items() if t in c
            )
            if score > 0:
                found.append((-score, i is None, i if i is not None else 0))
        out += ((item, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(found)[:k], 1))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in docs], "doc_id long, text string, id string, n int, score int, item_id int")
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, block int")
    return d.repartition(5), q


WORDS = ["the", "of", "and", *(f"w{k}" for k in range(40)), "é", "日本", "naïve"]


def corpus(n, seed):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(WORDS))]
    sep = [" ", ", ", "\n", "--", "\x00"]
    return [
        (k, "".join(rng.choice((w, w.upper())) + rng.choice(sep) for w in rng.choices(WORDS, weights, k=rng.randrange(60))))
        for k in range(n)
    ]


@pytest.mark.parametrize("block, size", [(2 << 20, 1 << 21), (200, 300)])
def test_ranking_matches_brute_force(spark, monkeypatch, odd_rows, block, size):
    """Also with small blocks of queries and of documents."""
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    monkeypatch.setattr(L, "BLOCK_COUNTS", size)
    monkeypatch.setattr(L, "ship", lambda spark: None)
    docs = corpus(300, 1) + odd_rows + [(1000 - k, "one two the w5") for k in range(60)] + [(None, "w5 w6")]
    items = corpus(25, 2) + [(90, None), (91, " -- "), (None, "one two"), (92, " ".join(WORDS * 3 + [f"x{k}" for k in range(90)])),
                             (93, "w5"), (93, "w5"), (94, "unknown"), (95, "x" * 5000)]
    for k in (1, 20):
        assert got(L.search(*frames(spark, docs, items), k=k)) == expected(docs, items, k)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert L.search(docs.limit(0), items).count() == 0
    assert L.search(docs, items.limit(0)).count() == 0
    assert L.search(docs, items).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_long_texts_are_read_in_pieces(monkeypatch):
    """Pieces are bounded, and neither a term at a cut nor a term longer than a
    piece is lost."""
    rng = random.Random(3)
    text = "".join(rng.choice(["abc", "de", "é日", "q" * 300]) + rng.choice(" -\n") for _ in range(3000))
    words = ["abc", "de", "é日", "q" * 300, "q"]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    parts = list(L._pieces(data, np.array([0, len(data)]), 100))
    assert sum(len(p) for _, p, _ in parts) == len(data) and max(len(p) for _, p, _ in parts) <= 100 + 303
    monkeypatch.setattr(L, "CHUNK_BYTES", 100)
    monkeypatch.setattr(L, "_pieces", lambda d, o, limit=100, f=L._pieces: f(d, o, limit))
    n, row, term, tf = L.count_terms(pa.array(["abc x", None, text, text]), L.Dictionary(words), len(words))
    want = Counter(terms(text))
    assert n.tolist() == [2, 0, want.total(), want.total()]
    assert {(r, words[t]): c for r, t, c in zip(row, term, tf)} == {
        (0, "abc"): 1, **{(r, w): want[w] for r in (2, 3) for w in words if want[w]}
    }


def test_masks_end_early():
    """Documents whose mask cannot reach the best ones are not scored."""
    n = 4000
    rare = np.arange(n) % 100 == 0
    at = np.concatenate(([0], np.cumsum(1 + rare)))
    term = np.concatenate([[0, 1] if r else [0] for r in rare])
    block = L.Block(np.arange(n), np.zeros(n, bool), np.full(n, 10), at, term, np.ones(len(term), np.int64), n, 10 * n)
    best = L.Best(20)
    assert block.rank([(0, 10), (1, 4000)], best) == rare.sum()
    assert best.doc.tolist() == list(range(0, 2000, 100))
