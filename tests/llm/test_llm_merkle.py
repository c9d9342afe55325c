import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, idx string, k0 int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def above(nodes, fanout):
    """All levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[k : k + fanout]) for k in range(0, len(last), fanout)])
    return levels


def siblings(levels, at, fanout):
    for nodes in levels[:-1]:
        run = at // fanout * fanout
        yield nodes[run:at], nodes[at + 1 : run + fanout]
        at //= fanout


def expected(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = above([leaf_of(r) for r in groups[g]], fanout)
    top = above([trees[g][-1][0] for g in order], fanout)
    out = []
    for t, g in enumerate(order):
        for k, r in enumerate(groups[g]):
            path = [*siblings(trees[g], k, fanout), *siblings(top, t, fanout)]
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], tuple(("".join(a), "".join(b)) for a, b in path)))
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "x", "y", 8) for r in rows], SCHEMA).repartition(parts)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in df.collect()), key=str)


def sample(n):
    langs = [None, "", "de", "é", "z"]
    return [(k, None if k % 11 == 0 else f"s{k % 3}", "en" if k % 3 else langs[k % 5], k if k % 4 else None, f"text {k}") for k in range(n)]


ODD = [(None, "a", "en", 1, "x"), (None, "a", "en", 1, "x"), (5, None, None, None, None), (5, None, None, None, ""),
       (6, "", "en", 9, "é 日本 \U0001f642"), (7, "s", "en", 2**63 - 1, "w" * 100_000), (8, "-", "only", 0, "-")]


@pytest.mark.parametrize("fanout, part, block, n", [(2, 15, 4096, 100), (2, 3, 4, 103), (3, 2, 9, 130), (5, 1, 2, 41), (2, 0, 2, 33)])
def test_proofs_match_brute_force(spark, monkeypatch, fanout, part, block, n):
    """Small leaf partitions and blocks, so that many partitions and rounds
    take part."""
    monkeypatch.setattr(merkle, "PART_BITS", part)
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "ship", lambda spark: None)
    rows = sample(n) + ODD + [(50, "same", "en", 1, "again")] * 20
    assert got(merkle.proofs(frame(spark, rows), fanout=fanout)) == expected(rows, fanout)


@pytest.mark.parametrize("size, fanout, lo, hi", [(1, 2, 0, 1), (7, 2, 2, 5), (100, 2, 37, 38), (100, 3, 0, 100), (64, 4, 5, 61)])
def test_requests_are_minimal(size, fanout, lo, hi):
    """Each proof is made of own and missing nodes only, and no missing node
    has all its leaves inside the range."""
    asked = list(merkle.missing(size, fanout, lo, hi))
    assert len(set(asked)) == len(asked)
    for level, i in asked:
        span = fanout**level
        assert (i + 1) * span <= lo or i * span >= hi
    levels = above([str(k) for k in range(size)], fanout)
    fetched = {(l, i): levels[l][i].encode() for l, i in asked}
    found, root = merkle.derive(size, fanout, lo, [str(k).encode() for k in range(lo, hi)], fetched)
    assert root.decode() == levels[-1][0]
    for k in (lo, hi - 1):
        want = [("".join(a), "".join(b)) for a, b in siblings(levels, k, fanout)]
        assert [(a.decode(), b.decode()) for a, b in merkle.path_of(k, fanout, found)] == want


def test_tampering_is_found(spark):
    docs = frame(spark, sample(60))
    other = merkle.leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    rows = merkle.audit(merkle.proofs(docs, carry={"claimed": F.when(F.col("doc_id") < 30, other)}), F.col("claimed")).collect()
    assert all(r.verified == (r.doc_id >= 30 or r.doc_id % 4 == 0) == (r.folded_root == r.root) for r in rows)
    assert len(rows) == 60


def test_empty_table_and_one_row(spark):
    assert merkle.proofs(frame(spark, [])).count() == 0
    (r,) = merkle.proofs(frame(spark, [(1, "a", None, 2, "t")])).collect()
    assert r.leaf == r.subroot == r.root == leaf_of((1, "a", None, 2, "t")) and r.path == []
