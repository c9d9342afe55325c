"""Merkle manifest of a dataset: a digest of every row, one tree of digests per
group, a tree over the groups' roots, and an inclusion proof of every row.

A leaf is the digest of a row's fields. Leaves of a group ascend by id; while
several nodes remain, every ``fanout`` consecutive ones become the digest of
their texts. The groups' roots, in order of the group (null first), make the
top tree in the same way.

Method (octopus multiproof). The leaves get their places by one sort over the
whole table and are cut into leaf partitions of 2^15 consecutive ones,
wherever the groups end. Trees are built in rounds of aligned blocks, one task
per block, and only nodes that a leaf partition may lack are stored. From the
bounds of its range alone each partition computes the minimal union of missing
node coordinates: of every level the rest of the first and of the last run.
They are fetched once by a join. The partition then derives all interiors that
its leaves share and expands the single proofs locally.

What moves: digests, ids and groups, never texts. No group of rows larger than
a block or a leaf partition meets in one task, whatever the sizes of groups.

Cases: a null field counts as null, not as an empty text; a null group is a
group of its own, the first; a null id sorts first. Rows with the same id and
group are ordered by their leaf, and equal rows are leaves of their own, so
the result does not depend on which of them comes first. A table without rows
gives no rows. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.ship import ship
from ledgerlens.session import materialize
from ledgerlens.sources.fixtures import with_row_index

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PART_BITS = 15  # leaf partitions of 32,768 rows
BLOCK = 4096  # nodes that one task of a round turns into a subtree
TOP = -1  # number of the tree over the groups' roots; the groups count from 0


# ------------------------------------------------------------------ digests --
def field_text(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` for null, else its length in UTF-8
    bytes, a colon and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields' texts one after another."""
    return F.sha2(F.concat(*map(field_text, values)), 256)


def proof_digest(path: Column | str) -> Column:
    """Hex SHA-256 of all siblings of a proof, from the leaf to the root."""
    texts = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(texts, ""), 256)


def fold(path: Column | str, leaf: Column) -> Column:
    """The root that a leaf and the siblings of a proof lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def _digest(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


# -------------------------------------------------------------- coordinates --
def missing(size: int, fanout: int, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """(level, index) of every node that is needed, besides the leaves lo to
    hi - 1 of a tree of ``size`` leaves, to derive all their proofs. Minimal:
    no node of it can be derived from the others."""
    level = 0
    while size > 1:
        first, end = lo // fanout * fanout, min(-(-hi // fanout) * fanout, size)
        yield from ((level, i) for i in (*range(first, lo), *range(hi, end)))
        lo, hi, size, level = first // fanout, -(-end // fanout), -(-size // fanout), level + 1


@dataclass
class Level:
    """The whole runs of one level that a partition's leaves lie in."""

    first: int
    nodes: list[bytes]


def derive(
    size: int, fanout: int, lo: int, leaves: list[bytes], fetched: Mapping[tuple[int, int], bytes]
) -> tuple[list[Level], bytes]:
    """The runs above consecutive leaves, level by level, and the root."""
    levels, own, level = [], leaves, 0
    while size > 1:
        hi = lo + len(own)
        first, end = lo // fanout * fanout, min(-(-hi // fanout) * fanout, size)
        nodes = [fetched[level, i] for i in range(first, lo)] + own + [fetched[level, i] for i in range(hi, end)]
        levels.append(Level(first, nodes))
        own = [_digest(nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        lo, size, level = first // fanout, -(-size // fanout), level + 1
    return levels, own[0]


def path_of(index: int, fanout: int, levels: Sequence[Level]) -> Iterator[tuple[bytes, bytes]]:
    """Of each level the siblings left and right of a leaf's ancestor."""
    for lv in levels:
        at, run = index - lv.first, index // fanout * fanout - lv.first
        yield b"".join(lv.nodes[run:at]), b"".join(lv.nodes[at + 1 : run + fanout])
        index //= fanout


# -------------------------------------------------------------------- trees --
def _levels_of_block(fanout: int) -> int:
    n = 1
    while fanout ** (n + 1) <= BLOCK:
        n += 1
    return n


def _subtree(base: int, steps: int, fanout: int, bits: int):
    return lambda table: _climb(table, base, steps, fanout, bits)


def _climb(table: pa.Table, base: int, steps: int, fanout: int, bits: int) -> pa.Table:
    """All levels above a block of consecutive nodes of level ``base``. The
    nodes of the last level go on to the next round; of the others only
    those stay whose run crosses a border of leaf partitions."""
    table = table.sort_by("idx")
    tree, size, first = (table.column(c)[0].as_py() for c in ("tree", "size", "first"))
    lo, own = table.column("idx")[0].as_py(), [x.encode() for x in table.column("digest").to_pylist()]
    n = size
    for _ in range(base):
        n = -(-n // fanout)
    found: list[tuple[int, int, bytes, bool]] = []
    for level in range(base + 1, base + steps + 1):
        if n == 1:
            break
        own = [_digest(own[k : k + fanout]) for k in range(0, len(own), fanout)]
        lo, n = lo // fanout, -(-n // fanout)
        span, last = fanout ** (level + 1), n == 1 or level == base + steps
        for i, h in enumerate(own, lo):
            run = i // fanout * span
            ends = (first + run, first + min(run + span, size) - 1)
            apart = tree == TOP or ends[0] >> bits != ends[1] >> bits
            if last or apart:
                found.append((level, i, h, n == 1))
    levels, at, digests, tops = zip(*found) if found else ((), (), (), ())
    k = len(found)
    return pa.table(
        {
            "tree": pa.array([tree] * k, pa.int64()),
            "level": pa.array(levels, pa.int32()),
            "idx": pa.array(at, pa.int64()),
            "digest": pa.array([d.decode() for d in digests], pa.string()),
            "size": pa.array([size] * k, pa.int64()),
            "first": pa.array([first] * k, pa.int64()),
            "is_root": pa.array(tops, pa.bool_()),
        }
    )


_NODE = "tree long, level int, idx long, digest string, size long, first long, is_root boolean"


def _build(leaves: DataFrame, largest: int, fanout: int) -> list[DataFrame]:
    """Nodes above the leaves (tree, idx, digest, size, first), one written
    table a round. ``largest`` is the size of the largest tree."""
    steps, base, rounds = _levels_of_block(fanout), 0, []
    block = fanout**steps
    current = leaves.where("size > 1")
    while largest > 1:
        nodes = (
            current.groupBy("tree", F.floor(F.col("idx") / block).alias("block"))
            .applyInArrow(_subtree(base, steps, fanout, PART_BITS), _NODE)
        )
        rounds.append(materialize(nodes, "merkle_nodes"))
        base, largest = base + steps, -(-largest // block)
        current = rounds[-1].where((F.col("level") == base) & ~F.col("is_root"))
        current = current.select("tree", "idx", "digest", "size", "first")
    return rounds


def _stored(leaves: DataFrame, rounds: Sequence[DataFrame], whole: bool, fanout: int) -> DataFrame:
    """The nodes that partitions may ask for: (tree, level, idx, digest)."""
    kept = leaves
    if not whole:
        run = F.floor(F.col("idx") / fanout) * fanout
        ends = [F.col("first") + run, F.col("first") + F.least(run + fanout, F.col("size")) - 1]
        low, high = (F.shiftright(e.cast("long"), PART_BITS) for e in ends)
        kept = leaves.where(low != high)
    out = kept.select("tree", F.lit(0).alias("level"), "idx", "digest")
    for r in rounds:
        out = out.unionAll(r.select("tree", "level", "idx", "digest"))
    return out


# ------------------------------------------------------------------- proofs --
def _requests(fanout: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[int, int, int, int]] = []
            for r in b.to_pylist():
                rows += ((r["part"], r["tree"], *c) for c in missing(r["size"], fanout, r["lo"], r["hi"] + 1))
            cols = list(zip(*rows)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("part", "tree", "level", "idx")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(names))

    return ask


def _expand(fanout: int, n_trees: int, carried: Sequence[str]):
    """(leaves, fetched nodes) of one partition -> its rows with proofs."""
    step = pa.struct([("left", pa.string()), ("right", pa.string())])

    def expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        leaves = leaves.sort_by([("tree", "ascending"), ("idx", "ascending")])
        fetched: dict[int, dict[tuple[int, int], bytes]] = {}
        for r in nodes.to_pylist():
            fetched.setdefault(r["tree"], {})[r["level"], r["idx"]] = r["digest"].encode()
        tree, at, size = (leaves.column(c).to_pylist() for c in ("tree", "idx", "size"))
        digests = [x.encode() for x in leaves.column("leaf").to_pylist()]
        starts = [k for k in range(len(tree)) if k == 0 or tree[k] != tree[k - 1]]
        trees = [
            derive(size[a], fanout, at[a], digests[a:b], fetched.get(tree[a], {}))
            for a, b in zip(starts, [*starts[1:], len(tree)])
        ]
        top, root = derive(n_trees, fanout, tree[0], [r for _, r in trees], fetched.get(TOP, {}))
        left: list[bytes] = []
        right: list[bytes] = []
        offsets, subroots = [0], []
        for (levels, subroot), a, b in zip(trees, starts, [*starts[1:], len(tree)]):
            above = list(path_of(tree[a], fanout, top))
            for k in range(a, b):
                for x, y in path_of(at[k], fanout, levels):
                    left.append(x)
                    right.append(y)
                for x, y in above:
                    left.append(x)
                    right.append(y)
                offsets.append(len(left))
            subroots += [subroot.decode()] * (b - a)
        sides = [pa.array(s, pa.binary()).cast(pa.string()) for s in (left, right)]
        path = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(sides, fields=list(step)))
        n = len(tree)
        cols = {c: leaves.column(c) for c in carried}
        cols |= {"leaf": leaves.column("leaf"), "subroot": pa.array(subroots, pa.string())}
        return pa.table(cols | {"root": pa.array([root.decode()] * n, pa.string()), "path": path})

    return expand


def proofs(
    docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
    fanout: int = 2, carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, the ``carry`` columns (computed from
    its row), leaf, subroot (root of its group), root (of everything) and
    path, the proof: of each level from the leaf to the root, the digests
    of the siblings to its left and to its right, joined."""
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    spark = docs.sparkSession
    ship(spark)
    carry = dict(carry or {})
    own = [id_col, *carry]
    leaf = leaf_digest([F.col(f) for f in fields])
    rows = docs.select(
        F.col(id_col).alias("k0"), *(c.alias(f"k{n}") for n, c in enumerate(carry.values(), 1)),
        F.col(group_col).alias("grp"), leaf.alias("leaf"), F.monotonically_increasing_id().alias("tie"),
    )
    rows = materialize(rows, "merkle_leaves")  # the sort reads it twice: texts are hashed once
    order = [F.col("grp").asc_nulls_first(), F.col("k0").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    ranked = with_row_index(rows, order, "place").drop("tie")
    groups = ranked.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    groups = materialize(with_row_index(groups, [F.col("first")], "tree"), "merkle_groups")
    n_trees, largest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).head()

    placed = ranked.join(groups.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(
        *(f"k{n}" for n in range(len(own))), "leaf", "tree", (F.col("place") - F.col("first")).alias("idx"),
        "size", "first", F.shiftright("place", PART_BITS).alias("part"),
    )
    leaves = placed.select("tree", "idx", F.col("leaf").alias("digest"), "size", "first")
    rounds = _build(leaves, largest, fanout)

    # The groups' roots are the leaves of the top tree.
    roots = leaves.where("size = 1").select("tree", "digest")
    for r in rounds:
        roots = roots.unionAll(r.where("is_root").select("tree", "digest"))
    top_leaves = roots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
        F.lit(n_trees).cast("long").alias("size"), F.lit(0).cast("long").alias("first"),
    )
    top_rounds = _build(top_leaves, n_trees, fanout)
    nodes = _stored(leaves, rounds, False, fanout).unionAll(_stored(top_leaves, top_rounds, True, fanout))

    ranges = placed.groupBy("part", "tree").agg(
        F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.max("size").alias("size")
    )
    ranges = materialize(ranges, "merkle_ranges")
    tops = ranges.groupBy("part").agg(
        F.lit(TOP).cast("long").alias("tree"), F.min("tree").alias("lo"), F.max("tree").alias("hi"),
        F.lit(n_trees).cast("long").alias("size"),
    )
    asked = ranges.unionAll(tops).mapInArrow(_requests(fanout), "part long, tree long, level int, idx long")
    fetched = asked.join(nodes, ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "digest")

    carried = [f"k{n}" for n in range(len(own))]
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in carried)
    out = (
        placed.drop("first").groupBy("part").cogroup(fetched.groupBy("part"))
        .applyInArrow(
            _expand(fanout, n_trees, carried),
            f"{schema}, leaf string, subroot string, root string, path array<struct<left: string, right: string>>",
        )
    )
    return out.select(*(F.col(c).alias(name) for c, name in zip(carried, own)), "leaf", "subroot", "root", "path")


def audit(proved: DataFrame, claimed: Column) -> DataFrame:
    """Adds folded_root, the root that a claimed leaf (the row's own where
    null) leads to by the row's proof, and verified, whether that is the
    manifest's root."""
    folded = fold("path", F.coalesce(claimed, F.col("leaf")))
    return proved.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))
