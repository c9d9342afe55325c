"""Sharding by a minimax contiguous partition (DataFrame operations only).

Rows with equal texts are an atomic group; groups are ordered by a 64-bit
hash of the text. The smallest capacity for which ``shards`` contiguous runs
of groups hold everything is found by binary search with a greedy check, and
the order is cut there.

Only summaries reach the driver. The hash space is cut into ``1 << BITS``
ranges whose total sizes are collected (a bound that does not depend on the
input). They bound the capacity from both sides and with it the places where a
cut can fall; only the ranges there are split again, until the bounds agree
or every range that a cut can meet is a single group. Ranges are split down to
60 of the hash's 64 bits: groups that agree in those (two of a billion groups
do so by chance about half the time) count as one.

Row places (``slot``) come from counts per hash range plus a row number
within it. A range of more than ``SLICE_ROWS`` rows, or of more than four times
the mean, is dealt over as many slices as its rows need, by a hash of each row's
own key, so neither a group of
copies nor a row repeated with the same id is numbered by a single task.

Cases: a null text has no bytes (size 8) and groups with the empty one; a
group larger than the mean gets a shard of its own size; rows repeated with
the same id get their own slots; fewer groups than shards leave shards
empty; an empty table gives an empty result; other columns are never looked
at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialize

BITS = 12  # of the hash, by which ranges are split at each level
SLICE_ROWS = 250_000  # about, that one task numbers at once
LEVELS = 5
EXTRA = 8  # bytes a row takes besides its text


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _range_of(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of the key, in unsigned order."""
    return F.shiftrightunsigned(key, 64 - depth)


def feasible_cuts(prefix: list[int], shards: int, capacity: int) -> list[int] | None:
    """Greedy check: the end index of each shard when each takes as many
    items as fit, or None if ``shards`` do not hold all. ``prefix`` has the
    running total, from 0."""
    n, at, cuts = len(prefix) - 1, 0, []
    for _ in range(shards):
        at = bisect_right(prefix, prefix[at] + capacity) - 1
        cuts.append(at)
    return cuts if at >= n else None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the smallest feasible shard capacity."""
    prefix = [0, *accumulate(sizes)]
    low, high = max([-(-prefix[-1] // shards), *sizes, 0]), prefix[-1]
    while low < high:
        mid = (low + high) // 2
        if feasible_cuts(prefix, shards, mid) is None:
            low = mid + 1
        else:
            high = mid
    return low


def even_cuts(sizes: list[int], shards: int, capacity: int) -> list[int]:
    """Cuts that keep every shard within ``capacity`` and, among those, each
    as near as possible to an equal share of what is left."""
    prefix = [0, *accumulate(sizes)]
    n, total = len(sizes), prefix[-1]
    need = [n]  # need[k]: first item such that the rest fits into k shards
    for _ in range(shards):
        need.append(bisect_left(prefix, prefix[need[-1]] - capacity))
    at, cuts = 0, []
    for k in range(shards, 0, -1):
        most = bisect_right(prefix, prefix[at] + capacity) - 1
        least = max(at, need[k - 1])
        goal = prefix[at] + (total - prefix[at]) / k
        j = min(max(bisect_left(prefix, goal), least), most)
        if j > least and goal - prefix[j - 1] < prefix[j] - goal:
            j -= 1
        cuts.append(j)
        at = j
    cuts[-1] = n
    return cuts


def _uncertain(items: list[tuple], shards: int) -> set[int]:
    """Items of several groups that must be split to settle the capacity.

    ``low`` bounds the capacity of the single groups from below, ``high`` is
    what the items need as they are; if they agree, nothing is open. Items
    over ``low`` come first, as a large group may hide in them. Otherwise cut k
    of any solution lies between total - (shards - k) * high and k * high."""
    sizes = [x[2] for x in items]
    prefix = [0, *accumulate(sizes)]
    total = prefix[-1]
    high = smallest_capacity(sizes, shards)
    low = max([-(-total // shards), *(x[2] for x in items if x[3] == 1), 0])
    if high == low:
        return set()
    large = {i for i, x in enumerate(items) if x[3] > 1 and x[2] > low}
    if large:
        return large
    found: set[int] = set()
    for k in range(1, shards):
        a, b = max(0, total - (shards - k) * high), min(total, k * high)
        lo, hi = bisect_right(prefix, a) - 1, bisect_left(prefix, b)
        found.update(i for i in range(max(lo, 0), min(hi, len(items))) if items[i][3] > 1)
    return found


def plan_cuts(
    summary: Callable[[int, list[int] | None], list[tuple[int, int, int]]], shards: int
) -> tuple[list[tuple], list[int], int]:
    """(items, cuts, capacity). An item is (depth, range, size, groups); a
    call summary(depth, parents) lists (range, size, groups) at that depth,
    within the given ranges one level up."""
    items = [(BITS, r, s, g) for r, s, g in sorted(summary(BITS, None))]
    while marked := {i for i in _uncertain(items, shards) if items[i][0] < BITS * LEVELS}:
        below: dict[tuple[int, int], list[tuple]] = {}
        for depth in {items[i][0] for i in marked}:
            parents = sorted(items[i][1] for i in marked if items[i][0] == depth)
            for r, s, g in sorted(summary(depth + BITS, parents)):
                below.setdefault((depth, r >> BITS), []).append((depth + BITS, r, s, g))
        items = [y for i, x in enumerate(items) for y in (below[x[0], x[1]] if i in marked else [x])]
    sizes = [x[2] for x in items]
    capacity = smallest_capacity(sizes, shards)
    return items, even_cuts(sizes, shards, capacity), capacity


def shard_rows(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law ('bytes'),
    shard, slot, grown_shard (null: more shards mean a new partition)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(EXTRA)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        _key(text).alias("key"),
        F.monotonically_increasing_id().alias("row"),  # written once, so it stays
    )
    rows = materialize(rows, "shard_rows")

    def summary(depth: int, parents: list[int] | None) -> list[tuple[int, int, int]]:
        part = rows.withColumn("range", _range_of(F.col("key"), depth))
        if parents is not None:
            wanted = spark.createDataFrame([(p,) for p in parents], "parent long")
            part = part.withColumn("parent", F.shiftright("range", BITS)).join(
                F.broadcast(wanted), "parent", "left_semi"
            )
        groups = part.groupBy("range", "key").agg(F.sum("size").alias("size"))
        found = groups.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("groups"))
        return [(r["range"], r["size"], r["groups"]) for r in found.toLocalIterator()]

    items, cuts, _ = plan_cuts(summary, shards)
    # First key (unsigned) of each shard, as the order of signed keys needs it.
    firsts, begin = [], 0
    for k, end in enumerate(cuts):
        if end > begin:
            depth, r, _, _ = items[begin]
            firsts.append((k, r << (64 - depth)))
        begin = end
    shard = F.lit(0)
    flipped = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    for k, first in firsts:
        shard = F.when(flipped >= F.lit(first - (1 << 63)), F.lit(k)).otherwise(shard)

    placed = rows.withColumn("shard", shard).withColumn("range", _range_of(F.col("key"), BITS))
    # At most 1 << BITS rows, whatever the input.
    in_ranges = [(r["range"], r["count"]) for r in placed.groupBy("range").count().collect()]
    most = max(1, min(slice_rows, 4 * sum(n for _, n in in_ranges) >> BITS))
    heavy = spark.createDataFrame([(r, -(-n // most)) for r, n in in_ranges if n > most], "range long, slices long")
    placed = placed.join(F.broadcast(heavy), "range", "left")
    slice_ = F.when(F.col("slices").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("row"), F.col("slices")))
    placed = placed.withColumn("slice", slice_.cast("int"))
    counts = placed.groupBy("shard", "range", "slice").agg(F.count("*").alias("n"))
    # One row per shard, range and slice.
    in_range = Window.partitionBy("shard", "range").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("shard", "range").agg(F.sum("n").alias("n"))
    begins = totals.select("shard", "range", F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("begin"))
    inner = counts.select(
        "shard", "range", "slice", F.coalesce(F.sum("n").over(in_range), F.lit(0)).alias("skip")
    )
    base = inner.join(begins, ["shard", "range"])
    number = F.row_number().over(Window.partitionBy("shard", "range", "slice").orderBy("key", "doc_id", "row"))
    return (
        placed.withColumn("number", number)
        .join(base, ["shard", "range", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("begin") + F.col("skip") + F.col("number") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
