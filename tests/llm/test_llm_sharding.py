import zlib
from collections import defaultdict
from itertools import accumulate

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import sharding

sizes = st.lists(st.integers(1, 50), max_size=40)


def brute_capacity(items, shards):
    """Minimax contiguous partition by dynamic programming."""
    prefix = [0, *accumulate(items)]
    best = [0] + [float("inf")] * len(items)
    for _ in range(shards):
        best = [min(max(best[j], prefix[i] - prefix[j]) for j in range(i + 1)) for i in range(len(items) + 1)]
    return best[-1]


@settings(max_examples=80, deadline=None)
@given(sizes, st.integers(1, 6))
def test_smallest_capacity(items, shards):
    assert sharding.smallest_capacity(items, shards) == brute_capacity(items, shards)


@settings(max_examples=80, deadline=None)
@given(sizes, st.integers(1, 6))
def test_cuts_stay_within_the_capacity(items, shards):
    capacity = sharding.smallest_capacity(items, shards)
    cuts = sharding.even_cuts(items, shards, capacity)
    assert len(cuts) == shards and cuts[-1] == len(items) and cuts == sorted(cuts)
    at = 0
    for c in cuts:
        assert sum(items[at:c]) <= capacity
        at = c


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(0, (1 << 60) - 1), st.integers(1, 500), max_size=60), st.integers(1, 8))
def test_summaries_lead_to_the_capacity_of_all_groups(leading, shards):
    """The plan from refined ranges is as good as one over single groups
    (told apart by the 60 leading bits of their hash)."""
    groups = {key << 4: size for key, size in leading.items()}

    def summary(depth, parents):
        found = defaultdict(lambda: [0, 0])
        for key, size in groups.items():
            r = key >> (64 - depth)
            if parents is None or r >> sharding.BITS in parents:
                found[r][0] += size
                found[r][1] += 1
        return [(r, s, n) for r, (s, n) in found.items()]

    _, _, capacity = sharding.plan_cuts(summary, shards)
    ordered = [s for _, s in sorted(groups.items())]
    assert capacity == sharding.smallest_capacity(ordered, shards)


def test_plan_splits_crowded_ranges():
    """Groups that share their leading bits are told apart further down."""
    groups = {(7 << 52) | (k << 30): 10 + k % 3 for k in range(400)}

    def summary(depth, parents):
        found = defaultdict(lambda: [0, 0])
        for key, size in groups.items():
            r = key >> (64 - depth)
            if parents is None or r >> sharding.BITS in parents:
                found[r][0] += size
                found[r][1] += 1
        return [(r, s, n) for r, (s, n) in found.items()]

    _, _, capacity = sharding.plan_cuts(summary, 8)
    assert capacity == sharding.smallest_capacity([s for _, s in sorted(groups.items())], 8)


def check(rows, out, shards):
    assert len(out) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in out:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        shard_of[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())


def test_rows_of_a_table(frame, odd_rows):
    rows = odd_rows + [(100 + k, "copy") for k in range(300)] + [(500 + k, f"t{k} " * (k % 40)) for k in range(400)]
    check(rows, sharding.shard_rows(frame(rows), 24).collect(), 24)


def test_hot_range_of_short_texts_is_sliced(frame):
    """Copies of a short text, by rows a third of all; one id repeated."""
    rows = [(k, "") for k in range(900)] + [(5, "same")] * 700 + [(2000 + k, f"text {k} " * 50) for k in range(1400)]
    check(rows, sharding.shard_rows(frame(rows), 5, slice_rows=40).collect(), 5)


def test_sizes_are_near_equal(frame):
    rows = [(k, f"text {k} " * 10) for k in range(2000)]
    out = sharding.shard_rows(frame(rows), 8).toPandas()
    total = out.groupby("shard")["size"].sum()
    assert len(total) == 8 and total.max() - total.min() < 500


def test_empty_table(frame):
    assert sharding.shard_rows(frame([])).count() == 0
