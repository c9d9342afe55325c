import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import caches, graph, idset, ship, words


@pytest.mark.parametrize("most_bits", [1 << 8, 1 << 10, idset.MOST_BITS])
def test_rows_without_a_set_of_ids(spark, most_bits):
    df = spark.createDataFrame([(k if k % 11 else None, f"t{k}", k) for k in range(300)], "doc_id long, _page string, _c0 int")
    gone = spark.createDataFrame([(k,) for k in range(0, 300, 3)] + [(None,), (9999,)], "doc_id long")
    out = idset.without(df, gone, "doc_id", most_bits)
    assert out.columns == df.columns
    want = sorted(k for k in range(300) if k % 11 == 0 or k % 3)
    assert sorted(r._c0 for r in out.collect()) == want
    likely = {r._c0 for r in idset.likely_in(df, gone, "doc_id", most_bits).collect()}
    assert {k for k in range(300) if k % 11 and k % 3 == 0} <= likely


@pytest.mark.parametrize("most_bits", [1 << 10, idset.MOST_BITS])
def test_rows_without_repeats(spark, most_bits):
    df = spark.createDataFrame([(f"k{k % 200}", k) for k in range(300)], "key string, n int")
    keys = spark.createDataFrame([(f"k{k}", k % 2 == 0) for k in range(100)] + [("k150", False)], "key string, kept boolean")
    out = [r.key for r in idset.without_repeats(df, keys, "key", most_bits).collect()]
    assert sorted(out) == sorted(f"k{k}" for k in range(200) if k != 150 and (k >= 100 or k % 2 == 0))


def test_bitmap_grows_with_the_ids(spark):
    """With ten times as many ids as the least bitmap has room for, few rows
    that are in no list take the exact way."""
    ids = spark.range(idset.LEAST_BITS // idset.BITS_AN_ID * 10).withColumnRenamed("id", "doc_id")
    others = spark.range(10**9, 10**9 + 20_000).withColumnRenamed("id", "doc_id")
    assert idset.likely_in(others, ids).count() < 20_000 / 12


def test_no_ids(spark):
    df = spark.range(5).withColumnRenamed("id", "doc_id")
    assert idset.without(df, df.limit(0)).count() == 5 and idset.likely_in(df, df.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(int(a), int(b)) for a, b in rng.integers(0, 90, (60, 2))] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_sliced_and_wide_columns():
    column = pa.array(["ab", None, "c d", "", "é"]).slice(1)
    for c in (column, column.cast(pa.large_string()), pa.chunked_array([column.slice(0, 2), column.slice(2)])):
        data, offsets = words.text_parts(c)
        assert data.tobytes().decode() == "c dé" and offsets.tolist() == [0, 0, 3, 3, 5]


def test_byte_hash_depends_on_the_bytes_alone():
    data = np.frombuffer(b"abcabcab", np.uint8)
    h = words.ByteHash(data).of(np.array([0, 3, 0, 1]), np.array([3, 6, 2, 3]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def test_a_file_is_read_by_the_name_it_was_handed_out_under(spark, tmp_path):
    (tmp_path / "words-of-a-test.txt").write_text("one two")
    name = ship.ship_file(spark, str(tmp_path / "words-of-a-test.txt"))
    ship.ship(spark)

    def run(batches):
        for batch in batches:
            with open(ship.shipped(name)) as f:
                yield pa.RecordBatch.from_arrays([pa.array([f.read()] * len(batch))], names=["body"])

    out = spark.range(0, 6, 1, 3).mapInArrow(run, "body string").collect()
    assert [r.body for r in out] == ["one two"] * 6


def test_a_released_task_leaves_nothing_behind():
    caches.kept("another operator's", list)
    run = caches.released(lambda batches: (caches.kept("own", lambda: b) for b in batches))
    assert list(run(iter([1, 2]))) == [1, 1] and not caches._kept
