import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import byte_bpe


@pytest.fixture(scope="module")
def theirs(rank_file):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(rank_file), special_tokens={}
    )


@pytest.fixture(scope="module")
def ours(rank_file):
    return byte_bpe.ByteBPE(rank_file, public_tokenizers.PATTERN)


def told(bpe, texts):
    return [b" ".join(runs).decode() for runs in bpe.encode_texts(texts)]


letters = st.sampled_from(list("aetbx  '.,\n\t0159é日\U0001f642sldt"))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(letters, max_size=80).map("".join), max_size=5))
def test_ids_are_those_of_the_library(ours, theirs, texts):
    ours.known.clear()
    assert told(ours, texts) == [" ".join(map(str, theirs.encode_ordinary(t))) for t in texts]


def test_long_pieces_and_long_texts(ours, theirs, monkeypatch):
    texts = ["a" * 700, "ab" * 300 + " " + "é" * 130, " \n" * 200, "The quick don't " * 300, "<|endoftext|>"]
    want = [" ".join(map(str, theirs.encode_ordinary(t))) for t in texts]
    assert told(ours, texts) == want
    monkeypatch.setattr(byte_bpe, "RUN_PIECES", 7)  # every text in runs
    monkeypatch.setattr(ours, "limit", 3)  # and a cache that is always full
    assert told(ours, texts) == want


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abetnis"), min_size=1, max_size=300), st.integers(1, 4))
def test_equal_ranks_at_once(ours, theirs, word, times):
    before, byte_bpe.LONG_PIECE = byte_bpe.LONG_PIECE, 2
    try:
        ours.known.clear()
        assert told(ours, [word * times]) == [" ".join(map(str, theirs.encode_ordinary(word * times)))]
    finally:
        byte_bpe.LONG_PIECE = before


def test_a_merge_that_makes_a_lower_rank_comes_first(tmp_path):
    """Ranks that no training gives: "aba" is lower than "ab"."""
    tokens = [bytes([b]) for b in range(256)] + [b"aba", b"bab", b"ab", b"aab", b"abab", b"ba"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens)))
    bpe = byte_bpe.ByteBPE(str(path), public_tokenizers.PATTERN)
    rng = random.Random(3)
    for size in (600, 700, 1500):
        piece = "".join(rng.choices("ab", k=size))
        want = [t.encode() for t in piece]
        while True:
            pairs = [(bpe.ranks.get(x + y, 1 << 30), k) for k, (x, y) in enumerate(zip(want, want[1:]))]
            rank, k = min(pairs)
            if rank == 1 << 30:
                break
            want[k : k + 2] = [want[k] + want[k + 1]]
        assert told(bpe, [piece]) == [" ".join(str(bpe.ranks[t]) for t in want)]


def test_a_piece_of_a_megabyte(ours, theirs):
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(2000)]
    piece = "".join(rng.choices(words, k=180_000))[: 1 << 20]
    begin = time.monotonic()
    got = told(ours, [piece])
    assert time.monotonic() - begin < 120
    assert got == [" ".join(map(str, theirs.encode_ordinary(piece)))]


def test_digests_of_a_table(frame, odd_rows, rank_file, theirs):
    out = byte_bpe.token_digests(frame(odd_rows), rank_file, public_tokenizers.PATTERN).collect()
    want = []
    for i, t in odd_rows:
        ids = theirs.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_round_trip(frame, odd_rows, rank_file):
    encoded = byte_bpe.encode(frame(odd_rows), rank_file, public_tokenizers.PATTERN)
    back = byte_bpe.decode(encoded, rank_file, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, r.text) for r in back.collect()), key=str)
    assert got == sorted(((i, t or "") for i, t in odd_rows), key=str)


def test_null_ids_and_empty_table(spark, frame, rank_file):
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    out = {r.doc_id: r.text for r in byte_bpe.decode(none, rank_file, public_tokenizers.PATTERN).collect()}
    assert out == {1: None, 2: ""}
    assert byte_bpe.token_digests(frame([]), rank_file, public_tokenizers.PATTERN).count() == 0
