import itertools
import string
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import packing, word_tokens
from ledgerlens.llm.word_tokens import WordEncoder


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 5), max_size=6), st.integers(1, 14))
def test_fullest_is_the_best_subset(counts, room):
    table = [counts.get(k, 0) for k in range(15)]
    used = packing.fullest(table, room)
    assert all(n <= table[k] for k, n in used)
    items = [k for k, n in counts.items() for _ in range(n)]
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums if s + x <= room}
    assert sum(k * n for k, n in used) == max(sums)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 40), max_size=12))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.minimum_bin_slack(histogram, 20)
    used = {}
    for c in plan:
        assert sum(k * n for k, n in c.pieces) <= 20
        for k, n in c.pieces:
            used[k] = used.get(k, 0) + n * c.repeat
    assert used == histogram


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(3)
    lengths = rng.integers(20, 900, 4000)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    bins = sum(c.repeat for c in packing.minimum_bin_slack(histogram))
    assert bins <= -(-int(lengths.sum()) // 2048) + 2


def test_word_encoder_matches_whole_texts(word_file):
    texts = ["It's THE end, of (all) Things...", "", " \t", "éÉ ü² ½ Ⅷ ｆｕ 日本", "<|endoftext|> <|ENDOFTEXT|> a<|endoftext|>b",
             "ΣΑΣ İx a\x1cb\x85c d", "don't we'll 12345 x" * 30, "é å"]
    whole = Tokenizer.from_file(word_file)
    for special in (True, False):
        whole.encode_special_tokens = not special
        for limit in (10, 10_000):
            enc = WordEncoder(word_file, "<u4", special, limit)
            for _ in range(2):
                got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode([t.encode() for t in texts])]
                assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture(scope="module")
def encoders(word_file):
    """Whether strings of special tokens count -> (tokenizers' encoder, ours)."""
    both = {}
    for special in (True, False):
        whole = Tokenizer.from_file(word_file)
        whole.encode_special_tokens = not special
        both[special] = whole, WordEncoder(word_file, "<u4", special, 500)
    return both


_PARTS = ["a", "Word", "naïve", "É", "×", "…", "’", "'s", "'T", "don't", ".", ",;", "&&&", "|", "<", "_", "-", "3", "½", "İ", "Σ",
          "\u0301", "\u0338", "\u0307", "日", "<|endoftext|>", "<|EndOfText|>", "\x1c", "\x85", "\u00a0", " ", "\n", "\t "]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_PARTS), max_size=12).map("".join), max_size=8), st.booleans())
def test_units_of_odd_texts_give_the_ids_of_whole_texts(encoders, texts, special):
    whole, ours = encoders[special]
    got = [np.frombuffer(x, "<u4").tolist() for x in ours.encode([t.encode() for t in texts])]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_share_units_whatever_their_case_and_punctuation(word_file):
    enc = WordEncoder(word_file)
    enc.encode([" ".join(w + p for w in ("word", "Word", "WORD", "naïve", "Naïve") for p in string.punctuation if p not in "<|>").encode()])
    assert {u for u in enc.numbers if u[:1].isalpha()} == {b"word", "naïve".encode()}
    assert len(enc.numbers) <= 2 + len(string.punctuation)


def test_texts_longer_than_a_block_of_units(word_file, monkeypatch):
    texts = ["One two, three! " * 20, "", "four " * 7]
    want = WordEncoder(word_file).encode([t.encode() for t in texts])
    monkeypatch.setattr(word_tokens, "_BLOCK", 3)
    assert WordEncoder(word_file, limit=2).encode([t.encode() for t in texts]) == want


def test_bytes_that_are_no_utf8(word_file):
    whole = Tokenizer.from_file(word_file)
    texts = [b"a\xc3", b"\xa9. b", b"\xa9", b".", b"\xff, C\xc3\xa9!"]
    got = [np.frombuffer(x, "<u4").tolist() for x in WordEncoder(word_file).encode(texts)]
    assert got == [whole.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]


def test_packing_of_a_table(frame, odd_rows, word_file):
    rows = [(k, t) for k, (_, t) in enumerate(odd_rows)] + [(100 + k, "a b c " * (k * 9)) for k in range(60)]
    out = packing.pack(frame(rows), word_file).toPandas()
    tok = Tokenizer.from_file(word_file)
    want = set()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for p, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a : a + 2048], "<u4")
            want.add((i, p, a, len(part), zlib.crc32(part.tobytes())))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert set(out[cols].itertuples(index=False, name=None)) == want and len(out) == len(want)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        ends = list(itertools.accumulate(g.length))
        assert [0, *ends[:-1]] == g.offset.tolist() and ends[-1] <= 2048
    assert out.sequence_id.nunique() <= -(-int(out.length.sum()) // 2048) + 1


def test_null_id_and_empty_table(frame, word_file):
    assert packing.pack(frame([(None, "a")]), word_file).first().doc_id is None
    assert packing.pack(frame([]), word_file).count() == 0
