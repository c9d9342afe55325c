"""Byte-level BPE encoding and decoding with a segment tree per piece.

A text is split by the public pattern; each distinct piece is encoded once.
Pieces of similar length are encoded together in numpy: every piece has a
segment tree over its byte positions whose leaves hold the rank of the pair
that starts there (and its place, so that the leftmost of equal ranks is the
smallest). The root names the next merge; a merge changes the leaves of the
merged place, of its live left neighbour and of the place that vanishes, each
a walk of logarithmic length to the root. In a long piece all places of the
lowest rank are found by walking down from the root and merged from left to
right in one numpy step, up to the first merge that makes a pair of lower rank
(which the next step then takes, as one merge at a time would): the steps are
bounded by the ranks that occur, not by the length. The finished ids are kept in
a bounded cache of the worker; decoding goes back from the ids alone.

Cases: a null or empty text has no tokens (digests of the empty string);
equal rows give equal results; an empty table gives an empty result; a null
doc_id stays null; other columns are never looked at. A text is handled in
runs of pieces, so its memory beyond the text itself is bounded by its longest
piece: one piece takes some 100 bytes of trees and links a byte.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.caches import kept
from ledgerlens.llm.ship import ship, ship_file, shipped
from ledgerlens.llm.word_tokens import utf8_rows
from ledgerlens.llm.words import text_chunks

CACHE_PIECES = 800_000
RUN_PIECES = 200_000  # of a long text at once
TREE_CELLS = 1 << 21  # cells of the trees of one batch of pieces
LONG_PIECE = 512  # bytes of a piece whose equal ranks are merged in one step
_NONE = np.int64(1) << np.int64(62)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class PairRanks:
    """Rank of the token that two neighbouring tokens make, for arrays."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = [
            ((ranks[t[:k]] << 32) | ranks[t[k:]], r)
            for t, r in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.keys = np.append(table[:, 0], np.int64(-1) ^ (np.int64(1) << np.int64(63)))
        self.ranks = np.append(table[:, 1], _NONE)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << np.int64(32)) | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


class ByteBPE:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str, limit: int = CACHE_PIECES) -> None:
        import regex

        self.split = regex.compile(pattern)
        self.ranks = read_ranks(path)
        self.pairs = PairRanks(self.ranks)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.told = {r: b"%d" % r for r in self.ranks.values()}
        self.vocabulary = {b"%d" % r: t for t, r in self.ranks.items()}
        self.known: dict[str, bytes] = {}
        self.limit = limit

    # -- pieces -----------------------------------------------------------
    def _merge(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Ids of pieces of at most ``width`` (a power of two) bytes."""
        n = len(pieces)
        lengths = np.array([len(p) for p in pieces])
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        token = self.single[padded]  # by place, of the flat array
        at = np.arange(n * width, dtype=np.int64)
        column = at % width
        end = np.repeat(lengths, width)
        live = column < end
        after = np.where(column + 1 < end, at + 1, -1)
        before = np.where(column > 0, at - 1, -1)
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        has = np.flatnonzero(live & (after >= 0))
        rank = self.pairs.of(token[has], token[after[has]])
        shift = np.int64(width)
        tree[has // width, width + has % width] = np.where(rank < _NONE, rank * shift + has % width, _NONE)
        level = width
        while level > 1:
            level >>= 1
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        flat = tree.reshape(-1)
        step = 2 * width

        def put(piece: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
            """Point updates: a leaf and the nodes above it."""
            node = width + place
            base = piece * step
            flat[base + node] = value
            while True:
                node = node >> 1
                if not node[0]:
                    return
                flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

        def leaf(place: np.ndarray) -> np.ndarray:
            """What the leaf of a live place holds."""
            follow = after[place]
            pair = self.pairs.of(token[place], token[np.maximum(follow, 0)])
            return np.where((follow >= 0) & (pair < _NONE), pair * shift + place % width, _NONE)

        def of_rank(piece: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Places (ascending) whose pair has the lowest rank of its piece,
            and that rank: from the roots down."""
            node = np.ones(len(piece), dtype=np.int64)
            while node[0] < width:
                piece, rank, node = np.repeat(piece, 2), np.repeat(rank, 2), np.repeat(2 * node, 2)
                node[1::2] += 1
                has = flat[piece * step + node] // shift == rank
                piece, rank, node = piece[has], rank[has], node[has]
            return piece * width + node - width, rank

        def at_once(place: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Those of ``of_rank``'s places that merges of one at a time, the
            leftmost first, would take one after the other."""
            index = np.arange(len(place))
            joined = np.concatenate(([False], after[place[:-1]] == place[1:]))
            run = np.maximum.accumulate(np.where(joined, 0, index))
            taken = (index - run) % 2 == 0  # of pairs that share a token, every other one
            place, rank = place[taken], rank[taken]
            left, right = before[place], after[after[place]]
            beside = np.concatenate(([False], right[:-1] == place[1:]))  # what is left of it was merged just before
            with_left = self.pairs.of(np.where(beside, rank, token[np.maximum(left, 0)]), rank)
            with_right = self.pairs.of(rank, token[np.maximum(right, 0)])
            lower = ((left >= 0) & (with_left < rank)) | ((right >= 0) & (with_right < rank))
            earlier = np.cumsum(lower) - lower
            piece = place // width
            taken = earlier == earlier[np.searchsorted(piece, piece)]
            return place[taken], rank[taken]

        active = np.arange(n)
        while True:
            top = flat[active * step + 1] if width > 1 else np.full(len(active), _NONE)
            going = top < _NONE
            active, top = active[going], top[going]
            if not len(active):
                break
            place, rank = active * width + top % shift, top // shift
            if width >= LONG_PIECE:
                place, rank = at_once(*of_rank(active, rank))
            piece = place // width
            token[place] = rank
            gone = after[place]
            follow = after[gone]
            after[place] = follow
            linked = follow >= 0
            before[follow[linked]] = place[linked]
            live[gone] = False
            put(piece, gone % width, np.full(len(piece), _NONE))
            put(piece, place % width, leaf(place))
            left = before[place]
            has_left = left >= 0
            if has_left.any():
                left = left[has_left]
                put(piece[has_left], left % width, leaf(left))
        counts = live.reshape(n, width).sum(axis=1)
        ids = token[live].tolist()
        out, at0 = [], 0
        for c in counts.tolist():
            out.append(ids[at0 : at0 + c])
            at0 += c
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces and keep their ids."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            body = p.encode()
            whole = self.ranks.get(body)
            if whole is not None:
                self.known[p] = self.told[whole]
            else:
                groups.setdefault(1 << (len(body) - 1).bit_length(), []).append((p, body))
        told = self.told
        for width, group in groups.items():
            block = max(1, TREE_CELLS // (2 * width))
            for k in range(0, len(group), block):
                part = group[k : k + block]
                for (p, _), ids in zip(part, self._merge([b for _, b in part], width)):
                    self.known[p] = b" ".join([told[i] for i in ids])

    # -- texts ------------------------------------------------------------
    def _runs(self, text: str) -> Iterator[list[str]]:
        found = (m.group() for m in self.split.finditer(text))
        while run := list(islice(found, RUN_PIECES)):
            yield run

    def _tell(self, runs: list[list[str]]) -> list[bytes]:
        """The ids of each run of pieces; new pieces are encoded together."""
        if len(self.known) > self.limit:
            self.known.clear()
        new: set[str] = set()
        for run in runs:
            new.update(run)
        self.learn(new.difference(self.known))
        get = self.known.__getitem__
        return [b" ".join(map(get, run)) for run in runs]

    def encode_texts(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """For each text, its ids (decimal, joined by spaces) in runs."""
        short = [len(t) <= 4 * RUN_PIECES for t in texts]
        told = iter(self._tell([self.split.findall(t) for t, s in zip(texts, short) if s]))
        for t, s in zip(texts, short):
            if s:
                ids = next(told)
                yield iter([ids] if ids else [])
            else:
                yield (self._tell([run])[0] for run in self._runs(t))

    def decode(self, told: bytes) -> bytes:
        """The bytes of decimal ids joined by spaces."""
        return b"".join(map(self.vocabulary.__getitem__, told.split()))

    def decode_ids(self, ids: Iterable[int]) -> bytes:
        return b"".join(self.vocabulary[b"%d" % i] for i in ids)


def coder(path: str, pattern: str) -> ByteBPE:
    """The coder of this Python worker, kept between tasks; ``path`` is the
    name of a file that was handed out."""
    return kept(("pieces", path, pattern), lambda: ByteBPE(shipped(path), pattern))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int)."""

    ranks = ship_file(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                texts = [t.decode("utf-8", "replace") for t in utf8_rows(data, offsets)]
                ids = [[int(x) for told in runs for x in told.split()] for runs in bpe.encode_texts(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(ids, pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of ids; a null list has a null text."""
    ship(encoded.sparkSession)
    picked = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    ranks = ship_file(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for batch in batches:
            texts = [
                None if ids is None else bpe.decode_ids(ids).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return picked.mapInArrow(run, "doc_id long, text string")


def token_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, and the SHA-256 of the
    ids (decimal, joined by one space) and of the decoded bytes."""

    ranks = ship_file(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                n, ids_digest, text_digest = [], [], []
                texts = [t.decode("utf-8", "replace") for t in utf8_rows(data, offsets)]
                for runs in bpe.encode_texts(texts):
                    of_ids, of_text, count = hashlib.sha256(), hashlib.sha256(), 0
                    for told in runs:
                        of_ids.update(b" " + told if count else told)
                        of_text.update(bpe.decode(told))
                        count += told.count(b" ") + 1
                    n.append(count), ids_digest.append(of_ids.hexdigest()), text_digest.append(of_text.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(ids_digest, pa.string()),
                     pa.array(text_digest, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
