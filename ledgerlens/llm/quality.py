"""Quality rules by repetition coverage.

For every text the share of its word characters that lies inside repeated
lines and inside repeated n-grams of several lengths is measured. The
n-grams are found with rolling hashes in numpy over the bytes of a whole
Arrow batch; there is no shuffle, and memory is bounded by the batch chunk
(``words.CHUNK_BYTES``) or by one text, if that is longer.

A text is rejected when it has fewer than ``Rules.min_words`` words, when
repeated 3-word windows hold more than ``Rules.max_repeat_words`` of its
words, or when any coverage is over its limit.

Cases: a null text has no words and is rejected; an empty text likewise;
repeated rows each get their own equal result; an empty table gives an
empty result; columns other than the id and the text are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.caches import released
from ledgerlens.llm.ship import ship
from ledgerlens.llm.words import SPACE, ByteHash, gram_hashes, mix, repeated, row_sums, spans, text_chunks


@dataclass(frozen=True)
class Rules:
    """Limits; coverages are shares of the text's word characters. They lie
    below the half that ``max_repeat_words`` already rejects and above the
    largest coverage of a clean-labelled document (README)."""

    min_words: int = 50
    max_repeat_words: float = 0.5
    max_line_chars: float = 0.45
    max_gram_chars: tuple[tuple[int, float], ...] = (
        (5, 0.45), (6, 0.45), (7, 0.45), (8, 0.45), (9, 0.45), (10, 0.43),
    )


SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_ROW = np.uint64(0x8CB92BA72F3D8DD7)


def _covered(in_gram: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside at least one marked window of n words."""
    edge = np.zeros(words + 1, dtype=np.int32)
    at = np.flatnonzero(in_gram)
    np.add.at(edge, at, 1) if len(at) < 32 else edge.__iadd__(np.bincount(at, minlength=words + 1).astype(np.int32))
    edge -= np.bincount(at + n, minlength=words + 1)[: words + 1].astype(np.int32)
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """All measures of the texts of one chunk, one entry per row."""
    rows = len(offsets) - 1
    space = SPACE[data]
    point = (data & 0xC0) != 0x80
    w = spans(~space, offsets)
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(point & ~space, out=points[1:])
    n_words = np.diff(w.first)
    out = {
        "n_words": n_words,
        "word_chars": points[offsets[1:]] - points[offsets[:-1]],
        "n_symbols": row_sums(SYMBOL[data], offsets),
    }
    chars = points[w.end] - points[w.start]
    hashed = ByteHash(data)

    # Lines: runs between \n bytes. A line with a word is never empty.
    line = spans(data != 0x0A, offsets)
    wordy = points[line.end] > points[line.start]
    ls, le, lr = line.start[wordy], line.end[wordy], line.row[wordy]
    key = mix(hashed.of(ls, le) ^ (lr.astype(np.uint64) * _ROW))
    again = repeated(key)
    later = np.zeros(len(key), dtype=bool)
    if again.any():
        at = np.flatnonzero(again)
        _, first = np.unique(key[at], return_index=True)  # stable: the earliest of equals
        later[at] = True
        later[at[first]] = False
    out["n_dup_lines"] = np.bincount(lr[later], minlength=rows)
    out["dup_line_chars"] = np.bincount(
        lr[again], weights=(points[le] - points[ls])[again], minlength=rows
    ).astype(np.int64)

    word = hashed.of(w.start, w.end)
    left = w.first[w.row + 1] - np.arange(len(word))  # words from here to the row's end
    salt = w.row.astype(np.uint64) * _ROW

    def inside(n: int) -> np.ndarray:
        grams = gram_hashes(word, n)
        ok = np.flatnonzero(left[: len(grams)] >= n)
        hit = np.zeros(len(word), dtype=bool)
        hit[ok] = repeated(mix(grams[ok] ^ salt[ok]))
        return _covered(hit, n, len(word))

    out["n_repeat_words"] = np.bincount(w.row[inside(3)], minlength=rows)
    for n, _ in rules.max_gram_chars:
        m = inside(n)
        out[f"dup_{n}gram_chars"] = np.bincount(w.row[m], weights=chars[m], minlength=rows).astype(np.int64)

    failed = (n_words < rules.min_words) | (out["n_repeat_words"] > rules.max_repeat_words * n_words)
    kept = ~failed & (out["dup_line_chars"] <= rules.max_line_chars * out["word_chars"])
    for n, most in rules.max_gram_chars:
        kept &= out[f"dup_{n}gram_chars"] <= most * out["word_chars"]
    return out | {"base_failed": failed, "kept": kept}


def _columns(rules: Rules) -> list[str]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    return names + [f"dup_{n}gram_chars" for n, _ in rules.max_gram_chars]


def quality_rules(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures (long), base_failed
    and kept (boolean)."""
    ship(docs.sparkSession)
    names = _columns(rules)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                m = measure(data, offsets, rules)
                cols = [ids.slice(lo, hi - lo), *(pa.array(m[c].astype(np.int64)) for c in names)]
                cols += [pa.array(m["base_failed"]), pa.array(m["kept"])]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *names, "base_failed", "kept"])

    return picked.mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they are."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(measure(data, offsets, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
