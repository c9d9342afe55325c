"""Best-fit packing of documents into fixed-length sequences by minimum bin
slack.

A document is its token ids and an end id. Only documents longer than a
sequence are cut, into whole sequences and a rest. The pieces' lengths are
counted (at most ``capacity`` counters, whatever the input), and the plan is
made on those counts: each sequence is opened with the longest piece left,
a subset-sum over the available lengths (a bitset held in one integer, a
shift for every length) finds the fullest feasible filling, and that
combination is removed as often as the counts allow. A repeat uses up a
length, so the number of combinations follows the number of lengths, not
the number of pieces.

Pieces take their places without a sort or a hot task: every task numbers
its pieces by length while it makes them, the counts per task and length
give the rest of the rank, and (length, rank) points into the plan.

Cases: a null or empty text is the end id alone; equal rows are packed each;
a null doc_id stays null; an empty table gives an empty result; other
columns are never looked at. Memory is bounded by one Arrow batch, or by
one text if that is longer, and by the words whose ids a worker keeps
(``cache_words``, less than 400 bytes each): more of them save time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.ship import ship, ship_file, shipped
from ledgerlens.llm.word_tokens import CACHE_WORDS, word_encoder
from ledgerlens.llm.words import text_chunks
from ledgerlens.session import materialize

CAPACITY = 2048
END_ID = 0
PIECE_SCHEMA = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"
)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece; ``number`` counts the pieces of a length within a
    task (``part``), from 0."""
    ship(docs.sparkSession)
    vocabulary = ship_file(docs.sparkSession, tokenizer)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(shipped(vocabulary), limit=cache_words)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        step = 4 * capacity
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                at, piece, start, length, crc, number = [], [], [], [], [], []
                for r, body in enumerate(encoder.encode_rows(data, offsets)):
                    body += end
                    for p, a in enumerate(range(0, len(body), step)):
                        part_ids = body[a : a + step]
                        n = len(part_ids) // 4
                        at.append(r), piece.append(p), start.append(a // 4), length.append(n)
                        crc.append(zlib.crc32(part_ids))
                        number.append(seen[n])
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array([part] * len(at), pa.int32()), pa.array(number, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"],
                )

    return picked.mapInArrow(run, PIECE_SCHEMA)


@dataclass(frozen=True)
class Combination:
    """Pieces that share a sequence: (length, times) pairs, and how many
    sequences are filled that way."""

    pieces: tuple[tuple[int, int], ...]
    repeat: int


def fullest(counts: list[int], room: int) -> list[tuple[int, int]]:
    """The (length, times) pairs with the largest sum of at most ``room``
    that the counts allow; longer pieces are tried first."""
    steps: list[tuple[int, int, int]] = []  # reach before, length, copies
    reach, mask = 1, (1 << (room + 1)) - 1
    for length in range(min(room, len(counts) - 1), 0, -1):
        left, block = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(block, left)
            after = (reach | reach << (length * take)) & mask
            if after != reach:
                steps.append((reach, length, take))
                reach = after
            left -= take
            block *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return sorted(used.items(), reverse=True)


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Combination]:
    """Combinations that use up the histogram (length -> count)."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    plan = []
    longest = capacity
    while longest:
        if not counts[longest]:
            longest -= 1
            continue
        counts[longest] -= 1
        filling = dict(fullest(counts, capacity - longest))
        counts[longest] += 1
        filling[longest] = filling.get(longest, 0) + 1
        repeat = min(counts[k] // n for k, n in filling.items())
        for k, n in filling.items():
            counts[k] -= n * repeat
        plan.append(Combination(tuple(sorted(filling.items(), reverse=True)), repeat))
    return plan


def plan_rows(plan: list[Combination]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, times, first sequence, offset) rows:
    which ranks of a length a combination takes, and where they lie."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for c in plan:
        offset = 0
        for length, times in c.pieces:
            first = taken.get(length, 0)
            taken[length] = first + times * c.repeat
            rows.append((length, first, taken[length], times, sequence, offset))
            offset += length * times
        sequence += c.repeat
    return rows


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    spark = docs.sparkSession
    made = materialize(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, cache_words), "pieces")
    counts = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skips = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_rows(minimum_bin_slack(histogram, capacity)),
        "length long, first long, end long, times long, sequence long, place long",
    )
    rank = F.col("number") + F.col("skip")
    ranked = made.join(skips, ["part", "length"]).withColumn("rank", rank)
    placed = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "plan_length")),
        (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
    )
    k = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(k / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(k, F.col("times")) * F.col("length")).cast("long").alias("offset"),
    )
