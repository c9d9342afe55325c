"""Token counts of documents in flat token files, by a separator scan.

A flat file holds fixed-width token ids and nothing else; an end-of-document
id stands behind every document and there is no index. Files are read in
blocks of equal size, wherever documents begin or end. In each block the
separators are found with one vectorised comparison; a prefix scan over the
blocks of a file (running count, running last separator) then tells how many
documents ended before a block and where its first document began, which
stitches documents that span blocks.

Files are opened by workers with ``pyarrow.fs`` from their URI, so they may lie
in any store that has one, the object stores of Hadoop's schemes (``s3a`` and the
like) included (a local path only where every worker sees it). Only
the part of a file that makes up a block is read at a time.

Cases: an empty file has no documents; two separators in a row make an empty
document (0 tokens); ids behind the last separator are a document that is not
``closed``; a document longer than many blocks is one row; bytes that do not
fill an id at the end of a file are an error. For the writer, a null text is
an empty document, equal rows are separate documents, strings of special
tokens within a text are ordinary text, an empty table writes no file, and
other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.ship import ship, ship_file, shipped
from ledgerlens.llm.word_tokens import word_encoder
from ledgerlens.llm.words import text_chunks
from ledgerlens.session import materialize, scratch_path

BLOCK_BYTES = 4 << 20
DTYPE = "<u2"


# Scheme of a Hadoop path -> that of the same store for pyarrow.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _uri(path: str) -> str:
    """The URI that pyarrow knows a path of the cluster by."""
    scheme, sep, rest = path.partition(":/")
    return f"{_SCHEMES.get(scheme, scheme)}:/{rest}" if sep else f"file://{path}"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(_uri(path))


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, dtype: str = DTYPE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write one flat file per task and return (path, bytes, document,
    doc_id): which document of a file (from 0) a row became. The names hold
    the task attempt and only those of committed attempts are returned, so a
    repeated or lost task leaves no wrong file in the list."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = ship_file(spark, tokenizer)
    folder = folder or scratch_path(spark, "token_files")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], dtype=dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(shipped(vocabulary), dtype, False)
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        out, size, document = None, 0, 0
        try:
            for batch in batches:
                for lo, hi, data, offsets in text_chunks(batch.column("text")):
                    if out is None:
                        fs, inner = _open(path)
                        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(inner)
                    for ids in encoder.encode_rows(data, offsets):
                        out.write(ids)
                        out.write(end)
                    n = hi - lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * n, pa.string()), pa.array(range(document, document + n), pa.int64()),
                         batch.column("doc_id").slice(lo, n)],
                        names=["path", "document", "doc_id"],
                    )
                    document += n
        finally:
            if out is not None:
                out.close()

    return materialize(picked.mapInArrow(run, "path string, document long, doc_id long"), "token_index")


def file_sizes(paths: DataFrame) -> DataFrame:
    """(path) -> (path, bytes)."""
    ship(paths.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for path in batch.column("path").to_pylist():
                fs, inner = _open(path)
                sizes.append(fs.get_file_info(inner).size)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return paths.select("path").mapInArrow(run, "path string, bytes long")


def token_counts(
    files: DataFrame, end_id: int, dtype: str = DTYPE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(path, bytes) of flat files -> one row per document: path, document
    (from 0 within the file), start (token offset), n_tokens (without the
    separator), closed."""
    ship(files.sparkSession)
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    size = F.col("bytes")
    blocks = files.where(size > 0).select(
        "path", "bytes", F.explode(F.sequence(F.lit(0), F.floor((size - 1) / block_bytes))).alias("block")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, total, block in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "block"))):
                if total % width:
                    raise ValueError(f"{path} does not hold whole ids")
                fs, inner = _open(path)
                with fs.open_input_file(inner) as f:
                    body = f.read_at(min(block_bytes, total - block * block_bytes), block * block_bytes)
                ids = np.frombuffer(body, dtype=dtype)
                ends = np.flatnonzero(ids == end_id) + block * block_bytes // width
                last = int(ends[-1]) if len(ends) else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path], pa.string()), pa.array([block], pa.int64()), pa.array([total // width], pa.int64()),
                     pa.array([len(ends)], pa.int64()), pa.array([last], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends, pa.int64()))],
                    names=["path", "block", "tokens", "n_ends", "last_end", "ends"],
                )

    schema = "path string, block long, tokens long, n_ends long, last_end long, ends array<long>"
    found = materialize(blocks.repartition("path", "block").mapInArrow(scan, schema), "separators")

    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select("path", "block", "n_ends", "last_end").select(
        "path", "block",
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last_end").over(earlier), F.lit(-1)).alias("came"),
    )
    ended = found.where("n_ends > 0").join(stitched, ["path", "block"])
    starts = F.transform(
        F.concat(F.array("came"), F.slice("ends", F.lit(1), F.size("ends") - 1)), lambda e: e + 1
    )
    closed = ended.select(
        "path", "before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end")))
    ).select(
        "path", (F.col("before") + F.col("pos")).alias("document"), F.col("col.start").alias("start"),
        (F.col("col.end") - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    whole = found.groupBy("path").agg(
        F.max("tokens").alias("tokens"), F.sum("n_ends").alias("document"),
        F.coalesce(F.max("last_end") + 1, F.lit(0)).alias("start"),
    )
    rest = whole.where("start < tokens").select(
        "path", "document", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(rest)


def document_token_counts(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens of every row: tokenized into flat files, which are
    then scanned."""
    index = write_token_files(docs, tokenizer, end_id, None, DTYPE, id_col, text_col)
    counts = token_counts(file_sizes(index.select("path").distinct()), end_id)
    return index.join(counts, ["path", "document"]).select("doc_id", "n_tokens")
