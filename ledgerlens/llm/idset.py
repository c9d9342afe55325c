"""Removing a set of ids from a wide table without shuffling the table.

The ids become a bitmap (hash of the id modulo the number of bits), built as
a grouped aggregate and broadcast. A row whose bit is clear is certainly not
in the set and never moves; only the rows whose bit is set are compared
exactly, by a shuffled anti join.

The bitmap's size follows from a count of the ids: ``BITS_AN_ID`` bits each,
so that of the rows in no list at most 1 of 16 takes the exact way at any
number of ids. What is broadcast at once never exceeds ``MOST_BITS`` (128 MB):
more ids are taken in several groups, by ranges of the key (of its hash where
it is no integer), one bitmap and one written pass a group. A pass reads the
rows of its range; where the table lies in the order of an integer key, as a
table written with its row numbers does, Parquet's statistics leave out the
others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ledgerlens.session import materialize

BITS_AN_ID = 16
LEAST_BITS = 1 << 20
MOST_BITS = 1 << 30
_PAGE = 32768  # bits of one page of Spark's bitmap functions


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bitmap(ids: DataFrame, id_col: str, bits: int) -> DataFrame:
    """The ids as bitmap pages: page (long), flags (binary, 4096 bytes); at
    most bits / 32768 rows."""
    place = _place(F.col(id_col), bits)
    return (
        ids.where(F.col(id_col).isNotNull())
        .groupBy(F.floor(place / _PAGE).alias("page"))
        .agg(F.bitmap_construct_agg(F.pmod(place, F.lit(_PAGE))).alias("flags"))
    )


def _may_hold(df: DataFrame, key: str, ids: DataFrame, id_col: str, bits: int) -> DataFrame:
    """``df`` with a boolean ``_maybe``: false only where the key is
    certainly not among ``ids``."""
    pages = F.broadcast(bitmap(ids, id_col, bits).withColumnRenamed("page", "_page"))
    place = _place(F.col(key), bits)
    bit = F.pmod(place, F.lit(_PAGE)).cast("int")
    byte = F.substring("flags", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit, F.lit(8)))
    marked = df.withColumn("_page", F.floor(place / _PAGE)).join(pages, "_page", "left")
    maybe = F.col(key).isNotNull() & (F.coalesce(is_set, F.lit(0)) == 1)
    return marked.select(*df.columns, maybe.alias("_maybe"))


def _cuts(ids: DataFrame, id_col: str, groups: int) -> tuple[Callable[[str], Column], list]:
    """What the groups are ranges of, and the ``groups - 1`` places between
    them."""
    if not isinstance(ids.schema[id_col].dataType, (IntegerType, LongType)):
        step = (1 << 64) // groups
        return (lambda c: F.xxhash64(F.col(c))), [k * step - (1 << 63) for k in range(1, groups)]
    shares = [k / groups for k in range(1, groups)]
    found = ids.agg(F.percentile_approx(id_col, shares, 10_000).alias("at")).first()["at"]
    return F.col, sorted(set(found or []))


def _by_group(
    df: DataFrame, key: str, ids: DataFrame, id_col: str, most_bits: int,
    work: Callable[[DataFrame, DataFrame, int], DataFrame],
) -> DataFrame:
    """``work(rows, ids, bits)`` over all rows and ids, or over each group of
    them where one bitmap would be too large; rows with a null key go with
    the first group."""
    n = ids.count()
    bits = LEAST_BITS
    while bits < min(n * BITS_AN_ID, most_bits):
        bits *= 2
    bits = min(bits, most_bits)
    groups = -(-n * BITS_AN_ID // most_bits)
    if groups <= 1:
        return work(df, ids, bits)
    measure, cuts = _cuts(ids, id_col, groups)
    parts = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        def within(c: str, low=low, high=high) -> Column:
            from_low = F.lit(True) if low is None else measure(c) >= F.lit(low)
            to_high = F.lit(True) if high is None else measure(c) < F.lit(high)
            first = F.col(c).isNull() if low is None else F.lit(False)
            return first | (F.col(c).isNotNull() & from_low & to_high)

        # Written one after another, so that one bitmap is held at a time.
        parts.append(materialize(work(df.where(within(key)), ids.where(within(id_col)), bits), "group"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def likely_in(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``df`` whose id may be among ``ids``: all that are, and
    a few more. Nothing of ``df`` is shuffled."""
    return _by_group(
        df, id_col, ids.select(id_col), id_col, most_bits,
        lambda rows, some, bits: _may_hold(rows, id_col, some, id_col, bits).where("_maybe").drop("_maybe"),
    )


def without(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``df`` whose id is not among ``ids`` (a null id stays);
    columns as in ``df``, whatever their names."""
    names = df.columns
    body = [f"_c{k}" for k in range(len(names))]
    key = f"_c{names.index(id_col)}"
    gone = ids.select(F.col(id_col).alias("_gone")).where(F.col("_gone").isNotNull())

    def work(rows: DataFrame, some: DataFrame, bits: int) -> DataFrame:
        marked = _may_hold(rows, key, some, "_gone", bits)
        doubtful = marked.where("_maybe").select(*body)
        kept = doubtful.join(some, doubtful[key] == some["_gone"], "left_anti")
        return marked.where(~F.col("_maybe")).select(*body).unionAll(kept)

    return _by_group(df.toDF(*body), key, gone, "_gone", most_bits, work).toDF(*names)


def without_repeats(df: DataFrame, keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``df`` whose (never null) ``key`` is not among the
    ``keys`` that are not kept, one row of each key. ``keys`` (the key,
    kept) names all keys that go and all that several rows have; a key it
    does not name belongs to one row, which stays where it is."""

    def work(rows: DataFrame, some: DataFrame, bits: int) -> DataFrame:
        marked = _may_hold(rows, key, some, key, bits)
        doubtful = marked.where("_maybe").drop("_maybe").dropDuplicates([key])
        kept = doubtful.join(some.where("NOT kept").select(key), key, "left_anti")
        return marked.where(~F.col("_maybe")).drop("_maybe").unionAll(kept.select(*rows.columns))

    return _by_group(df, key, keys, key, most_bits, work)
