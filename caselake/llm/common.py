"""Pieces that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that ends a word, and its complement.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text itself, a null one as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words in text order; an empty array for a text without any.

    Every kind of white space becomes a blank first: splitting at one character
    takes a third of the time of splitting at a pattern.
    """
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that tell a row of documents from any row with another id or text.

    Ids may repeat or be null, so results that belong to a row are joined by id
    and text digest, null-safe; rows equal in both have equal results.
    """
    return [F.col(doc_id).alias("doc_id"), F.xxhash64(whole_text(text)).alias("text_hash")]


def by_row(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the columns of ``row_key``, null-safe; the right side's keys go."""
    renamed = right.withColumnRenamed("doc_id", "_right_id").withColumnRenamed("text_hash", "_right_hash")
    same = left["doc_id"].eqNullSafe(renamed["_right_id"]) & (left["text_hash"] == renamed["_right_hash"])
    return left.join(renamed, same, how).drop("_right_id", "_right_hash")


def constant_array(values: Sequence[float], digits: int = 6) -> Column:
    """A constant array of doubles to look up by position inside any expression.

    For tables whose size is fixed by a parameter. It travels as one string
    literal, which Spark folds to an array when it plans the query.
    """
    return F.split(F.lit(",".join(f"{v:.{digits}f}" for v in values)), ",").cast("array<double>")


def slot_test(slot: Column, taken: Sequence[int], slots: int) -> Column:
    """True where ``slot`` is one of ``taken``: a bitmap of ``slots`` bits as a constant,
    to keep rows that cannot matter out of a shuffle. What passes is checked exactly."""
    width = 52  # bits that a double holds exactly, with room
    bits = [0] * (-(-slots // width))
    for at in taken:
        bits[at // width] |= 1 << (at % width)
    word = F.get(constant_array(bits, 0), F.floor(slot / F.lit(width)).cast("int")).cast("bigint")
    return F.getbit(word, (slot % width).cast("int")) == 1


def paired(left: Column, right: Column, shift: int, n: Column) -> Column:
    """Hash of each of the first ``n`` elements of ``left`` with the one ``shift`` places
    on in ``right``; nothing where ``n`` is not positive."""
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(shift + 1), n), lambda a, b: F.xxhash64(a, b))


def slices(batch: pa.RecordBatch, column: str, room: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of about ``room`` bytes in ``column`` together; a longer one is alone."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + room, side="right")))
        yield batch.slice(first, last - first)
        first = last
