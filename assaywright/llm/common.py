"""What the training-data operators share: word patterns, table reading, row keys, bounded batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import SizeLimit

#: What separates words: space, tab, newline, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARACTERS = "\x20\t\n\x0b\f\r"
_GAP_BYTES = re.compile(rb"[\x20\x09-\x0D]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What these operators broadcast at most: measured, see SizeLimit.
BROADCAST = SizeLimit(rows=200_000, bytes=16 * 1024 * 1024, hot_rows=50_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words between gaps; NULL has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARACTERS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP))).cast("long")


def fits(keyed: DataFrame, limit: SizeLimit = BROADCAST) -> bool:
    """Whether a stored frame is small enough to broadcast; one aggregate over it."""
    return limit.admits(keyed)


def small(keyed: DataFrame, limit: SizeLimit = BROADCAST) -> DataFrame:
    """The stored frame, marked for broadcast if it was measured to fit."""
    return F.broadcast(keyed) if fits(keyed, limit) else keyed


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``most_bytes`` (one longer text is a part of its own)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def word_blocks(raw: bytes, most: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size."""
    start = 0
    while len(raw) - start > most:
        cut = _GAP_BYTES.search(raw, start + most)
        if cut is None:
            break
        yield raw[start : cut.start()].split()
        start = cut.end()
    yield (raw[start:] if start else raw).split()
