"""What the corpus operators share: table access, folds, running offsets, Arrow helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylane.session import prepare

FOLDS, HELD_OUT = 4, 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text leaves remainder 2 by 4. A null id: false."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def arrival() -> Column:
    """A number per row of a table scan; the same on a retry, as a task then reads the same rows in the same order."""
    return F.monotonically_increasing_id()


def offsets(counts: DataFrame, key: str, count: str, block: int = 1000) -> DataFrame:
    """(key, base): the sum of ``count`` over all lower keys. ``counts`` has one row per whole-number key.

    Sums run within blocks of keys first; one task sees one row per block, never one per key.
    """
    blocked = counts.select(key, count, F.floor(F.col(key) / block).alias("_block"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = blocked.withColumn("_in", F.coalesce(F.sum(count).over(before(Window.partitionBy("_block").orderBy(key))), F.lit(0)))
    totals = blocked.groupBy("_block").agg(F.sum(count).alias("_sum"))
    blocks = totals.select("_block", F.coalesce(F.sum("_sum").over(before(Window.orderBy("_block"))), F.lit(0)).alias("_base"))
    return inside.join(blocks, "_block").select(key, (F.col("_in") + F.col("_base")).alias("base"))


def broadcast_within(table: DataFrame, row_bytes: Column, limit: int = 64 << 20) -> DataFrame:
    """A stored table, to be broadcast if its rows add up to ``limit`` bytes at most; else joined by shuffle."""
    size = table.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(table) if size <= limit else table


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(work: Batches) -> Batches:
    """``work`` for mapInArrow, after which freed memory goes back to the machine: Python workers outlive their tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in small slices, so that what a task builds from its texts stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space (blank, \\t to \\r) of all texts in a row, and their number per text; null has none."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    split = pc.ascii_split_whitespace(trimmed)
    words, counts = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
    empty = pc.binary_length(trimmed).to_numpy() == 0  # split gives an empty text as one empty word
    return words.filter(pc.greater(pc.binary_length(words), 0)), np.where(empty, 0, counts)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [x or "" for x in column.to_pylist()]
