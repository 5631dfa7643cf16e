"""Token ids in Parquet: one list column, ids in document order, with statistics that let readers skip pages."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylane.llm.common import arrival, offsets, tidy
from paylane.llm.tokens import WORD_BPE, encoder
from paylane.session import broadcast_if_small, staged

# Writer settings: row groups of 32 MB and pages of 256 kB bound what a selective read must load; ids lie in a dictionary
# while it is small and in delta blocks beyond it (version 2 pages); page indexes are written by default.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(256 << 10),
}


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def encode_rows(tokenizer: str, end: int, rows: int = 1000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                ids, sizes = encoder(tokenizer).encode(batch.column("text"))
                last = np.cumsum(sizes + 1)
                with_end = np.insert(ids, np.cumsum(sizes), end).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last]), pa.int32()), pa.array(with_end))
                begins = start + last - sizes - 1
                start += int(last[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("meta"), pa.array(np.full(len(sizes), part), pa.int32()),
                     pa.array(begins), pa.array(sizes + 1), lists],
                    ["doc_id", "meta", "part", "start_in_part", "n_tokens", "ids"],
                )

    return encode


def write_tokens(
    docs: DataFrame, path: str, end: int, tokenizer: str = WORD_BPE, meta: Sequence[str] = (), options: dict[str, str] = FILE_OPTIONS
) -> None:
    """Encode every whole text and write the ids with ``end`` after each document, ascending by ``doc_id`` across files.

    Null texts are empty: ``end`` alone. Null ids sort first. Rows of equal id keep the order of the scan and may lie in
    several files, so a hot id is no single task's work. ``meta`` names further columns, kept in a struct of that name.
    """
    kept = F.struct(*meta) if meta else F.lit(None).cast("struct<none:int>")
    rows = docs.select("doc_id", "text", kept.alias("meta"), arrival().alias("arrived"))
    rows = rows.repartitionByRange("doc_id", "arrived").sortWithinPartitions("doc_id", "arrived").drop("arrived")
    long, fields = T.LongType(), T.StructField
    schema = T.StructType([rows.schema["doc_id"], rows.schema["meta"], fields("part", T.IntegerType()), fields("start_in_part", long),
                           fields("n_tokens", long), fields("ids", T.ArrayType(T.IntegerType()))])
    rows.mapInArrow(tidy(encode_rows(tokenizer, end)), schema).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None, columns: Sequence[str] = ("ids",)) -> DataFrame:
    """Documents with ``start``, the number of ids before them in the whole collection, and the columns asked for.

    ``where`` on ``doc_id`` reaches the scan, where row groups and pages outside it are skipped; ``ids`` are read only if
    asked for. Starts come from sums by file part, so a selective read needs no ids of other documents.
    """
    files = spark.read.parquet(path)
    bases = offsets(files.groupBy("part").agg(F.sum("n_tokens").alias("n")), "part", "n")
    bases = broadcast_if_small(staged(bases, "token-bases"))  # one row per file part; the ids need not be shuffled
    rows = files if where is None else files.where(where)
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", *columns)


def checksums(tokens: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns and the unsigned crc32 of each row's ids as little-endian 32-bit integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
            crc = pa.array([crc_of(values[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), crc], [*columns, "ids_crc32"])

    rows = tokens.select(*columns, "ids")
    schema = T.StructType([*(rows.schema[c] for c in columns), T.StructField("ids_crc32", T.LongType())])
    return rows.mapInArrow(tidy(sums), schema)
