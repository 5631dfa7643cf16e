"""Shards in uniformly random order by a two-pass external shuffle.

Pass one scatters rows by a seeded hash into buckets that fit a task's memory. Pass two takes each bucket alone, puts it
in a reproducible order, permutes it (Fisher-Yates, by a generator seeded with the bucket's number) and writes it. Buckets
one after another are one random order of all rows, which the shards cut into runs of equal length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylane.llm.common import Batches, arrival, offsets, tidy
from paylane.session import broadcast_if_small, staged

BUCKET_BYTES = 32 << 20
ROWS_AT_ONCE = 4096


def shuffled_bucket(seed: int) -> Batches:
    """A whole partition is one bucket, held in memory and permuted."""

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        bucket = table.column("bucket")[0].as_py()
        # Rows arrive in any order; a repeated task must permute the same sequence.
        order = np.argsort(table.column("arrived").to_numpy(), kind="stable")
        order = order[np.random.default_rng([seed, bucket]).permutation(len(order))]
        for at in range(0, len(order), ROWS_AT_ONCE):
            part = table.select(["bucket", "record"]).take(pa.array(order[at : at + ROWS_AT_ONCE]))
            places = pa.array(np.arange(at, at + part.num_rows), pa.int64())
            yield from part.append_column("place", places).combine_chunks().to_batches()

    return shuffle


def write_shuffled(docs: DataFrame, path: str, seed: int = 7, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> int:
    """Write all rows of ``docs`` below ``path`` in random order; returns the number of buckets.

    Each file row has ``bucket``, ``place`` (its place in the bucket, from 0) and ``record``, the whole row as a struct, so
    that no column of the input can clash. The bucket number hashes the row's number in the scan: repeated rows and equal
    ids spread as all others do. ``docs`` must be read from a table, whose rows a repeated task meets in the same order.
    An empty table gives no bucket rows. Null texts are kept.
    """
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64).alias("n")).first()["n"]
    buckets = max(1, -(-(size or 0) // bucket_bytes))
    rows = docs.select(F.struct("*").alias("record")).withColumn("arrived", arrival())
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "arrived"), F.lit(buckets)).cast("int"))
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), rows.schema["record"], T.StructField("place", T.LongType())])
    # As many partitions as buckets, one bucket each, whatever the session's number of shuffle partitions.
    scattered = rows.repartitionById(buckets, F.col("bucket"))
    scattered.select("bucket", "arrived", "record").mapInArrow(tidy(shuffled_bucket(seed)), schema).write.parquet(path)
    return buckets


def read_shards(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """(record, shard, slot) of a shuffled table: shard sizes differ by one at most, slots of a shard run from 0 without gaps.

    The first shards are the larger ones. With fewer rows than shards the last shards are empty.
    """
    rows = spark.read.parquet(path)
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).first()["total"] or 0
    least, more = divmod(total, shards)
    bases = broadcast_if_small(staged(offsets(counts, "bucket", "n"), "bucket-bases"))  # one row per bucket
    cut = rows.join(bases, "bucket").withColumn("at", F.col("base") + F.col("place"))
    # The first ``more`` shards have one row more than ``least``.
    large = more * (least + 1)
    shard = F.when(F.col("at") < large, F.expr(f"at div {least + 1}")).otherwise(F.expr(f"{more} + (at - {large}) div {max(least, 1)}"))
    cut = cut.withColumn("shard", shard.cast("int"))
    slot = F.col("at") - F.col("shard") * least - F.least(F.col("shard"), F.lit(more))
    return cut.select("record", "shard", slot.cast("long").alias("slot"))
