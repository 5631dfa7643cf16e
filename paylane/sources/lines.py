"""Line files: ordered text output, reading back, and digests of the written files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import file_names, staged

# Copies of one line that are kept together while sorting.
COPIES_PER_SLICE = 10_000
# Lines per part file, so that a file can be digested within one task.
LINES_PER_FILE = 250_000


def total_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Sort by the named columns, missing values last, ties by the line itself."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order], F.asc_nulls_last("line"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Lines with their place in total order, from 0.

    Sorted ranges are stored, each row with its place in its range; places of ranges are sums over one row per range.
    """
    at = F.monotonically_increasing_id()  # range number and place in it
    ranges = staged(total_order(df, order).withColumns({"_range": F.shiftright(at, 33), "_at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "sorted")
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ranges.join(starts, "_range").withColumn("position", F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")


def _sliced_copies(df: DataFrame, order: list[str], copies_per_slice: int) -> DataFrame:
    """One row per distinct line and slice of its copies, so that no group of copies is sorted in one task."""
    each = F.col("copies") if "copies" in df.columns else F.lit(1)
    counted = df.groupBy(*order, "line").agg(F.sum(each).alias("copies"))
    slices = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / copies_per_slice))
    size = F.least(F.lit(copies_per_slice), F.col("copies") - F.col("slice") * copies_per_slice)
    return counted.withColumn("slice", F.explode(slices)).withColumn("size", size.cast("int"))


class Digest(NamedTuple):
    """One part file: its place (partition, file of the partition), MD5 and size."""

    part: int
    file: int
    md5: str
    size_bytes: int


class Counts(NamedTuple):
    """What was found while lines were written: lines, how often their key changed from one to the next, digests of the files."""

    n_lines: int
    n_runs: int
    digests: tuple[Digest, ...] = ()


FILES = pa.list_(pa.struct([("md5", pa.string()), ("size_bytes", pa.int64())]))
EDGE = pa.struct([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("inside", pa.int64()), ("files", FILES)])


class FileDigests:
    """Digests of the files that a partition's lines go to, which hold so many lines each; lines pass and are not kept."""

    def __init__(self, lines_per_file: int):
        self.most, self.done = lines_per_file, []
        self._open()

    def _open(self) -> None:
        self.md5, self.size, self.lines = hashlib.md5(usedforsecurity=False), 0, 0

    def _close(self) -> None:
        self.done.append({"md5": self.md5.hexdigest(), "size_bytes": self.size})
        self._open()

    def _add(self, content: bytes, lines: int) -> None:
        self.md5.update(content)
        self.size += len(content)
        self.lines += lines
        if self.lines == self.most:
            self._close()

    def add(self, batch: pa.RecordBatch) -> None:
        lines, sizes = batch.column("line").cast(pa.binary()).to_pylist(), batch.column("size").to_numpy()
        if (sizes == 1).all():
            at = 0
            while at < len(lines):
                part = lines[at : at + self.most - self.lines]
                self._add(b"".join([x for line in part for x in (line or b"", b"\n")]), len(part))
                at += len(part)
            return
        for line, size in zip(lines, sizes.tolist()):
            whole = (line or b"") + b"\n"
            while size:
                now = min(size, self.most - self.lines)
                self._add(whole * now, now)
                size -= now

    def files(self) -> list[dict]:
        if self.lines:
            self._close()
        return self.done


def watched(lines_per_file: int):
    """Lines as they come; the last of a partition carries its first and last key, the changes between, and its files' digests."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, last, inside, digests = None, None, None, 0, FileDigests(lines_per_file)

        def out(batch: pa.RecordBatch, edge: dict | None) -> pa.RecordBatch:
            edges = pa.array([None] * (batch.num_rows - 1) + [edge], EDGE)
            return pa.RecordBatch.from_arrays([batch.column("line"), batch.column("size"), edges], ["line", "size", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield out(held, None)
            key = batch.column("key")
            changed = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False).astype(bool)
            head, held = key[0].as_py(), batch
            inside += int(np.count_nonzero(changed)) + (last is not None and last != head)
            first, last = head if first is None else first, key[-1].as_py()
            digests.add(batch)
        if held is not None:
            yield out(held, {"part": TaskContext.get().partitionId(), "first": first, "last": last, "inside": inside, "files": digests.files()})

    return work


def counted_runs(edges: list) -> int:
    """Changes of the key over all partitions in order; a blank key at the start is no change."""
    before, runs = "", 0
    for e in sorted(edges, key=lambda e: e["part"]):
        runs += e["inside"] + (e["first"] != before)
        before = e["last"]
    return runs


def write_lines(
    df: DataFrame,
    path: str,
    order: list[str],
    fold_copies: bool = False,
    lines_per_file: int = LINES_PER_FILE,
    copies_per_slice: int = COPIES_PER_SLICE,
    key: Column | None = None,
) -> Counts:
    """Write ``line`` in total order: part files in name order, lines in order within each. Returns what was counted on the way.

    Runs of the blank-stripped ``key`` (a column over ``line``; without one every line counts) are added up where a partition
    is written, and its files digested, one edge each; so nothing that was written is read again, and no file has to fit a row.

    ``fold_copies`` is for extracts that can hold very many equal lines: they travel to the sort as counts,
    spread over the range, and are written out again in full. Lines that come with their number in ``copies`` always do.
    """
    folded = fold_copies or "copies" in df.columns
    if folded:
        ordered = _sliced_copies(df, order, copies_per_slice).orderBy(*[F.asc_nulls_last(c) for c in [*order, "line", "slice"]])
    else:
        ordered = total_order(df, order).withColumn("size", F.lit(1))
    seen = Observation()
    # Equal neighbours never change the key, so copies are looked at once.
    mark = F.lit("") if key is None else F.coalesce(F.trim(key), F.lit(""))
    edge = "struct<part: int, first: string, last: string, inside: bigint, files: array<struct<md5: string, size_bytes: bigint>>>"
    lines = ordered.select("line", "size", mark.alias("key")).mapInArrow(watched(lines_per_file), f"line string, size int, edge {edge}")
    lines = lines.observe(seen, F.coalesce(F.sum("size"), F.lit(0)).alias("n_lines"), F.collect_list("edge").alias("edges"))  # an edge a partition
    line = F.explode(F.array_repeat(F.col("line"), F.col("size"))).alias("line") if folded else F.col("line")
    lines.select(line).write.mode("overwrite").option("maxRecordsPerFile", lines_per_file).text(path)
    facts = seen.get
    digests = tuple(Digest(e["part"], n, f["md5"], f["size_bytes"]) for e in facts["edges"] for n, f in enumerate(e["files"]))
    return Counts(facts["n_lines"], facts["n_lines"] if key is None else counted_runs(facts["edges"]), digests)


def named_digests(spark: SparkSession, path: str, digests: tuple[Digest, ...]) -> list[tuple[str, str, int]]:
    """(file, MD5, size) of written digests, by the names that the writer gave: partition and file of it are parts of them."""
    names = {}
    for name in file_names(spark, path):
        if found := re.match(r"part-(\d+)-.*-c(\d+)", name):
            names[int(found[1]), int(found[2])] = name
    return sorted((names[d.part, d.file], d.md5, d.size_bytes) for d in digests)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Name, size, modification time and MD5 of every part file.

    A digest needs a file whole inside one task; ``write_lines`` bounds the files for that.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.md5("content").alias("md5"),
    )


def file_totals(spark: SparkSession, path: str) -> DataFrame:
    """Size and last modification of one output, from the file listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"), F.max("modificationTime").alias("finished_at"))
