"""Counts over written lines, and the freshness of the replica."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lag_seconds

# Greatest accepted lag and sample age, and the three verdicts.
MAX_LAG_SECONDS = 1800
MAX_SAMPLE_MINUTES = 30
DELAYED, BROKEN, FRESH = "DELAY", " Critical Data Broken status", "OK"
SAMPLE_FORMAT = "MM/dd/yyyy HH:mm:ss"


def line_count(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of rows of one segment: its first and last key, changes inside, rows."""
    names = ("file", "start", "first", "last", "inside", "n")
    done, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, key = (batch.column(c) for c in ("file", "start", "key"))

        def differs(c: pa.Array) -> np.ndarray:
            return pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False).astype(bool)

        moved, changed = differs(file) | differs(start), differs(key)
        cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts[:-1], cuts[1:]):
            own = (file[x].as_py(), start[x].as_py())
            first, last = key[x].as_py(), key[y - 1].as_py()
            inside = int(changed[x : y - 1].sum())
            if now and now[:2] == own:
                now = (*own, now[2], last, now[4] + inside + (now[3] != first), now[5] + y - x)
            else:
                done += [now] if now else []
                now = (*own, first, last, inside, y - x)
    done += [now] if now else []
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    columns = list(zip(*done)) if done else [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], list(names))


def _counted(rows: DataFrame) -> DataFrame:
    """Lines and runs over rows (file, start, key) that lie in order within segments (file, start), segments in order.

    Segments are summed up where they are read, one row each; only those rows are put in order and joined by their edges. A
    blank key at the start is no change.
    """
    parts = rows.mapInArrow(_edges, "file string, start long, first string, last string, inside long, n long")
    carried = F.coalesce(F.lag("last").over(Window.orderBy("file", "start")), F.lit(""))
    joined = parts.withColumn("edge", F.when(carried != F.col("first"), 1).otherwise(0))
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"), F.coalesce(F.sum(F.col("inside") + F.col("edge")), F.lit(0)).alias("n_runs"))


def _blank_free(key: Column) -> Column:
    return F.coalesce(F.trim(key), F.lit(""))


def run_count(lines: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """How often the blank-stripped ``key`` changes from one line to the next in sort order; a blank start is no change.

    Equal neighbours never count, so equal (order, key) rows are folded first, which also folds hot keys. The distinct rows
    are sorted in ranges, which are summed up in place.
    """
    folded = lines.select(*order, _blank_free(key).alias("key")).distinct()
    by = [F.asc_nulls_last(c) for c in [*order, "key"]]
    ranged = folded.repartitionByRange(*by).sortWithinPartitions(*by)
    return _counted(ranged.select(F.lit("").alias("file"), F.spark_partition_id().cast("long").alias("start"), "key")).select("n_runs")


def control_counts(written: DataFrame, key: Column | None) -> DataFrame:
    """Lines, and lines counted once per run of ``key`` (all of them where the output has no key), in the order of the files.

    ``written``: lines as ``read_lines`` gives them; files are in order by name and read piece by piece, without a shuffle.
    """
    if key is None:
        return line_count(written).withColumn("n_distinct", F.col("n_lines"))
    where = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return _counted(written.select(*where, _blank_free(key).alias("key"))).select("n_lines", F.col("n_runs").alias("n_distinct"))


def freshness_status(stats: DataFrame, now: Column) -> DataFrame:
    """Verdict per replica sample: long lag, missing lag, old sample, in that order."""
    age = F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.col("datum_time"), F.lit(SAMPLE_FORMAT)), now)
    lag = lag_seconds(F.col("value"))
    status = (
        F.when(lag > MAX_LAG_SECONDS, DELAYED)
        .when(F.col("value").isNull(), BROKEN)
        .when(age > MAX_SAMPLE_MINUTES * 60, DELAYED)
        .otherwise(FRESH)
    )
    return stats.where(F.col("name") == "apply lag").select(status.alias("status"), F.col("value").alias("lag"))
