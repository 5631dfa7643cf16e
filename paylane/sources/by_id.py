"""A table kept in order of an id, for questions that name ids and no dates.

Rows are sorted by the id, and every row group carries the id's least and greatest value and a Bloom filter over it. A few ids
are looked up by value: the scan skips each row group that holds none of them, so what is read grows with the ids asked for
and not with the table. Many ids, such as all of a window, are summed up as spans first, which skip what lies outside.
Batches are appended as they come, each in its own order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, staged

# Ids per row group are bounded by its bytes; the filter is sized for that many, wrong once in a million lookups.
ROW_GROUP_BYTES = 64 << 20
IDS_PER_GROUP = 500_000
WRONG = 1e-6
# Ids that one scan looks up by value, as one set in the reader's filter; and scans of that kind.
IDS_BY_VALUE = 10_000
LOTS = 8
SPANS = 64


def append_by_id(rows: DataFrame, path: str, key: str = "transfer_id", row_group_bytes: int = ROW_GROUP_BYTES, ids_per_group: int = IDS_PER_GROUP) -> None:
    """Add a batch to the table at ``path``. An id with very many rows is spread over files by the rows' own hash."""
    spread = F.xxhash64(*rows.columns)
    ordered = rows.repartitionByRange(F.col(key), spread).sortWithinPartitions(F.col(key))
    writer = ordered.write.mode("append").option("parquet.block.size", row_group_bytes)
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.fpp#{key}", WRONG)
    writer.option(f"parquet.bloom.filter.expected.ndv#{key}", ids_per_group).parquet(path)


def lots_of(ids: DataFrame, key: str, n: int) -> Iterator[list]:
    """Distinct non-null ids in lots of at most IDS_BY_VALUE, each a range of them."""
    values = [r[0] for r in ids.orderBy(key).collect()]  # IDS_BY_VALUE * LOTS at most
    for at in range(0, n, IDS_BY_VALUE):
        yield values[at : at + IDS_BY_VALUE]


def spans_of(ids: DataFrame, key: str, spans: int = SPANS) -> list[tuple]:
    """(least, greatest) of at most some ranges that cover all ids: neighbouring ids, apart by their first two characters."""
    first = F.substring(F.col(key).cast("string"), 1, 2)
    ranges = ids.repartitionByRange(spans, key).groupBy(F.spark_partition_id(), first).agg(F.min(key), F.max(key))
    found = [(r[2], r[3]) for r in ranges.limit(4 * spans + 1).collect()]
    if len(found) <= 4 * spans:
        return sorted(found)
    return [tuple(ids.agg(F.min(key), F.max(key)).first())]


def inside(key: Column, spans: list[tuple]) -> Column:
    return reduce(Column.__or__, [(key >= F.lit(a)) & (key <= F.lit(b)) for a, b in spans])


def rows_of(table: DataFrame, ids: DataFrame, key: str = "transfer_id") -> DataFrame:
    """Rows of ``table`` (read from an ``append_by_id`` path) whose key is among ``ids``; copies of ids do not multiply.

    Up to LOTS * IDS_BY_VALUE ids become values that the scan looks up. More are joined, as before, past the spans that they
    cover; then most row groups hold some.
    """
    wanted = staged(ids.select(key).where(F.col(key).isNotNull()).distinct(), "ids")
    n = wanted.count()
    if n == 0:
        return table.where(F.lit(False))
    if n <= LOTS * IDS_BY_VALUE:
        parts = [table.where(F.col(key).isin(lot)) for lot in lots_of(wanted, key, n)]
        return reduce(DataFrame.unionByName, parts)
    spans = spans_of(wanted, key)
    found = table.where(inside(F.col(key), spans)).join(broadcast_if_small(wanted), key, "left_semi")
    # The spans are for this scan alone. On a bare key, Catalyst would test them on all that is joined to the rows as well, dozens of
    # comparisons a row, each with the key computed anew where it is an expression; so the key is given out as one (always itself).
    same = F.when(F.col(key) >= F.lit(min(least for least, _ in spans)), F.col(key))
    return found.select(*[same.alias(c) if c == key else F.col(c) for c in found.columns])
