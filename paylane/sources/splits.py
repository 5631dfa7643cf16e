"""Splits of a database table for parallel reading, of about equal row counts.

Ids are seldom spread evenly, so ranges of equal width give uneven readers. The database counts rows per leading characters of
the key once (a small result), and the ranges are cut where the counts add up.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def histogram_query(table: str, column: str, width: int) -> str:
    """A subquery to read in place of the table: rows by the key's first characters."""
    part = f"substr({column}, 1, {width})"
    return f"(select {part} as bucket, count(*) as n from {table} group by {part}) histogram"


def literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def balanced_predicates(histogram: Iterable[tuple[str | None, int]], column: str, parts: int) -> list[str]:
    """WHERE conditions that cover every row once, missing keys included, for at most ``parts`` readers.

    A range is closed as soon as it holds its share of what is left, so no reader has more than a share and one bucket;
    a bucket of its own that is larger than that can only be split by longer leading characters.
    """
    counts = list(histogram)
    buckets, missing = sorted((b, n) for b, n in counts if b is not None), sum(n for b, n in counts if b is None)
    left, cuts, held = sum(n for _, n in buckets) + missing, [], missing
    for (_, n), (following, _) in zip(buckets, buckets[1:]):
        held += n
        if len(cuts) + 1 < parts and held >= left / (parts - len(cuts)):
            cuts.append(following)
            left, held = left - held, 0
    if not cuts:
        return ["1 = 1"]
    first = f"({column} < {literal(cuts[0])} or {column} is null)"
    inner = [f"({column} >= {literal(a)} and {column} < {literal(b)})" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"{column} >= {literal(cuts[-1])}"]


def table_predicates(spark: SparkSession, options: dict[str, str], table: str, column: str, parts: int, width: int = 6) -> list[str]:
    """Predicates for ``spark.read.jdbc`` from the table's own histogram, of as many rows as there are leading characters."""
    found = spark.read.format("jdbc").options(**options, dbtable=histogram_query(table, column, width)).load().collect()
    return balanced_predicates([(r[0], int(r[1])) for r in found], column, parts)
