"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds every document's terms as a Bloom signature, and again those that occur 2, 4, 8 and 16 times at least. Documents
of like size share a block, whose signatures are stored by bit: a slice is one bit of all its documents. The slices of a term,
and-ed, are a bitmap of the documents that may hold it; it never leaves one out. Weighted sums of bitmaps, each scaled by what
so many occurrences can add in a document of that length, are upper bounds of scores, for all queries and documents of a block
at once. The documents with the highest bounds are scored exactly; the tenth best of them is a bar that the tenth best of all
cannot be below. Every document whose bound reaches the bar is then scored exactly, all others are excluded by proof.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylane.llm.common import broadcast_within, tidy
from paylane.llm.wordhash import mixed, text_slices, word_hashes
from paylane.session import prepare, staged

LEVELS = 5  # signatures for 1, 2, 4, 8 and 16 occurrences
PROBES = 3
BITS = 12  # of a signature for each of its entries, rounded up to a power of two
# A signature has at most 2**20 bits; fuller ones let bounds rise, never fall.
LEAST_WIDTH, MOST_WIDTH = 6, 20
BLOCK_BITS = 22
MOST_DOCS = 2048
TOP = 10
SEEDS = 20
LOT = 2000  # queries answered by one pass over the index

INDEX = "width int, doc_ids array<long>, keys array<long>, lengths array<long>, slices binary"


def probes(terms: np.ndarray, level: int) -> np.ndarray:
    """PROBES numbers of 20 bits for each term; a signature of fewer bits uses their low ones."""
    x = mixed(terms + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64)))
    return np.stack([(x >> np.uint64(21 * p)) & np.uint64((1 << MOST_WIDTH) - 1) for p in range(PROBES)], axis=-1).astype(np.int64)


def counted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of the distinct terms of each text, in order of text."""
    distinct, place = np.unique(hashes, return_inverse=True)
    text = np.repeat(np.arange(len(counts)), counts)
    key, often = np.unique((text << 32) | place, return_counts=True)
    return key >> 32, distinct[key & 0xFFFFFFFF], often


class Blocks:
    """Documents of one signature width until they fill a block."""

    def __init__(self, width: int):
        self.width, self.most = width, max(8, min(MOST_DOCS, 1 << max(0, BLOCK_BITS - width)))
        self.docs, self.bits, self.own = [], [], []

    def add(self, doc: tuple, bits: np.ndarray) -> dict | None:
        self.own.append(np.full(len(bits), len(self.docs)))
        self.docs.append(doc)
        self.bits.append(bits)
        return self.flush() if len(self.docs) == self.most else None

    def flush(self) -> dict | None:
        if not self.docs:
            return None
        table = np.zeros((1 << self.width, -(-len(self.docs) // 8) * 8), np.uint8)
        table[np.concatenate(self.bits) & ((1 << self.width) - 1), np.concatenate(self.own)] = 1
        ids, keys, lengths = (list(x) for x in zip(*self.docs))
        self.docs, self.bits, self.own = [], [], []
        return {"width": self.width, "doc_ids": ids, "keys": keys, "lengths": lengths, "slices": np.packbits(table, axis=1).tobytes()}


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("width", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "keys", "lengths")), ("slices", pa.binary())])
    open_blocks: dict[int, Blocks] = {}
    for whole in batches:
        for batch in text_slices(whole, "text"):
            hashes, counts = word_hashes(batch.column("text"))
            text, term, often = counted(hashes, counts)
            rows, bits = [text], [probes(term, 0)]
            for level in range(1, LEVELS):
                more = often >= 1 << level
                rows.append(text[more])
                bits.append(probes(term[more], level))
            rows, bits = np.concatenate(rows), np.concatenate(bits)
            order = np.argsort(rows, kind="stable")
            ends = np.cumsum(np.bincount(rows, minlength=len(counts)))
            bits = bits[order]
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            begin = 0
            for row, (n, end) in enumerate(zip(counts.tolist(), ends.tolist())):
                if n:
                    width = min(MOST_WIDTH, max(LEAST_WIDTH, (BITS * (end - begin) - 1).bit_length()))
                    block = open_blocks.setdefault(width, Blocks(width)).add((ids[row], keys[row], n), bits[begin:end].ravel())
                    if block:
                        yield pa.RecordBatch.from_pylist([block], kind)
                begin = end
    for blocks in open_blocks.values():
        if block := blocks.flush():
            yield pa.RecordBatch.from_pylist([block], kind)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")


def build_index(docs: DataFrame, path: str) -> DataFrame:
    """Write the blocks of all documents that have a term, and read them back. The index knows nothing of queries."""
    _keyed(docs).mapInArrow(tidy(signatures), INDEX).write.parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


@dataclass
class Queries:
    """A lot of queries: ids, their distinct terms as places in ``terms`` (sorted), with how often each stands in the query."""

    items: list
    terms: np.ndarray
    of: list[np.ndarray]
    often: list[np.ndarray]
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 1

    @classmethod
    def of_rows(cls, rows: list[tuple]) -> Queries:
        hashes, counts = word_hashes(pa.array([text for _, text in rows], pa.string()))
        query, term, often = counted(hashes, counts)
        terms = np.unique(term)
        place = np.searchsorted(terms, term)
        bounds = np.searchsorted(query, np.arange(len(rows) + 1))
        parts = list(zip(bounds, bounds[1:]))
        return cls([item for item, _ in rows], terms, [place[a:b] for a, b in parts], [often[a:b] for a, b in parts])

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash stands among the terms; -1 for others."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        return 25 + (75 * lengths * self.documents) // self.length

    def score(self, query: int, tf: np.ndarray, damp: int) -> int:
        own = tf[self.of[query]]
        return int((self.weights[self.of[query]] * self.often[query] * ((1_000_000_000 * own) // (1000 * own + 8 * damp))).sum())


def frequencies(docs: DataFrame, queries: Queries) -> np.ndarray:
    """For each term of the queries the number of documents that hold it: one row a term and task comes together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(queries.terms), np.int64)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                hashes, counts = word_hashes(batch.column("text"))
                at = queries.places(hashes)
                text = np.repeat(np.arange(len(counts)), counts)[at >= 0]
                found += np.bincount(np.unique((text << 32) | at[at >= 0]) & 0xFFFFFFFF, minlength=len(found))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["term", "n"])

    out = np.zeros(len(queries.terms), np.int64)
    if len(out):
        rows = docs.select("text").mapInArrow(tidy(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        for r in rows.collect():  # one row per query term at most
            out[r["term"]] = r["n"]
    return out


def bounds_of(queries: Queries, block: dict) -> np.ndarray:
    """Upper bounds of the scores of all queries (rows) and all documents of a block; exact whole numbers in doubles."""
    n = len(block["lengths"])
    lengths = np.array(block["lengths"], np.int64)
    damp, mask = queries.damping(lengths), (1 << block["width"]) - 1
    slices = np.frombuffer(block["slices"], np.uint8).reshape(1 << block["width"], -1)
    out = np.zeros((len(queries.of), n))
    weights, before, maybe = queries.weights.astype(np.float64), np.zeros(n, np.int64), None
    for level in range(LEVELS):
        own = slices[probes(queries.terms, level) & mask]
        present = np.bitwise_and.reduce(own, axis=1)
        maybe = present if maybe is None else maybe & present
        if not maybe.any():
            break
        most = lengths if level == LEVELS - 1 else np.minimum((2 << level) - 1, lengths)
        adds = (1_000_000_000 * most) // (1000 * most + 8 * damp)
        bitmaps, some = np.unpackbits(maybe, axis=1, count=n), maybe.any(axis=1)
        for query, (terms, often) in enumerate(zip(queries.of, queries.often)):
            here = some[terms]
            if here.any():
                use = terms[here]
                out[query] += ((weights[use] * often[here]) @ bitmaps[use].astype(np.float64)) * (adds - before)
        before = adds
    return out


PAIR = pa.schema([("query", pa.int64()), ("bound", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64())])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def pairs_batch(query: np.ndarray, bound: np.ndarray, block: dict, doc: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(block[c], pa.int64()).take(pa.array(doc)) for c in ("doc_ids", "keys")]
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(bound.astype(np.int64)), *columns], schema=PAIR)


def highest(queries: Queries):
    """The SEEDS documents of a task with the highest bounds, for each query."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for block in blocks_of(batches):
            bounds = bounds_of(queries, block)
            k = min(SEEDS, bounds.shape[1])
            top = np.argpartition(-bounds, k - 1, axis=1)[:, :k]
            query = np.repeat(np.arange(len(bounds)), k)
            values = np.take_along_axis(bounds, top, 1).ravel()
            some = values > 0
            rows = pa.Table.from_batches([pairs_batch(query[some], values[some], block, top.ravel()[some])])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            rows = rows.sort_by([("query", "ascending"), ("bound", "descending")])
            of = rows.column("query").to_numpy()
            kept = rows.filter(pa.array(np.arange(len(of)) - np.searchsorted(of, of) < SEEDS))
        if kept is not None:
            yield from kept.combine_chunks().to_batches()

    return work


def reaching(queries: Queries, bars: np.ndarray):
    """All pairs of a query and a document whose bound reaches the query's bar.

    Of documents with the same text, which score the same, a block's ten of least id are enough: they come before the others.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            bounds = bounds_of(queries, block)
            query, doc = np.nonzero(bounds >= bars[:, None])
            if len(query):
                keys = np.array(block["keys"], np.int64)
                ids = np.array([(1 << 63) - 1 if i is None else i for i in block["doc_ids"]], np.int64)
                order = np.lexsort((ids[doc], keys[doc], query))
                query, doc = query[order], doc[order]
                starts = np.r_[True, (query[1:] != query[:-1]) | (keys[doc][1:] != keys[doc][:-1])]
                first = np.flatnonzero(starts)
                place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
                keep = place < TOP
                yield pairs_batch(query[keep], bounds[query[keep], doc[keep]], block, doc[keep])

    return work


SCORED = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def best_of(rows: pa.Table, top: int) -> pa.Table:
    """The ``top`` rows of each query: highest score, then least id (a null id last)."""
    rows = rows.sort_by([("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
    of = rows.column("query").to_numpy()
    return rows.filter(pa.array(np.arange(len(of)) - np.searchsorted(of, of) < top))


def scorer(queries: Queries, top: int):
    """Exact scores of texts for their queries; a task hands on its best ``top`` of each query."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = SCORED.empty_table()
        for whole in batches:
            out = []
            for batch in text_slices(whole, "text"):
                hashes, counts = word_hashes(batch.column("text"))
                at, last = queries.places(hashes), np.cumsum(counts)
                damps = queries.damping(counts)
                for n, end, damp, doc_id, wanted in zip(counts, last, damps, batch.column("doc_id").to_pylist(), batch.column("queries").to_pylist()):
                    own = at[end - n : end]
                    tf = np.bincount(own[own >= 0], minlength=len(queries.terms))
                    scores = ((q, doc_id, queries.score(q, tf, damp)) for q in set(wanted))
                    out += [s for s in scores if s[2] > 0]
            if out:
                rows = pa.Table.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=SCORED)
                kept = best_of(pa.concat_tables([kept, rows]), top)
        yield from kept.combine_chunks().to_batches()

    return work


def rescored(docs: DataFrame, pairs: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(query, doc_id, score) of the rows of ``docs`` that ``pairs`` names, at least the best ``top`` of each query."""
    wanted = staged(pairs.groupBy("doc_id", "key").agg(F.collect_list("query").alias("queries")), "wanted")
    wanted = broadcast_within(wanted.withColumnsRenamed({"doc_id": "_id", "key": "_key"}), F.lit(48) + 8 * F.size("queries"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    rows = _keyed(docs).join(wanted, same).select("doc_id", "text", "queries")
    return rows.mapInArrow(tidy(scorer(queries, top)), "query long, doc_id long, score long")


def ranked(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_lot(docs: DataFrame, index: DataFrame, queries: Queries) -> DataFrame:
    """(query, rank, doc_id, score): the best documents of a lot of queries."""
    facts = index.select(F.size("lengths").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    total = facts.agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    queries.documents, queries.length = total["n"] or 0, total["l"] or 1
    df = frequencies(docs, queries).tolist()
    queries.weights = np.array([math.floor(1000 * math.log((2 * queries.documents + 2) / (2 * n + 1))) for n in df], np.int64)

    tops = Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id", "key")
    seeds = index.mapInArrow(tidy(highest(queries)), _ddl(PAIR)).withColumn("_n", F.row_number().over(tops)).where(F.col("_n") <= SEEDS)
    known = ranked(rescored(docs, seeds, queries, TOP), TOP).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("bar"))
    bars = np.ones(len(queries.items))  # a score of 0 is no hit
    for r in known.where(F.col("n") >= TOP).collect():  # one row a query
        bars[r["query"]] = max(1, r["bar"])
    pairs = staged(index.mapInArrow(tidy(reaching(queries, bars)), _ddl(PAIR)), "pairs")
    return ranked(rescored(docs, pairs, queries, TOP), TOP).select("query", "rank", "doc_id", "score")


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} long" for f in schema)


def lots_of(spark: SparkSession, items: DataFrame, lot: Column, n: int) -> Iterator[list[tuple]]:
    for number in range(n):
        rows = items.where(lot == number).select("item_id", "text").collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, str(r[0]), r[1] or ""))


def search(docs: DataFrame, items: DataFrame, index_path: str) -> DataFrame:
    """(item_id, rank, doc_id, score): the ten best documents of each item by the weighted terms they share.

    Scores are whole numbers of 64 bits. Equal scores rank by ascending doc_id (null last); documents that share no term of
    weight are left out, so an item may have fewer rows, or none. A null text has no terms. A repeated row ranks once per row,
    a repeated item is answered once per row. Terms are told apart by 64-bit hashes. Queries are taken in lots of some LOT at a time,
    which is what the driver and each task hold of them.
    """
    spark = prepare(docs.sparkSession)
    index = build_index(docs, index_path)
    n = max(1, -(-items.count() // LOT))
    lot = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(n))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for rows in lots_of(spark, items, lot, n):
        if not rows:
            continue
        found = search_lot(docs, index, Queries.of_rows(rows))
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(rows)], f"query long, item_id {kind}")
        out = out.unionByName(staged(found, "found").join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    return out
