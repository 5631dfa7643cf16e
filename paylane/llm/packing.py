"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

Pieces are dealt into pools by a hash; a pool is a packing problem of its own, worked on by several islands (tasks) that
differ in their random numbers. An individual is a set of bins. Crossover injects whole well-filled bins of one parent into
the other, drops the bins of the other that hold any of their pieces, and best-fits the displaced pieces, largest first.
After each epoch every island passes its elite to the next island of the pool; at last the pool's best elite is taken.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylane.llm.common import tidy
from paylane.llm.token_files import crc_of
from paylane.llm.tokens import WORD_BPE, encoder
from paylane.session import staged

POOL, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 4096, 2, 2, 6, 8

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def piece_rows(tokenizer: str, end: int, most: int, rows: int = 1000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                ids, sizes = encoder(tokenizer).encode(batch.column("text"))
                ids = np.insert(ids, np.cumsum(sizes), end).astype(np.uint32)
                sizes = sizes + 1
                n = -(-sizes // most)
                doc = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * most
                length = np.minimum(sizes[doc] - start, most)
                first = (np.cumsum(sizes) - sizes)[doc] + start
                crc = [crc_of(ids[a : a + b]) for a, b in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(len(doc))), batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()),
                     pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    ["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
                )
                uid += len(doc)

    return cut


def pieces(docs: DataFrame, most: int = 2048, end: int = 0, tokenizer: str = WORD_BPE) -> DataFrame:
    """One row per piece of at most ``most`` ids; a document's ids end with ``end``. A null or empty text is that id alone.

    Only documents longer than ``most`` are cut. ``uid`` tells repeated rows apart. The pieces are written once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(rows.mapInArrow(tidy(piece_rows(tokenizer, end, most)), PIECES), "pieces")


# ---------------------------------------------------------------- one pool, in one task


class Pool:
    """Sizes of a pool's pieces, and the moves of the genetic algorithm on packings of them (lists of bins of indices)."""

    def __init__(self, sizes: list[int], capacity: int, rng: np.random.Generator):
        self.sizes, self.capacity, self.rng = sizes, capacity, rng

    def room(self, items: list[int]) -> int:
        return self.capacity - sum(self.sizes[i] for i in items)

    def best_fit(self, bins: list[list[int]], items: list[int]) -> list[list[int]]:
        """Put items, in the given order, each where least room is left over; open a bin where none has room."""
        rooms = sorted((room, k) for k, b in enumerate(bins) if (room := self.room(b)))
        for i in items:
            size = self.sizes[i]
            at = bisect_left(rooms, (size, -1))
            if at == len(rooms):
                room, k = self.capacity, len(bins)
                bins.append([])
            else:
                room, k = rooms.pop(at)
            bins[k].append(i)
            if room > size:
                insort(rooms, (room - size, k))
        return bins

    def falling(self, items: list[int], noise: float = 0.0) -> list[int]:
        weight = np.array([self.sizes[i] for i in items], float)
        if noise:
            weight *= self.rng.uniform(1 - noise, 1 + noise, len(items))
        return [items[k] for k in np.argsort(-weight, kind="stable")]

    def fitness(self, bins: list[list[int]]) -> tuple[int, float]:
        """Fewer bins are better; then uneven filling, which leaves room together."""
        return -len(bins), sum(((self.capacity - self.room(b)) / self.capacity) ** 2 for b in bins)

    def crossover(self, one: list[list[int]], other: list[list[int]]) -> list[list[int]]:
        rooms = [self.room(b) for b in other]
        well = np.argsort(rooms, kind="stable")[: max(1, len(other) // 2)]
        chosen = self.rng.choice(well, max(1, len(well) // 4), replace=False)
        injected = [list(other[k]) for k in chosen.tolist()]
        taken = {i for b in injected for i in b}
        kept, loose = [], []
        for b in one:
            if taken.isdisjoint(b):
                kept.append(list(b))
            else:
                loose += [i for i in b if i not in taken]
        return self.best_fit(kept + injected, self.falling(loose))

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        """Empty some of the worst-filled bins and a few others, and best-fit their pieces again."""
        rooms = np.array([self.room(b) for b in bins])
        worst = np.argsort(-rooms, kind="stable")[: max(1, len(bins) // 20)]
        gone = {*worst.tolist(), *self.rng.integers(0, len(bins), max(1, len(bins) // 20)).tolist()}
        loose = [i for k in sorted(gone) for i in bins[k]]
        return self.best_fit([list(b) for k, b in enumerate(bins) if k not in gone], self.falling(loose, 0.05))

    def evolve(self, seeds: list[list[list[int]]], population: int, generations: int) -> list[list[int]]:
        everything = list(range(len(self.sizes)))
        alive = seeds or [self.best_fit([], self.falling(everything))]
        while len(alive) < population:
            alive.append(self.mutate(alive[0]) if seeds else self.best_fit([], self.falling(everything, 0.02 * len(alive))))
        scored = sorted(((self.fitness(x), k, x) for k, x in enumerate(alive)), reverse=True)
        least, born = -(-sum(self.sizes) // self.capacity), len(scored)
        for _ in range(generations):
            if len(scored[0][2]) <= least:
                break  # no packing has fewer bins
            a, b = sorted(self.rng.choice(len(scored), 2, replace=False).tolist())
            child = self.mutate(self.crossover(scored[a][2], scored[b][2]))
            if (score := self.fitness(child)) > scored[-1][0]:
                scored[-1] = (score, born, child)
                scored.sort(reverse=True)
                born += 1
        return scored[0][2]


def bins_of(numbers: np.ndarray) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(numbers.tolist()):
        bins.setdefault(b, []).append(i)
    return list(bins.values())


def numbers_of(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def island(capacity: int, seed: int, epoch: int, population: int, generations: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["origin", "uid"], kind="stable")
        pool, here = int(rows["pool"].iloc[0]), int(rows["island"].iloc[0])
        elites = [part for _, part in rows.groupby("origin", sort=True)]
        first = elites[0]
        sizes = first["length"].tolist()
        task = Pool(sizes, capacity, np.random.default_rng([seed, epoch, pool, here]))
        seeds = [bins_of(part["bin"].to_numpy()) for part in elites] if epoch else []
        best = task.evolve(seeds, population, generations)
        return first[["pool", "island", "uid", "length"]].assign(bin=numbers_of(best, len(sizes)))

    return work


def laid_out(rows: pd.DataFrame) -> pd.DataFrame:
    """The best elite of a pool, with each piece's place in its sequence."""
    n_bins = rows.groupby("island")["bin"].nunique()
    best = rows[rows["island"] == n_bins.idxmin()].sort_values(["bin", "uid"], kind="stable")
    ends = best.groupby("bin")["length"].cumsum()
    return pd.DataFrame({"uid": best["uid"], "sequence_id": best["pool"].astype("int64") * (1 << 24) + best["bin"], "offset": ends - best["length"]})


def pack(
    items: DataFrame, capacity: int = 2048, seed: int = 11, pool: int = POOL, islands: int = ISLANDS, epochs: int = EPOCHS,
    population: int = POPULATION, generations: int = GENERATIONS,
) -> DataFrame:
    """``items`` (uid, length, ...) with ``sequence_id`` and ``offset``: no sequence is longer than ``capacity``.

    Pieces that fill a sequence are sequences of their own (negative numbers) and never enter a pool. Pools take about
    ``pool`` pieces each, however many there are. An empty table gives an empty result. Lengths must be 1 to ``capacity``.
    """
    rest = items.where(F.col("length") < capacity)
    pools = max(1, -(-rest.count() // pool))
    dealt = rest.select("uid", "length", F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(pools)).cast("int").alias("pool"))
    state = dealt.withColumn("bin", F.lit(0).cast("long")).withColumn("island", F.explode(F.array(*(F.lit(k) for k in range(islands)))))
    state = state.withColumn("origin", F.col("island"))
    schema = "pool int, island int, uid long, length long, bin long"
    for epoch in range(epochs):
        done = state.groupBy("pool", "island").applyInPandas(island(capacity, seed, epoch, population, generations), schema)
        nexts = F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands)))
        state = done.select("pool", F.col("island").alias("origin"), F.explode(F.array_distinct(nexts)).alias("island"), "uid", "length", "bin")
    placed = done.groupBy("pool").applyInPandas(laid_out, "uid long, sequence_id long, offset long")
    full = items.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    return items.where(F.col("length") < capacity).join(placed, "uid").unionByName(full)
