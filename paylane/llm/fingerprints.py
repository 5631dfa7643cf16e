"""Document fingerprints by improved consistent weighted sampling.

A document is a vector of weighted terms: its white-space separated words, alone and in adjacent pairs, as 64-bit hashes,
weighted by how often they occur. Sample k gives each term r ~ Gamma(2, 1), c ~ Gamma(2, 1) and b ~ Uniform(0, 1), all
hashed from term and k, so that no two terms share them; with t = floor(ln w / r + b) the term with the least
ln c - r (t - b) - r is drawn, and (term, t) is the sample. Two documents draw the same sample with the probability of
their generalised Jaccard similarity, the sum of the smaller weights over the sum of the larger. A fingerprint keeps 16
hashed bits of each sample.

A Gamma(2, 1) is the sum of two exponentials, of which the first is a uniform share: r = s + q and b = s / r. So
ln c - r (t - b) - r = ln c - q - r t, and what is compared is its exponential, c u exp(-r t) with u = exp(-q) uniform. A
weight of 1 has t = 0 for every s, which is then not needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylane.llm.common import arrival, split_words, texts_of, tidy
from paylane.session import staged

SAMPLES, SEED = 64, 42
PAIRS_AT_ONCE, DRAWS_AT_ONCE = 32_768, 128
ONE, HALF = np.uint32(0x3F800000), np.float32(1 - 2**-24)


def uniform(bits: np.ndarray) -> np.ndarray:
    """Inner points of (0, 1) from numbers of 23 bits, which float32 holds exactly."""
    bits |= ONE
    points = bits.view(np.float32)
    points -= HALF
    return points


@lru_cache(8)
def keys_of(samples: int, seed: int) -> np.ndarray:
    """Odd numbers."""
    return np.random.default_rng(seed).integers(0, 1 << 64, samples, np.uint64) | np.uint64(1)


def seeded(term: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """64 well mixed bits for each term and sample; the same in every task. Terms are hashes already."""
    x = term[:, None] * keys_of(samples, seed)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def one_more(x: np.ndarray, factor: int) -> np.ndarray:
    """One more uniform point from each number."""
    return uniform((x * np.uint64(factor) >> np.uint64(41)).astype(np.uint32))


def draws(term: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """c u for each term and sample."""
    out = np.empty((len(term), samples), np.float32)
    for at in range(0, len(term), DRAWS_AT_ONCE):
        part = slice(at, at + DRAWS_AT_ONCE)
        x = seeded(term[part], samples, seed)
        u = one_more(x, 0x9E3779B97F4A7C15)
        c = uniform(x.view(np.uint32) >> np.uint32(9))
        c = np.log(c[:, ::2] * c[:, 1::2])
        np.multiply(c, u, out=out[part])
    np.negative(out, out=out)
    return out


def steps(term: np.ndarray, weight: np.ndarray, samples: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """t and r for terms of weights above 1."""
    x = seeded(term, samples, seed)
    q, s = -np.log(one_more(x, 0x9E3779B97F4A7C15)), -np.log(one_more(x, 0xBF58476D1CE4E5B9))
    r = q + s
    return np.floor((np.log(weight).astype(np.float32)[:, None] + s) / r), r


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place of the term, weight) of all terms, in order of text and term, and the sorted hashes of terms."""
    flat, counts = split_words(pa.array(texts, pa.string()))
    seen = flat.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, seen.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(seen.dictionary))
    words = hashes[seen.indices.to_numpy()]
    text = np.repeat(np.arange(len(texts)), counts)
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    together = text[:-1] == text[1:]
    text = np.concatenate([text, text[:-1][together]])
    distinct, place = np.unique(np.concatenate([words, pairs[together]]), return_inverse=True)
    key, weight = np.unique((text << 32) | place, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, weight, distinct


def fingerprints(texts: list[str], samples: int = SAMPLES, seed: int = SEED) -> np.ndarray:
    """One row of 16-bit codes per text; a text without words has zeros, which no other text has."""
    text, place, weight, distinct = terms(texts)
    out = np.zeros((len(texts), samples), np.uint16)
    best = np.full((len(texts), samples), np.inf, np.float32)
    for at in range(0, len(text), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        own, (used, rows) = text[part], np.unique(place[part], return_inverse=True)
        table = draws(distinct[used], samples, seed)
        short = ((distinct[used] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
        often = np.flatnonzero(weight[part] > 1)  # t is 0 for a weight of 1
        t, r = steps(distinct[used[rows[often]]], weight[part][often], samples, seed)
        drop = np.exp(-r * t)
        bounds = np.r_[np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), len(own)]
        marks = np.searchsorted(often, bounds)
        for begin, end, low, high in zip(bounds, bounds[1:], marks, marks[1:]):
            value = table[rows[begin:end]]
            heavy = often[low:high] - begin
            value[heavy] *= drop[low:high]
            least = value.min(axis=0)
            row, col = np.divmod(np.flatnonzero(value == least), samples)
            level = np.zeros(end - begin, np.int64)
            level[heavy] = np.arange(low + 1, high + 1)
            of = level[row]
            step = np.where(of > 0, t[of - 1, col], 0) if high > low else np.zeros(len(row))
            code = (short[rows[begin + row]] + step.astype(np.int64).astype(np.uint32)) * np.uint32(0x85EBCA6B)
            drawn = np.zeros(samples, np.uint16)
            drawn[col] = (code >> np.uint32(16)).astype(np.uint16) | np.uint16(1)
            doc = own[begin]
            better = least <= best[doc]  # a long text goes on in the next slice; of equal values the last is drawn, as inside one
            out[doc] = np.where(better, drawn, out[doc])
            best[doc] = np.where(better, least, best[doc])
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples: an estimate of the generalised Jaccard similarity. Two texts without words are alike."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many from the start of the next text."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def digest(texts: list[str], nexts: list[str]) -> dict[str, pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, nexts)]
    n = len(texts)
    codes = fingerprints([*(x for both in zip(texts, changed) for x in both), *nexts[-1:]])  # what shares terms side by side
    own, other, following = codes[: 2 * n : 2], codes[1 : 2 * n : 2], codes[2 * n :]
    # nexts[i] is texts[i + 1], but for the last.
    after = np.concatenate([own[1:], following]) if n else own
    return {
        "n_chars": pa.array([len(x) for x in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed]),
        "fingerprint": pa.array([x.tobytes() for x in own], pa.binary()),
        "edited_fingerprint": pa.array([x.tobytes() for x in other], pa.binary()),
        "near_edited": pa.array(likeness(own, other), pa.float64()),
        "near_next": pa.array(likeness(own, after), pa.float64()),
    }


DIGEST = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def in_order(batches: Iterator[pa.RecordBatch], rows: int = 400) -> Iterator[pa.RecordBatch]:
    """Digests of a sorted partition. The last document has no next one here: it goes out as ``last_text``, the first as ``first_text``."""
    part, first, held_id, held = TaskContext.get().partitionId(), None, [], []
    names = [x.split()[0] for x in DIGEST.split(", ")]

    def emit(ids: list, columns: dict[str, pa.Array], heads: list, tails: list) -> pa.RecordBatch:
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part), pa.int32()), pa.array(ids, pa.int64()), *(columns[c] for c in names), pa.array(heads, pa.string()), pa.array(tails, pa.string())],
            ["part", "doc_id", *names, "first_text", "last_text"],
        )

    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            ids, texts = [*held_id, *batch.column("doc_id").to_pylist()], [*held, *texts_of(batch.column("text"))]
            if first is None:
                first = texts[0]
            yield emit(ids[:-1], digest(texts[:-1], texts[1:]), [None] * (len(ids) - 1), [None] * (len(ids) - 1))
            held_id, held = ids[-1:], texts[-1:]
    if held:
        empty = {c: pa.nulls(1, k) for c, k in zip(names, (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()))}
        yield emit(held_id, empty, [first], held)


def at_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the last documents of partitions, each with the first text of the next partition."""
    for batch in batches:
        ids, texts, nexts = batch.column("doc_id"), texts_of(batch.column("last_text")), texts_of(batch.column("next_text"))
        for k, (text, following) in enumerate(zip(texts, nexts)):
            columns = digest([text], [following])
            yield pa.RecordBatch.from_arrays([ids.slice(k, 1), *columns.values()], ["doc_id", *columns])


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited form, and their likeness to each other and to the next document's.

    Documents are in order of doc_id (null first), rows of equal id in order of the scan; after the last comes the first. A
    null text is an empty one. Texts cross the network once, sorted in ranges; what ranges need from their neighbours is
    one row each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", arrival().alias("arrived"))
    rows = rows.repartitionByRange("doc_id", "arrived").sortWithinPartitions("doc_id", "arrived").drop("arrived")
    schema = f"part int, doc_id long, {DIGEST}, first_text string, last_text string"
    done = staged(rows.mapInArrow(tidy(in_order), schema), "fingerprints")

    ends = done.where("last_text is not null")
    parts = ends.select("part")
    order = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("follower"))  # one row per partition
    least = parts.agg(F.min("part")).first()[0]
    order = order.withColumn("follower", F.coalesce("follower", F.lit(least)))
    firsts = ends.select(F.col("part").alias("follower"), F.col("first_text").alias("next_text"))
    bounds = ends.select("part", "doc_id", "last_text").join(order, "part").join(firsts, "follower")
    last = bounds.select("doc_id", "last_text", "next_text").mapInArrow(at_bounds, f"doc_id long, {DIGEST}")
    inner = done.where("last_text is null").select("doc_id", *(x.split()[0] for x in DIGEST.split(", ")))
    return inner.unionByName(last)
