"""Language of texts by a linear-chain conditional random field over words.

Every word of a text is labelled with a language. Its potentials come from hashed features (the word itself as a lexicon
entry, prefixes, suffixes, byte n-grams), neighbouring labels from learned transitions, which let a text switch language
but rarely. Forward-backward gives each word's marginals; the language of a text is that with the largest share of its
words. A chain holds at most CHAIN words: longer texts are several chains.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylane.llm.common import Batches, held_out, split_words, tidy
from paylane.session import broadcast_if_small, staged

BUCKETS, CHAIN, MEMO, ROWS = 1 << 17, 128, 400_000, 1000
# Bounds of the training sample: documents a language, and chains of CHAIN words a document.
DOCUMENTS, CHAINS = 300, 3
UNDETERMINED = "und"


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def bucket(x: np.ndarray, kind: int) -> np.ndarray:
    """Bucket of a feature value of some kind."""
    h = (x.astype(np.uint64) + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(20)).astype(np.int64) % BUCKETS


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words, on the bytes of their lower-case forms: per word its lexicon entry, prefixes and suffixes of one
    to three bytes (words x 7); per byte of all framed words the two- and three-byte sequences that begin there (bytes x 2),
    and where each word's bytes begin. BUCKETS stands for none; words without a letter have none at all."""
    framed = [b"<%s>" % w.lower().encode("utf-8", "surrogatepass") for w in words]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    data = np.frombuffer(b"".join(framed) + b"\0\0\0", np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    starts, n = ends - sizes, int(ends[-1]) if len(ends) else 0
    letters = np.fromiter(map(has_letter, words), bool, len(words))
    left = np.repeat(ends, sizes) - np.arange(n)  # bytes from here to the word's end
    two = data[:n] | data[1 : n + 1] << 8
    three = two | data[2 : n + 2] << 16
    on = np.repeat(letters, sizes)
    grams = np.stack([np.where(on & (left > k), bucket(v, k + 1), BUCKETS) for k, v in ((1, two), (2, three))], axis=1)
    whole = np.empty((len(words), 7), np.int64)
    whole[:, 0] = bucket(np.fromiter(map(zlib.crc32, framed), np.int64, len(framed)), 4)
    first = last = np.zeros(len(words), np.int64)
    for k in (1, 2, 3):
        first, last = first | data[np.minimum(starts + k, n)] << 8 * k, last | data[np.maximum(ends - 1 - k, 0)] << 8 * k
        whole[:, k] = np.where(sizes - 2 >= k, bucket(first, 4 + k), BUCKETS)
        whole[:, 3 + k] = np.where(sizes - 2 >= k, bucket(last, 7 + k), BUCKETS)
    whole[~letters] = BUCKETS
    return whole, grams, starts


@dataclass(frozen=True, eq=False)
class Field:
    """Learned potentials: of features (BUCKETS x labels), of transitions and of first labels."""

    key: int
    labels: tuple[str, ...]
    weights: np.ndarray
    moves: np.ndarray
    starts: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Potentials of words; words without a letter have none."""
        whole, grams, starts = features(words)
        weights = np.vstack([self.weights, np.zeros((1, len(self.labels)), np.float32)])
        sums = sum(weights[whole[:, k]] for k in range(whole.shape[1]))
        for k in range(2):
            sums = sums + np.add.reduceat(weights[grams[:, k]], starts, axis=0)
        return np.clip(sums, -20, 20)


def marginals(emissions: np.ndarray, moves: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over chains of equal width (chains, words, labels), padded after ``lengths``.

    Returns the marginals of words, the expected transitions summed over all places, and the log partition sum.
    """
    n, width, k = emissions.shape
    top = emissions.max(axis=2, keepdims=True)
    e, a = np.exp(emissions - top), np.exp(moves)
    inside = np.arange(width)[None, :] < lengths[:, None]
    e[~inside] = 1.0
    forward, scale = np.empty_like(e), np.ones((n, width))
    state = np.exp(starts) * e[:, 0]
    for t in range(width):
        if t:
            state = (forward[:, t - 1] @ a) * e[:, t]
        scale[:, t] = state.sum(axis=1)
        forward[:, t] = state / scale[:, t, None]
    backward = np.ones_like(e)
    steps = np.zeros((k, k))
    for t in range(width - 2, -1, -1):
        ahead = backward[:, t + 1] * e[:, t + 1] / scale[:, t + 1, None]
        on = inside[:, t + 1]
        steps += (forward[on, t].T @ ahead[on]) * a
        # Past its end a chain passes nothing back.
        backward[:, t] = np.where(on[:, None], ahead @ a.T, 1.0)
    logs = np.log(scale) + top[:, :, 0]
    return forward * backward, steps, float(logs[inside].sum())


def chains_of(ids: np.ndarray, sizes: np.ndarray, width: int = CHAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers as a padded matrix of chains (-1 after the end), chain lengths and the text of each chain."""
    n = -(-sizes // width)
    text = np.repeat(np.arange(len(sizes)), n)
    place = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    lengths = np.minimum(sizes[text] - place * width, width)
    starts = (np.cumsum(sizes) - sizes)[text] + place * width
    cells = np.arange(width)[None, :]
    where = np.where(cells < lengths[:, None], starts[:, None] + cells, 0)
    return np.where(cells < lengths[:, None], ids[where] if len(ids) else -1, -1), lengths, text


# ---------------------------------------------------------------- learning


def spliced(chains: list[tuple[list[str], int]], rng: np.random.Generator) -> list[tuple[list[str], list[int]]]:
    """Chains with a label per word; every other one gets a middle part from another chain, so that switches are seen."""
    out = []
    for words, label in chains:
        labels = [label] * len(words)
        if len(words) >= 6 and rng.random() < 0.5:
            other, its = chains[rng.integers(len(chains))]
            a, b = sorted(rng.integers(0, len(words), 2).tolist())
            part = other[: b - a]
            words, labels = words[:a] + part + words[a + len(part) :], labels[:a] + [its] * len(part) + labels[a + len(part) :]
        out.append((words, labels))
    return out


def train(samples: list[tuple[str, str]], steps: int = 40, rate: float = 0.15, decay: float = 1e-6, seed: int = 3) -> Field | None:
    """Maximum likelihood by full-batch gradients over (text, language) pairs; None without any word."""
    labels = tuple(sorted({lang for _, lang in samples}))
    rng, chains = np.random.default_rng(seed), []
    for text, lang in samples:
        words = text.split()
        parts = [words[i : i + CHAIN] for i in range(0, len(words), CHAIN)]
        for i in rng.permutation(len(parts))[:CHAINS].tolist():
            chains.append((parts[i], labels.index(lang)))
    if not chains:
        return None
    cut = spliced(chains, rng)
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in cut for w in words))}
    whole, grams, first = features(list(vocabulary))
    n_words = len(vocabulary)
    flat = np.concatenate([whole.ravel(), grams.ravel()])
    owner = np.concatenate([np.repeat(np.arange(n_words), 7), np.repeat(np.repeat(np.arange(n_words), np.diff(np.r_[first, len(grams)])), 2)])
    flat, owner = flat[flat < BUCKETS], owner[flat < BUCKETS]
    ids, lengths, _ = chains_of(np.array([vocabulary[w] for words, _ in cut for w in words]), np.array([len(w) for w, _ in cut]))
    gold, _, _ = chains_of(np.array([y for _, ys in cut for y in ys]), np.array([len(w) for w, _ in cut]))
    k, inside = len(labels), ids >= 0
    places, gold_in = ids[inside], gold[inside]
    seen = np.bincount(places * k + gold_in, minlength=n_words * k).reshape(-1, k)
    pairs = inside[:, 1:]
    gold_moves = np.bincount((gold[:, :-1] * k + gold[:, 1:])[pairs], minlength=k * k).reshape(k, k)
    gold_starts = np.bincount(gold[:, 0], minlength=k)
    total = len(places)
    size = BUCKETS * k
    theta, m, v = np.zeros(size + k * k + k), np.zeros(size + k * k + k), np.zeros(size + k * k + k)
    for step in range(1, steps + 1):
        weights, moves, starts = theta[:size].reshape(-1, k), theta[size : size + k * k].reshape(k, k), theta[size + k * k :]
        word = np.stack([np.bincount(owner, weights[flat, y], n_words) for y in range(k)], axis=1)
        p, moved, _ = marginals(np.where(inside[..., None], word[np.maximum(ids, 0)], 0.0), moves, starts, lengths)
        expected = np.stack([np.bincount(places, p[inside][:, y], n_words) for y in range(k)], axis=1)
        over = (expected - seen) / total
        g = np.concatenate([
            np.stack([np.bincount(flat, over[owner, y], BUCKETS) for y in range(k)], axis=1).ravel() + decay * theta[:size],
            ((moved - gold_moves) / total).ravel(), (p[:, 0].sum(axis=0) - gold_starts) / len(ids),
        ])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    key = zlib.crc32(repr(labels).encode(), zlib.crc32(theta.tobytes()))
    return Field(key, labels, theta[:size].reshape(-1, k).astype(np.float32), theta[size : size + k * k].reshape(k, k), theta[size + k * k :])


def some_chains(seed: int) -> Batches:
    """At most CHAINS chains of each text, drawn by the text itself, so that no whole text travels."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = text.split()
                starts = np.arange(0, len(words), CHAIN)
                drawn = np.random.default_rng([seed, zlib.crc32(text.encode("utf-8", "surrogatepass"))]).permutation(starts)[:CHAINS]
                out += [" ".join(words[at : at + CHAIN]) for at in drawn.tolist()]
                langs += [lang] * len(drawn)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.string())], ["lang", "text"])

    return work


def fit(docs: DataFrame, documents: int = DOCUMENTS, seed: int = 9) -> Field | None:
    """Learn from at most ``documents`` rows of each language outside the held-out fold (the first by a seeded hash of the id).

    Rows without language, text or id teach nothing; None if no row is left.
    """
    ours = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).where("lang is not null and text is not null")
    # One scan picks each language's ids: a row repeated, or an id with several texts, is one candidate, its least text hash.
    order = F.struct(F.xxhash64(F.lit(seed), "doc_id").alias("at"), "doc_id", F.xxhash64("text").alias("key"))
    ids = staged(ours.groupBy("lang", "doc_id").agg(F.min(order).alias("o")), "language-ids")
    # Hashes are even, so the first ``documents`` of a language lie below this cut; only what does is ranked in one task.
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    ids = ids.join(broadcast_if_small(staged(counts, "language-counts")), "lang")
    ids = ids.where(F.col("o.at").cast("double") / 2.0**64 + 0.5 < F.lit(4.0 * documents) / F.col("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("o"))
    ids = ids.withColumn("place", place).where(F.col("place") <= documents).select("lang", "doc_id", F.col("o.key").alias("key"))
    ids = staged(ids, "language-sample")
    # The second brings one row for each: of equal rows any, as their texts are equal.
    rows = ours.withColumn("key", F.xxhash64("text")).join(broadcast_if_small(ids), ["lang", "doc_id", "key"])
    rows = rows.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    chains = rows.select("lang", "text").mapInArrow(tidy(some_chains(seed)), "lang string, text string")
    return train(sorted((r["text"], r["lang"]) for r in chains.collect()))  # CHAINS * CHAIN words a document at most


# ---------------------------------------------------------------- labelling


class Labeller:
    """Scores whole texts; keeps the potentials of words met lately."""

    def __init__(self, field: Field):
        self.field = field
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.rows = np.zeros((MEMO, len(self.field.labels)), np.float32)
        self.letters = np.zeros(MEMO, bool)

    def slots(self, words: pa.Array) -> np.ndarray:
        seen = words.dictionary_encode()
        distinct = seen.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.slot) + len(distinct) > len(self.letters):
            self.clear()
        if len(distinct) > len(self.letters):
            self.rows = np.zeros((len(distinct), len(self.field.labels)), np.float32)
            self.letters = np.zeros(len(distinct), bool)
        found = np.fromiter(map(self.slot.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [distinct[i] for i in missing.tolist()]
            first = len(self.slot)
            self.rows[first : first + len(new)] = self.field.emissions(new)
            self.letters[first : first + len(new)] = [has_letter(w) for w in new]
            self.slot.update(zip(new, range(first, first + len(new))))
            found[missing] = np.arange(first, first + len(new))
        return found[seen.indices.to_numpy()]

    def shares(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Expected share of each label among the words with letters, and the number of such words."""
        words, n_words = split_words(texts)
        ids, lengths, text = chains_of(self.slots(words), n_words)
        sums, counts = np.zeros((len(texts), len(self.field.labels))), np.zeros(len(texts))
        order = np.argsort(lengths, kind="stable")
        for part in np.array_split(order, max(1, len(order) // 1024)):  # chains of like lengths together
            if not len(part):
                continue
            width = int(lengths[part].max())
            own = np.maximum(ids[part, :width], 0)
            inside = ids[part, :width] >= 0
            p, _, _ = marginals(np.where(inside[..., None], self.rows[own], 0.0), self.field.moves, self.field.starts, lengths[part])
            counted = inside & self.letters[own]
            np.add.at(sums, text[part], (p * counted[..., None]).sum(axis=1))
            np.add.at(counts, text[part], counted.sum(axis=1))
        return sums / np.maximum(counts, 1)[:, None], counts


_LATEST: list[Labeller] = []


def labeller(field: Field) -> Labeller:
    """The labeller of this field that an earlier task left in this Python worker, or a new one."""
    if not _LATEST or _LATEST[0].field.key != field.key:
        _LATEST[:] = [Labeller(field)]
    return _LATEST[0]


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, lang_pred, score): the label with the largest share of a text's words, and that share.

    ``und`` with score 0 if the text is null or has no letter, or if nothing could be learned.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if field is None else labeller(field)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                names, scores = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
                if own is not None:
                    shares, counts = own.shares(batch.column("text"))
                    best = shares.argmax(axis=1)
                    names = np.where(counts > 0, np.array(own.field.labels, object)[best], UNDETERMINED)
                    scores = np.where(counts > 0, shares.max(axis=1), 0.0)
                columns = [batch.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(np.clip(scores, 0, 1))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(tidy(work), schema)
