"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled good; unlabelled are web documents of the training folds, good and bad, labels
unseen. A linear model on text statistics minimises the non-negative unbiased risk
``prior * R_pos(+1) + max(0, R_unl(-1) - prior * R_pos(-1))``, so that the part of the unlabelled risk that good documents
must account for is taken off and never goes below zero. The class prior is estimated from the data first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylane.llm.common import held_out, slices, texts_of, tidy

# Bounds of the training sample; ids are taken in the order of a seeded hash.
POSITIVES, UNLABELLED = 4000, 8000
THRESHOLD = 0.7

SENTENCE_END = re.compile(r"[.!?](?:\s|$)")
RUN = re.compile(r"([^\w\s])\1")
NAMES = (
    "letters", "upper", "digits", "spaces", "marks", "mark_runs", "sentence_ends", "newlines", "words", "word_length",
    "distinct_words", "repeated_words", "capital_words", "all_capital_words", "marked_words", "lone_marks",
)


def statistics(text: str) -> list[float]:
    """Shares and logarithms that describe a text; none depends on the words themselves."""
    if not text:
        return [0.0] * len(NAMES)
    raw = text.encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = text.split()
    w = max(1, len(words))
    upper, lower, high = int(seen[65:91].sum()), int(seen[97:123].sum()), int(seen[128:].sum())
    digits, white = int(seen[48:58].sum()), int(seen[9:14].sum() + seen[32])
    marks = n - upper - lower - high - digits - white
    capitals = sum(x[0].isupper() for x in words)
    shouted = sum(map(str.isupper, words))
    plain = sum(map(str.isalpha, words))
    alone = sum(not x[0].isalnum() and len(x) == 1 for x in words)
    repeated = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
    root = lambda x, of: (x / of) ** 0.5  # noqa: E731 - spreads small shares
    return [
        (upper + lower + high) / n, root(upper, n), root(digits, n), white / n, root(marks, n), root(len(RUN.findall(text)), w),
        root(len(SENTENCE_END.findall(text)), w), root(int(seen[10]), w), np.log1p(len(words)), np.log1p(n / w),
        len(set(words)) / w ** 0.8, root(repeated, w), root(capitals, w), root(shouted, w), 1 - plain / w, root(alone, w),
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(NAMES))


@dataclass(frozen=True)
class Model:
    """A score is the logistic of a margin that is linear in centred statistics and their distances from the centre."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.hstack([z, np.abs(z), np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.inputs(x) @ self.weights)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def minimise(gradient, size: int, steps: int, rate: float = 0.1) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimated_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled: a logistic model tells given positives from unlabelled rows; the share is
    the largest that fits under the unlabelled scores, level by level, where positives are dense."""

    def gradient(w):
        return p.T @ (sigmoid(p @ w) - 1) / len(p) + u.T @ sigmoid(u @ w) / len(u) + 1e-3 * w

    w = minimise(gradient, p.shape[1], 200)
    sp, su = np.sort(p @ w), np.sort(u @ w)
    levels = np.quantile(sp, np.linspace(0.02, 0.5, 25))
    above_p = 1 - np.searchsorted(sp, levels) / len(sp)
    above_u = 1 - np.searchsorted(su, levels) / len(su)
    return float(np.clip(np.median(above_u / above_p), 0.05, 0.95))


def fit_matrices(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600, decay: float | None = None) -> Model:
    decay = 0.5 / len(positive) if decay is None else decay  # few examples hold the weights down
    centre, scale = np.median(positive, axis=0), positive.std(axis=0) + 1e-3
    blank = Model(centre, scale, np.zeros(2 * positive.shape[1] + 1), 0.5)
    p, u = blank.inputs(positive), blank.inputs(unlabelled)
    prior = estimated_prior(p, u)

    def gradient(w):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        # Sigmoid loss: a row counts sigmoid(-margin) as positive, sigmoid(margin) as negative.
        slope_p = p.T @ (sp * (1 - sp)) / len(p)
        slope_u = u.T @ (su * (1 - su)) / len(u)
        negative = su.mean() - prior * sp.mean()
        if negative < 0:  # the unlabelled risk is over-fitted: step back along it alone
            return prior * slope_p - slope_u + decay * w
        return -prior * slope_p + slope_u - prior * slope_p + decay * w

    return Model(centre, scale, minimise(gradient, p.shape[1], steps), prior)


def training_rows(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int, seed: int) -> DataFrame:
    """(good, some, x) for a bounded sample of the training folds: labelled good, and any document, its label unseen."""
    order = F.xxhash64(F.lit(seed), "doc_id")
    ours = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text")
    good = labels.where("quality = 1").select("doc_id").where(~held_out(F.col("doc_id"))).distinct()
    good = good.orderBy(order, "doc_id").limit(positives)
    some = ours.select("doc_id").distinct().orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").limit(unlabelled)
    chosen = good.withColumn("good", F.lit(1)).join(some.withColumn("some", F.lit(1)), "doc_id", "full")
    # The sample's statistics are taken where the rows are; only numbers reach the driver.
    rows = ours.join(F.broadcast(chosen), "doc_id")
    return statistics_of(rows, ["good", "some"])


def statistics_of(rows: DataFrame, columns: list[str]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                x = matrix(texts_of(batch.column("text")))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), lists], [*columns, "x"])

    given = rows.select(*columns, "text")
    schema = T.StructType([*(given.schema[c] for c in columns), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return given.mapInArrow(tidy(work), schema)


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, seed: int = 5) -> Model | None:
    """Train on at most ``positives`` good and ``unlabelled`` other rows outside the held-out fold; None without either kind.

    ``quality`` is read for good labels only; bad labels are never used. Rows of null id teach nothing.
    """
    got = training_rows(docs, labels, positives, unlabelled, seed).collect()
    rows = sorted((r["good"] is not None, r["some"] is not None, r["x"]) for r in got)
    p, u = [x for g, _, x in rows if g], [x for _, s, x in rows if s]
    return fit_matrices(np.array(p), np.array(u)) if p and u else None


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(row, score, predicted): each row of ``docs`` as a struct, the chance that it is good, and 1 from ``threshold`` up.

    A null text is scored as an empty one. Without a model (nothing to learn from) every score is 1.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = texts_of(batch.column("row").field(at))
                scores = np.ones(len(texts)) if model is None else model.score(matrix(texts))
                flags = (scores >= threshold).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores), pa.array(flags)], ["row", "score", "predicted"])

    rows, at = docs.select(F.struct("*").alias("row")), docs.columns.index("text")
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(tidy(work), schema)
