"""License texts in documents by diagonal voting.

Every document gives the hashes of its rolling word pairs, which Spark joins to the places of pairs in license templates. A
shared pair votes for a diagonal, its place in the document less its place in the template: where the template would begin.
Words put in or left out shift what follows to a neighbouring diagonal, so neighbours are merged as far as the template's
slack reaches. What gets the votes that a match cannot do without is verified word by word: a template of ``slack`` s is found
where s edits of words turn it into the passage. No match is lost before that, as an edit breaks two pairs at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylane.llm.common import broadcast_within, slices, tidy
from paylane.llm.decontamination import text_key
from paylane.llm.wordhash import mixed, text_slices, word_hashes, word_starts
from paylane.session import prepare, staged

EDITS = 0.2  # share of a template's words that may differ
AT_ONCE = 4096
LANE = 32  # places of a template whose votes one number holds


@dataclass(frozen=True)
class Template:
    """A license text with its label. ``exact`` ones allow no edit; ``base`` marks those that are counted as phrases."""

    label: str
    text: str
    exact: bool = False
    base: bool = False


# The phrases that count as base places, and their labels.
PHRASES = (
    Template("mit", "mit license", exact=True, base=True),
    Template("apache", "apache license", exact=True, base=True),
    Template("gpl", "general public license", exact=True, base=True),
)
# Names and standard notices of public licenses.
NOTICES = (
    Template("agpl", "affero general public license", exact=True),
    Template("lgpl", "lesser general public license", exact=True),
    Template("mpl", "mozilla public license", exact=True),
    Template("bsd", "bsd license", exact=True),
    Template("isc", "isc license", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
    Template("cc-by-sa", "cc by sa", exact=True),
    Template("cc-by", "cc by 4 0", exact=True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("apache", "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
)
TEMPLATES = (*PHRASES, *NOTICES)


def words_between(low: np.ndarray, starts: np.ndarray, first: int, to: int) -> list[bytes]:
    """Words ``first`` to ``to`` of those that begin at ``starts``."""
    if to <= first:
        return []
    end = starts[to] if to < len(starts) else len(low)
    raw = low[starts[first] : end].tobytes()
    begin = starts[first:to] - starts[first]
    bounds = [*begin.tolist(), len(raw)]
    return [raw[a:b].rstrip(b"\0") for a, b in zip(bounds, bounds[1:])]


class Matcher:
    """A template's words and how many of them may differ."""

    def __init__(self, template: Template):
        low, starts, _ = word_starts(pa.array([template.text]))
        self.template, self.words = template, words_between(low, starts, 0, len(starts))
        if len(self.words) < 2:
            raise ValueError(f"a template needs two words: {template.text!r}")
        self.slack = 0 if template.exact else int(EDITS * len(self.words))
        self.need = max(1, len(self.words) - 1 - 2 * self.slack)

    def distances(self, words: list[bytes], anchored: bool = False) -> np.ndarray:
        """For each n, the least edits that turn the template into words that end at n and begin anywhere (``anchored``: at 0)."""
        here = self.words
        rank = np.arange(len(here) + 1)
        column, out = rank, np.empty(len(words) + 1, np.int64)
        out[0] = len(here)
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(here))}
        own = np.array([vocabulary[w] for w in here])
        for n, word in enumerate(words, 1):
            step = np.empty_like(column)
            step[0] = n if anchored else 0
            step[1:] = np.minimum(column[:-1] + (own != vocabulary.get(word, -1)), column[1:] + 1)
            column = np.minimum.accumulate(step - rank) + rank
            out[n] = column[-1]
        return out

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(start, end, likeness) of passages that match, best first, none over another."""
        size = len(self.words)
        if self.slack == 0:
            return [(s, s + size, 1.0) for s in range(len(words) - size + 1) if words[s : s + size] == self.words]
        found, taken = [], np.zeros(len(words), bool)
        ends = self.distances(words)
        backwards = Matcher.__new__(Matcher)
        backwards.words = self.words[::-1]
        for end in sorted(np.flatnonzero(ends <= self.slack).tolist(), key=lambda n: (ends[n], n)):
            head = max(0, end - size - self.slack)
            lengths = backwards.distances(words[head:end][::-1], anchored=True)
            edits, _, length = min((d, abs(n - size), n) for n, d in enumerate(lengths.tolist()))
            if not taken[end - length : end].any():
                taken[end - length : end] = True
                found.append((end - length, end, 1.0 - edits / size))
        return found


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of each word with the one after it."""
    return mixed(hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:]).view(np.int64)


def template_places(spark: SparkSession, matchers: list[Matcher]) -> DataFrame:
    """(gram, template, at): where the word pairs of the templates stand."""
    rows = []
    for number, m in enumerate(matchers):
        hashes, _ = word_hashes(pa.array([m.template.text]))
        rows += [(int(g), number, at) for at, g in enumerate(pair_hashes(hashes))]
    places = spark.createDataFrame(rows, "gram long, template int, at int")
    return F.broadcast(places) if len(rows) <= 1_000_000 else places


def rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All word pairs of each text, in runs of at most AT_ONCE, with the place of the first."""
    for whole in batches:
        for batch in text_slices(whole, "text"):
            hashes, counts = word_hashes(batch.column("text"))
            grams = pair_hashes(hashes) if len(hashes) else np.empty(0, np.int64)
            last = np.cumsum(counts)
            runs = [(row, at, min(at + AT_ONCE, n - 1)) for row, n in enumerate(counts.tolist()) for at in range(0, n - 1, AT_ONCE)]
            if not runs:
                continue
            rows, first, to = (np.array(x, np.int64) for x in zip(*runs))
            base = (last - counts)[rows]
            take = np.repeat(base + first, to - first) + np.arange((to - first).sum()) - np.repeat(np.cumsum(to - first) - (to - first), to - first)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(to - first)], pa.int32()), pa.array(grams[take]))
            keys = [batch.column(c).take(pa.array(rows)) for c in ("k1", "k2")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(first), lists], ["k1", "k2", "first", "grams"])


def votes(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(k1, k2, template, diagonal, lane, bits): the template's places that vote for a diagonal of a text, 32 a lane.

    Copies of a text vote for the same bits, which are set once however many copies there are.
    """
    texts = docs.select(*text_key(F.col("text")), "text")
    runs = texts.mapInArrow(tidy(rolling), "k1 long, k2 int, first long, grams array<long>")
    pairs = runs.select("k1", "k2", "first", F.posexplode("grams").alias("n", "gram"))
    hits = pairs.join(places, "gram").select("k1", "k2", "template", (F.col("first") + F.col("n") - F.col("at")).alias("diagonal"), "at")
    lane = F.floor(F.col("at") / LANE).cast("int").alias("lane")
    bit = F.expr(f"shiftleft(1L, at % {LANE})").alias("bit")
    return hits.select("k1", "k2", "template", "diagonal", lane, bit).groupBy("k1", "k2", "template", "diagonal", "lane").agg(F.bit_or("bit").alias("bits"))


def candidates(docs: DataFrame, matchers: list[Matcher]) -> DataFrame:
    """(k1, k2, regions): per text, the templates and ranges of diagonals that got the votes a match needs.

    Diagonals of a template are merged while the next is within its slack; votes of the merged ones add up.
    """
    spark = docs.sparkSession
    facts = spark.createDataFrame([(n, m.slack, m.need) for n, m in enumerate(matchers)], "template int, slack int, need int")
    of_template = Window.partitionBy("k1", "k2", "template").orderBy("diagonal", "lane")
    cast = votes(docs, template_places(spark, matchers)).join(F.broadcast(facts), "template")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(of_template) > F.col("slack"), F.lit(True))
    merged = cast.withColumn("opens", opens.cast("int")).withColumn("chain", F.sum("opens").over(of_template))
    chains = merged.groupBy("k1", "k2", "template", "chain").agg(
        F.sum(F.bit_count("bits")).alias("votes"), F.first("need").alias("need"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high")
    )
    regions = F.array_sort(F.collect_list(F.struct("template", "low", "high"))).alias("regions")
    return chains.where("votes >= need").groupBy("k1", "k2").agg(regions)


SPAN = "struct<label: string, base: boolean, start: long, end: long, likeness: double>"


def verifier(templates: tuple[Template, ...]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(t) for t in templates]
        kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("likeness", pa.float64())]))
        for whole in batches:
            for part in slices(whole):
                for batch in text_slices(part, "text"):
                    low, starts, counts = word_starts(batch.column("text"))
                    last, out = np.cumsum(counts), []
                    for n, end, regions in zip(counts.tolist(), last.tolist(), batch.column("regions").to_pylist()):
                        out.append(sorted(spans_of(matchers, low, starts, end - n, end, regions or [])))
                    spans = [[{"label": s[2], "base": s[3], "start": s[0], "end": s[1], "likeness": s[4]} for s in row] for row in out]
                    columns = [batch.column(c) for c in batch.schema.names if c not in ("text", "regions")]
                    names = [c for c in batch.schema.names if c not in ("text", "regions")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), pa.array(spans, kind)], [*names, "n_words", "spans"])

    return work


def spans_of(matchers: list[Matcher], low: np.ndarray, starts: np.ndarray, first: int, end: int, regions: list[dict]) -> set[tuple]:
    """(start, end, label, base, likeness) of the passages inside the regions of one text, whose words are ``first`` to ``end``."""
    found = set()
    for r in regions:
        m = matchers[r["template"]]
        a = first + max(0, r["low"] - m.slack)
        b = min(end, first + r["high"] + len(m.words) + m.slack)
        for start, to, likeness in m.passages(words_between(low, starts, a, b)):
            found.add((a - first + start, a - first + to, m.template.label, m.template.base, likeness))
    return found


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row's columns ``keep``, ``n_words``, and ``spans``: label, whether a base phrase, first word, end, likeness.

    A null or empty text has no words and no spans. Equal texts are matched once, verified per row. Texts are read twice, and
    only the few regions with enough votes are stored or joined: by broadcast if they are measured to be small, else by
    shuffle.
    """
    prepare(docs.sparkSession)
    matchers = [Matcher(t) for t in templates]
    regions = staged(candidates(docs, matchers), "license-regions")
    regions = broadcast_within(regions, F.lit(48) + 24 * F.size("regions"))
    rows = docs.select(*keep, "text", *text_key(F.col("text"))).join(regions, ["k1", "k2"], "left").drop("k1", "k2")
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(tidy(verifier(templates)), f"{kept}, n_words long, spans array<{SPAN}>")


def summary(found: DataFrame) -> DataFrame:
    """Counts and labels from ``scan``: base places, the first and last of them, labels of base and of all spans, best likeness."""
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["likeness"])), F.lit(0.0)).alias("score"),
    )
