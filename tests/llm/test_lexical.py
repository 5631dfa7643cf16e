"""Ranked search against scoring every document for every query."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from paylane.llm import lexical
from tests.llm.test_licenses import words

ITEMS = "item_id long, text string"


def expected(docs, items):
    terms = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    n_docs, length = sum(n > 0 for *_, n in terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in terms:
            if n:
                m = 25 + (75 * n * n_docs) // length
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in words(text))
                if s > 0:
                    scores.append((-s, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def search(spark, docs_of, tmp_path):
    def run(docs, items, index=None):
        frame = docs_of(docs) if isinstance(docs, list) else docs
        found = lexical.search(frame, docs_of(items, ITEMS), index or f"{tmp_path}/index-{random.random()}")
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return run


def corpus(n, rng, vocabulary=400):
    names = [f"t{i}" for i in range(vocabulary)]
    text = lambda k: " ".join(names[min(int(rng.expovariate(0.02)), vocabulary - 1)] for _ in range(k))
    return [(i, text(rng.choice([1, 5, 20, 60, 300]))) for i in range(n)], text


def test_against_scores_of_all(search):
    rng = random.Random(8)
    docs, text = corpus(700, rng)
    docs += [(2000 + i, "t3 t9 t9 t77 copy") for i in range(60)] + [(3000, "t5 " * 40_000 + "t399")]
    rng.shuffle(docs)
    items = [(i, text(rng.choice([1, 3, 12, 40]))) for i in range(25)] + [(50, "copy t9 t9"), (51, "nothing here"), (52, "T5, t399!")]
    assert search(docs, items) == expected(docs, items)


def test_lots_of_queries(search, monkeypatch):
    rng = random.Random(9)
    docs, text = corpus(200, rng)
    items = [(i, text(6)) for i in range(30)]
    monkeypatch.setattr(lexical, "LOT", 8)
    assert search(docs, items) == expected(docs, items)


def test_odd_tables(search, odd, none, clash):
    items = [(1, "one Two twelve"), (2, None), (3, ""), (None, "id word"), (4, "word word É"), (4, "word word É"), (5, "some other plain words here"), (6, "ünïcode 你好")]
    for docs in (odd, none, clash):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert search(docs, items) == expected(rows, items)
        assert search(docs, []) == []


def test_bounds_never_fall_below_scores_and_exclude(spark, docs_of, tmp_path):
    """Also in signatures that are far too full."""
    rng = random.Random(11)
    docs, text = corpus(400, rng)
    for bits, least in ((lexical.BITS, 0.5), (1, 0.0)):
        keep, lexical.BITS = lexical.BITS, bits
        try:
            blocks = [b.to_pylist() for b in lexical.signatures(iter([pa.record_batch([pa.array([d for d, _ in docs]), pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["doc_id", "key", "text"])]))]
        finally:
            lexical.BITS = keep
        blocks = [b for bs in blocks for b in bs]
        assert sum(len(b["doc_ids"]) for b in blocks) == len(docs)
        q = lexical.Queries.of_rows([(i, text(10)) for i in range(20)])
        counts = {d: Counter(words(t)) for d, t in docs}
        q.documents, q.length = len(docs), sum(sum(c.values()) for c in counts.values())
        q.weights = np.array([rng.randint(1, 6000) for _ in q.terms])
        excluded = 0
        exact = {d: lexical.counted(*lexical.word_hashes(pa.array([t])))[1:] for d, t in docs}
        for b in blocks:
            bounds = lexical.bounds_of(q, b)
            damp = q.damping(np.array(b["lengths"]))
            for at, d in enumerate(b["doc_ids"]):
                tf = np.zeros(len(q.terms), np.int64)
                place = q.places(exact[d][0])
                tf[place[place >= 0]] = exact[d][1][place >= 0]
                for query in range(20):
                    score = q.score(query, tf, damp[at])
                    assert bounds[query, at] >= score
                    excluded += bounds[query, at] == 0
        assert excluded >= least * 0.3 * 20 * len(docs)
