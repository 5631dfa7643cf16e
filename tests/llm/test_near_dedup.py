"""Near duplicates against all pairs, components against plain search."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from paylane.llm import near_dedup as near
from paylane.llm.components import components
from tests.llm.conftest import SF


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    w = min(width, len(words))
    return frozenset(tuple(words[i : i + w]) for i in range(len(words) - w + 1))


def groups(rows, width, percent=80):
    """Least id of everything linked, by comparing all pairs."""
    sets = [(d, shingles(t, width)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: near.LAST)
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least[find(i)], near.LAST if d is None else d)
    return sorted((near.LAST if d is None else d, len(s), None if least[find(i)] == near.LAST else least[find(i)]) for i, (d, s) in enumerate(sets))


def got(docs, **how):
    return sorted((r["ord"], r["n_shingles"], r["component_id"]) for r in near.near_groups(docs, **how).collect())


@pytest.mark.parametrize("width", [2, 5])
def test_groups_equal_all_pairs(spark, width):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(docs, width=width) == groups([(r["doc_id"], r["text"]) for r in docs.collect()], width)


def test_odd_tables(odd, none, clash):
    for docs in (odd, none, clash):
        assert got(docs, width=2) == groups([(r["doc_id"], r["text"]) for r in docs.collect()], 2)
        kept = near.keep_one(docs, width=2)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert len(rows) == len({repr(tuple(r)) for r in rows})
    assert sum(r["text"] is not None and r["text"].startswith("one two") for r in near.keep_one(odd, width=2).collect()) == 1


def variants(n, words=60, seed=1, edits=2):
    """Copies of one text that each replace some words of their own."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for i in rng.sample(range(words), edits):
            own[i] = f"v{k}x{i}"
        out.append((k, " ".join(own)))
    return out


def test_large_families_and_blocks(docs_of, monkeypatch):
    """Families of several blocks, of which one holds copies that are linked through their base alone."""
    monkeypatch.setattr(near, "SMALL", 20)
    monkeypatch.setattr(near, "BLOCK", 40)
    monkeypatch.setattr(near, "HUBS", 2)
    rows = variants(150)
    other = [(1000 + k, t.replace("w", "z")) for k, t in variants(60, seed=2)]
    star = [(2000 + k, t.replace("w", "y")) for k, t in variants(90, seed=3, edits=3)]
    star.append((2500, " ".join(f"y{i}" for i in range(60))))
    want = groups([*rows, *other, *star], 2)
    assert len({c for _, _, c in want}) < 20
    assert got(docs_of([*rows, *other, *star]), width=2) == want


def test_links_on_full_sets():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(40)]
    sets += [np.arange(80, dtype=np.uint64), np.arange(100, dtype=np.uint64), np.zeros(0, np.uint64)]
    got_links = near.linked_sets(sets, 80)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(set(a.tolist()) & set(b.tolist()))
            if i != j:
                assert got_links[i, j] == (both > 0 and 100 * both >= 80 * (len(a) + len(b) - both))
    assert near.linked_sets(sets[-3:-1], 80)[0, 1]


def test_roots():
    rng = np.random.default_rng(1)
    m = rng.random((60, 60)) < 0.02
    m |= m.T
    root = near.roots_of(m)
    assert all(root[i] == root[j] for i, j in zip(*np.nonzero(m))) and (root[root] == root).all() and (root <= np.arange(60)).all()


def test_minwise_values_estimate_similarity():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(200, 1200, dtype=np.uint64)
    sets = [near.mixed(a + np.uint64(1)), near.mixed(b + np.uint64(1))]
    m = near.minwise(sets, 1)
    assert abs((m[0] == m[1]).mean() - 800 / 1200) < 0.15
    same = near.equal_bits(near.sketches(m)[:1], near.sketches(m)[1:])[0, 0]
    assert abs(same / near.COORDINATES - (1 + 800 / 1200) / 2) < 0.15


def test_lower_cases_ascii_only():
    a, b, c = near.shingle_sets(pa.array(["ÄB cd", "Äb CD", "äb cd"]), 2)
    assert a.tolist() == b.tolist() != c.tolist()


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: find(x) for x in {y for a, b in links if a != b for y in (a, b)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
