"""Fingerprints, quality and language: estimates against exact values, held-out accuracy, odd tables."""

import hashlib
import math
from collections import Counter
from itertools import product

import numpy as np
import pytest

from paylane.llm import fingerprints, language, quality, queries
from tests.llm.conftest import SF

SF1 = "/root/testdata/sf0.01"


def bag(text):
    words = text.split()
    return Counter(words) + Counter(zip(words, words[1:]))


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_op1(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, SF).collect()}
    assert len(rows) == len(docs)
    errors, prints = [], {}
    for i, (d, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        r = rows[d]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(r["near_edited"] - jaccard(bag(text), bag(edited)))
        errors.append(r["near_next"] - jaccard(bag(text), bag(following)))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_samples_do_not_depend_on_slices(monkeypatch):
    texts = ["a b c d e f g " * 9, "", "a b c x", "one", " ".join(str(i) for i in range(3000))]
    whole = fingerprints.fingerprints(texts)
    monkeypatch.setattr(fingerprints, "PAIRS_AT_ONCE", 7)
    assert (fingerprints.fingerprints(texts) == whole).all()
    assert (whole[1] == 0).all() and (whole[[0, 2, 3, 4]] != 0).all()
    assert fingerprints.fingerprints([]).shape == (0, fingerprints.SAMPLES)


def test_likeness_of_very_long_texts():
    """Terms are not merged, however many a text has."""
    words = lambda name, n: [f"{name}{i * 7919 % n}" for i in range(n)]
    common, a, b = words("c", 50_000), words("a", 100_000), words("b", 100_000)
    often = " ".join(common * 2)
    texts = [" ".join(a), " ".join(b), " ".join(common + a), " ".join(common + b), " ".join(common), often]
    codes = fingerprints.fingerprints(texts, samples=512)
    for x, y in ((0, 1), (2, 3), (0, 2), (1, 3), (4, 5), (0, 5)):
        got, want = (codes[x] == codes[y]).mean(), jaccard(bag(texts[x]), bag(texts[y]))
        assert abs(got - want) < 4 * np.sqrt(want * (1 - want) / 512) + 0.003, (x, y, got, want)


def test_fingerprints_of_odd_tables(odd, none, clash):
    for docs in (odd, none, clash):
        rows = docs.collect()
        got = fingerprints.document_fingerprints(docs).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in rows)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_next_documents_across_partitions(spark, docs_of):
    """Rows come in any order, and each partition's last document has its next one in another partition."""
    texts = {i: f"text number {i} " + "abc " * (i % 7) for i in range(100)}
    docs = docs_of(sorted(texts.items(), key=lambda x: (x[0] * 37) % 100)).repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fingerprints.document_fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for r in got:
        edited = fingerprints.edited(texts[r["doc_id"]], texts[(r["doc_id"] + 1) % 100])
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


# ---------------------------------------------------------------- quality


def test_op5_on_held_out_rows(spark):
    quality_of = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    rows = queries.op5_quality(spark, SF1).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(quality_of[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality_of]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_prior_and_risk_on_known_mixtures():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.8):
        good, n = rng.normal(0, 1, (1500, 3)), 3000
        mixed = np.vstack([rng.normal(0, 1, (int(n * share), 3)), rng.normal(3, 1, (n - int(n * share), 3))])
        model = quality.fit_matrices(good, mixed)
        assert abs(model.prior - share) < 0.12
        right = np.r_[model.score(rng.normal(0, 1, (500, 3))) >= 0.5, model.score(rng.normal(3, 1, (500, 3))) < 0.5]
        assert right.mean() > 0.93


def test_labels_are_not_learned_from_held_out_rows_or_bad_labels(spark, docs_of):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    a = quality.fit(docs, labels)
    b = quality.fit(docs, labels.where("crc32(cast(doc_id as string)) % 4 <> 2 and quality = 1"))
    assert (a.weights == b.weights).all()


def test_quality_of_odd_tables(odd, none, clash, spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for docs in (odd, none, clash):
        for given in (labels, labels.limit(0)):
            rows = quality.score(docs, quality.fit(docs, given))
            assert rows.select("row.*").columns == docs.columns and rows.count() == docs.count()


# ---------------------------------------------------------------- language


def test_op9_on_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF1}/documents.parquet").collect()}
    rows = queries.op9_language(spark, SF1).collect()
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(held) / len(held) > 0.97


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    e, moves, starts, lengths = rng.normal(size=(3, 4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2), np.array([4, 2, 1])
    p, steps, logs = language.marginals(e, moves, starts, lengths)
    all_steps, total = np.zeros((2, 2)), 0.0
    for c, n in enumerate(lengths):
        z, want = 0.0, np.zeros((n, 2))
        mine = np.zeros((2, 2))
        for path in product(range(2), repeat=int(n)):
            w = math.exp(starts[path[0]] + sum(e[c, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            z += w
            for t, y in enumerate(path):
                want[t, y] += w
            for a, b in zip(path, path[1:]):
                mine[a, b] += w
        assert np.allclose(p[c, :n], want / z)
        all_steps += mine / z
        total += math.log(z)
    assert np.allclose(steps, all_steps) and np.isclose(logs, total)


def test_switches_inside_a_text():
    samples = [("the cat sat on the mat with that other thing " * 4, "en"), ("der Hund und die Katze schlafen nicht immer noch " * 4, "de")] * 6
    field = language.train(samples, steps=60)
    import pyarrow as pa

    shares, counts = language.Labeller(field).shares(pa.array(["the cat sat on the mat der Hund und die Katze schlafen", "the cat", None, "12 -- 5"]))
    assert field.labels == ("de", "en") and counts.tolist() == [12, 2, 0, 0]
    assert 0.3 < shares[0, 0] < 0.7 and shares[1, 1] > 0.8


@pytest.mark.parametrize("lang", [None, "en"])
def test_language_of_odd_tables(odd, none, clash, docs_of, lang):
    for docs in (odd, none, clash, docs_of([(1, "only one language", lang)])):
        rows = language.predict(docs, language.fit(docs)).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
        empty = {r["doc_id"] for r in docs.collect() if not any(map(str.isalpha, r["text"] or ""))}
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in empty)


def test_language_sample_is_bounded_by_rows(spark, docs_of, monkeypatch):
    """An id that repeats over most rows is one candidate, of long texts three chains are taken, and the table is read twice."""
    rows = [(i, f"ein kleiner satz {i} über das haus", "de") for i in range(40)] + [(i, f"a little sentence {i} about the house", "en") for i in range(40, 80)]
    rows += [(81, f"der lange text {i % 7} " * 200, "de") for i in range(600)]
    docs = docs_of(rows)
    taken, ranked = [], []
    train = language.train
    monkeypatch.setattr(language, "train", lambda samples, **how: taken.append(samples) or train(samples, **how))
    store = language.staged
    monkeypatch.setattr(language, "staged", lambda df, name: ranked.append(store(df, name)) or ranked[-1])
    monkeypatch.setattr(language, "DOCUMENTS", 300)
    fields = [language.fit(docs.repartition(n)) for n in (1, 5)]
    assert taken[0] == taken[1] and fields[0].key == fields[1].key
    long = [text for text, lang in taken[0] if text.startswith(("der lange", "lange", "text"))]
    assert len(long) <= language.CHAINS and all(len(t.split()) <= language.CHAIN for t, _ in taken[0])
    ranked.clear()
    language.fit(docs, documents=3)
    assert ranked[-1].count() == 6 and ranked[0].count() > 50  # of each language three, out of all its ids
