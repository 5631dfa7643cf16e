"""Benchmark windows against a plain search."""

import re

import pytest

from paylane.llm.decontamination import with_contamination
from tests.llm.conftest import SF


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(texts, items):
    windows = {}
    for item, text in items:
        ws = words(text)
        for s in range(max(1, len(ws) - 9) if ws else 0):
            windows.setdefault(tuple(ws[s : s + 10]), set()).add(item)
    out = []
    for d, text in texts:
        ws, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(ws) - n + 1):
                if owners := windows.get(tuple(ws[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= owners
        out.append((d, len(ws), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def got(docs, bench):
    rows = with_contamination(docs, bench).select("row.doc_id", "n_words", "n_hit", "items").collect()
    return sorted(((r[0], r[1], r[2], list(r[3])) for r in rows), key=repr)


@pytest.fixture
def bench_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def test_places_and_lengths(docs_of, bench_of):
    ten = " ".join(ITEM.split()[:10])
    texts = [
        (1, f"before {ITEM} after"), (2, f"{ten.upper()}! and {ten}"), (3, " ".join(ITEM.split()[:9])), (4, ITEM.replace("eta", "eto")),
        (5, f"x {ITEM} y {ITEM}"), (6, "one two"), (7, "one Two three one two"), (8, "solo"), (9, "ÉTÉ été"), (10, f"{ITEM} " * 300),
        (11, "-- ?!"), (12, " ".join(ITEM.split()[3:])),
    ]
    items = [(1, ITEM), (2, "one two"), (3, "Solo."), (4, None), (5, " .,; "), (6, ITEM), (None, "été"), (7, "alpha beta"), (3, "Solo.")]
    assert got(docs_of(texts), bench_of(items)) == expected(texts, items)


def test_odd_tables(odd, none, clash, bench_of):
    items = [(1, "two three four five six seven eight nine ten eleven"), (2, "word " * 12), (3, "some plain")]
    for docs in (odd, none, clash):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert got(docs, bench_of(items)) == expected(rows, items)
        assert got(docs, bench_of([])) == expected(rows, [])
        assert with_contamination(docs, bench_of(items)).select("row.*").columns == docs.columns


def test_given_documents(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    result = got(docs, bench)
    assert result == expected([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert any(r[2] for r in result)
    plan = with_contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_words_are_counted_without_being_listed(docs_of, bench_of):
    texts = [None, "", " ", "x", "  x", "x  ", ".,;", "\n\ta b\x00c\x7f", "É_é ß,ÿ", "𝄞𝄞 \U0010ffff-a1", "x x x", "a" * 5000 + " ?" * 5000, " " * 200_000, "-a-" * 3]
    docs = docs_of(list(enumerate(texts)))
    found = with_contamination(docs, bench_of([(1, "one two")])).select("row.doc_id", "n_words")
    assert dict(map(tuple, found.collect())) == {n: len(words(t)) for n, t in enumerate(texts)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_count" not in plan and "regexp_extract_all" not in plan
