"""Repeated lines against all pairs of lines."""


import pytest

from paylane.llm.line_dedup import LAST, MIN_CHARS, dedup_lines
from tests.llm.conftest import SF


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :] or a[p + 1 :] == b[p:]


def expected(rows, least=MIN_CHARS):
    lines = []
    for d, text in {(d, t) for d, t in rows if t is not None}:
        for no, line in enumerate(text.split("\n")):
            if len(line.strip(" ")) >= least:
                lines.append(((LAST if d is None else d, no), d, text, line.strip(" ")))
    out = []
    for d, text in rows:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        keep, all_lines = [], text.split("\n")
        for no, line in enumerate(all_lines):
            here, t = (LAST if d is None else d, no), line.strip(" ")
            gone = len(t) >= least and any(o < here and within_one(x, t) for o, _, _, x in lines)
            keep += [] if gone else [line]
        out.append((d, "\n".join(keep), len(all_lines), len(all_lines) - len(keep)))
    return sorted(out, key=repr)


def got(docs, **how):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in dedup_lines(docs, **how).collect()), key=repr)


BASE = "the quick brown fox jumps over the lazy dog and runs away"


def test_one_edit_at_every_place(docs_of):
    rows = [(0, BASE + "\nsome other line that stays as it is")]
    n = 0
    for i in range(len(BASE) + 1):
        for changed in (BASE[:i] + "Q" + BASE[i:], BASE[:i] + BASE[i + 1 :], BASE[:i] + "Q" + BASE[i + 1 :]):
            n += 1
            rows.append((n, changed))
    rows += [(900, BASE[:5] + "XY" + BASE[5:]), (901, BASE.replace("quick", "quirky")), (902, "  " + BASE + " ")]
    assert got(docs_of(rows)) == expected(rows)


@pytest.mark.parametrize("n", [20, 21, 31, 32, 33, 63, 64, 65, 97])
def test_block_bounds(docs_of, n):
    text = "".join(chr(97 + (i * 7 + i * i) % 26) for i in range(n))
    rows = [(0, text)] + [(1 + i, text[:i] + "é" + text[i:]) for i in range(0, n + 1, 5)]
    rows += [(200 + i, text[:i] + text[i + 1 :]) for i in range(0, n, 5)] + [(400 + i, text[:i] + "ß" + text[i + 1 :]) for i in range(0, n, 5)]
    assert got(docs_of(rows)) == expected(rows)


def test_odd_tables(odd, none, clash):
    for docs in (odd, none, clash):
        assert got(docs) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
        assert dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]


def test_hot_line_and_chain(docs_of):
    """Every link of a chain has an earlier partner; a line repeated in all documents stays in the first only."""
    chain = ["a" * 20 + "b" * k + "a" * (20 - k) for k in range(20)]
    rows = [(k, f"{BASE}\n{line}") for k, line in enumerate(chain)]
    assert got(docs_of(rows)) == expected(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(docs) == expected(rows)


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_lines(docs_of):
    """Repeats and one-edit variants of lines of every length go; lines without a character stay."""
    short = ["Les.", "And ornd.", "Of, edti oner.", "x", "yz", "abc", "nineteen characters"]
    rows = [(0, "\n".join(short)), (1, "\n".join(["", *short, " "])), (2, "Les\nAnd ormd.\n  x \nq\nLess.\nLos\nall its own")]
    rows += [(10 + n, "abcdefghijklmnopqrstuvw"[:n] + "\n" + "ABCDEFGHIJKLMNOPQRSTUVW"[:n]) for n in range(2, 24, 2)]
    found = got(docs_of(rows))
    assert found == expected(rows, least=1)
    assert found[1][1] != rows[1][1] and "Les." not in found[1][1]


def test_hot_short_line(docs_of):
    rows = [(k, f"}}\n{BASE[:15]}{k * 7919}") for k in range(50)]
    found = {d: text for d, text, _, _ in got(docs_of(rows))}
    assert found[0].startswith("}") and not any(found[k].startswith("}") for k in range(1, 50))
