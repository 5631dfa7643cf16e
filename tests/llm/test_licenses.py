"""License passages against a plain search of every text for every template."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from paylane.llm import licenses, queries, wordhash
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def least_edits(template, text):
    """Edits of words between the template and the passage of the text that is nearest to it."""
    row = [0] * (len(text) + 1)
    for i, t in enumerate(template, 1):
        new = [i]
        for j, w in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (t != w)))
        row = new
    return min(row)


def expected(rows):
    out = []
    templates = [(t, words(t.text)) for t in licenses.TEMPLATES]
    for doc_id, text in rows:
        ws, base, labels, best = words(text), [], set(), 0.0
        for t, tw in templates:
            if t.exact:
                at = [i for i in range(len(ws) - len(tw) + 1) if ws[i : i + len(tw)] == tw]
                base += [(i, t.label) for i in at] if t.base else []
                likeness = float(bool(at))
            else:
                edits = least_edits(tw, ws) if set(tw) & set(ws) else len(tw)
                likeness = 1 - edits / len(tw) if edits <= int(licenses.EDITS * len(tw)) else 0.0
            if likeness:
                labels.add(t.label)
                best = max(best, likeness)
        at = [i for i, _ in base]
        out.append((doc_id, len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(best, 9)))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return sorted(((*tuple(r)[:-1], round(r[-1], 9)) for r in df.collect()), key=repr)


def scanned(docs):
    return got(licenses.summary(licenses.scan(docs)))


def test_query_against_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    result = got(queries.op12_licenses(spark, SF))
    assert result == expected(rows)
    assert any(r[5] for r in result) and any(not r[6] for r in result)


def test_places_of_phrases_and_edited_notices(docs_of):
    rng, notices = random.Random(2), [t.text for t in licenses.NOTICES if not t.exact]
    rows = [
        (1, "MIT License, mit-license; MIT\nLICENSE mit licenses"), (2, "the general general public license general public license v3"),
        (3, "Apache License Apache license mit  license"), (4, "a lesser general public license, É general public licensé"), (5, "CC BY-NC 4.0. cc by 4.0"),
        (6, "mit " * 50 + "license"), (7, "under the terms of the " * 400), (8, "apache"), (9, "license mit"),
    ]
    for n in range(60):
        ws = words(rng.choice(notices))
        for _ in range(rng.randint(0, int(0.3 * len(ws)))):
            at = rng.randrange(len(ws))
            ws[at : at + 1] = rng.choice([[], ["odd"], [ws[at], "more"], ["new", "words"]])
        filler = [rng.choice(["of", "the", "in", "to", "any", "license", "word", "this"]) for _ in range(rng.randint(0, 300))]
        at = rng.randint(0, len(filler))
        rows.append((100 + n, " ".join(filler[:at] + ws + filler[at:])))
    assert scanned(docs_of(rows)) == expected(rows)


def test_odd_tables(odd, none, clash):
    for docs in (odd, none, clash):
        assert scanned(docs) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_many_copies_and_a_common_line(docs_of):
    rows = [(i, "Released under the MIT License.") for i in range(3000)] + [(9000 + i, f"text {i} of the Apache License") for i in range(50)]
    assert scanned(docs_of(rows)) == expected(rows)


def test_templates_are_a_parameter(docs_of):
    mine = (licenses.Template("own", " ".join(f"w{i}" for i in range(200))), licenses.Template("two", "do this", exact=True))
    text = " ".join(f"w{i}" for i in range(200) if i % 9 != 4)
    found = licenses.scan(docs_of([(1, "x y " + text + " z"), (2, "Do this! do that")]), mine).orderBy("doc_id").collect()
    assert [(s.label, s.start, s.end) for s in found[0].spans] == [("own", 2, 2 + len(words(text)))]
    assert [(s.label, s.base, s.start, s.end, s.likeness) for s in found[1].spans] == [("two", False, 0, 2, 1.0)]
    with pytest.raises(ValueError):
        licenses.Matcher(licenses.Template("short", "one"))


def test_hashed_words_are_the_words():
    rng = random.Random(4)
    texts = [None, "", "A", "a", " b É", "x" * 3_000_000, "end", "end of", "\x00nul\x00byte", "日本 語", "Z9 z9-Z9"]
    texts += ["".join(rng.choice("ab Zé9.\n") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    column = pa.array(texts).slice(1)
    hashes, counts = wordhash.word_hashes(column)
    plain = [words(t) for t in texts[1:]]
    assert counts.tolist() == [len(w) for w in plain]
    flat, names = [w for ws in plain for w in ws], {}
    assert all(names.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist())) and len(set(names.values())) == len(names)
    assert sum(s.num_rows for s in wordhash.text_slices(pa.record_batch([column], ["text"]), "text", 50)) == len(column)
    assert np.array_equal(wordhash.word_hashes(column.slice(3, 5))[1], counts[3:8])
