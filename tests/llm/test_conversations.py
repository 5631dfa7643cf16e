"""Repair of conversations against a plain search over edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
import xxhash

from paylane.llm import conversations, queries
from tests.llm.conftest import SF

CONV = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\f\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """Least (cost, audit, repaired lines) by plain recursion over rows and the last initial kept."""

    @lru_cache(None)
    def go(i, last, inserted):
        out = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 2:
            for role in ("user", "assistant"):
                if to := STEP.get((last, role[0])):
                    out += [(3 + c, "I" + a, (role + ":", *t)) for c, a, t in go(i, to, inserted + 1)]
        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            out += [(4 + c, "D" + a, t) for c, a, t in go(i + 1, last, 0)]
            if not must_go:
                late = 3 if truncated else 0
                for new, price, edit in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if to := STEP.get((last, new[:1])):
                        out += [(price + late + c, edit + a, (f"{new}:{text}", *t)) for c, a, t in go(i + 1, to, 0)]
        return [min(out)] if out else []

    for i in range(len(rows), 0, -50):  # bounded depth
        for last in ("", "s", "u", "a"):
            go(i, last, 0)
    return go(0, "", 0)[0]


def spark_hash(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def expected(table, damage=True):
    out, convs = [], {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fault == 4:
            role = "user"
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, spark_hash(r[1], "\n", r[2])))
        turns = {t for t, _, _ in rows if t is not None}
        marked, seen, count = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            end = text.rstrip(BLANKS)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") or not a for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(tuple(marked))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), illegal, cost, audit, sha))
    return sorted(out, key=repr)


@pytest.fixture
def conv_of(docs_of):
    return lambda rows: docs_of(rows, CONV)


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def damaged(rows):
    return got(conversations.repair_all(conversations.damaged(rows), rows))


def test_query_against_plain_search(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_conversations(spark, SF)) == expected(table)


def test_every_short_row_of_symbols():
    chars = "duaxsUASX"
    rng = random.Random(5)
    role = {"u": "user", "a": "assistant", "s": "system", "x": "tool", "d": "user"}
    for n in range(0, 12):
        for _ in range(60):
            symbols = "".join(rng.choice(chars) for _ in range(n))
            rows = tuple((role[c.lower()], "t", c == "d", c.isupper()) for c in symbols)
            assert conversations.cheapest(conversations.parse(symbols)) == cheapest(rows)[:2], symbols


def test_odd_rows(conv_of):
    rows = [
        (1, None, "user", "Hi."), (1, 3, "assistant", "Yes."), (1, 1, None, None), (1, 9, "", "Empty role."),
        (2, 0, "user", None), (2, 1, "user", " \n\t"), (3, 5, "system", "Be kind."), (None, 0, "user", "No id."), (None, 1, "assistant", "No id."),
        (4, 0, "user", "Same."), (4, 0, "user", "Same."), (4, 0, "assistant", "Same."), (4, 0, "user", "Other"), (4, 2, "user", "Same."),
        (5, 0, "user", "x" * 100_000 + "."), (5, 1, "assistant", "É! 你好 😀"), (6, None, "user", "a."), (6, None, "assistant", "b."),
        *((7, t, "user", "Again.") for t in range(40)), (8, 7, "tool", "Data!"),
    ]
    assert damaged(conv_of(rows)) == expected(rows)
    assert got(conversations.repair(conv_of(rows))) == expected(rows, damage=False)


def test_empty_table_and_other_columns(conv_of, docs_of):
    assert damaged(conv_of([])) == []
    extra = CONV + ", h1 string, state string, at string, facts string, part string, copy string, fault string"
    rows = [(1, 0, "user", "A."), (1, 1, "assistant", "B.")]
    assert damaged(docs_of(rows, extra)) == expected(rows)


def test_a_conversation_cut_by_ranges(spark, conv_of, monkeypatch):
    """Half of all rows are one conversation, which several tasks parse."""
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool"]
    rows = [(77, t, rng.choice(roles), rng.choice(["Fine.", "Cut", "", f"Turn {t}.", f"Odd {t}"])) for t in range(600)]
    rows += [(c, t, rng.choice(roles), f"Text {c} {t}.") for c in range(150) for t in range(700, 704)]
    rng.shuffle(rows)
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables = conv_of(rows)
        stored, store = {}, conversations.staged
        monkeypatch.setattr(conversations, "staged", lambda df, name: stored.setdefault(name, store(df, name)))
        parsed = conversations.parsed_conversations(conversations.prepared(tables))
        assert parsed.count() == 150 and stored["parts"].where("conv_id = 77").count() > 2
        stored.clear()
        assert damaged(tables) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)


def test_long_conversations_parse_fast():
    """Spans double: a hundred times the rows take far less than a million times the work of a full chart."""
    symbols = "".join(random.Random(1).choice("uaxdUAs") for _ in range(20_000))
    cost, audit = conversations.cheapest(conversations.parse(symbols))
    assert len(audit) - audit.count("I") == len(symbols) and cost > 0
