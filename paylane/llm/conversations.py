"""Repair of conversation structure by weighted CYK parsing over intervals of rows.

A sound conversation reads ``(s?(ua)+)?`` by the initials of its roles. Rows are kept, given another role, deleted, and
missing ones inserted, each at a price; the cheapest way is told as an audit, one initial an edit.

The grammar, in Chomsky normal form, has a nonterminal for every factor of a sound conversation: nothing kept (``E``),
turns that start with u or a and end with u or a (``UU UA AA AU``), the system row alone (``S``) and with turns after it
(``SU SA``). A cell of a span holds the least (cost, audit) of each. Blocks of eight rows get a full chart, all spans and
all splits, shortest first. Rows may be inserted anywhere, so each leaf is closed under insertion at both ends. As edits never
reach over the border of two rows and the nonterminals name every factor, one split is enough for a longer span: cells of
neighbouring blocks combine in pairs, span by doubled span. Audits of one span and nonterminal with equal costs never start
with one another, so the least of parts is the least of the whole.

Rows are sorted in ranges that cut long conversations; what a task sees of one is a segment with its own cell, and segments
combine pairwise. So a conversation that holds a third of all rows is parsed by a third of the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylane.llm.common import tidy
from paylane.operators.skew import LOT, with_lot
from paylane.session import prepare, staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\f\r"
LEGAL = {"su", "ua", "au"}
BLOCK = 8

# Nonterminals with the first and last initial of what they derive, and whether a system row leads it.
FACTORS = {"E": ("", ""), "UU": ("u", "u"), "UA": ("u", "a"), "AA": ("a", "a"), "AU": ("a", "u"), "S": ("s", "s"), "SU": ("s", "u"), "SA": ("s", "a")}
NAMES = list(FACTORS)
SOUND = [NAMES.index(n) for n in ("E", "UA", "SA")]
Cell = tuple  # of (cost, audit) or None, one for each nonterminal


def rules() -> list[tuple[int, int, int]]:
    """(whole, left, right): every pair of factors whose initials may stand side by side, and what they make."""
    out = []
    for x, (first, end) in FACTORS.items():
        for y, (start, last) in FACTORS.items():
            if x == "E" or y == "E" or end + start in LEGAL:
                ends = (first or start, last or end)
                out += [(NAMES.index(z), NAMES.index(x), NAMES.index(y)) for z, e in FACTORS.items() if e == ends]
    return out


RULES = rules()


def joined(left: Cell, right: Cell, best: list | None = None) -> list:
    best = [None] * len(NAMES) if best is None else best
    for whole, x, y in RULES:
        a, b = left[x], right[y]
        if a and b:
            cost, held = a[0] + b[0], best[whole]
            if held is None or cost < held[0]:
                best[whole] = (cost, a[1] + b[1])
            elif cost == held[0] and (audit := a[1] + b[1]) < held[1]:
                best[whole] = (cost, audit)
    return best


def cell(**found) -> Cell:
    return tuple(found.get(n) for n in NAMES)


# Between two rows: nothing, or inserted turns.
BETWEEN = cell(E=(0, ""), UU=(INSERT, "I"), AA=(INSERT, "I"), UA=(2 * INSERT, "II"), AU=(2 * INSERT, "II"))


@lru_cache(64)
def leaf(symbol: str) -> Cell:
    """The cell of one row: ``d`` must go, else its role's initial (``x``: any other), in upper case if it is truncated."""
    found = {"E": (DELETE, "D")}
    if symbol != "d":
        late = TRUNCATED if symbol.isupper() else 0
        found |= {"UU": (REROLE + late, "R"), "AA": (REROLE + late, "R")}
        if kept := {"u": "UU", "a": "AA", "s": "S"}.get(symbol.lower()):
            found[kept] = (KEEP + late, "K")
    return tuple(joined(joined(BETWEEN, cell(**found)), BETWEEN))


@lru_cache(1 << 15)
def chart(symbols: str) -> Cell:
    """The cell of a block, bottom-up by length of span over all splits."""
    cells = {(i, i + 1): leaf(s) for i, s in enumerate(symbols)}
    for length in range(2, len(symbols) + 1):
        for i in range(len(symbols) - length + 1):
            best = None
            for k in range(i + 1, i + length):
                best = joined(cells[i, k], cells[k, i + length], best)
            cells[i, i + length] = best
    return tuple(cells[0, len(symbols)])


def parse(symbols: str) -> Cell:
    """The cell of a row of symbols: charts of blocks, then spans of doubled length."""
    cells = [chart(symbols[at : at + BLOCK]) for at in range(0, len(symbols), BLOCK)] or [BETWEEN]
    while len(cells) > 1:
        cells = [tuple(joined(*pair)) if len(pair) > 1 else pair[0] for pair in (cells[i : i + 2] for i in range(0, len(cells), 2))]
    return cells[0]


def cheapest(whole: Cell) -> tuple[int, str]:
    return min(whole[x] for x in SOUND if whole[x])


def n_illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


COUNTS = ("first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal")
FACTS = {
    **{c: pa.int64() for c in COUNTS},
    **{c: pa.string() for c in ("first", "last")},
    "costs": pa.list_(pa.int64()),
    "audits": pa.list_(pa.string()),
}
SEGMENT = ", ".join(["part int", *(f"{c} long" for c in COUNTS), "first string, last string, costs array<long>, audits array<string>"])


def segment(lines: list[tuple]) -> dict:
    """Facts and cell of neighbouring lines (turn, initial, state, copies, seen): equal rows of a turn are one line."""
    initials, symbols, turns = [], [], []
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    for turn, initial, state, copies, seen in lines:
        initials.append(initial * copies)
        if state == "blank":
            count["blank"] += copies
            symbols.append("d" * copies)
        else:
            more = copies if seen else copies - 1
            count["duplicate"] += more
            if not seen:
                count["truncated"] += state == "truncated"
                symbols.append(initial.upper() if state == "truncated" else initial)
            symbols.append("d" * more)
        if turn is not None and (not turns or turns[-1] != turn):
            turns.append(turn)
    initials = "".join(initials)
    parsed = parse("".join(symbols))
    return {
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(turns), **count,
        "illegal": n_illegal(initials), "first": initials[:1], "last": initials[-1:],
        "costs": [c and c[0] for c in parsed], "audits": [c and c[1] for c in parsed],
    }


def merged(left: dict, right: dict) -> dict:
    """One segment from two neighbouring ones."""
    parsed = joined(*([a if a is None else (int(c), a) for c, a in zip(s["costs"], s["audits"])] for s in (left, right)))
    either = lambda a, b: b if a is None else a
    return {
        "first_turn": either(left["first_turn"], right["first_turn"]),
        "last_turn": either(right["last_turn"], left["last_turn"]),
        "turns": left["turns"] + right["turns"] - (left["last_turn"] is not None and left["last_turn"] == right["first_turn"]),
        **{c: left[c] + right[c] for c in ("blank", "duplicate", "truncated")},
        "illegal": left["illegal"] + right["illegal"] + n_illegal(left["last"] + right["first"]),
        "first": left["first"], "last": right["last"],
        "costs": [c and c[0] for c in parsed], "audits": [c and c[1] for c in parsed],
    }


def rows_of(batches: Iterator[pa.RecordBatch], ids: list) -> Iterator[tuple]:
    """Rows as tuples; ``ids`` takes up the type of the conversation ids."""
    for batch in batches:
        ids[:] = [batch.schema.field(0).type]
        yield from zip(*(c.to_pylist() for c in batch.columns))


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation that the sorted lines of a partition touch."""
    part, kind, out = TaskContext.get().partitionId(), [], []

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(out, pa.schema([("conv_id", kind[0]), ("part", pa.int32()), *FACTS.items()]))

    for conv_id, lines in groupby(rows_of(batches, kind), key=lambda row: row[0]):
        out.append({"conv_id": conv_id, "part": part, **segment([row[1:] for row in lines])})
        if len(out) >= 2000:
            yield emit()
            out = []
    if out:
        yield emit()


def merge_pair(pair: pa.Table) -> pa.Table:
    """Two neighbouring segments of a conversation as one; a last one without neighbour as it is."""
    rows = sorted(pair.to_pylist(), key=lambda r: r["at"])
    out = rows[0] | (merged(*rows) if len(rows) > 1 else {}) | {"at": rows[0]["at"] // 2}
    return pa.Table.from_pylist([out], pair.schema)


def prepared(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and two hashes of role and text; a null role or text is one space."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    return rows.withColumns({"h1": F.xxhash64("role", F.lit("\n"), "text"), "h2": F.xxhash64("text", F.lit("\t"), "role")})


def _same_conversation(other: str) -> Column:
    return F.col("conv_id").eqNullSafe(F.col(other))


def lines_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, initial, state, copies, seen): equal rows of a turn as one line, ``seen`` in an earlier turn.

    Role and text do not travel: their hashes do. Copies are counted before any exchange.
    """
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    state = F.when(end == "", "blank").when(end.isin(".", "!", "?"), "sound").otherwise("truncated")
    initial = F.substring("role", 1, 1)
    narrow = rows.select("conv_id", "turn", "h1", "h2", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), state.alias("state"))
    lines = narrow.groupBy("conv_id", "turn", "h1", "h2", "initial", "state").agg(F.count("*").alias("copies"))
    again = with_lot(narrow.select("conv_id", "h1", "h2", F.struct("turn").alias("turn")), "h1", "h2")
    firsts = again.groupBy("conv_id", "h1", "h2", LOT).agg(F.min("turn").alias("_first"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_first")
    same = _same_conversation("_conv") & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    seen = ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    return lines.join(firsts, same).select("conv_id", "turn", "h1", "h2", "initial", "state", "copies", seen.alias("seen"))


def parsed_conversations(rows: DataFrame) -> DataFrame:
    """One segment per conversation: facts, and costs and audits by nonterminal."""
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T.StructType.fromDDL(SEGMENT).fields])
    order = ["conv_id", "turn", "h1", "h2"]
    lines = lines_of(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    lines = lines.select("conv_id", "turn", "initial", "state", "copies", "seen")
    done = staged(lines.mapInArrow(tidy(segments), schema), "segments")
    # Only the first and the last conversation of a range can go on elsewhere: two ids a task at most are broadcast.
    cut = staged(done.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("_cut")), "cut-ids")
    whole = done.join(F.broadcast(cut), _same_conversation("_cut"), "left_anti").drop("part")
    at = (F.row_number().over(Window.partitionBy("conv_id").orderBy("part")) - 1).cast("long")
    parts = done.join(F.broadcast(cut), _same_conversation("_cut"), "left_semi").withColumn("at", at).drop("part")
    parts = staged(parts, "parts")
    most = parts.agg(F.max("at")).first()[0]
    while most:
        parts = parts.groupBy("conv_id", F.floor(F.col("at") / 2).alias("pair")).applyInArrow(merge_pair, parts.schema)
        most //= 2
    return whole.unionByName(parts.drop("at"))


ROLES, FOLLOWER = {"u": "user", "a": "assistant"}, {"s": "u", "u": "a", "a": "u"}


def digest(audit: str, rows: Iterator[tuple[str, str]]) -> str:
    """SHA-256 of the repaired lines ``role:text``; rows go through it one by one."""
    sha, lead, expected, edits = hashlib.sha256(), b"", "u", iter(audit)

    def add(role: str, text: str) -> None:
        nonlocal lead, expected
        sha.update(lead + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        lead, expected = b"\n", FOLLOWER[role[0]]

    for edit in edits:
        if edit == "I":
            add(ROLES[expected], "")
            continue
        role, text = next(rows)
        if edit != "D":
            add(role if edit == "K" else ROLES[expected], text)
    return sha.hexdigest()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, those of a conversation behind its audit, which carries its facts along."""
    kind, out = [], []
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [pa.string() if "string" in f else pa.int64() for f in RESULT.split(", ")]

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(out, pa.schema([("conv_id", kind[0]), *zip(names, types)]))

    for conv_id, rows in groupby(rows_of(batches, kind), key=lambda row: row[0]):
        _, facts, role, text = next(rows)
        out.append({"conv_id": conv_id, **facts, "repaired_sha256": digest(facts["audit"], (row[2:] for row in rows))})
        if len(out) >= 2000:
            yield emit()
            out = []
    if out:
        yield emit()


def facts_of(parsed: DataFrame) -> Column:
    """Gaps, faults, and the least (cost, audit) of the sound nonterminals."""
    ways = F.array(*(F.struct(F.col("costs")[x].alias("cost"), F.col("audits")[x].alias("audit")) for x in SOUND))
    best = F.array_min(F.filter(ways, lambda w: w["cost"].isNotNull()))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    return F.struct(gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit"))


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps between turns, faulty rows, bad neighbours, and the cheapest repair with its audit and digest.

    Rows are taken by turn (null first), rows of one turn by a hash of role and text, so the result does not depend on the
    order of files. A row's first fault counts: blank, else duplicate (role and text were there before), else truncated. A null
    role or text is one space; an empty role has no initial and cannot be kept. A null id is a conversation of its own. Rows
    of a conversation are digested in order by one task, as SHA-256 has to be, but never held; other columns are ignored.
    """
    prepare(conversations.sparkSession)
    rows = prepared(conversations)
    parsed = parsed_conversations(rows)
    audits = parsed.select("conv_id", facts_of(parsed).alias("facts"))
    stream = rows.unionByName(audits, allowMissingColumns=True)
    first = F.col("facts").isNull()
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", first, "turn", "h1", "h2")
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T.StructType.fromDDL(RESULT).fields])
    return stream.select("conv_id", "facts", "role", "text").mapInArrow(tidy(digests), schema)


def repair_all(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """``repair`` with a row for every id of ``ids`` as well: one without rows has zeros, an empty audit and digest."""
    fixed = repair(conversations)
    known = fixed.withColumnRenamed("conv_id", "_conv")
    out = ids.select("conv_id").distinct().join(known, _same_conversation("_conv"), "left")
    empty = {c: F.lit("") if "string" in kind else F.lit(0).cast("long") for c, kind in (f.split() for f in RESULT.split(", "))}
    empty["repaired_sha256"] = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *(F.coalesce(c, e).alias(c) for c, e in empty.items()))


DAMAGES = 20


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn``: dropped, emptied, without end marks, repeated, or of role user.

    A null stands for one space in the key, in role and in text; in conv_id and turn it stays null.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key) % DAMAGES
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        fault.alias("fault"),
    )
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("fault <> 0").withColumn("copy", F.explode(copies)).drop("fault", "copy")
