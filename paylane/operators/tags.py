"""Tag rules: equality on the transfer subtype, then conditions that each rule may leave open."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blank_to_null
from ..session import staged


def max_keep_first(value: Column, key: Column) -> Column:
    """Aggregate: the greatest value among the rows with the least key; a missing key sorts last."""
    return F.max_by(value, F.struct((-key).alias("k"), value.alias("v")))


def first_two(c: Column) -> Column:
    return blank_to_null(F.upper(F.substring(F.trim(c), 1, 2)))


def ledger_conditions() -> dict[str, Column]:
    """Rule column -> the ledger value that it must equal."""
    return {
        "service_type": F.col("service_type"),
        "sender_user_id": F.col("sender_user_id"),
        "sender_designation": F.col("sender_designation"),
        "receiver_designation": F.col("receiver_designation"),
        "sender_domain_code": F.col("sender_domain"),
        "receiver_domain_code": F.col("receiver_domain"),
        "sender_state": F.col("sender_state"),
        "receiver_state": F.col("receiver_state"),
        "reference_number2": first_two(F.col("reference_number")),
        "source_txn_id": first_two(F.col("attr_2_value")),
    }


# Rules whose bits one number holds; the sign is left alone.
WORD = 63
INDEX_BYTES = 64 << 20


class RuleIndex(NamedTuple):
    """Rules by subtype, numbered in the order in which they win, as sets of bits.

    ``subtypes`` has a row per subtype: its tags by number, the set of all its rules and, per condition that any rule asks, the
    set of rules that leave it open. ``asking`` has per condition the set of rules that name a value, by subtype and value.
    """

    subtypes: DataFrame
    asking: dict[str, DataFrame]
    words: int
    small: bool


def rule_index(rules: DataFrame, conditions: list[str]) -> RuleIndex | None:
    """The index of ``rules``, all of it derived from a stored, numbered copy; None if no rule has a subtype."""
    first = Window.partitionBy("transfer_subtype").orderBy(F.asc_nulls_last("tag_id"), F.desc_nulls_last("tag_name"))
    numbered = rules.where(F.col("transfer_subtype").isNotNull()).select(
        F.col("transfer_subtype").alias("_subtype"), "tag_name", *conditions, (F.row_number().over(first) - 1).alias("place")
    )
    numbered = staged(numbered, "rules")
    facts = numbered.agg(F.count("*").alias("n"), F.max("place").alias("last"), *[F.count(c).alias(c) for c in conditions]).first()
    if not facts["n"]:
        return None
    words, asked = facts["last"] // WORD + 1, [c for c in conditions if facts[c]]
    bit = F.expr(f"shiftleft(1L, place % {WORD})")

    def rule_set(member: Column) -> Column:
        inside = [F.bit_or(F.when(member & (F.expr(f"place div {WORD}") == i), bit)) for i in range(words)]
        return F.array(*[F.coalesce(w, F.lit(0).cast("long")) for w in inside])

    places = F.array_sort(F.collect_list(F.struct("place", "tag_name")))
    subtypes = numbered.groupBy("_subtype").agg(
        F.transform(places, lambda p: p["tag_name"]).alias("_tags"),
        rule_set(F.lit(True)).alias("_all"),
        *[rule_set(F.col(c).isNull()).alias(f"_open_{c}") for c in asked],
    )
    asking = {
        c: numbered.where(F.col(c).isNotNull()).groupBy(F.col("_subtype").alias(f"_subtype_{c}"), F.col(c).alias(f"_value_{c}")).agg(rule_set(F.lit(True)).alias(f"_named_{c}"))
        for c in asked
    }
    size = facts["n"] * (len(asked) + 1) * (8 * words * (len(asked) + 2) + 200)
    return RuleIndex(subtypes, asking, words, size <= INDEX_BYTES)


def match_rules(
    df: DataFrame,
    rules: DataFrame,
    subtype: str = "transfer_subtype",
    equal: dict[str, Column] | None = None,
    differ: dict[str, Column] | None = None,
    out: str = "tag_name",
) -> DataFrame:
    """The tag of the first matching rule by id (greatest tag on equal ids), else the subtype itself.

    A row looks up, per condition, the set of rules that its value meets, ands the sets and takes the lowest bit. The sets lie
    in small tables of the rules alone, broadcast within a bound on their bytes, so rows are neither exchanged nor joined among
    themselves, whatever they hold and however many share a subtype. A missing value meets only rules that leave the
    condition open.
    """
    equal = ledger_conditions() if equal is None else equal
    differ = {"not_receiver_state": F.col("receiver_state")} if differ is None else differ
    index = rule_index(rules, [*equal, *differ])
    if index is None:
        return df.withColumn(out, F.col(subtype))
    hint = F.broadcast if index.small else (lambda table: table)
    asked = {c: value for c, value in {**equal, **differ}.items() if c in index.asking}
    kept = df.columns
    rows = df.withColumns({"_of": F.col(subtype), **{f"_asked_{c}": value for c, value in asked.items()}})
    rows = rows.join(hint(index.subtypes), F.col("_of") == F.col("_subtype"), "left")
    for c in asked:
        same = (F.col("_of") == F.col(f"_subtype_{c}")) & (F.col(f"_asked_{c}") == F.col(f"_value_{c}"))
        rows = rows.join(hint(index.asking[c]), same, "left")

    def met(c: str, i: int) -> Column:
        named = F.coalesce(F.get(f"_named_{c}", F.lit(i)), F.lit(0).cast("long"))
        open_to_all = F.get(f"_open_{c}", F.lit(i))
        if c in equal:
            return open_to_all.bitwiseOR(named)
        others = F.get("_all", F.lit(i)).bitwiseAND(F.bitwise_not(named))
        return F.when(F.col(f"_asked_{c}").isNull(), open_to_all).otherwise(others)

    sets = {f"_met_{i}": reduce(Column.bitwiseAND, [met(c, i) for c in asked], F.get("_all", F.lit(i))) for i in range(index.words)}
    rows = rows.withColumns(sets)
    tag = None
    for i, name in enumerate(sets):
        lowest = F.bit_count(F.expr(f"({name} & -{name}) - 1"))
        found, value = F.col(name) != 0, F.get("_tags", lowest + WORD * i)
        tag = F.when(found, value) if tag is None else tag.when(found, value)
    tagged = F.coalesce(tag, F.col("_of")).alias(out)
    return rows.select(*[c for c in kept if c != out], tagged)
