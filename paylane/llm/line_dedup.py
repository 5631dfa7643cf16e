"""Near-duplicate lines within one edit, by a deletion-neighbourhood join in DataFrame operations only.

Two lines are within one edit if some text arises from both by leaving out one character at the same place (replacement), or
if leaving one character out of the longer gives the shorter (insertion). Writing out the variants of every whole line costs
the square of its length, so the place of the edit is narrowed down first, which loses no pair:

1. one edit leaves the first or the last half of a line as it was: only lines that share a half with another line go on;
2. cut into blocks, one edit leaves all but one block as they were (blocks are counted from the left, what follows the block
   from the right): only (line, block) pairs that some other line shares go on;
3. there the variants of the block are emitted as hashed keys and joined.

Equal variants form groups in which every line is one edit from the group's first line: replacement groups hold lines that
differ at one and the same place, insertion groups hold one shorter line and its extensions. So each line needs one partner
per group, its earliest, and no group is ever listed in pairs. Partners are confirmed by edit distance on the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylane.llm.common import broadcast_within
from paylane.session import broadcast_if_small, staged

MIN_CHARS, BLOCK = 1, 32
LAST = (1 << 63) - 1


def documents_keyed(docs: DataFrame) -> DataFrame:
    """(ord, dk, text): ord orders documents (null ids last), dk tells texts of one id apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64("doc_id", "text").alias("dk"), "text")


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(ord, dk, no, t, n): lines of at least ``min_chars`` characters, without outer blanks."""
    rows = documents_keyed(docs).select("ord", "dk", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    rows = rows.select("ord", "dk", "no", F.trim("line").alias("t")).withColumn("n", F.char_length("t"))
    return rows.where(F.col("n") >= min_chars)


def half_keys() -> Column:
    """Hashes of a first and a last half. Halves have the same length for lengths 4k to 4k + 3; a line of length 4k also
    gives the halves of the lengths below, so that lines whose lengths differ by one meet."""
    t = F.col("t")

    def pair(a: Column) -> list[Column]:
        return [F.xxhash64(F.lit("first"), a, F.left(t, a)), F.xxhash64(F.lit("last"), a, F.right(t, a))]

    half = F.expr("int(n div 4) * 2")
    return F.when(F.col("n") % 4 == 0, F.array(*pair(half), *pair(half - 2))).otherwise(F.array(*pair(half)))


def shared(keyed: DataFrame, key: str) -> DataFrame:
    """Rows (key, h, ...) whose key some row of another h has as well."""
    groups = keyed.groupBy(key).agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select(key)
    return keyed.join(groups, key, "left_semi")


def variants() -> Column:
    """Array of (vk, role): hashed variants of a block with one character left out."""
    region, at = F.col("region"), F.sequence(F.lit(1), F.char_length("region"))
    without = lambda i: (F.left(region, i - 1), F.substring(region, i + 1, F.lit(1 << 30)))
    key = lambda role, *parts: F.struct(F.xxhash64("bk", *parts).alias("vk"), F.lit(role).alias("role"))
    replaced = F.transform(at, lambda i: key("same", F.lit("r"), i, *without(i)))
    shorter = F.array(key("short", F.lit("i"), region))
    longer = F.transform(at, lambda i: key("long", F.lit("i"), F.concat(*without(i))))
    none = F.array().cast("array<struct<vk:bigint,role:string>>")
    by_length = F.when(F.col("base") == F.col("n"), F.concat(F.when(F.char_length("region") > 0, replaced).otherwise(none), shorter))
    return by_length.otherwise(F.when(F.char_length("region") > 0, longer).otherwise(none))


def near_lines(cands: DataFrame, block: int = BLOCK) -> DataFrame:
    """(h) of the distinct lines (h, t, n, first) that have an earlier line within one edit. ``first`` orders lines."""
    bases = F.explode(F.array(F.col("n"), F.col("n") - 1)).alias("base")
    rows = cands.select("h", "t", "n", "first", bases)
    rows = rows.select("*", F.explode(F.expr(f"sequence(0, int(greatest(base - 1, 0) div {block}))")).alias("j"))
    rows = rows.withColumn("before", F.col("j") * block).withColumn("after", F.greatest(F.col("base") - F.col("before") - block, F.lit(0)))
    whole = F.xxhash64("base", "j", F.left("t", F.col("before")), F.right("t", F.col("after")))
    region = F.expr("substring(t, before + 1, n - before - after)")
    blocks = shared(rows.select("h", "n", "first", "base", region.alias("region"), whole.alias("bk")), "bk")
    keyed = blocks.select("h", "first", F.explode(variants()).alias("v")).select("h", "first", "v.vk", "v.role")
    earliest = lambda role: F.min(F.when(F.col("role") == role, F.struct("first", "h")))
    groups = keyed.groupBy("vk").agg(
        F.min("h").alias("lo"), F.max("h").alias("hi"), *(earliest(r).alias(r) for r in ("same", "short", "long"))
    ).where("lo <> hi")
    partner = F.when(F.col("role") == "same", F.col("same")).when(F.col("role") == "short", F.col("long")).otherwise(F.col("short"))
    links = keyed.join(groups, "vk").select("h", "first", partner.alias("p")).where("p.first < first").select("h", F.col("p.h").alias("other")).distinct()
    texts = cands.select("h", "t")
    both = links.join(texts, "h").join(texts.select(F.col("h").alias("other"), F.col("t").alias("u")), "other")
    return both.where(F.levenshtein("t", "u", 1) >= 0).select("h").distinct()


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, block: int = BLOCK) -> DataFrame:
    """(ord, dk, drops): numbers (from 0) of the lines that an earlier line of the corpus repeats within one edit.

    Earlier means a lower doc_id (null last), then a lower line number; an earlier line counts even if it is dropped itself.
    """
    lines = lines_of(docs, min_chars)
    line_key = [F.xxhash64("t").alias("h"), F.hash("t").alias("g")]
    table = staged(lines.select("ord", "dk", "no", *line_key, half_keys().alias("halves")), "lines")

    # Copies of a line are counted before halves are spread, so that a hot short line is one row there.
    firsts = table.groupBy("h", "g").agg(
        F.min(F.struct("ord", "dk", "no")).alias("first"), F.count("*").alias("copies"), F.first("halves").alias("halves")
    )
    firsts = staged(firsts, "line-firsts")
    near_half = shared(firsts.select("h", F.explode("halves").alias("k")), "k").select("h").distinct()
    texts = lines.select(line_key[0], "t", "n").join(broadcast_if_small(staged(near_half, "line-candidates")), "h").dropDuplicates(["h"])
    cands = staged(texts.join(firsts.groupBy("h").agg(F.min("first").alias("first")), "h"), "line-texts")
    near = near_lines(cands, block).withColumn("near", F.lit(True))

    repeated = firsts.join(near, "h", "left").where("copies > 1 or near")
    repeated = staged(repeated.select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near")), "line-repeats")
    found = table.select("ord", "dk", "no", "h", "g").join(broadcast_if_small(repeated), ["h", "g"])
    found = found.where(F.col("near") | (F.struct("ord", "dk", "no") != F.col("first")))
    return found.groupBy("ord", "dk").agg(F.collect_set("no").alias("drops"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, block: int = BLOCK) -> DataFrame:
    """``docs`` with repeated lines left out of ``text``, and ``n_lines`` and ``n_dropped`` beside its columns.

    A line is left out if an earlier line of the corpus, of this or another document, is within one edit of it (outer blanks
    aside). All lines count but those without a character; a caller may leave out lines under ``min_chars``. A null text stays null, with no
    lines; a text all of whose lines go becomes empty. Repeated rows (same id and text) count as one occurrence and get
    the same result. Other columns pass through, but for input columns named n_lines and n_dropped, which are replaced.
    """
    drops = staged(dropped_lines(docs, min_chars, block), "line-drops")
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*names).alias("row"))
    rows = rows.withColumn("_ord", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST))).withColumn("_dk", F.xxhash64("row.doc_id", "row.text"))
    drops = broadcast_within(drops.select(F.col("ord").alias("_ord"), F.col("dk").alias("_dk"), "drops"), F.lit(40) + 4 * F.size("drops"))
    rows = rows.join(drops, ["_ord", "_dk"], "left").withColumn("lines", F.split("row.text", "\n"))
    kept = F.filter("lines", lambda line, i: ~F.array_contains("drops", i))
    text = F.when(F.col("drops").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    counts = [F.coalesce(F.size("lines"), F.lit(0)), F.coalesce(F.size("drops"), F.lit(0))]
    n_lines, n_dropped = (F.greatest(c, F.lit(0)).alias(a) for c, a in zip(counts, ("n_lines", "n_dropped")))
    return rows.select(*((text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in names), n_lines, n_dropped)
