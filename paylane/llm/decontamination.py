"""Benchmark passages in documents, by a prefix-filtered set join in DataFrame operations only.

An item gives windows of ten consecutive words (an item of fewer words is one window), a window the set of its shingles of
three words. A document that contains a window contains each of its shingles, so one shingle per window is a sufficient
prefix: the one that is rarest in the corpus. Positions bound where the window must lie. A candidate counts if all shingles of the
window stand at their places, which is containment word by word (shingles are compared by 64-bit hashes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylane.llm.common import broadcast_within
from paylane.session import broadcast_if_small, staged

WINDOW, SHINGLE = 10, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Before lower-casing: what lies between words, and words. ASCII characters are listed one by one, which a matcher looks up in a
# table; ranges it tries one after the other.
BETWEEN_CHARS = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())
BETWEEN, WORD = f"[{BETWEEN_CHARS}]+", f"[^{BETWEEN_CHARS}]+"


def ascii_lower(text: Column) -> Column:
    """A-Z only; the general lower() does just that on texts without other characters, at a fraction of the cost."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def count_words(text: Column) -> Column:
    """Number of words, without listing them: a word and what follows it up to the next becomes one letter.

    A word in front takes up what stands before the first.
    """
    rest = F.regexp_replace(F.concat(F.lit("x "), F.coalesce(text, F.lit(""))), f"{WORD}[{BETWEEN_CHARS}]*", "x")
    return (F.octet_length(rest) - 1).cast("long")


def shingles(words: str, m: int) -> Column:
    """Array of hashes of the ``m`` words from each place on; the last m - 1 lack words and must not be used."""
    return F.transform(words, lambda _, i: F.xxhash64(F.lit(m), *(F.get(F.col(words), i + k) for k in range(m))))


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(wid, item_id, words): one row for each window of each item."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.expr(f"sequence(1, greatest(size(all) - {window} + 1, 1))")
    cut = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("all", s, window))).alias("words"))
    return cut.select(F.xxhash64("words").alias("wid"), "item_id", "words").distinct()


def shingled(windows: DataFrame, shingle: int) -> DataFrame:
    """(wid, m, n, off, sh): the shingles of distinct windows; m is their width, less than ``shingle`` in shorter windows only."""
    one = windows.groupBy("wid").agg(F.first("words").alias("words"))
    parts = []
    for m in range(1, shingle + 1):
        rows = one.where(F.size("words") >= m if m == shingle else F.size("words") == m)
        full = F.slice(shingles("words", m), 1, F.size("words") - (m - 1))
        sets = rows.select("wid", F.size("words").alias("n"), F.posexplode(full).alias("off", "sh"))
        parts.append(sets.select("wid", F.lit(m).alias("m"), "n", "off", "sh"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def text_key(text: Column) -> list[Column]:
    """Two hashes that stand for a text: copies are worked on once."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")]


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, start, n, wid): where windows stand in distinct texts; and (wid, item_id): whose windows they are."""
    windows = staged(windows_of(benchmark, window), "windows")
    sets = staged(shingled(windows, shingle), "window-shingles")
    wanted = staged(sets.select("m", "sh").distinct(), "shingles")
    texts = docs.select(*text_key(F.col("text")), words_of(F.col("text")).alias("words"))
    hits = None
    for m in [r["m"] for r in wanted.select("m").distinct().orderBy("m").collect()]:  # at most ``shingle`` widths
        rows = texts.select("k1", "k2", F.size("words").alias("n_words"), F.posexplode(shingles("words", m)).alias("pos", "sh"))
        found = rows.join(broadcast_if_small(wanted.where(F.col("m") == m)), "sh").where(F.col("pos") <= F.col("n_words") - m)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:  # no item has a word
        hits = texts.select("k1", "k2", F.size("words").alias("n_words"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("sh"), F.lit(0).alias("m")).where("false")
    hits = staged(hits.select("k1", "k2", "n_words", "pos", "m", "sh").distinct(), "shingle-hits")

    rarity = hits.groupBy("m", "sh").agg(F.count("*").alias("freq"))
    ordered = sets.join(rarity, ["m", "sh"], "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    prefix = ordered.groupBy("wid", "m", "n").agg(F.min(F.struct("freq", "off", "sh")).alias("r"))
    prefix = prefix.where("r.freq > 0").select("wid", "m", "n", F.col("r.off").alias("off"), F.col("r.sh").alias("sh"))
    cands = hits.join(prefix, ["m", "sh"]).withColumn("start", F.col("pos") - F.col("off"))
    cands = cands.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words"))).select("k1", "k2", "wid", "m", "n", "start")
    needed = cands.join(sets.select("wid", "off", "sh"), "wid").withColumn("pos", F.col("start") + F.col("off"))
    there = needed.join(hits.select("k1", "k2", "pos", "m", "sh"), ["k1", "k2", "pos", "m", "sh"], "left_semi")
    whole = there.groupBy("k1", "k2", "wid", "start", "n", "m").agg(F.count("*").alias("there"))
    found = whole.where(F.col("there") == F.col("n") - F.col("m") + 1).select("k1", "k2", "start", "n", "wid")
    return staged(found, "windows-found"), windows.select("wid", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(k1, k2, n_hit, items) of the texts that contain a window: words inside windows, and the sorted item ids as text.

    Items without words are in no text. Items without id count for ``n_hit`` and are not listed.
    """
    found, owners = occurrences(docs, benchmark, window, shingle)
    covered = found.select("k1", "k2", F.explode(F.expr("sequence(start, start + n - 1)")).alias("pos")).distinct()
    counts = covered.groupBy("k1", "k2").agg(F.count("*").alias("n_hit"))
    items = found.select("k1", "k2", "wid").distinct().join(owners, "wid").groupBy("k1", "k2")
    items = items.agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return counts.join(items, ["k1", "k2"])


def with_contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """(row, n_words, n_hit, items) for every row of ``docs`` (a struct of all its columns). A null text has no words."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", *text_key(F.col("row.text")), count_words(F.col("row.text")).alias("n_words"))
    text_bytes = F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 16)
    found = broadcast_within(staged(contamination(docs, benchmark, **how), "contamination"), F.lit(48) + text_bytes)
    out = rows.join(found, ["k1", "k2"], "left")
    return out.select("row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
