"""Registered queries of the corpus operators, each over its whole table, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from paylane.llm import conversations, decontamination, fingerprints, language, lexical, licenses, line_dedup, near_dedup, packing, quality, rollups, sharding, token_files
from paylane.llm import oracle
from paylane.llm.common import held_out, read_table
from paylane.session import staged, work_dir


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.document_fingerprints(read_table(spark, sf_dir, "documents"))
    return prints.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines that an earlier line repeats within one edit, and the digest of what stays."""
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles; a repeated row gives its result once per row."""
    docs = read_table(spark, sf_dir, "documents")
    groups = near_dedup.near_groups(docs, width=2, percent=80)
    doc_id = F.when(F.col("ord") != near_dedup.LAST, F.col("ord"))
    return groups.select(doc_id.alias("doc_id"), "n_shingles", "component_id", doc_id.eqNullSafe(F.col("component_id")).alias("kept"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: shards of the shuffled table, sizes and checksums taken from the written records."""
    path = work_dir(spark, "shuffled")
    sharding.write_shuffled(read_table(spark, sf_dir, "documents"), path)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return sharding.read_shards(spark, path, 24).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    scored = quality.score(docs.select("doc_id", "text"), model)
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", "predicted")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read_table(spark, sf_dir, "documents"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents, the second delivered twice: inserts of all, deletes of exact copies (the lowest id
    stays), and revised counts of what is left in languages other than English, which move to another tokenizer version.

    Rows of the lowest id are told by text and id together, so the rows of one text are dealt over all tasks. A row without
    id or text is no copy.
    """
    docs = read_table(spark, sf_dir, "documents")
    counts = [rollups.n_tokens(F.col("text"), v).alias(c) for v, c in (("words-1", "old"), ("marks-1", "new"))]
    rows = staged(docs.select("doc_id", "source", "lang", F.sha2("text", 256).alias("same"), *counts), "counted")
    firsts = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = staged(rows.join(firsts, ["same", "doc_id"], "left"), "marked")
    copy = F.col("first").isNull() & F.col("same").isNotNull() & F.col("doc_id").isNotNull()
    copies, stay = marked.where(copy), marked.where(~copy & (F.col("lang") != "en"))
    store = rollups.Rollup(spark, work_dir(spark, "rollup"))
    store.commit("load", rollups.signed(rows, 1, "words-1", "old"))
    store.commit("copies", rollups.signed(copies, -1, "words-1", "old"))
    revised = rollups.signed(stay, -1, "words-1", "old").unionByName(rollups.signed(stay, 1, "marks-1", "new"))
    store.commit("revised", revised)
    store.commit("copies", rollups.signed(copies, -1, "words-1", "old"))
    store.keep_totals()
    return store.totals()


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.with_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path, end=2, meta=("lang", "source"))
    return token_files.checksums(token_files.read_tokens(spark, path), ["doc_id", "start", "n_tokens"])


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conversations.repair_all(conversations.damaged(rows), rows)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(read_table(spark, sf_dir, "documents")))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return lexical.search(docs, items, work_dir(spark, "signatures"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_language": op9_language,
    "op10_token_files": op10_token_files,
    "op11_conversations": op11_conversations,
    "op12_licenses": op12_licenses,
    "op13_lexical": op13_lexical,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": oracle.LINE_DEDUP,
    "op3_near_dedup": oracle.NEAR_DEDUP,
    "op7_token_counts": oracle.TOKEN_COUNTS,
    "op8_decontamination": oracle.DECONTAMINATION,
    "op13_lexical": oracle.LEXICAL,
}
