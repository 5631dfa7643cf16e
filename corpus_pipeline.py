"""From raw documents to packed training sequences: quality, repeated lines, near duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a table; each is written as Parquet and read again as the next one's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylane.llm import decontamination, line_dedup, near_dedup, packing, quality
from paylane.llm.common import read_table
from paylane.session import prepare, staged

# Rows go to Python and back in batches of so many bytes, not of the usual 64 MB: an executor holds one on each side for every
# task, and what both sides once took for it they keep from stage to stage. The setting stays, as stages are computed later.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the documents' training folds and the good labels."""
    ready(spark)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select("row.*")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or the same, has had; ``n_chars`` follows the text.

    A document of which no word is left, though it had some, is a copy throughout and goes. One that was empty stays as it is.
    """
    ready(spark)
    found = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = found.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    counted = F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.withColumn("n_chars", F.coalesce(counted, F.col("n_chars")))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are alike: five-word shingles, similarity 0.8 or more."""
    ready(spark)
    return near_dedup.keep_one(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no window of a benchmark item."""
    ready(spark)
    found = decontamination.with_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    ready(spark)
    return packing.pack(packing.pieces(docs)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# The classifier, the trees and the packing have no SQL counterpart; tests/llm checks each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = staged(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
