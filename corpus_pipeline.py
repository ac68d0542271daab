"""From documents to packed training sequences: five stages, each an operator of tabwarden.llm.

Every stage but the last returns the columns of the documents it got.  Stages that remove documents judge each row by its
own text: they number the rows, so rows without a doc_id and rows that share one are judged like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.llm import contamination, neardup, packing, pii, quality
from tabwarden.llm.common import discard_since, tables, written
from tabwarden.llm.queries import word_tokenizer


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with _row, a number of each row; written once, so that all readings and retries agree."""
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered", compression="zstd")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test of their language and source reject go."""
    rows = _numbered(docs)
    gone = written(quality.judge_quality(rows, "_row"), "judged").where(~F.col("kept")).select(F.col("id").alias("_row"))
    # the texts are shuffled at every size, and not sorted
    return rows.join(gone.hint("shuffle_hash"), "_row", "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows whose 5-word shingles are similar by 0.8 or more, the one with the smallest doc_id stays.

    A row without a doc_id stays only if no row of its group has one; of equal ids the first row stays.  Blank texts are like no other.
    """
    rows = _numbered(docs)
    found = neardup.near_duplicates(rows, "_row", shingle=5).select(F.col("id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row"))
    stay = found.groupBy("component_id").agg(first.alias("first")).select("first._row")
    return rows.join(stay.hint("shuffle_hash"), "_row", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item by 0.8 or more of its 5-word shingles go."""
    return contamination.decontaminated(_numbered(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "_row").select(*docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets."""
    found = pii.find_spans(docs).withColumn("text", pii.redacted(F.col("text"), F.col("spans")))
    found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.packed(docs, word_tokenizer(), window=4096, end=2).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", redaction),
    ("packing", pack),
]
#: SQL has no word for the robust estimate, the learnt spans and the tokenizer; tests/llm/test_pipeline.py tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; a stage's tables and its input go when its result is written."""
    before, docs = tables(), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard_since(spark, before, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
