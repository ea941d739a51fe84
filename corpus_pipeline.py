"""The corpus pipeline: STAGES applied in order to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's docs.
All but the last return the columns of ``documents``.  Nulls, empty tables and
repeated rows are handled as each operator's docstring says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm import mixing, near_dedup, packing, quality_rules, substring_dedup
from streamkit.llm.registry import fresh_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five words, similarity 0.8) the smallest id stays."""
    return near_dedup.keep_one(docs, k=5, percent=80).select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that also occur earlier leave the texts."""
    out = substring_dedup.strip_repeats(docs, window=50)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them (0 to 3 times)."""
    return mixing.mixed_rows(docs).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: one row per piece of a document."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("substring_dedup", repeated_passages),
          ("source_mix", mixture), ("packing", packed)]

ORACLE_SQL = None  # 64-bit hashes, tokenizing and packing are outside SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
