"""A pipeline for training data: five stages, each of which works on all that its predecessor kept.

run(spark, sf_dir) applies them to the table documents; every stage's result is written as Parquet in
the folder that all executors share and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import _common, decontaminate, line_dedup, near_dedup, packing, quality
from corpusloom.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose posterior quality is low, go."""
    return quality.keep_good(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of a document's source go; n_chars is that of the new text."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the least id."""
    return near_dedup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, _common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, as pieces in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality_rules", good_quality), ("line_dedup", without_boilerplate), ("near_dedup", without_near_duplicates), ("decontamination", without_benchmark), ("packing", packed)]

#: Several stages can't be expressed in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = _common.materialise(stage(spark, docs, sf_dir), name)
    return docs
