"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import chat_format, decontaminate, html_extract, line_dedup, near_dedup, packing, quality, secret_scan, toxicity, warc
from corpusloom.llm._common import table
from corpusloom.llm.twins import ORACLE_SQL  # noqa: F401


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer's file; operators take it as a parameter."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An owner is a source; it keeps a repository for each language."""
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"), owner="source", repo=F.concat_ws("/", "source", "lang"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region of a document that holds a benchmark item; clean documents have none."""
    return decontaminate.find_regions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold another template's control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_format.chat_format(rows.unionByName(extra))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posterior is given to six decimals; the verdict is that of the whole number."""
    return quality.quality_report(table(spark, sf_dir, "documents")).withColumn("quality", F.round("quality", 6))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs, counts=True).drop("source")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.capture_history(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "capture_no")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_secret_scan, op2_toxicity, op3_decontaminate, op4_html_extract, op5_near_dedup, op6_chat_format, op7_quality, op8_line_dedup, op9_warc, op10_packing)}
