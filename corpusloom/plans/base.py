"""Registration of queries: a function of (spark, sf_dir) and, where SQL can express it, its DuckDB twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows dealt to several tasks per core: what is made of each row takes far longer than to move it."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def over(spark: SparkSession, sf_dir: str, text: str, **more: DataFrame) -> DataFrame:
    """A SQL text that names tables in braces, over the tables of a directory (and others by name)."""
    used = [n for n in (*TABLES, *more) if f"{{{n}}}" in text]
    text = text.replace("{", "{{").replace("}", "}}")
    for n in used:
        text = text.replace(f"{{{{{n}}}}}", f"{{{n}}}")
    return spark.sql(text, **{n: more.get(n) if n in more else table(spark, sf_dir, n) for n in used})


def plain(text: str) -> str:
    """The same text for an engine where the tables are views."""
    return re.sub(r"\{(" + "|".join(TABLES) + r")\}", r"\1", text)


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function under its name; sql is its twin, in which {table} may stand for a table."""

    def add(f: Callable) -> Callable:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = f
        if sql:
            ORACLES[key] = plain(sql).strip()
        return f

    return add
