"""Append-only logs as streams: incremental ingest, replay of checkpoints, gates and sessions over event time.

The reference form of these operators is a batch over a log; each stream here gives the batch's result
once its input is drained.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_stream(spark: SparkSession, path: str, schema: T.StructType, time: str = "ts", files_per_trigger: int = 1, **options: str) -> DataFrame:
    """Parquet files of a folder (or one file) as they arrive; a naive time becomes an instant, as watermarks need one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # a stream's source is a folder
        options["pathGlobFilter"] = at.getName()
        path = str(at.getParent())
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).options(**options).parquet(path)
    return s.withColumn(time, F.col(time).cast("timestamp"))


def ingest_once(stream: DataFrame, digest: str, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first row of each digest; state is kept as long as duplicates may come late."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([digest])


def windowed_counts(stream: DataFrame, by: str, time: str = "ts", width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    w = F.window(time, width, slide or width)
    return stream.withWatermark(time, late).groupBy(w, by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), by, "n")


def session_counts(stream: DataFrame, by: str, time: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    s = F.session_window(time, gap)
    return stream.withWatermark(time, late).groupBy(s, by).agg(F.count(F.lit(1)).alias("n")).select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def last_states(stream: DataFrame, item: str, state: str, seq: list[str]) -> DataFrame:
    """The last state of each item, in update mode: one aggregate row of state per item."""
    return stream.groupBy(item).agg(F.max_by(state, F.struct(*seq)).alias("state"))


def gates(stream: DataFrame, by: str, value: str, high: float, low: float, order: str = "ts") -> DataFrame:
    """(by, order, gate) with hysteresis kept across batches: one word of state per key."""
    schema = T.StructType([stream.schema[by], stream.schema[order], T.StructField("gate", T.StringType())])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        gate = state.get[0] if state.exists else "run"
        # a key's rows of one trigger, in order
        rows = pd.concat(batches).sort_values(order)
        out = []
        for v in rows[value]:
            gate = "stop" if v < high else "run" if v >= low else gate
            out.append(gate)
        state.update((gate,))
        yield pd.DataFrame({by: key[0], order: rows[order].to_numpy(), "gate": out})

    return stream.groupBy(by).applyInPandasWithState(step, schema, "gate string", "append", "NoTimeout")


def drain(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run a stream until its input is used up and return what it wrote (in memory; for tests and small results)."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    q = (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def settle(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream until its input is used up, write each trigger's rows under folder and read what holds.

    Each trigger's rows go to a directory of their own, which a repeated trigger overwrites, so every
    row is there exactly once; in complete mode the last trigger's rows are the result.
    """
    spark, schema = df.sparkSession, df.schema
    q = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{folder}/state")
    q = q.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{folder}/rows/n={n}")).start()
    q.awaitTermination()
    at = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/rows").select("*", F.regexp_extract(F.col("_metadata.file_path"), r"/n=(\d+)/", 1).cast("bigint").alias("__n"))
    if mode != "complete":
        return at.drop("__n")
    newest = at.agg(F.max("__n").alias("m"))
    return at.join(F.broadcast(newest), F.col("__n") == F.col("m")).drop("__n", "m")
