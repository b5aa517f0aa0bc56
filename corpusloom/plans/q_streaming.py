"""Streams over the events table, drained: what they write equals the batch's result."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators.skew import scratch
from corpusloom.plans.base import query, table
from corpusloom.streaming import logs


def _stream(spark, sf_dir):  # noqa: ANN001, ANN202
    return logs.event_stream(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events").schema)


def _folder(spark) -> str:  # noqa: ANN001
    return scratch(spark, "stream")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS state FROM {events} GROUP BY user_id")
def stream_last_states(spark, sf_dir):  # noqa: ANN001, ANN201
    return logs.settle(logs.last_states(_stream(spark, sf_dir), "user_id", "event_type", ["ts", "event_id"]), _folder(spark), "complete")


@query("SELECT count(DISTINCT user_id || event_type) AS n_distinct, count(DISTINCT event_type) AS n_types FROM {events}")
def stream_ingest_once(spark, sf_dir):  # noqa: ANN001, ANN201
    """First rows by a digest of user and type; which row of equal ones comes first is the source's order."""
    keyed = _stream(spark, sf_dir).withColumn("digest", F.concat(F.col("user_id").cast("string"), F.col("event_type")))
    once = logs.settle(logs.ingest_once(keyed.select("digest", "event_type", "ts"), "digest", late="400 days"), _folder(spark))
    return once.agg(F.count(F.lit(1)).alias("n_distinct"), F.countDistinct("event_type").alias("n_types"))


@query("SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, event_type, count(*) AS n FROM {events} GROUP BY ALL")
def stream_hourly_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    """Complete mode keeps all windows, so the last hours need no later event to close them."""
    e = _stream(spark, sf_dir)
    counts = e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("window.start").alias("start_us"), "event_type", "n")
    return logs.settle(counts, _folder(spark), "complete")
