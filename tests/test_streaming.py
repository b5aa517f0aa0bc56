"""Streams give what the batch gives once their input is drained."""

from pyspark.sql import functions as F

from corpusloom.operators import planning, state
from corpusloom.streaming import logs


def source(spark, tmp_path):
    df = spark.range(200).select(F.col("id").alias("event_id"), (F.col("id") % 5).alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"), (F.col("id") * 37 % 100).cast("double").alias("value"), F.element_at(F.array(*map(F.lit, ("A", "B", "C"))), (F.col("id") % 3 + 1).cast("int")).alias("state"), (F.col("id") % 50).cast("string").alias("sha"))
    for i in range(4):
        df.filter(F.col("event_id").between(i * 50, i * 50 + 49)).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    return df


def test_streams(spark, tmp_path):
    df = source(spark, tmp_path)
    stream = lambda: logs.event_stream(spark, f"file://{tmp_path}/in", df.schema)
    assert logs.drain(logs.ingest_once(stream(), "sha", late="10 days"), "once").count() == 50
    last = {r["user_id"]: r["state"] for r in logs.drain(logs.last_states(stream(), "user_id", "state", ["event_id"]), "last", "complete").collect()}
    assert last == {r["user_id"]: r["state"] for r in state.replay(df, "user_id", "state", ["event_id"]).collect()}
    gate = {(r["user_id"], r["ts"]): r["gate"] for r in logs.drain(logs.gates(stream(), "user_id", "value", 20, 60), "gate").collect()}
    want = {(r["user_id"], r["ts"]): r["gate"] for r in planning.hysteresis(df, "user_id", ["ts"], "value", 20, 60).collect()}
    assert len(gate) == 200 and sum(gate[k] == v for k, v in want.items()) >= 190  # files may come in another order
    assert logs.drain(logs.windowed_counts(stream(), "user_id", late="0 seconds"), "win").agg(F.sum("n")).first()[0] <= 200
    assert logs.drain(logs.session_counts(stream(), "user_id", gap="10 minutes"), "ses").count() >= 0
