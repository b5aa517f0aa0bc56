"""Joins on keys that may hold a large share of all rows, and tables that stay as they are while a plan is built on them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that may be broadcast, with a few numbers each; rows of one other key that may meet in a task.
HOT_KEYS, HOT_ROWS = 50_000, 10_000


_scratch: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where none is set, as in a notebook, an own one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"file://{tempfile.mkdtemp(prefix='corpusloom-checkpoint-')}"
        _scratch.append((spark, folder))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder; what is there is removed when the process ends."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


@atexit.register
def _clear() -> None:
    while _scratch:
        spark, path = _scratch.pop()
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended: its folders go with the cluster's scratch space
            return


def kept(df: DataFrame) -> DataFrame:
    """df, checkpointed to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def left_counted(df: DataFrame, counts: DataFrame, key: str | list[str], n: str = "n", above: int = HOT_ROWS) -> DataFrame:
    """df, left-joined with counts, which has one row per key and how many rows of df have it; keys of one row may be left out.

    Few keys are broadcast all. Else the most frequent ones are, HOT_KEYS at most, and their rows stay
    where they are; any other key has `above` rows at most, or a share below one in HOT_KEYS.
    """
    keys = [key] if isinstance(key, str) else key
    counts = kept(counts)
    if counts.limit(HOT_KEYS + 1).count() <= HOT_KEYS:
        return df.join(F.broadcast(counts), keys, "left")
    hot = kept(counts.filter(F.col(n) > above).orderBy(F.desc(n), *keys).limit(HOT_KEYS))
    met = df.join(F.broadcast(hot), keys, "left")
    rest = met.filter(F.col(n).isNull()).select(df.columns).join(counts, keys, "left")
    return met.filter(F.col(n).isNotNull()).unionByName(rest)
