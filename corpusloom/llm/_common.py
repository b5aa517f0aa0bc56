"""What several operators share: tables in the shared folder, batch sizes, text as numpy arrays."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch that goes to a Python worker; bounds a worker's memory.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
#: Bytes that a writing task holds of a table before it puts them out.
ROW_GROUP_BYTES = 32 << 20
#: Keys that may be broadcast with a few numbers each.
HOT_KEYS = 50_000

_written: list[tuple[SparkSession, str]] = []
atexit.register(lambda: release())


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session and make the package importable on its workers."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = (spark.conf.get(name) or "").rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    root = str(Path(__file__).resolve().parents[2])
    seen = {os.path.realpath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if root not in seen and os.path.realpath(root) not in seen and not getattr(spark.sparkContext, "_corpusloom", False):
        import shutil

        folder = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/corpusloom", "zip", root, "corpusloom"))
        spark.sparkContext._corpusloom = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or (only where that is unset) an own one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"file://{tempfile.mkdtemp(prefix='corpusloom-shared-')}"
        spark.sparkContext.setCheckpointDir(base)
        _written.append((spark, base))
    return base.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder; it is removed when this process ends, or by release()."""
    path = f"{shared_dir(spark)}/corpusloom/{what}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialise(df: DataFrame, what: str, folded: bool = False) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again.

    folded: the table comes from a shuffle and has a known small bound; it is written by at most two
    tasks per core, which spares thousands of tiny files where Spark does not merge small partitions.

    This cuts the lineage: a lost executor costs at most the tasks of the stage that runs, and a
    Python pass that several later plans read runs once.
    """
    spark = df.sparkSession
    path = new_path(spark, what)
    if folded:
        df = df.coalesce(max(8, 2 * spark.sparkContext.defaultParallelism))
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, n: int) -> DataFrame:
    """df, of n rows that are a job each, one by one over as many tasks as there is use for."""
    return df.repartition(max(1, min(n, 4 * df.sparkSession.sparkContext.defaultParallelism)))


def hottest(counts: DataFrame, n: str, above: int) -> DataFrame:
    """The rows of counts (one per key) with the largest n, of those above the bound: HOT_KEYS at most, so they may be broadcast.

    Any other key has n rows up to the bound, or less than one in HOT_KEYS of all rows.
    """
    key = [c for c in counts.columns if c != n]
    return materialise(counts.filter(F.col(n) > above).orderBy(F.desc(n), *key).limit(HOT_KEYS), "hottest", folded=True)


def join_counted(df: DataFrame, counts: DataFrame, key: str, n: str, above: int) -> DataFrame:
    """df with the columns of counts, written tables of which counts has one row per key and how many rows of df have it (n).

    Few keys are broadcast all; else those of the most rows are, and no task gets more than `above` rows of another.
    """
    if counts.limit(HOT_KEYS + 1).count() <= HOT_KEYS:
        return df.join(F.broadcast(counts), key)
    hot = hottest(counts, n, above)
    met = df.join(F.broadcast(hot), key, "left")
    rest = met.filter(F.col(n).isNull()).select(df.columns).join(counts.join(F.broadcast(hot.select(key)), key, "left_anti"), key)
    return met.filter(F.col(n).isNotNull()).unionByName(rest)


def release() -> None:
    """Remove the tables of materialise(). Results that still read them must have been written before."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended: its folders go with the cluster's scratch space
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def codepoints(text: str) -> np.ndarray:
    """The code points of a text, one uint32 each."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply); wraps silently."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
