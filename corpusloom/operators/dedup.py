"""Exact and near duplicates of hashed and vectored items, and leakage-safe splits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions.ids import hash_fraction
from corpusloom.operators.skew import kept, left_counted

SPLIT_SEED, SPLIT_RATIOS = 20260924, (0.8, 0.1, 0.1)


def exact_groups(df: DataFrame, key: str, digest: str) -> DataFrame:
    """(digest, n, members): sorted members of each digest that several rows have; an empty digest is no group."""
    some = df.filter(F.coalesce(F.col(digest), F.lit("")) != "")
    return some.groupBy(digest).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(key)).alias("members")).filter("n > 1")


def first_wins(df: DataFrame, key: str, digest: str) -> DataFrame:
    """df with duplicate_of: the least key of the same digest, null for the first itself.

    The first of each digest is an aggregate that combines before its shuffle, and only digests of
    several rows are joined, the most frequent ones by broadcast: a frequent digest gathers nowhere.
    """
    d = F.coalesce(F.concat(F.lit("="), F.col(digest).cast("string")), F.lit(""))
    first = df.groupBy(d.alias("__d")).agg(F.min(key).alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    out = left_counted(df.withColumn("__d", d), first, "__d", "__n")
    return out.withColumn("duplicate_of", F.when(F.col("__first") < F.col(key), F.col("__first"))).drop("__first", "__d", "__n")


def new_rows(df: DataFrame, seen: DataFrame, digest: str, key: str) -> DataFrame:
    """Rows whose digest was not seen before, the first of each digest."""
    fresh = first_wins(df.join(seen.select(digest).distinct(), digest, "left_anti"), key, digest)
    return fresh.filter("duplicate_of is null").drop("duplicate_of")


def group_key(speaker: Column, source: Column, own: Column) -> Column:
    """What must not be split: the speaker, else the source, else the item; empty counts as absent."""
    blank = lambda c: F.when(c.cast("string") != "", c.cast("string"))
    return F.coalesce(blank(speaker), blank(source), own.cast("string"))


def split_of(group: Column | str, ratios: tuple[float, float, float] = SPLIT_RATIOS, seed: int = SPLIT_SEED) -> Column:
    """train, validation or test by the hash of the group: no shuffle, and more rows never move earlier ones."""
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    at = hash_fraction(seed, group)
    return F.when(at < ratios[0], "train").when(at < ratios[0] + ratios[1], "validation").otherwise("test")


def leaking_groups(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups that stand in several splits."""
    pairs = df.select(group, split).distinct()
    return pairs.groupBy(group).agg(F.count(F.lit(1)).alias("n_splits"), F.array_join(F.array_sort(F.collect_list(split)), ",").alias("splits")).filter("n_splits > 1")


def hyperplanes(dim: int, tables: int = 8, planes: int = 16, seed: int = 1234) -> np.ndarray:
    """Random planes, table by table: shape (tables, dim, planes)."""
    rng = np.random.default_rng(seed)
    return np.stack([rng.standard_normal((dim, planes)) for _ in range(tables)])


def sign_keys(vector: Column, planes: np.ndarray) -> Column:
    """array<bigint>: for each table the number whose bit i is set if the vector lies on plane i's side. One product of matrices per batch."""
    tables, dim, n = planes.shape
    flat = np.concatenate(list(planes), axis=1)

    @F.pandas_udf("array<bigint>")
    def keys(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        side = np.stack(vectors.to_numpy()).astype(np.float64) @ flat >= 0
        return pd.Series(list(side.reshape(-1, tables, n).astype(np.int64) @ (1 << np.arange(n))))

    return keys(vector)


#: Vectors of a bucket that meet others in a task's memory at once.
BLOCK = 2048


def representatives(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector, copies): of rows with equal vectors the one with the least key, for all of them."""
    return df.groupBy(F.col(vector)).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies")).select(key, vector, "copies")


def members(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, representative): which row stands for each row in pairs."""
    reps = df.groupBy(F.col(vector)).agg(F.min(key).alias("representative"), F.count(F.lit(1)).alias("__n"))
    return left_counted(df.select(key, vector), reps, vector, "__n").select(key, "representative")


def _forest(alike: np.ndarray) -> list[tuple[int, int]]:
    """Links that join whatever a symmetric matrix joins, fewer than its rows: from each node to those first reached by it."""
    new, out = alike.any(0), []
    for root in range(len(alike)):
        if not new[root]:
            continue
        new[root], front = False, np.array([root])
        while len(front):
            rows = alike[front]
            reached = np.flatnonzero(rows.any(0) & new)
            out += zip(front[rows[:, reached].argmax(0)].tolist(), reached.tolist())
            new[reached], front = False, reached
    return out


def _bucket_pairs(reps: DataFrame, key: str, vector: str, planes: np.ndarray, threshold: float | None, joined: bool = False) -> DataFrame:
    """(a, b, cosine), a < b, of vectors of one bucket with a cosine from the threshold on; joined: only so many as join all that they join.

    Only vectors that share a bucket are moved. A bucket is dealt into blocks of about BLOCK by a hash
    of the key, and each two blocks meet as two matrices. A pair comes out of the first table alone
    whose bucket it shares.
    """
    kind = reps.schema[key].dataType
    keyed = kept(reps.filter(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"), sign_keys(F.col(vector), planes).alias("keys")))
    rows = keyed.select("id", F.posexplode("keys").alias("t", "k"))
    sizes = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = left_counted(rows, sizes, ["t", "k"]).filter("n is not null").withColumn("nb", F.ceil(F.col("n") / BLOCK))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("id"), "nb")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    rows = rows.select("id", "t", "k", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    dealt = rows.join(keyed, "id").repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("cosine", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("t", "k", "i", "j", "side", "id", "v", "keys"))))
        for (t, _, i, j), group in groupby(rows, key=lambda r: r[:4]):
            side, ids, v, keys = (list(x) for x in list(zip(*group))[4:])
            side, v, keys = np.array(side), np.array(v, np.float64), np.array(keys)
            cos = v @ v.T
            alike = np.ones(cos.shape, bool) if threshold is None else cos >= threshold
            np.fill_diagonal(alike, False)
            if i != j:  # members of one block meet elsewhere
                alike &= side[:, None] != side
            if joined:
                pairs = _forest(alike)
            else:
                x, y = np.nonzero(np.triu(alike))
                first = ~(keys[x, :t] == keys[y, :t]).any(1)
                pairs = list(zip(x[first].tolist(), y[first].tolist()))
            for lo in range(0, len(pairs), 10_000):
                out = [(*sorted((ids[x], ids[y])), float(cos[x, y])) for x, y in pairs[lo : lo + 10_000]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def candidate_pairs(df: DataFrame, key: str, vector: str, planes: np.ndarray) -> DataFrame:
    """(a, b) with a < b of representatives (see members) that share a bucket in some table: unlike vectors all, equal ones never."""
    return _bucket_pairs(representatives(df, key, vector), key, vector, planes, None).select("a", "b")


def cosine(a: Column, b: Column) -> Column:
    """Of unit vectors: the dot product, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def similar_pairs(df: DataFrame, key: str, vector: str, planes: np.ndarray, threshold: float) -> DataFrame:
    """(a, b, cosine) of the candidate pairs from the threshold on: between representatives, whose other rows members() names."""
    return _bucket_pairs(representatives(df, key, vector), key, vector, planes, threshold)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each is connected to; labels spread along edges and jump.

    Each round's labels are checkpointed. A node of many edges, or a component of many nodes, is
    joined by its count (see left_counted).
    """
    both = kept(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    degrees = kept(both.groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    labels = kept(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        near = left_counted(both, labels.select(F.col("node").alias("b"), "component").join(degrees, "b"), "b").groupBy("a").agg(F.min("component").alias("m"))
        once = kept(labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("was"), F.least("component", "m").alias("mid")))
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far")).join(once.groupBy("mid").agg(F.count(F.lit(1)).alias("n")), "mid")
        new = kept(left_counted(once, jump, "mid").select("node", "was", F.coalesce(F.least("far", "mid"), "mid").alias("component")))
        labels = new.select("node", "component")
        if new.filter("was <> component").isEmpty():
            return labels


def near_groups(df: DataFrame, key: str, vector: str, planes: np.ndarray, threshold: float = 0.985) -> DataFrame:
    """(component, n, members) of more than one item. Buckets give only the links that join their members; equal vectors are alike."""
    reps = representatives(df, key, vector)
    labels = components(_bucket_pairs(reps, key, vector, planes, threshold, joined=True))
    copied = reps.filter((F.col("copies") > 1) & (cosine(F.col(vector), F.col(vector)) >= threshold)).select(F.col(key).alias("representative"), F.col(key).alias("own"))
    rows = members(df, key, vector).join(labels.withColumnRenamed("node", "representative"), "representative", "left").join(copied, "representative", "left")
    rows = rows.withColumn("component", F.coalesce("component", "own")).filter("component is not null")
    return rows.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(key)).alias("members"))


def numbered(df: DataFrame, order: list[str], start: int = 1, name: str = "number") -> DataFrame:
    """df with a dense global number in the given order.

    Range-partitioned, counted per partition and offset: no task sees all rows. The rows are
    checkpointed so that both passes see the same partitions.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id())
    dealt = kept(dealt)
    counts = dealt.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))  # a row per partition
    within = dealt.withColumn("__i", F.col("__m").bitwiseAND((1 << 33) - 1))
    return within.join(F.broadcast(offsets), "__p").withColumn(name, (F.col("__o") + F.col("__i") + start).cast("bigint")).drop("__p", "__m", "__i", "__o")
