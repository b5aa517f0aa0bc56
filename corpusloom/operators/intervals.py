"""Interval algebra per key: rows (key, start, end); numbers of any type.

Unions are gaps-and-islands over a running maximum, so a key's intervals need one sort and no
self-join; intersection and difference are joins on the key and the island's reach.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(df: DataFrame, key: str = "key", gap=0) -> DataFrame:  # noqa: ANN001
    """Intervals that overlap, touch or lie at most gap apart become one."""
    w = Window.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(key, "start", "end", F.when(F.col("start") - reach <= gap, 0).otherwise(1).alias("__new"))
    grouped = marked.withColumn("__g", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(key, "__g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__g")


def dilate(df: DataFrame, pad, most, key: str = "key") -> DataFrame:  # noqa: ANN001
    return merge(df.select(key, F.greatest(F.lit(0), F.col("start") - pad).alias("start"), F.least(F.lit(most), F.col("end") + pad).alias("end")), key)


def bins(start: Column, end: Column, width: int) -> Column:
    """The bins of a width that an interval meets: an equality for joins on overlap."""
    return F.sequence(F.floor(start / width), F.floor(end / width))


def overlap_join(a: DataFrame, b: DataFrame, width: int, key: str = "key") -> DataFrame:
    """(key, a_start, a_end, b_start, b_end) of pairs that overlap strictly, each once.

    Both sides are cut into bins, and a pair counts in the bin where the later one begins: the join is an
    equality on key and bin and stays so for keys with many intervals.
    """
    left = a.select(key, F.col("start").alias("a_start"), F.col("end").alias("a_end"), F.explode(bins(F.col("start"), F.col("end"), width)).alias("__bin"))
    right = b.select(key, F.col("start").alias("b_start"), F.col("end").alias("b_end"), F.explode(bins(F.col("start"), F.col("end"), width)).alias("__bin"))
    met = left.join(right, [key, "__bin"]).filter((F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end")))
    return met.filter(F.col("__bin") == F.floor(F.greatest("a_start", "b_start") / width)).drop("__bin")


def intersect(a: DataFrame, b: DataFrame, width: int, key: str = "key") -> DataFrame:
    """What both unions cover."""
    met = overlap_join(merge(a, key), merge(b, key), width, key)
    return met.select(key, F.greatest("a_start", "b_start").alias("start"), F.least("a_end", "b_end").alias("end"))


def subtract(a: DataFrame, b: DataFrame, key: str = "key", sliver=0) -> DataFrame:  # noqa: ANN001
    """What a covers and b does not; pieces of at most sliver are dropped.

    A sweep: ends of the merged intervals in order, with running counts of either side.
    """
    ends = reduce(DataFrame.unionByName, [merge(x, key).select(key, F.col(c).alias("at"), F.lit(da * s).alias("da"), F.lit(db * s).alias("db")) for x, da, db in ((a, 1, 0), (b, 0, 1)) for c, s in (("start", 1), ("end", -1))])
    at = ends.groupBy(key, "at").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    w = Window.partitionBy(key).orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = at.select(key, F.col("at").alias("start"), F.lead("at").over(w).alias("end"), F.sum("da").over(run).alias("__a"), F.sum("db").over(run).alias("__b"))
    left = swept.filter((F.col("__a") > 0) & (F.col("__b") == 0) & F.col("end").isNotNull()).select(key, "start", "end")
    # a neighbour that only touches belongs to the same piece of a's union unless b lies between
    return merge(left, key).filter(F.col("end") - F.col("start") > sliver)


def covered(df: DataFrame, key: str = "key") -> DataFrame:
    return merge(df, key).groupBy(key).agg(F.sum(F.col("end") - F.col("start")).alias("covered"), F.count(F.lit(1)).alias("n_islands"))


def windows(df: DataFrame, duration: str, width, hop, key: str = "key") -> DataFrame:  # noqa: ANN001
    """(key, n, start, end): windows of a width every hop; the last ends at the duration; a short one is one window."""
    d = F.col(duration)
    count = F.when(d <= width, F.lit(1)).otherwise(F.ceil((d - width) / hop).cast("int") + 1)
    rows = df.select(key, d.alias("__d"), F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("n"))
    return rows.select(key, "n", (F.col("n") * hop).alias("start"), F.least(F.col("n") * hop + width, F.col("__d")).alias("end"))


def active_runs(df: DataFrame, order: str, active: Column, key: str = "key", least: int = 1) -> DataFrame:
    """(key, first, length) of runs of rows that are active, in order."""
    w = Window.partitionBy(key).orderBy(order)
    marked = df.select(key, F.row_number().over(w).alias("i"), active.alias("on")).filter("on")
    grouped = marked.withColumn("g", F.col("i") - F.row_number().over(Window.partitionBy(key).orderBy("i")))
    return grouped.groupBy(key, "g").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("length")).filter(F.col("length") >= least).drop("g")


def clip_events(events: DataFrame, segments: DataFrame, width: int, key: str = "key") -> DataFrame:
    """Events cut to the segments that they overlap strictly, in seconds of the segment: (key, seg_start, seg_end, start, end)."""
    met = overlap_join(events, segments, width, key)
    return met.select(key, F.col("b_start").alias("seg_start"), F.col("b_end").alias("seg_end"), (F.greatest("a_start", "b_start") - F.col("b_start")).alias("start"), (F.least("a_end", "b_end") - F.col("b_start")).alias("end"))


def nearest(points: DataFrame, targets: DataFrame, tolerance, key: str = "key") -> DataFrame:  # noqa: ANN001
    """(key, t, point): each target's nearest point within a tolerance (ties: the earlier), else null.

    Points and targets are merged in one ordered pass: the last point before and the first one after
    are window functions, so no pairs are formed.
    """
    p = points.select(key, F.col("point").alias("at"), F.col("point").alias("p"), F.lit(None).cast(points.schema["point"].dataType).alias("t"))
    t = targets.select(key, F.col("t").alias("at"), F.lit(None).cast(points.schema["point"].dataType).alias("p"), "t")
    both = p.unionByName(t)
    w = Window.partitionBy(key).orderBy("at")
    before = F.last("p", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    after = F.first("p", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    near = both.select(key, "t", before.alias("b"), after.alias("a")).filter("t is not null")
    best = F.when(F.col("a").isNull() | (F.col("t") - F.col("b") <= F.col("a") - F.col("t")), F.col("b")).otherwise(F.col("a"))
    return near.select(key, "t", F.when(F.abs(best - F.col("t")) <= tolerance, best).alias("point"))


def local_minima(df: DataFrame, order: str, value: str, percentile: float = 0.2, key: str = "key") -> DataFrame:
    """Rows at or below their key's percentile that no neighbour undercuts; the first and last row are none."""
    w = Window.partitionBy(key).orderBy(order)
    floor = F.percentile(value, percentile).over(Window.partitionBy(key))
    near = df.select("*", F.lag(value).over(w).alias("__p"), F.lead(value).over(w).alias("__n"), floor.alias("__f"))
    return near.filter((F.col(value) <= F.col("__f")) & (F.col(value) <= F.col("__p")) & (F.col(value) <= F.col("__n"))).drop("__p", "__n", "__f")


def sessions(df: DataFrame, time: str, gap, key: str = "key") -> DataFrame:  # noqa: ANN001
    """(key, session_no, start, end, n): a session ends before a pause longer than gap."""
    w = Window.partitionBy(key).orderBy(time)
    new = F.when(F.col(time) - F.lag(time).over(w) <= gap, 0).otherwise(1)
    numbered = df.select(key, F.col(time).alias("__t"), new.alias("__new")).withColumn("session_no", F.sum("__new").over(Window.partitionBy(key).orderBy("__t").rangeBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "session_no").agg(F.min("__t").alias("start"), F.max("__t").alias("end"), F.count(F.lit(1)).alias("n"))
