"""Aggregations: funnels, calibration, strata, histograms. Ratios are plain doubles of integer counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def sections(*parts: tuple[str, DataFrame]) -> DataFrame:
    """(section, item, n) of several counts; each part has the columns item and n."""
    return reduce(DataFrame.unionByName, [d.select(F.lit(s).alias("section"), F.col("item").cast("string").alias("item"), F.col("n").cast("bigint").alias("n")) for s, d in parts])


def counts(df: DataFrame, by: Column | str) -> DataFrame:
    by = F.col(by) if isinstance(by, str) else by
    return df.groupBy(by.alias("item")).agg(F.count(F.lit(1)).alias("n"))


def funnel(decided: DataFrame) -> DataFrame:
    """Candidates, decisions and reason codes, counted: one pass for each."""
    total = decided.agg(F.lit("total").alias("item"), F.count(F.lit(1)).alias("n"))
    return sections(("candidates", total), ("decision", counts(decided, "decision")), ("reason", counts(decided.select(F.explode("reason_codes").alias("r")), "r")))


def accept_coverage(decided: DataFrame) -> DataFrame:
    n, ok = F.count(F.lit(1)), F.count_if(F.col("decision") == "ACCEPT")
    return decided.agg(n.alias("n_total"), ok.alias("n_accept"), ratio(ok, n).alias("accept_coverage"))


def confusion(df: DataFrame, truth: Column, said: Column, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and f1, zero-safe."""
    tp, fp, fn, tn = (F.count_if(c) for c in (truth & said, ~truth & said, truth & ~said, ~truth & ~said))
    got = df.groupBy(*(by or [])).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    got = got.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return got.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def error_rates(df: DataFrame, noisy: Column, decision: str = "decision") -> DataFrame:
    """Noisy ones accepted, and clean ones rejected, as fractions of the noisy and clean ones."""
    d = F.col(decision)
    return df.agg(ratio(F.count_if(noisy & (d == "ACCEPT")), F.count_if(noisy)).alias("false_accept_rate"), ratio(F.count_if(~noisy & d.isin("REJECT", "REJECT_TECH")), F.count_if(~noisy)).alias("false_reject_rate"))


def coverage(df: DataFrame, decision: str = "decision") -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_total"), *(ratio(F.count_if(F.col(decision) == d), n).alias(f"{d.lower()}_fraction") for d in ("ACCEPT", "REVIEW")))


def strata(gold: DataFrame) -> DataFrame:
    """Gold clips by split, domain and label, and clean against noisy."""
    clean = F.when(F.col("is_clean"), "clean").otherwise("noisy")
    return sections(("split", counts(gold, "split")), ("domain", counts(gold, "domain")), ("label", counts(gold.select(F.explode("labels").alias("l")), "l")), ("quality", counts(gold, clean)))


def shared_keys(gold: DataFrame, keys: dict[str, str], split: str = "split", calibration: str = "calibration") -> DataFrame:
    """(kind, shared) of keys that stand on both sides of the calibration split; must be empty."""
    side = F.col(split) == calibration
    return reduce(DataFrame.unionByName, [gold.groupBy(F.col(c).cast("string").alias("shared")).agg(F.bool_or(side).alias("a"), F.bool_or(~side).alias("b")).filter("a and b").select(F.lit(k).alias("kind"), "shared") for k, c in keys.items()])


def calibration(gold: DataFrame, decided: DataFrame, keys: dict[str, str], key: str = "clip_id") -> DataFrame:
    """Error rates over decided gold clips; raises if a key stands on both sides of the split."""
    if not shared_keys(gold, keys).isEmpty():
        raise ValueError("calibration and held-out clips share a source, speaker or family")
    return error_rates(gold.join(decided, key), ~F.col("is_clean"))


def split_statistics(df: DataFrame, duration: str = "duration", speaker: str = "speaker", language: str = "language") -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(speaker).alias("n_speakers"), F.array_join(F.array_sort(F.collect_set(language)), ",").alias("languages"), F.sum(duration).alias("total_duration"))


def homogeneity(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, n_values, homogeneous, mode): whether all rows of a source share a value, and the commonest (ties: the least)."""
    per = df.groupBy(by, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy(by).agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_values"), (F.count(F.lit(1)) == 1).alias("homogeneous"), F.min_by("v", F.struct((-F.col("k")).alias("k"), F.col("v").alias("v"))).alias("mode"))


def percentiles(df: DataFrame, by: str, value: str, at: tuple[float, ...]) -> DataFrame:
    """Exact percentiles with linear interpolation."""
    return df.groupBy(by).agg(*(F.percentile(value, p).alias(f"p{round(p * 100):02d}") for p in at))


def stratified_sample(df: DataFrame, key: str, size: str, n: int, by: str) -> DataFrame:
    """Of each group the smallest and the largest row and n - 2 more, spread evenly over the order of the key."""
    w, m = Window.partitionBy(by), max(1, n - 2)
    i, total = F.row_number().over(w.orderBy(key)) - 1, F.count(F.lit(1)).over(w)
    ranked = df.select("*", i.alias("__i"), total.alias("__c"), F.row_number().over(w.orderBy(size, key)).alias("__s"), F.row_number().over(w.orderBy(F.desc(size), F.desc(key))).alias("__l"))
    # picks are floor(k * count / m) for k below m: row i is one if the least k with k * count >= i * m lands on it
    k = F.ceil(F.col("__i") * m / F.col("__c"))
    even = (F.col("__c") <= m) | ((k < m) & (F.floor(k * F.col("__c") / m) == F.col("__i")))
    return ranked.filter(even | (F.col("__s") == 1) | (F.col("__l") == 1)).drop("__i", "__c", "__s", "__l")
