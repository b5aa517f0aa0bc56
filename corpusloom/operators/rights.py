"""Rights of sources, by explicit declarations; fail-closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Declarations up to which they are broadcast; beyond, the prefix join goes by the prefixes' lengths.
BROADCAST_DECLARATIONS = 10_000


def evaluate(sources: DataFrame, declarations: DataFrame, key: str = "source_id", uri: str = "source_uri", license_col: str | None = "source_license") -> DataFrame:
    """sources with rights_status, redistribution_permitted, commercial_training_permitted, license and rights_reason.

    declarations: seq, source_id, uri_prefix, rights_status, redistribution_permitted,
    commercial_training_permitted, source_license. One by id wins, else the longest matching prefix
    (ties: the first declared). The prefix match is an equality on a prefix of the URI, one
    candidate row for each distinct length of a prefix, so no cross join is needed at any size.
    """
    d = declarations.select("seq", "source_id", "uri_prefix", F.struct("rights_status", "redistribution_permitted", "commercial_training_permitted", "source_license").alias("d"))
    by_id = d.filter("source_id is not null").groupBy("source_id").agg(F.min_by("d", "seq").alias("__by_id")).withColumnRenamed("source_id", "__sid")
    prefixes = d.filter("uri_prefix <> ''").groupBy("uri_prefix").agg(F.min_by("d", "seq").alias("__by_prefix")).withColumnRenamed("uri_prefix", "__prefix")
    lengths = [r[0] for r in prefixes.select(F.length("__prefix")).distinct().collect()]  # as many as the longest prefix has characters, at most
    hint = F.broadcast if declarations.limit(BROADCAST_DECLARATIONS + 1).count() <= BROADCAST_DECLARATIONS else (lambda x: x)
    out = sources.join(hint(by_id), F.col(key) == F.col("__sid"), "left").drop("__sid")
    if lengths:
        fits = F.filter(F.lit(sorted(lengths)), lambda n: n <= F.length("__u"))
        found = sources.select(F.col(uri).alias("__u")).distinct().withColumn("__n", F.explode(fits))
        found = found.withColumn("__cut", F.substring("__u", F.lit(1), F.col("__n"))).join(hint(prefixes), F.col("__cut") == F.col("__prefix"))
        longest = found.groupBy("__u").agg(F.max_by("__by_prefix", "__n").alias("__by_prefix"))
        out = out.join(longest, F.col(uri) == F.col("__u"), "left").drop("__u")
    else:
        out = out.withColumn("__by_prefix", F.lit(None).cast(d.schema["d"].dataType))
    chosen = F.coalesce("__by_id", "__by_prefix")
    declared = F.col(license_col) if license_col else F.lit(None).cast("string")
    return out.withColumns(judged(chosen, declared)).drop("__by_id", "__by_prefix")


def judged(d: Column, declared: Column) -> dict[str, Column]:
    status = F.coalesce(d["rights_status"], F.lit("LICENSE_REVIEW"))
    flag = F.coalesce(d["redistribution_permitted"], F.lit(False))
    clash = flag & (status != "REDISTRIBUTION_APPROVED")
    blank = lambda c: F.when(c != "", c)
    return {
        "rights_status": F.when(d.isNull() | clash, "LICENSE_REVIEW").otherwise(status),
        "redistribution_permitted": F.when(d.isNull() | clash, False).otherwise(flag),
        "commercial_training_permitted": F.when(d.isNull(), "UNKNOWN").otherwise(F.coalesce(d["commercial_training_permitted"], F.lit("UNKNOWN"))),
        "license": F.coalesce(blank(declared), F.when(d.isNotNull(), blank(d["source_license"])), F.lit("UNKNOWN")),
        "rights_reason": F.when(d.isNull(), "no declaration").when(clash, "flag without approval").otherwise("declared"),
    }


def job_rights(status: Column, redistribute: Column) -> dict[str, Column]:
    """Rights of a job entry: an unknown status is UNKNOWN; redistribution only if approved."""
    s = F.upper(F.trim(status))
    known = F.when(F.coalesce(s.isin("REDISTRIBUTION_APPROVED", "TRAIN_ONLY", "LICENSE_REVIEW", "FORBIDDEN", "UNKNOWN"), F.lit(False)), s).otherwise("UNKNOWN")
    return {"rights_status": known, "redistribution_permitted": (known == "REDISTRIBUTION_APPROVED") & F.coalesce(redistribute, F.lit(False))}


def rights_report(rows: DataFrame) -> DataFrame:
    """One row: sorted distinct licences and statuses, and the number of distinct sources."""
    return rows.agg(F.array_sort(F.collect_set("license")).alias("licenses"), F.array_sort(F.collect_set("rights_status")).alias("statuses"), F.countDistinct("source_id").alias("n_sources"))


def first_rows(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter("__n = 1").drop("__n")
