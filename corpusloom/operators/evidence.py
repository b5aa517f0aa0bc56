"""Evidence rows: segments with their share of a clip's measurements, and rejections without segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import short_id


def excluded(events: Column) -> Column:
    """The events that cut a clip: of the gravest severity, or music alone."""
    return F.filter(events, lambda e: (e["severity"] == "N3") | (e["label"] == "MUSIC_ONLY"))


def sliced(events: Column, start: Column, end: Column) -> Column:
    """Events that overlap [start, end) strictly, in seconds of it; what an event says stays."""
    inside = F.filter(events, lambda e: (e["end_s"] > start) & (e["start_s"] < end))
    return F.transform(inside, lambda e: e.withField("start_s", F.greatest(e["start_s"], start) - start).withField("end_s", F.least(e["end_s"], end) - start))


def speech_share(speech: Column, start: Column, end: Column) -> Column:
    """The share of [start, end) that (disjoint) speech intervals cover, 1 at most."""
    covered = F.aggregate(speech, F.lit(0.0), lambda a, x: a + F.greatest(F.lit(0.0), F.least(x["end"], end) - F.greatest(x["start"], start)))
    return F.least(F.lit(1.0), covered / F.greatest(F.lit(1e-9), end - start))


def planned(segments: Column, duration: Column, most: float = 12.0) -> Column:
    """The planned segments; of a clip without any the whole clip, most seconds of it."""
    whole = F.array(F.struct(F.lit(0.0).alias("start_s"), F.least(duration, F.lit(most)).alias("end_s"), F.lit(False).alias("uncertain")))
    return F.when(F.coalesce(F.size(segments), F.lit(0)) < 1, whole).otherwise(segments)


def is_segmented(segments: Column, duration: Column, slack: float = 0.2) -> Column:
    """Several segments, or one that leaves out more than the slack."""
    total = F.aggregate(segments, F.lit(0.0), lambda a, s: a + s["end_s"] - s["start_s"])
    return (F.size(segments) > 1) | (total < duration - slack)


def assemble(clips: DataFrame, m: str = "measured", min_duration: float = 3.0, max_duration: float = 12.0, no_split: bool = False) -> DataFrame:
    """Evidence rows of measured clips: one per segment, exploded after the measurement, never measured again.

    early is set instead of a decision for a clip that is short or, under no_split, would be cut:
    those have one row of the whole clip.
    """
    c = lambda n: F.col(f"{m}.{n}")
    seg = planned(c("segments"), c("duration_s"), max_duration)
    df = clips.filter(c("status") == "OK").withColumn("__seg", seg).withColumn("segmented", is_segmented(F.col("__seg"), c("duration_s")))
    short = c("duration_s") < min_duration
    cut = F.lit(no_split) & F.col("segmented")
    whole = F.array(F.struct(F.lit(0.0).alias("start_s"), c("duration_s").alias("end_s"), F.lit(False).alias("uncertain")))
    early = F.when(short, F.array(F.lit("DURATION_TOO_SHORT"))).when(cut, F.array(F.lit("REQUIRES_SEGMENTATION")))
    df = df.withColumn("early", early).withColumn("__seg", F.when(short | cut, whole).otherwise(F.col("__seg")))
    rows = df.select("*", F.posexplode("__seg").alias("segment_no", "__s")).drop("__seg")
    s, e = F.col("__s.start_s"), F.col("__s.end_s")
    return rows.withColumns({
        "interval_start_sample": F.floor(s * c("sample_rate")).cast("bigint"), "interval_end_sample": F.floor(e * c("sample_rate")).cast("bigint"), "analysis_sample_rate": c("sample_rate"), "speech_ratio": speech_share(c("speech"), s, e), "noise_events": sliced(c("noise_events"), s, e),
        "clipping_ratio": c("clipping_ratio"), "boundary_uncertain": F.col("__s.uncertain"), "transcript_trusted": ~F.col("segmented") & ~F.col("__s.uncertain"),
    }).drop("__s")


def rejected(sources: DataFrame, stage: str, reasons: Column, decision: str = "REJECT_TECH", sha: str = "source_sha256") -> DataFrame:
    """One evidence row per rejected source: an id of the content and the stage (of an error also its reason), no interval."""
    parts = [F.col(sha), F.lit(stage)] + ([F.get(reasons, F.lit(0))] if stage == "error" else [])
    zero = F.lit(0).cast("bigint")
    return sources.select(short_id(*parts, prefix="SEG_").alias("segment_id"), F.col(sha), zero.alias("interval_start_sample"), zero.alias("interval_end_sample"), F.lit(16000).alias("analysis_sample_rate"), F.lit(decision).alias("decision"), reasons.alias("reason_codes"))


def probe_usable(size: Column, recorded: Column, codec: Column) -> Column:
    """Whether a probe of ingest may be used again: the size is known, above 0 and unchanged, and the codec was found."""
    return F.coalesce((recorded > 0) & (size == recorded) & codec.isNotNull(), F.lit(False))
