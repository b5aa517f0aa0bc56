"""Signal measurement over clips made in the query, and streams. These have no SQL twin; tests hold them to known signals."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F

from corpusloom.operators import admission, dedup, policy, signal
from corpusloom.plans.base import query, spread, table

RATE = 16000


@lru_cache(maxsize=32)
def voice(seconds: float, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """What speechlike signals of a length share: the voice, and where there is noise in it."""
    t = np.arange(int(rate * seconds)) / rate
    return sum(np.sin(2 * np.pi * 130 * k * t) / k for k in range(1, 12)) * (0.5 + 0.5 * np.sin(2 * np.pi * 3 * t)), np.sin(2 * np.pi * 1.5 * t) > 0.8


def synthetic(kind: str, seconds: float, seed: int, rate: int = RATE) -> np.ndarray:
    """A signal of a kind: speechlike, tone, noise, silence, clipped."""
    n = int(rate * seconds)
    if kind == "speechlike":
        voiced, noisy = voice(seconds, rate)
        x = voiced + 0.1 * np.random.default_rng(seed).standard_normal(n) * noisy
        return 0.6 * x / np.abs(x).max()
    if kind == "noise":
        return 0.1 * np.random.default_rng(seed).standard_normal(n)
    t = np.arange(n) / rate
    if kind == "tone":
        return 0.5 * np.sin(2 * np.pi * 440 * t)
    if kind == "clipped":
        return np.clip(3 * np.sin(2 * np.pi * 220 * t), -1, 1)
    return np.zeros(n)


KINDS = ("speechlike", "tone", "noise", "silence", "clipped")


def encoded(kind: str, seconds: float, seed: int = 0) -> bytes:
    return signal.write_wav(signal.to_pcm16(synthetic(kind, seconds, seed))[0], RATE)


#: Clips of kinds without noise, which no seed changes.
steady = lru_cache(maxsize=32)(encoded)


def made(doc_id: int, n_chars: int) -> bytes:
    kind, seconds = KINDS[doc_id % 5], 0.5 + n_chars % 7 / 2
    return encoded(kind, seconds, doc_id) if kind in ("speechlike", "noise") else steady(kind, seconds)


def sources(spark, sf_dir):  # noqa: ANN001, ANN201
    """What clips are made of, where they are measured."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "n_chars"))


def measured(spark, sf_dir):  # noqa: ANN001, ANN201
    return signal.measure(sources(spark, sf_dir), ("doc_id", "n_chars"), load=made)


@query()
def wav_measure(spark, sf_dir):  # noqa: ANN001, ANN201
    m = measured(spark, sf_dir)
    return m.select("doc_id", *(F.col(f"measured.{c}").alias(c) for c in ("status", "sample_rate", "n_samples", "rms", "peak", "clipping_ratio", "max_clipped_run", "bandwidth_hz", "flatness", "hum_ratio", "noise_floor_db")), F.size("measured.speech").alias("n_speech"), F.size("measured.noise_events").alias("n_noise"))


@query()
def segment_plan(spark, sf_dir):  # noqa: ANN001, ANN201
    m = measured(spark, sf_dir)
    return m.select("doc_id", F.posexplode("measured.segments").alias("n", "s")).select("doc_id", "n", "s.start_s", "s.end_s", "s.uncertain")


@query()
def wav_verdict(spark, sf_dir):  # noqa: ANN001, ANN201
    """Measurement in one Arrow pass, then the technical verdict and the policy as expressions."""
    m = measured(spark, sf_dir)
    v = admission.technical_verdict(signal.technical_columns())
    evidence = m.withColumns({k: v[k] for k in ("verdict", "low_bandwidth_suspected")}).select(
        F.concat(F.lit("seg_"), F.col("doc_id").cast("string")).alias("segment_id"), "verdict", "low_bandwidth_suspected", F.lit(0).cast("bigint").alias("interval_start_sample"), F.col("measured.n_samples").alias("interval_end_sample"), F.col("measured.sample_rate").alias("analysis_sample_rate"),
        (F.aggregate("measured.speech", F.lit(0.0), lambda a, x: a + x["end"] - x["start"]) / F.col("measured.duration_s")).alias("speech_ratio"), F.col("measured.clipping_ratio").alias("clipping_ratio"), F.col("measured.noise_events").alias("noise_events"), F.array().cast("array<double>").alias("speaker_overlap_intervals"),
        *(F.lit(False).alias(c) for c in ("avail_music", "avail_quality", "avail_speaker")), F.lit("UNKNOWN").alias("quality_status"), F.lit("UNKNOWN").alias("speaker_status"), *(F.lit(None).cast("double").alias(c) for c in ("sig", "bak", "ovrl")), F.lit("NOT_APPLICABLE").alias("transcript_match_status"), F.lit("REDISTRIBUTION_APPROVED").alias("rights_status"), F.lit(True).alias("redistribution_permitted"),
    )
    return policy.decide(evidence).select("segment_id", "verdict", "decision", F.array_join("reason_codes", "|").alias("reason_codes"))


@query()
def wav_render(spark, sf_dir):  # noqa: ANN001, ANN201
    r = signal.render(sources(spark, sf_dir), ("doc_id", "n_chars"), load=made)
    return r.select("doc_id", "rendered.sha256", "rendered.n_samples", "rendered.clipped", "rendered.status")


@query()
def wav_fingerprints(spark, sf_dir):  # noqa: ANN001, ANN201
    """Fingerprints and their bucket keys, which near-duplicate groups are found by."""
    m = signal.fingerprints(sources(spark, sf_dir), ("doc_id", "n_chars"), "fp", load=made)
    return m.select("doc_id", F.size("fp").alias("n_bins"), F.array_join(dedup.sign_keys(F.col("fp"), dedup.hyperplanes(32)).cast("array<string>"), ",").alias("keys"))
