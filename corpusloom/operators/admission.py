"""Which sources come in: rate classes, codecs, the technical gate and admission."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codec names, by whether they lose information. Fixed values.
LOSSLESS = ("pcm_s8", "pcm_u8", "pcm_s16le", "pcm_s16be", "pcm_s24le", "pcm_s24be", "pcm_s32le", "pcm_s32be", "pcm_f32le", "pcm_f32be", "pcm_f64le", "pcm_f64be", "flac", "alac", "wavpack", "tta", "truehd", "mlp")
LOSSY = ("mp3", "mp3float", "aac", "aac_latm", "vorbis", "opus", "ac3", "eac3", "wmav1", "wmav2", "amr_nb", "amrnb", "amr_wb", "amrwb", "gsm", "gsm_ms", "g723_1", "g729", "nellymoser", "qdm2", "cook", "pcm_mulaw", "pcm_alaw", "adpcm_ms", "adpcm_ima_wav", "adpcm_ima_qt", "adpcm_g726", "adpcm_swf", "adpcm_yamaha")


@dataclass(frozen=True)
class Admission:
    native_rate: int = 24000
    conditional_rate: int = 22050
    low_rate: int = 16000
    reject_low: bool = True
    reject_narrow: bool = True


@dataclass(frozen=True)
class Technical:
    min_duration_s: float = 0.2
    max_duration_s: float = 12.0
    max_pre_segment_s: float = 600.0
    segment_over_max: bool = False
    max_dc: float = 0.02
    max_clipping: float = 0.01
    min_rms: float = 1e-4
    tolerance_s: float = 0.05
    bandwidth_warn: float = 0.45
    nyquist_hz: float = 12000.0


def rate_class(rate: Column, a: Admission = Admission()) -> Column:  # noqa: B008
    return F.when(rate >= a.native_rate, "NATIVE_OR_HIGHER").when(rate >= a.conditional_rate, "BELOW_MIN_NATIVE").when(rate >= a.low_rate, "LOW_BANDWIDTH_SOURCE").otherwise("NARROWBAND_SOURCE")


def lossy(codec: Column) -> Column:
    """true, false or null: an unknown codec is never a reason to reject."""
    c = F.lower(F.trim(codec))
    return F.when(c.isin(*LOSSLESS), False).when(c.isin(*LOSSY), True)


def reasons(*cases: tuple[Column, Column | str]) -> Column:
    """The texts of the cases that hold, in their order."""
    return F.filter(F.array(*(F.when(F.coalesce(w, F.lit(False)), F.lit(t) if isinstance(t, str) else t) for w, t in cases)), lambda x: x.isNotNull())


def admission(rate: Column, codec: Column, low_bandwidth: Column, a: Admission = Admission(), bandwidth: Column | None = None) -> dict[str, Column]:  # noqa: B008
    """source_rate_class, action, admitted, source_lossy and ordered reason_codes. A rate that can't be measured is an error."""
    none = F.coalesce(rate <= 0, F.lit(True))
    kind, loss = rate_class(rate, a), lossy(codec)
    is_ = lambda k: ~none & (kind == k)
    text = rate.cast("string")
    return {
        "source_rate_class": F.when(~none, kind),
        "action": F.when(none, "ERROR").when(kind == "NATIVE_OR_HIGHER", "IDENTITY").when(kind == "BELOW_MIN_NATIVE", "REJECT_BELOW_MIN_NATIVE").when(kind == "LOW_BANDWIDTH_SOURCE", "REJECT_LOW_BANDWIDTH").otherwise("REJECT_NARROWBAND"),
        "admitted": F.when(none, False).when(kind == "NATIVE_OR_HIGHER", True).when(kind == "BELOW_MIN_NATIVE", False).when(kind == "LOW_BANDWIDTH_SOURCE", not a.reject_low).otherwise(not a.reject_narrow),
        "source_lossy": loss,
        "reason_codes": reasons(
            (none, "SOURCE_SAMPLE_RATE_UNMEASURABLE"),
            (~none, F.concat(F.lit("SOURCE_RATE_CLASS:"), kind, F.lit(":sr="), text)),
            (~none & loss, F.concat(F.lit("SOURCE_LOSSY:codec="), codec)),
            (~none & low_bandwidth, F.concat(F.lit("SUSPECTED_UPSAMPLED_SOURCE:eff_bw="), F.lit("None") if bandwidth is None else F.coalesce(bandwidth.cast("double").cast("string"), F.lit("None")))),
            (is_("BELOW_MIN_NATIVE"), F.concat(F.lit("BELOW_MIN_NATIVE:sr="), text, F.lit(f"<min={a.native_rate}"))),
            (is_("LOW_BANDWIDTH_SOURCE"), "LOW_BANDWIDTH_SOURCE"),
            (is_("NARROWBAND_SOURCE"), "NARROWBAND_SOURCE"),
        ),
    }


def technical_verdict(m: dict[str, Column], t: Technical = Technical()) -> dict[str, Column]:  # noqa: B008
    """verdict, valid, low_bandwidth_suspected and reason codes from measured columns.

    m has n_samples, rms, clipping_ratio, dc_offset, has_nan, has_inf, duration_s, declared_s,
    bandwidth_hz and sample_rate. An offset or a wrong declared duration is a reason, not a reject.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    empty, quiet, clipped = m["n_samples"] == 0, m["rms"] < t.min_rms, m["clipping_ratio"] > t.max_clipping
    broken = yes(empty) | yes(m["has_nan"]) | yes(m["has_inf"])
    short, over = m["duration_s"] < t.min_duration_s, m["duration_s"] > t.max_duration_s
    salvage = F.lit(t.segment_over_max) & over & (m["duration_s"] <= t.max_pre_segment_s)
    low = (m["sample_rate"] > 0) & (m["bandwidth_hz"] < t.bandwidth_warn * F.least(m["sample_rate"] / 2.0, F.lit(t.nyquist_hz)))
    hard = broken | yes(quiet) | yes(clipped)
    verdict = F.when(hard | yes(short), "REJECT_TECH").when(yes(salvage), "SEGMENT_CANDIDATE").when(yes(over), "REJECT_TECH").otherwise("VALID")
    mismatch = (m["duration_s"] > 0) & (F.abs(m["declared_s"] - m["duration_s"]) > F.greatest(F.lit(t.tolerance_s), 0.02 * m["duration_s"]))
    timed = ~broken
    return {
        "verdict": verdict,
        "valid": verdict.isin("VALID", "SEGMENT_CANDIDATE"),
        "low_bandwidth_suspected": yes(low),
        "reason_codes": reasons((m["has_nan"], "NAN_SAMPLES"), (m["has_inf"], "INF_SAMPLES"), (empty, "EMPTY_AUDIO"), (quiet, "SILENT_OR_NO_SPEECH_LEVEL"), (clipped, "CLIPPING"), (F.abs(m["dc_offset"]) > t.max_dc, "DC_OFFSET"), (low, "LOW_BANDWIDTH_SUSPECTED"), (timed & short, "TOO_SHORT"), (timed & salvage, "OVER_MAX_DURATION_SEGMENT_CANDIDATE"), (timed & over & ~yes(salvage), "TOO_LONG"), (mismatch, "DURATION_MISMATCH")),
    }


def classify_error(kind: Column, status: Column, message: Column) -> Column:
    """permanent, rate_limited, disk_full or transient, by the error's name, HTTP status and message. The first that fits wins."""
    low, yes = F.lower(F.coalesce(message, F.lit(""))), lambda c: F.coalesce(c, F.lit(False))
    gone = yes(kind.isin("RepositoryNotFoundError", "RevisionNotFoundError", "EntryNotFoundError", "RemoteEntryNotFoundError", "GatedRepoError", "DisabledRepoError"))
    gone = gone | F.substring(low, 1, 60).contains("404") | yes(status.isin(401, 403, 404))
    full = low.contains("no space left") | low.contains("disk quota")
    return F.when(gone, "permanent").when(yes(status == 429), "rate_limited").when(yes(status.between(500, 599)), "transient").when(full, "disk_full").otherwise("transient")


def size_profile(size: Column, small: int = 5 << 20, large: int = 500 << 20) -> dict[str, Column]:
    """Aggregates over an inventory: profile, n, n_small, n_large, total_bytes."""
    n, few, many = F.count(size), F.count_if(size >= large), F.count_if(size <= small)
    return {"profile": F.when(n == 0, "empty").when((few > 0) & (few * 2 >= n), "few_large").when(many * 2 >= n, "many_small").otherwise("mixed"), "n": n, "n_small": many, "n_large": few, "total_bytes": F.coalesce(F.sum(size), F.lit(0))}
