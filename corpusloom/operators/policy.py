"""The verdict engine: ten three-valued checks per segment, combined fail-closed into six decisions.

Measurements are columns; every check is an expression that gives PASS, FAIL or UNKNOWN and never a
SQL null. Nothing here runs Python on rows, so a policy over a whole corpus is one narrow stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import fixed

PASS, FAIL, UNKNOWN = "PASS", "FAIL", "UNKNOWN"
CHECKS = ("has_speech", "duration_ok", "source_bandwidth_ok", "no_clipping", "no_confirmed_music_overlap", "no_severe_noise_overlap", "no_interfering_speech", "quality_ok", "transcript_ok", "rights_ok")
#: Ranks of severities; one that is not known ranks with the worst. Fixed values.
SEVERITY_RANK = {"N0": 0, "N1": 1, "N2": 2, "N3": 3}
NOISE_LABELS = ("HISS_STATIC", "HUM_BUZZ", "ENV_CONTINUOUS", "REVERB_ECHO")


@dataclass(frozen=True)
class Policy:
    """What a release demands. Floors that are None are not applied."""

    version: str = "policy-1"
    required: tuple[str, ...] = CHECKS
    min_speech_ratio: float = 0.5
    max_clip_ratio: float = 0.01
    min_duration_s: float = 3.0
    max_duration_s: float = 12.0
    max_noise_severity: str = "N1"
    forbid_music: bool = True
    single_speaker: bool = False
    target: str = "public"
    floors: dict[str, float | None] = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, raw: dict) -> Policy:
        """From a parsed configuration: a version and the required checks must be there, unknown keys are ignored."""
        for key in ("policy_version", "required_checks"):
            if key not in raw:
                raise ValueError(f"the policy lacks {key}")
        names = {"min_speech_ratio": "min_speech_ratio", "max_clip_ratio": "max_clip_ratio", "min_duration_s": "min_duration_s", "max_duration_s": "max_duration_s", "hiss_overlap_max_severity": "max_noise_severity", "music_overlap_forbidden": "forbid_music", "single_speaker_required": "single_speaker", "release_target": "target"}
        floors = {k: raw.get(f"min_quality_{k}") for k in ("sig", "bak", "ovrl")}
        return cls(version=raw["policy_version"], required=tuple(raw["required_checks"]), floors=floors, **{v: raw[k] for k, v in names.items() if k in raw})


def severity_rank(c: Column) -> Column:
    out = F.lit(3)
    for k, v in SEVERITY_RANK.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _check(*cases: tuple[Column, str, Column | str | None], last: str = PASS) -> tuple[Column, Column]:
    """(result, reason) of the first case that holds; a null condition does not hold."""
    result, reason = F.lit(last), F.lit(None).cast("string")
    for when, value, why in reversed(cases):
        why = F.lit(why) if isinstance(why, str) or why is None else why
        result = F.when(_yes(when), value).otherwise(result)
        reason = F.when(_yes(when), why.cast("string")).otherwise(reason)
    return result, reason


def checks(p: Policy, bandwidth: Column | None = None) -> dict[str, tuple[Column, Column]]:
    """Each check's (result, reason) over the columns of an evidence row; bandwidth, if measured, is told in its reason."""
    c = F.col
    said = lambda text, *parts: F.concat(F.lit(text), *(F.lit(x) if isinstance(x, str) else x for x in parts))
    suspected = F.lit("SUSPECTED_UPSAMPLED_SOURCE")
    if bandwidth is not None:
        suspected = F.concat(suspected, F.coalesce(said(":eff_bw=", fixed(bandwidth, 0), "Hz"), F.lit("")))
    events = c("noise_events")  # a null array has no events: what it gives is null, and a null condition does not hold
    length = (c("interval_end_sample") - c("interval_start_sample")) / c("analysis_sample_rate")
    no_time = c("analysis_sample_rate").isNull() | (c("analysis_sample_rate") == 0) | (c("interval_end_sample") <= c("interval_start_sample"))
    time_ok = F.when(~_yes(no_time), length)
    music = F.exists(events, lambda e: (e["label"] == "MUSIC_BACKGROUND") & e["overlaps_speech"] & (severity_rank(e["severity"]) >= 2))
    worst = F.array_max(F.transform(F.filter(events, lambda e: e["overlaps_speech"] & e["label"].isin(*NOISE_LABELS)), lambda e: severity_rank(e["severity"])))
    rights = c("rights_status")
    out = {
        "has_speech": _check((c("speech_ratio").isNull(), UNKNOWN, "SPEECH_RATIO_UNKNOWN"), (c("speech_ratio") < p.min_speech_ratio, FAIL, said("NO_SPEECH:ratio=", fixed(c("speech_ratio"), 2)))),
        "duration_ok": _check((no_time, UNKNOWN, "DURATION_UNKNOWN"), (time_ok < p.min_duration_s, FAIL, said("DURATION_TOO_SHORT:", fixed(time_ok, 2), f"s<{p.min_duration_s:.1f}s")), (time_ok > p.max_duration_s, FAIL, said("DURATION_TOO_LONG:", fixed(time_ok, 2), f"s>{p.max_duration_s:.1f}s"))),
        "source_bandwidth_ok": _check((c("low_bandwidth_suspected"), UNKNOWN, suspected)),
        "no_clipping": _check((F.exists(events, lambda e: (e["label"] == "CLIPPING_DISTORTION") & (e["severity"] == "N3")), FAIL, "CLIPPING_CONFIRMED_N3"), (c("clipping_ratio") > p.max_clip_ratio, FAIL, said("CLIPPING_RATIO:", fixed(c("clipping_ratio"), 4)))),
        "no_confirmed_music_overlap": _check((~_yes(c("avail_music")), UNKNOWN, "MUSIC_GATE_UNAVAILABLE"), (music, FAIL, "MUSIC_OVERLAP_CONFIRMED")) if p.forbid_music else _check(),
        "no_severe_noise_overlap": _check((worst > SEVERITY_RANK.get(p.max_noise_severity, 1), FAIL, f"NOISE_OVERLAP_SEVERITY>{p.max_noise_severity}")),
        "no_interfering_speech": _check((~_yes(c("avail_speaker")) | (c("speaker_status") == UNKNOWN), UNKNOWN, "SPEAKER_GATE_UNAVAILABLE"), (F.size(c("speaker_overlap_intervals")) > 0, FAIL, "INTERFERING_SPEECH_CONFIRMED")) if p.single_speaker else _check(),
        "transcript_ok": _check((c("transcript_match_status").isin("OK", "NOT_APPLICABLE"), PASS, None), (c("transcript_match_status") == "ERROR", FAIL, "TRANSCRIPT_MISMATCH"), (F.lit(True), UNKNOWN, "TRANSCRIPT_UNVERIFIED")),
    }
    cases: list = [(~_yes(c("avail_quality")) | ~_yes(c("quality_status") == "OK"), UNKNOWN, "QUALITY_MODEL_UNAVAILABLE")]
    for name in ("sig", "bak", "ovrl"):
        if (floor := p.floors.get(name)) is not None:
            cases += [(c(name).isNull(), UNKNOWN, f"QUALITY_{name.upper()}_UNKNOWN"), (c(name) < floor, FAIL, said(f"QUALITY_{name.upper()}_BELOW:", fixed(c(name), 2), f"<{floor:.2f}"))]
    out["quality_ok"] = _check(*cases)
    if p.target == "public":
        good, why = (rights == "REDISTRIBUTION_APPROVED") & c("redistribution_permitted"), "RIGHTS_NOT_REDISTRIBUTABLE:"
    else:
        good, why = rights.isin("REDISTRIBUTION_APPROVED", "TRAIN_ONLY"), "RIGHTS_INSUFFICIENT:"
    out["rights_ok"] = _check((good, PASS, None), (F.lit(True), FAIL, F.concat(F.lit(why), F.coalesce(rights, F.lit("")))))
    return {k: out[k] for k in CHECKS}


def combine(results: dict[str, Column], p: Policy) -> Column:
    """The decision. A required check that is not known counts as UNKNOWN; rights alone failing is a matter of licence review."""
    need = {k: results.get(k, F.lit(UNKNOWN)) for k in p.required}
    none = F.lit(False)
    failed = none
    failed_else = none
    unknown = none
    for k, v in need.items():
        failed = failed | (v == FAIL)
        unknown = unknown | (v == UNKNOWN)
        if k != "rights_ok":
            failed_else = failed_else | (v == FAIL)
    rights = need["rights_ok"] == FAIL if "rights_ok" in need else none
    return F.when(rights & ~failed_else, "LICENSE_REVIEW").when(failed, "REJECT").when(_yes(F.col("rights_status").isin("LICENSE_REVIEW", "UNKNOWN")), "LICENSE_REVIEW").when(unknown, "REVIEW").otherwise("ACCEPT")


def decide(evidence: DataFrame, p: Policy | None = None) -> DataFrame:
    """evidence with observed_checks (a map), reason_codes (in the order of the checks) and decision."""
    p = p or Policy()
    found = checks(p, F.col("effective_bandwidth_hz") if "effective_bandwidth_hz" in evidence.columns else None)
    out = evidence.select("*", *(r.alias(f"__c_{k}") for k, (r, _) in found.items()), *(w.alias(f"__w_{k}") for k, (_, w) in found.items()))
    results = {k: F.col(f"__c_{k}") for k in found}
    observed = F.create_map(*(x for k in found for x in (F.lit(k), results[k])))
    reasons = F.filter(F.array(*(F.col(f"__w_{k}") for k in found)), lambda x: x.isNotNull())
    out = out.withColumns({"observed_checks": observed, "reason_codes": reasons, "decision": combine(results, p)})
    return out.drop(*(c for c in out.columns if c.startswith("__")))


def review_queue(decided: DataFrame) -> DataFrame:
    """What a person must look at. Rejections are not in it."""
    keep = decided.filter(F.col("decision").isin("REVIEW", "ERROR", "LICENSE_REVIEW"))
    return keep.withColumn("evidence_ref", F.concat(F.lit("evidence/"), F.col("segment_id"), F.lit(".json")))


def terminal_decision(decided: DataFrame, key: str, order: str) -> DataFrame:
    """One decision per source: the gravest of its segments', of equal ones the first."""
    rank = F.when(F.col("decision") == "REJECT_TECH", 4).when(F.col("decision") == "REJECT", 3).when(F.col("decision") == "ACCEPT", 1).otherwise(2)
    return decided.groupBy(key).agg(F.max_by("decision", F.struct(rank.alias("r"), (-F.col(order)).alias("o"))).alias("decision"))
