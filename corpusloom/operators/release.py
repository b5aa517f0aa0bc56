"""Releases, canonical rows and the handoff: validation by the first rule that fails, identities, upserts, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import SEPARATOR, short_id, text
from corpusloom.functions.text import language_code
from corpusloom.operators.dedup import numbered
from corpusloom.schemas import SPLITS

MAX_DURATION = 12.0
#: Names that stand for a licence or a consent that is not known. Fixed values.
UNKNOWN_LICENSES = ("UNKNOWN", "UNLICENSED", "NONE", "NULL", "N/A", "NA", "", "SPECIMEN", "UNSPECIFIED", "UNSPECIFIED-OPERATOR-DECLARED", "UNKNOWN-OPERATOR-DECLARED")
UNKNOWN_CONSENT = ("UNKNOWN", "UNSPECIFIED", "UNLICENSED", "NONE", "NULL", "N/A", "NA", "")


def first_of(*rules: tuple[Column, Column | str]) -> Column:
    """The text of the first rule that does not hold; a null condition does not hold. null if all do."""
    out = F.lit(None).cast("string")
    for ok, why in reversed(rules):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(why) if isinstance(why, str) else why).otherwise(out)
    return out


def release_blocker(target: str = "train_only") -> Column:
    """Why a row may not be released, or null."""
    c = F.col
    rules = [
        (c("quality_gate") == "ACCEPT", "NOT_ACCEPT"),
        ((c("sample_rate") > 0) & (c("channels") == 1) & (c("encoding") == "PCM_S16LE"), "NOT_MONO_PCM16"),
        (~c("audio").startswith("/") & ~F.get(F.split("audio", "/"), F.lit(0)).contains(":"), "ABSOLUTE_PATH"),
        ((F.length("audio_sha256") == 64) & (F.length("source_sha256") == 64), "MALFORMED_SHA256"),
        ((c("duration_s") > 0) & (c("duration_s") <= MAX_DURATION), "DURATION_OUT_OF_POLICY"),
    ]
    if target == "public":
        rules.append(((c("rights_status") == "REDISTRIBUTION_APPROVED") & c("redistribution_permitted"), "NOT_REDISTRIBUTABLE"))
    return first_of(*rules)


def build_release(rows: DataFrame, audio: DataFrame, target: str = "train_only") -> DataFrame:
    """rows with blocker: row rules, then audio missing, then a hash that differs. audio: audio_id, sha256."""
    out = rows.join(audio.select("audio_id", F.col("sha256").alias("__sha")), "audio_id", "left")
    seen = first_of((F.col("__sha").isNotNull(), "AUDIO_MISSING"), (F.col("__sha") == F.col("audio_sha256"), "AUDIO_SHA_MISMATCH"))
    return out.withColumn("blocker", F.coalesce(release_blocker(target), seen)).drop("__sha")


def canonical_error(prefix: str = "clip") -> Column:
    """The first broken rule of a canonical six-field row, or null."""
    c = F.col
    return first_of(
        (c("audio").isNotNull() & c("file_name").isNotNull() & c("text").isNotNull() & c("speaker").isNotNull() & c("language").isNotNull(), "NOT_A_STRING"),
        (c("audio") == c("file_name"), "AUDIO_NE_FILE_NAME"),
        (c("audio").rlike(rf"^audio/[0-9a-f]{{2}}/(?:{prefix.lower()}_[0-9a-f]{{32}}|{prefix}_[0-9]{{7,}})\.wav$"), "BAD_AUDIO_PATH"),
        (F.trim("text") != "", "EMPTY_TEXT"),
        (c("speaker").rlike(r"^spk_[0-9a-f]{32}$"), "BAD_SPEAKER"),
        (c("duration").isNotNull() & ~F.isnan("duration") & (F.abs("duration") < float("inf")), "DURATION_NOT_FINITE"),
        (c("duration") > 0, "DURATION_NONPOSITIVE"),
        ((c("language") != "") & (F.length("language") <= 10), "BAD_LANGUAGE"),
    )


def export_blocker(public: bool = True) -> Column:
    """Why a sample may not be exported, or null."""
    c = F.col
    allowed = ("REDISTRIBUTION_APPROVED",) if public else ("REDISTRIBUTION_APPROVED", "TRAIN_ONLY")
    rules = [(c("rights_status").isin(*allowed), F.concat(F.lit("RIGHT_NOT_PERMITTED:"), text("rights_status")))]
    if public:
        rules.append((c("redistribution_permitted"), "REDISTRIBUTION_FLAG_FALSE"))
    return first_of(*rules, (c("split").isin(*SPLITS), F.concat(F.lit("UNKNOWN_SPLIT:"), text("split"))), (c("transcript_verified") & (F.trim("text") != ""), "TRANSCRIPT_UNVERIFIED"), (c("language_verified") & language_code(c("language")).isNotNull(), "LANGUAGE_UNVERIFIED"))


def safe_audio_path(c: Column) -> Column:
    """A relative path below a split or audio/, without steps up, empty or dot parts, colons or backslashes."""
    head = F.get(F.split(c, "/"), F.lit(0))
    return (c != "") & (c == F.trim(c)) & c.rlike(r"^[^/:\\][^:\\]*$") & ~c.contains("../") & ~c.contains("//") & ~c.rlike(r"(^|/)\./") & ~c.endswith("..") & head.isin(*SPLITS, "audio")


def handoff_error() -> Column:
    """The first broken rule of a handoff row, or null."""
    c = F.col
    solid = lambda n: c(n).isNotNull() & (F.trim(n) != "")
    return first_of(
        (solid("id"), "ID"), (solid("audio") & safe_audio_path(c("audio")), "AUDIO_PATH"), (solid("transcript"), "TRANSCRIPT"), (language_code(c("language")).isNotNull(), "LANGUAGE"), (c("speaker_id").rlike(r"^spk_[0-9a-f]{32}$"), "SPEAKER"),
        (c("split").isin(*SPLITS), "SPLIT"), (c("audio").startswith(F.concat(c("split"), F.lit("/"))), "AUDIO_OUTSIDE_SPLIT"), (~F.upper(F.trim("license")).isin(*UNKNOWN_LICENSES), "LICENSE_UNKNOWN"), (~F.upper(F.trim("consent")).isin(*UNKNOWN_CONSENT), "CONSENT_UNKNOWN"),
    )


def handoff_rows(rows: DataFrame, provenance: DataFrame, default_consent: str = "redistribution-approved") -> DataFrame:
    """Canonical rows with their provenance's licence and consent, and error (no provenance is one)."""
    p = provenance.select(F.col("id").alias("__id"), F.col("license").alias("__license"), F.col("consent").alias("__consent"))
    rid = F.regexp_extract("file_name", r"([^/]+)\.wav$", 1)
    out = rows.join(p, rid == F.col("__id"), "left")
    consent = F.coalesce(F.when(F.trim("__consent") != "", F.col("__consent")), F.lit(default_consent))
    out = out.select(rid.alias("id"), F.concat("split", F.lit("/"), "audio").alias("audio"), F.col("text").alias("transcript"), language_code(F.col("language")).alias("language"), F.col("speaker").alias("speaker_id"), "split", F.trim("__license").alias("license"), consent.alias("consent"), F.col("__id").isNull().alias("__none"))
    return out.withColumn("error", F.when(F.col("__none"), "NO_PROVENANCE").otherwise(handoff_error())).drop("__none")


def sample_key(schema: str, revision: Column, source_id: Column, sha: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(SEPARATOR, F.lit(schema), text(revision), text(source_id), text(sha), text(start), text(end))


def allocate_ids(keys: DataFrame, known: DataFrame, counter: int, order: list[str], prefix: str = "clip") -> DataFrame:
    """(key, id, reused): known keys keep their id, new ones get the next numbers in order.

    The caller commits the new ids and the counter before anything uses them.
    """
    old = keys.join(known.select("key", "id"), "key").select("key", "id", F.lit(True).alias("reused"))
    first = keys.join(known.select("key"), "key", "left_anti").groupBy("key").agg(F.min(F.struct(*order)).alias("__o")).select("key", "__o.*")
    new = numbered(first, [*order, "key"], counter + 1, "__n").select("key", F.concat(F.lit(f"{prefix}_"), F.lpad(F.col("__n").cast("string"), 7, "0")).alias("id"), F.lit(False).alias("reused"))
    return old.distinct().unionByName(new)


def speaker_id(scope: Column, speaker: Column, key: Column, verified: Column) -> Column:
    """One id per speaker within a source; an unverified speaker is one of its own for each sample. Hash-derived, so runs agree."""
    named = F.coalesce(verified, F.lit(False)) & F.coalesce(speaker != "", F.lit(False))
    return F.concat(F.lit("spk_"), F.when(named, short_id(F.lit("speaker"), scope, speaker, length=32)).otherwise(short_id(F.lit("sample"), key, length=32)))


def upsert(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, outcome): kept, reused (identical), conflict (same key, other fields) or added."""
    a = old.select(F.col(key).alias("__a"), F.struct(*fields).alias("__x"))
    b = new.select(F.col(key).alias("__b"), F.struct(*fields).alias("__y"))
    met = a.join(b, F.col("__a") == F.col("__b"), "full_outer")
    same = F.col("__x").eqNullSafe(F.col("__y"))
    return met.select(F.coalesce("__a", "__b").alias(key), F.when(F.col("__b").isNull(), "kept").when(F.col("__a").isNull(), "added").when(same, "reused").otherwise("conflict").alias("outcome"))


def canonical_errors(rows: DataFrame, audio: DataFrame, prefix: str = "clip", tolerance: float = 0.01) -> DataFrame:
    """(code, subject): rows against files. audio: split, path, sample_rate, channels, sample_width, duration."""
    pattern = rf"^audio/[0-9a-f]{{2}}/(?:{prefix.lower()}_[0-9a-f]{{32}}|{prefix}_[0-9]{{7,}})\.wav$"
    files = audio.select(F.col("split").alias("__s"), F.col("path").alias("__p"), "sample_rate", "channels", "sample_width", F.col("duration").alias("__d"))
    met = rows.join(files, (F.col("split") == F.col("__s")) & (F.col("audio") == F.col("__p")), "full_outer")
    has_row, has_file = F.col("file_name").isNotNull(), F.col("__p").isNotNull()
    both = has_row & has_file

    def per_row(code: str, bad: Column) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), code)

    codes = F.array(
        per_row("AUDIO_NE_FILE_NAME", has_row & (F.col("audio") != F.col("file_name"))), per_row("BAD_AUDIO_PATH", has_row & ~F.col("audio").rlike(pattern)), per_row("DANGLING_METADATA", has_row & ~has_file), per_row("ORPHAN_AUDIO", has_file & ~has_row),
        per_row("BAD_SAMPLE_RATE", both & (F.col("sample_rate") <= 0)), per_row("NOT_MONO", both & (F.col("channels") != 1)), per_row("NOT_PCM16", both & (F.col("sample_width") != 2)), per_row("DURATION_MISMATCH", both & (F.abs(F.col("__d") - F.col("duration")) > tolerance)),
    )
    found = met.select(F.explode(F.filter(codes, lambda x: x.isNotNull())).alias("code"), F.coalesce("file_name", "__p").alias("subject"))
    twice = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("DUPLICATE_ROW").alias("code"), F.col("file_name").alias("subject"))
    leak = rows.select("speaker", "split").distinct().groupBy("speaker").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("SPEAKER_SPLIT_LEAK").alias("code"), F.col("speaker").alias("subject"))
    return reduce(DataFrame.unionByName, [found, twice, leak])


def release_errors(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(code, subject): absolute paths, missing audio, hashes and rates that differ. files: path, sha256, sample_rate, channels, sample_width."""
    f = files.select(F.col("path").alias("__p"), F.col("sha256").alias("__h"), F.col("sample_rate").alias("__r"), F.col("channels").alias("__c"), F.col("sample_width").alias("__w"))
    met = rows.join(f, F.col("audio") == F.col("__p"), "left")
    absolute = F.col("audio").startswith("/") | F.get(F.split("audio", "/"), F.lit(0)).contains(":")
    here = ~absolute & F.col("__p").isNotNull()
    case = lambda code, bad: F.when(F.coalesce(bad, F.lit(False)), code)
    codes = F.array(case("ABSOLUTE_PATH", absolute), case("AUDIO_MISSING", ~absolute & F.col("__p").isNull()), case("SHA_MISMATCH", here & ~F.col("__h").eqNullSafe(F.col("audio_sha256"))), case("SR_MISSING", here & F.coalesce(F.col("sample_rate") <= 0, F.lit(True))), case("SR_MISMATCH", here & (F.col("sample_rate") > 0) & (F.col("__r") != F.col("sample_rate"))), case("NOT_MONO", here & (F.col("__c") != 1)), case("NOT_PCM16", here & (F.col("__w") != 2)))
    return met.select(F.explode(F.filter(codes, lambda x: x.isNotNull())).alias("code"), F.col("audio_id").alias("subject"))


def accepted_to_release(accepted: DataFrame, prefix: str = "AUD") -> DataFrame:
    """Release rows of accepted segments: ids by audio hash, anonymous speakers and language where none is known."""
    lang = F.coalesce(F.when(F.col("source_language") != "", F.col("source_language")), F.lit("vi"))
    return accepted.withColumns({
        "language": lang,
        "audio_id": F.concat(F.lit(f"{prefix}_"), lang, F.lit("_"), short_id("audio_sha256", length=12)),
        "speaker_id": F.coalesce(F.when(F.col("source_speaker_ref") != "", F.col("source_speaker_ref")), F.concat(F.lit("anon_"), short_id("source_sha256", length=10))),
        "rights_evidence_id": F.concat(F.lit("RIGHTS_"), short_id("source_id", length=10)),
        "transcript": F.when(F.col("segmented"), "").otherwise(text("source_transcript")),
    })


def sidecar_override(rows: DataFrame, sidecar: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """rows with the sidecar's fields where it has the key: its presence counts, even with a null."""
    s = sidecar.select(F.col(key).alias("__k"), *(F.col(f).alias(f"__{f}") for f in fields))
    out = rows.join(s, F.col(key) == F.col("__k"), "left")
    return out.withColumns({f: F.when(F.col("__k").isNotNull(), F.col(f"__{f}")).otherwise(F.col(f)) for f in fields}).drop("__k", *(f"__{f}" for f in fields))
