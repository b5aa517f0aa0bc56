"""Explicit schemas of the records, and the values that their enumerations allow. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the enumerations.
MEASUREMENT = ("OK", "NOT_APPLICABLE", "UNKNOWN", "ERROR")
RIGHTS = ("REDISTRIBUTION_APPROVED", "TRAIN_ONLY", "LICENSE_REVIEW", "FORBIDDEN", "UNKNOWN")
DECISION = ("ACCEPT", "REVIEW", "REJECT", "REJECT_TECH", "ERROR", "LICENSE_REVIEW")
SEVERITY = ("N0", "N1", "N2", "N3", "NX")
BATCH_STATUS = ("PLANNED", "IN_PROGRESS", "BATCH_PROCESSED", "RELEASE_READY", "DONE", "BLOCKED")
SPLITS = ("train", "validation", "test")


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "bigint": T.LongType(), "int": T.IntegerType(), "array<string>": T.ArrayType(T.StringType())}


def _of(**fields: str) -> T.StructType:
    """A struct of named types; DDL would need a session at import."""
    return T.StructType([T.StructField(k, _TYPES[v]) for k, v in fields.items()])


NOISE_EVENT = _of(label="string", start_s="double", end_s="double", overlaps_speech="boolean", severity="string", confidence="double", score="double", detector="string", model_revision="string")
INTERVALS = T.ArrayType(_of(start="double", end="double"))
SOURCE_RECORD = _of(
    source_id="string", source_uri="string", source_revision="string", original_file_id="string", source_sha256="string", source_bytes="bigint", source_mime="string", source_container="string", source_codec="string", source_lossy="boolean", source_sample_rate="int", source_channels="int", source_duration_s="double", source_rate_class="string",
    effective_bandwidth_hz="double", low_bandwidth_suspected="boolean", source_license="string", license_evidence_uri="string", rights_owner="string", consent_reference="string", consent_scope="string", rights_status="string", redistribution_permitted="boolean", commercial_training_permitted="string", attribution_required="boolean",
    source_split="string", source_speaker_ref="string", source_transcript="string", source_language="string", ingest_status="string", ingestion_timestamp_utc="string", staged_path="string", reason_codes="array<string>", schema_version="string",
)
REVIEW_ITEM = _of(segment_id="string", source_id="string", decision="string", reason_codes="array<string>", evidence_ref="string")
CHECKPOINT_EVENT = _of(run_id="string", item_id="string", state="string", ts_utc="string")
GOLD_CLIP = _of(clip_id="string", path="string", split="string", source_id="string", speaker_id="string", recording_family="string", is_clean="boolean", labels="array<string>", severity="string", domain="string")
INVENTORY_ITEM = _of(path="string", size="bigint", expected_sha256="string", index="bigint")
CANONICAL_ROW = _of(audio="string", text="string", file_name="string", speaker="string", duration="double", language="string")
HANDOFF_ROW = _of(id="string", audio="string", transcript="string", language="string", speaker_id="string", split="string", license="string", consent="string")


def closed_rows(lines: DataFrame, schema: T.StructType, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON lines with exactly the schema's keys: parsed fields, and error (null if the row keeps the contract).

    Missing and extra keys are named in sorted order; text that is no JSON object is an error of its own.
    """
    want = F.array(*(F.lit(f.name) for f in schema))
    keys = F.json_object_keys(F.col(column))
    missing, extra = F.array_sort(F.array_except(want, keys)), F.array_sort(F.array_except(keys, want))
    error = F.when(keys.isNull(), "NOT_AN_OBJECT").when((F.size(missing) > 0) | (F.size(extra) > 0), F.concat(F.lit("KEYS:missing="), F.array_join(missing, ","), F.lit(";extra="), F.array_join(extra, ",")))
    return lines.select(*(keep or []), F.from_json(column, schema).alias("__r"), error.alias("error")).select(*(keep or []), "__r.*", "error")


def one_of(c: Column, values: tuple[str, ...]) -> Column:
    return F.coalesce(c.isin(*values), F.lit(False))
