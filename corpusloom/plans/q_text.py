"""Scalar functions over text."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import signal
from corpusloom.plans.base import over, query, table


@query("SELECT doc_id FROM {documents} WHERE regexp_matches(text, 'hf_[A-Za-z0-9]{20,}|AKIA[0-9A-Z]{16}|-----BEGIN|token\\s*[:=]')".replace("{20,}", "{20,}"))
def secret_scan(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").filter(text.has_secret(F.col("text"))).select("doc_id")


@query("""SELECT item_id, trim(regexp_replace(regexp_replace(lower(trim(nfc_normalize(text))), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS normalized FROM {benchmark}""".replace("{benchmark}", "benchmark"))
def normalize_text(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "benchmark").select("item_id", text.normalize_transcript(F.col("text")).alias("normalized"))


_PLAIN = "SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '[^A-Za-z0-9 ]', '{g}') AS t FROM {conversations}"


@query("WITH p AS (" + _PLAIN.replace("'{g}'", "' ', 'g'") + r"""), n AS (SELECT *, trim(regexp_replace(lower(trim(t)), '\s+', ' ', 'g')) AS r, trim(regexp_replace(lower(trim(translate(t, 'aon', 'xy') || ' Zz')), '\s+', ' ', 'g')) AS h FROM p)
SELECT conv_id, turn, r AS said, CASE WHEN length(r) = 0 THEN 1.0::DOUBLE ELSE levenshtein(r, h)::DOUBLE / length(r) END AS cer FROM n""")
def char_error_rate(spark, sf_dir):  # noqa: ANN001, ANN201
    """Whole turns of conversations, their letters and digits of ASCII (which the twin counts right), against an edited copy."""
    p = over(spark, sf_dir, _PLAIN.replace("'{g}'", "' '"))
    return p.select("conv_id", "turn", text.normalize_transcript(F.col("t")).alias("said"), text.char_error_rate(F.col("t"), F.concat(F.translate("t", "aon", "xy"), F.lit(" Zz"))).alias("cer"))


@query()
def char_error_rate_whole(spark, sf_dir):  # noqa: ANN001, ANN201
    """Whole turns of conversations, all letters, against an edited copy; no twin, as DuckDB's levenshtein counts bytes."""
    c = table(spark, sf_dir, "conversations")
    r = F.coalesce("text", F.lit(""))
    h = F.concat(F.translate(r, "aon", "äó"), F.lit(" …"))  # a and o replaced, n dropped, two characters more
    return c.select("conv_id", "turn", text.normalize_transcript(r).alias("reference"), text.normalize_transcript(h).alias("hypothesis"), text.char_error_rate(r, h).alias("cer"))


@query("""SELECT conv_id, turn, CASE WHEN trim(coalesce(text, '')) = '' THEN 'NOT_APPLICABLE' WHEN role = 'system' THEN 'OK' WHEN turn % 3 = 0 THEN 'UNKNOWN' WHEN (turn % 5) / 8.0 > 0.35 THEN 'ERROR' ELSE 'UNKNOWN' END AS status FROM {conversations}""")
def transcript_status(spark, sf_dir):  # noqa: ANN001, ANN201
    c = table(spark, sf_dir, "conversations")
    hyp = F.when(F.col("turn") % 3 != 0, F.col("text"))
    return c.select("conv_id", "turn", text.transcript_status(F.col("text"), F.col("role") == "system", hyp, (F.col("turn") % 5) / 8.0).alias("status"))


TAGS = "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN ' vi-VN ' WHEN 1 THEN 'EN_us' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '-x' WHEN 5 THEN 'zh-Hant-TW' ELSE lang END AS tag FROM {documents}"


@query("WITH t AS (" + TAGS + ") SELECT doc_id, nullif(lower(trim(split_part(replace(trim(tag), '_', '-'), '-', 1))), '') AS code FROM t")
def language_code(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, TAGS).select("doc_id", text.language_code(F.col("tag")).alias("code"))


LICENSES = "SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN ' MIT ' WHEN 1 THEN 'CC-BY-4.0' WHEN 2 THEN 'openrail' WHEN 3 THEN NULL WHEN 4 THEN 'Apache-2.0' WHEN 5 THEN 'custom terms' WHEN 6 THEN 'other' ELSE 'lgpl-3.0' END AS l FROM {documents}"


@query("WITH t AS (" + LICENSES + ") SELECT doc_id, CASE WHEN lower(trim(l)) IN ('mit', 'cc-by-4.0', 'apache-2.0', 'lgpl-3.0') THEN lower(trim(l)) ELSE 'other' END AS license FROM t")
def license_map(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, LICENSES).select("doc_id", text.hub_license(F.col("l")).alias("license"))


URIS = "SELECT page_id, CASE page_id % 6 WHEN 0 THEN concat('hf://datasets/name@rev/p/', CAST(page_id AS STRING)) WHEN 1 THEN concat('hf://datasets/name/p/', CAST(page_id AS STRING)) WHEN 2 THEN concat('file:///data/d', CAST(page_id % 5 AS STRING), '/x.wav') WHEN 3 THEN '' WHEN 4 THEN NULL ELSE url END AS uri, CASE WHEN page_id % 4 = 0 THEN 'r2' ELSE 'r1' END AS rev FROM {pages}"


@query("WITH u AS (" + URIS + """) SELECT page_id, CASE WHEN coalesce(uri, '') = '' THEN 'rev:' || rev WHEN uri LIKE 'hf://datasets/name@%' THEN 'hf://datasets/name@rev' WHEN uri LIKE 'hf://%' THEN 'hf://datasets/name@' || rev WHEN uri LIKE 'file://%' THEN regexp_replace(uri, '/[^/]*$', '') ELSE uri END AS scope FROM u""")
def scope_of(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, URIS).select("page_id", text.source_scope(F.col("uri"), F.col("rev")).alias("scope"))


@query("""SELECT * FROM (VALUES ('org/name', 'org/name', NULL), ('org/name@v1', 'org/name', 'v1'), (' datasets/org/name/ ', 'org/name', NULL), ('https://huggingface.co/datasets/org/name', 'org/name', NULL), ('https://huggingface.co/datasets/org/name/tree/dev/x', 'org/name', 'dev'),
('https://huggingface.co/datasets/org/name/resolve/abc', 'org/name', 'abc'), ('https://example.com/datasets/org/name', NULL, NULL), ('org', NULL, NULL), ('a/b/c', NULL, NULL), ('org/..x', NULL, NULL), ('', NULL, NULL), ('org/name@ ', 'org/name', NULL)) t(ref, repo_id, revision)""")
def repo_ref(spark, sf_dir):  # noqa: ANN001, ANN201
    refs = ["org/name", "org/name@v1", " datasets/org/name/ ", "https://huggingface.co/datasets/org/name", "https://huggingface.co/datasets/org/name/tree/dev/x", "https://huggingface.co/datasets/org/name/resolve/abc", "https://example.com/datasets/org/name", "org", "a/b/c", "org/..x", "", "org/name@ "]
    got = text.repo_reference(F.col("ref"))
    return spark.createDataFrame([(r,) for r in refs], "ref string").select("ref", *(c.alias(k) for k, c in got.items()))


PATHS = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('clip_', lpad(CAST(doc_id AS STRING), 7, '0')) WHEN 1 THEN concat('clip_', md5(source)) WHEN 2 THEN concat('clip_', CAST(10000000 + doc_id AS STRING)) ELSE source END AS id FROM {documents}"


@query("WITH p AS (" + PATHS + ") SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN NULL WHEN 1 THEN 'audio/' || substr(id, 6, 2) || '/' || id || '.wav' ELSE 'audio/' || right(id, 2) || '/' || id || '.wav' END AS path FROM p")
def canonical_paths(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, PATHS).select("doc_id", text.sharded_path(F.col("id")).alias("path"))


@query("""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN source || '--' || lang || '--b' || doc_id % 7 END AS rid, source, lang FROM {documents}) SELECT doc_id, rid AS release_id, 'staging/' || rid AS staging_revision, 'releases/' || rid AS path_prefix, source || '__' || lang || '__c' || lpad(CAST(doc_id % 7 AS VARCHAR), 5, '0') AS chunk, regexp_replace(source || ' x/ü', '[^A-Za-z0-9._-]+', '_', 'g') AS safe FROM r""")
def release_names(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    got = text.release_names(F.col("source"), F.col("lang"), F.when(i % 5 == 0, ".b").otherwise(F.concat(F.lit("b"), (i % 7).cast("string"))))
    return d.select("doc_id", *(c.alias(k) for k, c in got.items()), text.chunk_name(F.col("source"), F.col("lang"), i % 7).alias("chunk"), text.safe_name(F.concat("source", F.lit(" x/ü"))).alias("safe"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, -0.08397278 * q * q + 1.22083953 * q + 0.0052439 AS sig, -0.13166888 * q * q + 1.60915514 * q + -0.39604546 AS bak, -0.06766283 * q * q + 1.11546468 * q + 0.04602535 AS ovrl FROM (SELECT *, l_quantity / 10 AS q FROM {lineitem}) x""")
def quality_scores(spark, sf_dir):  # noqa: ANN001, ANN201
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity") / 10
    return li.select("l_orderkey", "l_linenumber", "l_partkey", *(c.alias(k) for k, c in signal.quality_scores({"sig": q, "bak": q, "ovrl": q}).items()))
