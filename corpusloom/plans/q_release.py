"""Releases, canonical rows, handoff and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import publish, release
from corpusloom.plans.base import over, query, table
from corpusloom.plans.q_reports import split_case

ROWS = """SELECT doc_id, concat('AUD_', CAST(doc_id AS STRING)) AS audio_id, CASE WHEN doc_id % 29 = 0 THEN 'REVIEW' ELSE 'ACCEPT' END AS quality_gate, CAST(CASE WHEN doc_id % 31 = 0 THEN 0 ELSE 24000 END AS INT) AS sample_rate, CAST(CASE WHEN doc_id % 37 = 0 THEN 2 ELSE 1 END AS INT) AS channels,
  'PCM_S16LE' AS encoding, concat(CASE doc_id % 41 WHEN 0 THEN '/abs/' WHEN 1 THEN 'c:/x/' ELSE 'audio/' END, CAST(doc_id AS STRING), '.wav') AS audio, CASE WHEN doc_id % 43 = 0 THEN 'short' ELSE {sha}(text{bits}) END AS audio_sha256, {sha}(source{bits}) AS source_sha256, CAST(n_chars AS DOUBLE) / 512 AS duration_s,
  CASE WHEN lang = 'en' THEN 'REDISTRIBUTION_APPROVED' ELSE 'TRAIN_ONLY' END AS rights_status, doc_id % 7 <> 0 AS redistribution_permitted FROM documents"""
ROWS_SQL = ROWS.format(sha="sha256", bits="")
ROWS_SPARK = ROWS.format(sha="sha2", bits=", 256").replace("FROM documents", "FROM {documents}")
_RULES = """CASE WHEN quality_gate <> 'ACCEPT' THEN 'NOT_ACCEPT' WHEN sample_rate <= 0 OR channels <> 1 THEN 'NOT_MONO_PCM16' WHEN audio LIKE '/%' OR audio LIKE 'c:%' THEN 'ABSOLUTE_PATH' WHEN length(audio_sha256) <> 64 THEN 'MALFORMED_SHA256' WHEN duration_s <= 0 OR duration_s > 12 THEN 'DURATION_OUT_OF_POLICY'"""


@query(f"SELECT audio_id, {_RULES} WHEN rights_status <> 'REDISTRIBUTION_APPROVED' OR NOT redistribution_permitted THEN 'NOT_REDISTRIBUTABLE' END AS blocker FROM ({ROWS_SQL}) r")
def release_validate(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, ROWS_SPARK).select("audio_id", release.release_blocker("public").alias("blocker"))


@query(f"SELECT audio_id, coalesce({_RULES} END, CASE WHEN doc_id % 5 = 0 THEN 'AUDIO_MISSING' WHEN doc_id % 11 = 0 THEN 'AUDIO_SHA_MISMATCH' END) AS blocker FROM ({ROWS_SQL}) r")
def release_build(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = over(spark, sf_dir, ROWS_SPARK)
    audio = rows.filter("doc_id % 5 <> 0").select("audio_id", F.when(F.col("doc_id") % 11 == 0, "other").otherwise(F.col("audio_sha256")).alias("sha256"))
    return release.build_release(rows, audio).select("audio_id", "blocker")


@query(f"""WITH r AS (SELECT * FROM ({ROWS_SQL}) x), f AS (SELECT audio AS path, CASE WHEN doc_id % 11 = 0 THEN 'other' ELSE audio_sha256 END AS sha256, CASE WHEN doc_id % 13 = 0 THEN 8000 ELSE 24000 END AS fr, CASE WHEN doc_id % 17 = 0 THEN 2 ELSE 1 END AS ch, CASE WHEN doc_id % 19 = 0 THEN 3 ELSE 2 END AS w FROM r WHERE doc_id % 5 <> 0),
m AS (SELECT r.*, f.path, f.sha256 AS fs, fr, ch, w, audio LIKE '/%' OR audio LIKE 'c:%' AS abs FROM r LEFT JOIN f ON f.path = r.audio),
l AS (SELECT audio_id, [CASE WHEN abs THEN 'ABSOLUTE_PATH' END, CASE WHEN NOT abs AND path IS NULL THEN 'AUDIO_MISSING' END, CASE WHEN NOT abs AND path IS NOT NULL AND fs <> audio_sha256 THEN 'SHA_MISMATCH' END, CASE WHEN NOT abs AND path IS NOT NULL AND sample_rate <= 0 THEN 'SR_MISSING' END,
  CASE WHEN NOT abs AND path IS NOT NULL AND sample_rate > 0 AND fr <> sample_rate THEN 'SR_MISMATCH' END, CASE WHEN NOT abs AND path IS NOT NULL AND ch <> 1 THEN 'NOT_MONO' END, CASE WHEN NOT abs AND path IS NOT NULL AND w <> 2 THEN 'NOT_PCM16' END] AS c FROM m)
SELECT code, audio_id AS subject FROM (SELECT unnest(c) AS code, audio_id FROM l) u WHERE code IS NOT NULL""")
def release_verify(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = over(spark, sf_dir, ROWS_SPARK)
    i = F.col("doc_id")
    files = rows.filter("doc_id % 5 <> 0").select(F.col("audio").alias("path"), F.when(i % 11 == 0, "other").otherwise(F.col("audio_sha256")).alias("sha256"), F.when(i % 13 == 0, 8000).otherwise(24000).alias("sample_rate"), F.when(i % 17 == 0, 2).otherwise(1).alias("channels"), F.when(i % 19 == 0, 3).otherwise(2).alias("sample_width"))
    return release.release_errors(rows, files)


#: Documents as canonical rows, some of them broken.
CANON = """SELECT doc_id, CASE doc_id % 23 WHEN 0 THEN concat('audio/', CAST(doc_id AS STRING), '.wav') WHEN 1 THEN NULL ELSE concat('audio/', right(lpad(CAST(doc_id AS STRING), 7, '0'), 2), '/clip_', lpad(CAST(doc_id AS STRING), 7, '0'), '.wav') END AS audio,
  CASE WHEN doc_id % 29 = 0 THEN '  ' ELSE concat('text ', CAST(doc_id AS STRING)) END AS text, concat('audio/', right(lpad(CAST(doc_id AS STRING), 7, '0'), 2), '/clip_', lpad(CAST(doc_id AS STRING), 7, '0'), '.wav') AS file_name,
  CASE WHEN doc_id % 31 = 0 THEN 'spk_1' ELSE concat('spk_', {md5}(source)) END AS speaker, CASE doc_id % 37 WHEN 0 THEN CAST(0 AS DOUBLE) ELSE CAST(n_chars AS DOUBLE) / 512 END AS duration, CASE WHEN doc_id % 41 = 0 THEN '' WHEN doc_id % 41 = 1 THEN 'klingon-variant' ELSE lang END AS language, source FROM documents"""
CANON_SQL, CANON_SPARK = CANON.format(md5="md5"), CANON.format(md5="md5").replace("FROM documents", "FROM {documents}")


@query(f"""SELECT doc_id, CASE WHEN audio IS NULL THEN 'NOT_A_STRING' WHEN audio <> file_name THEN 'AUDIO_NE_FILE_NAME' WHEN NOT regexp_matches(audio, '^audio/[0-9a-f]{{2}}/clip_[0-9]{{7,}}\\.wav$') THEN 'BAD_AUDIO_PATH' WHEN trim(text) = '' THEN 'EMPTY_TEXT' WHEN NOT regexp_matches(speaker, '^spk_[0-9a-f]{{32}}$') THEN 'BAD_SPEAKER'
  WHEN duration <= 0 THEN 'DURATION_NONPOSITIVE' WHEN language = '' OR length(language) > 10 THEN 'BAD_LANGUAGE' END AS error FROM ({CANON_SQL}) c""".replace("{{", "{").replace("}}", "}"))
def canonical_rows(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, CANON_SPARK).select("doc_id", release.canonical_error().alias("error"))


@query(f"""WITH r AS (SELECT *, {split_case("source || CAST(doc_id % 40 = 0 AS VARCHAR)")} AS split FROM ({CANON_SQL}) c WHERE audio IS NOT NULL),
f AS (SELECT split, file_name AS path, CASE WHEN doc_id % 43 = 0 THEN 2 ELSE 1 END AS ch, duration + CASE WHEN doc_id % 47 = 0 THEN 0.5 ELSE 0 END AS d FROM r WHERE doc_id % 53 <> 0 UNION ALL SELECT 'train', 'audio/00/stray_' || doc_id || '.wav', 1, 1.0 FROM r WHERE doc_id % 59 = 0),
m AS (SELECT r.file_name, r.audio, r.duration, f.path, f.ch, f.d FROM r FULL JOIN f ON r.split = f.split AND r.audio = f.path),
l AS (SELECT coalesce(file_name, path) AS subject, [CASE WHEN audio <> file_name THEN 'AUDIO_NE_FILE_NAME' END, CASE WHEN NOT regexp_matches(audio, '^audio/[0-9a-f]{{2}}/clip_[0-9]{{7,}}\\.wav$') THEN 'BAD_AUDIO_PATH' END, CASE WHEN file_name IS NOT NULL AND path IS NULL THEN 'DANGLING_METADATA' END, CASE WHEN file_name IS NULL THEN 'ORPHAN_AUDIO' END,
  CASE WHEN file_name IS NOT NULL AND ch <> 1 THEN 'NOT_MONO' END, CASE WHEN file_name IS NOT NULL AND abs(d - duration) > 0.01 THEN 'DURATION_MISMATCH' END] AS c FROM m)
SELECT code, subject FROM (SELECT unnest(c) AS code, subject FROM l) u WHERE code IS NOT NULL UNION ALL SELECT 'DUPLICATE_ROW', file_name FROM r GROUP BY file_name HAVING count(*) > 1 UNION ALL SELECT 'SPEAKER_SPLIT_LEAK', speaker FROM r GROUP BY speaker HAVING count(DISTINCT split) > 1""".replace("{{", "{").replace("}}", "}"))
def canonical_verify(spark, sf_dir):  # noqa: ANN001, ANN201
    from corpusloom.operators.dedup import split_of

    r = over(spark, sf_dir, CANON_SPARK).filter("audio is not null").withColumn("split", split_of(F.concat("source", (F.col("doc_id") % 40 == 0).cast("string"))))
    i = F.col("doc_id")
    f = r.filter("doc_id % 53 <> 0").select("split", F.col("file_name").alias("path"), F.lit(24000).alias("sample_rate"), F.when(i % 43 == 0, 2).otherwise(1).alias("channels"), F.lit(2).alias("sample_width"), (F.col("duration") + F.when(i % 47 == 0, 0.5).otherwise(0.0)).alias("duration"))
    stray = r.filter("doc_id % 59 = 0").select(F.lit("train").alias("split"), F.concat(F.lit("audio/00/stray_"), i.cast("string"), F.lit(".wav")).alias("path"), F.lit(24000).alias("sample_rate"), F.lit(1).alias("channels"), F.lit(2).alias("sample_width"), F.lit(1.0).alias("duration"))
    return release.canonical_errors(r, f.unionByName(stray))


SAMPLES = """SELECT d.doc_id, CASE d.doc_id % 6 WHEN 0 THEN 'TRAIN_ONLY' WHEN 1 THEN NULL ELSE 'REDISTRIBUTION_APPROVED' END AS rights_status, d.doc_id % 7 <> 0 AS redistribution_permitted, CASE d.doc_id % 11 WHEN 0 THEN 'dev' ELSE 'train' END AS split, coalesce(l.quality, 1) = 1 AS transcript_verified,
  CASE WHEN d.doc_id % 13 = 0 THEN ' ' ELSE d.text END AS text, d.doc_id % 17 <> 0 AS language_verified, CASE WHEN d.doc_id % 19 = 0 THEN '-' ELSE d.lang END AS language FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id"""


@query("WITH s AS (" + SAMPLES + """) SELECT doc_id, CASE WHEN coalesce(rights_status, '') <> 'REDISTRIBUTION_APPROVED' THEN 'RIGHT_NOT_PERMITTED:' || coalesce(rights_status, '') WHEN NOT redistribution_permitted THEN 'REDISTRIBUTION_FLAG_FALSE' WHEN split NOT IN ('train', 'validation', 'test') THEN 'UNKNOWN_SPLIT:' || split
  WHEN NOT transcript_verified OR trim(text) = '' THEN 'TRANSCRIPT_UNVERIFIED' WHEN NOT language_verified OR language = '-' THEN 'LANGUAGE_UNVERIFIED' END AS blocker FROM s""")
def canonical_blockers(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, SAMPLES).select("doc_id", release.export_blocker().alias("blocker"))


@query("""WITH k AS (SELECT doc_id, 'key-' || doc_id AS key FROM {documents}), o AS (SELECT key, 'clip_' || lpad(CAST(row_number() OVER (ORDER BY doc_id) AS VARCHAR), 7, '0') AS id FROM k WHERE doc_id % 2 = 0), c AS (SELECT count(*) AS n FROM o)
SELECT key, id, TRUE AS reused FROM o UNION ALL SELECT key, 'clip_' || lpad(CAST(n + row_number() OVER (ORDER BY doc_id) AS VARCHAR), 7, '0'), FALSE FROM k, c WHERE doc_id % 2 <> 0""")
def canonical_ids(spark, sf_dir):  # noqa: ANN001, ANN201
    """Ids of a second run: the first run's keys keep theirs, the others go on from the counter."""
    k = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("key-"), F.col("doc_id").cast("string")).alias("key"))
    none = spark.createDataFrame([], "key string, id string")
    first = release.allocate_ids(k.filter("doc_id % 2 = 0"), none, 0, ["doc_id"])
    counter = k.filter("doc_id % 2 = 0").count()
    return release.allocate_ids(k, first.select("key", "id"), counter, ["doc_id"])


@query("""SELECT doc_id, 'spk_' || CASE WHEN doc_id % 3 <> 0 AND source <> '' THEN substr(sha256('speaker' || chr(31) || lang || chr(31) || source), 1, 32) ELSE substr(sha256('sample' || chr(31) || doc_id), 1, 32) END AS speaker FROM {documents}""")
def speaker_map(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", release.speaker_id(F.col("lang"), F.col("source"), F.col("doc_id"), F.col("doc_id") % 3 != 0).alias("speaker"))


@query("""WITH o AS (SELECT doc_id, lang, n_chars AS n FROM {documents} WHERE doc_id % 2 = 0), n AS (SELECT doc_id, lang, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS n FROM {documents} WHERE doc_id % 3 = 0)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN 'kept' WHEN o.doc_id IS NULL THEN 'added' WHEN o.n = n.n THEN 'reused' ELSE 'conflict' END AS outcome FROM o FULL JOIN n ON o.doc_id = n.doc_id""")
def canonical_upsert(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    old = d.filter("doc_id % 2 = 0").select("doc_id", "lang", F.col("n_chars").alias("n"))
    new = d.filter("doc_id % 3 = 0").select("doc_id", "lang", (F.col("n_chars") + (F.col("doc_id") % 5 == 0).cast("int")).alias("n"))
    return release.upsert(old, new, "doc_id", ["lang", "n"])


HANDOFF = """SELECT doc_id, CAST(doc_id AS STRING) AS id, CASE doc_id % 11 WHEN 0 THEN concat('/train/', CAST(doc_id AS STRING)) WHEN 1 THEN 'train/../x.wav' WHEN 2 THEN 'train//x.wav' WHEN 3 THEN 'train/./x.wav' WHEN 4 THEN 'other/x.wav' WHEN 5 THEN 'audio/x.wav' WHEN 6 THEN 'train/x:y.wav' ELSE concat('train/audio/', CAST(doc_id AS STRING), '.wav') END AS audio,
  CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE 'said' END AS transcript, CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat(lang, '-XX') END AS language, concat('spk_', CASE WHEN doc_id % 19 = 0 THEN '1' ELSE md5(source) END) AS speaker_id, CASE WHEN doc_id % 23 = 0 THEN 'dev' ELSE 'train' END AS split,
  CASE doc_id % 29 WHEN 0 THEN ' unknown ' WHEN 1 THEN NULL ELSE 'mit' END AS license, CASE WHEN doc_id % 31 = 0 THEN 'n/a' ELSE 'research' END AS consent FROM {documents}"""


@query("WITH h AS (" + HANDOFF + """) SELECT doc_id, CASE WHEN doc_id % 11 IN (0, 1, 2, 3, 4, 6) THEN 'AUDIO_PATH' WHEN trim(transcript) = '' THEN 'TRANSCRIPT' WHEN language = '' THEN 'LANGUAGE' WHEN length(speaker_id) <> 36 THEN 'SPEAKER' WHEN split = 'dev' THEN 'SPLIT' WHEN NOT starts_with(audio, split || '/') THEN 'AUDIO_OUTSIDE_SPLIT'
  WHEN coalesce(upper(trim(license)), 'NONE') IN ('UNKNOWN', 'NONE') THEN 'LICENSE_UNKNOWN' WHEN upper(trim(consent)) = 'N/A' THEN 'CONSENT_UNKNOWN' END AS error FROM h""")
def handoff_validate(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, HANDOFF).select("doc_id", release.handoff_error().alias("error"))


@query(f"""WITH c AS (SELECT *, {split_case('source')} AS split FROM ({CANON_SQL}) x WHERE doc_id % 23 > 1 AND doc_id % 29 <> 0 AND doc_id % 31 <> 0 AND doc_id % 41 > 1), r AS (SELECT *, 'clip_' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS id FROM c)
SELECT id, split || '/' || audio AS audio, language, speaker AS speaker_id, split, CASE WHEN doc_id % 3 <> 0 THEN CASE WHEN doc_id % 5 = 0 THEN 'UNSPECIFIED' ELSE 'mit' END END AS license, CASE WHEN doc_id % 3 <> 0 AND doc_id % 4 = 0 THEN 'research' ELSE 'redistribution-approved' END AS consent,
  CASE WHEN doc_id % 3 = 0 THEN 'NO_PROVENANCE' WHEN doc_id % 5 = 0 THEN 'LICENSE_UNKNOWN' END AS error FROM r""")
def handoff_rows(spark, sf_dir):  # noqa: ANN001, ANN201
    from corpusloom.operators.dedup import split_of

    c = over(spark, sf_dir, CANON_SPARK).filter("doc_id % 23 > 1 AND doc_id % 29 <> 0 AND doc_id % 31 <> 0 AND doc_id % 41 > 1").withColumn("split", split_of("source"))
    i = F.col("doc_id")
    p = c.filter("doc_id % 3 <> 0").select(F.concat(F.lit("clip_"), F.lpad(i.cast("string"), 7, "0")).alias("id"), F.when(i % 5 == 0, "UNSPECIFIED").otherwise("mit").alias("license"), F.when(i % 4 == 0, "research").otherwise("").alias("consent"))
    return release.handoff_rows(c, p).drop("transcript")


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN NULLIF(lang, 'en') ELSE text END AS text, CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END AS language FROM {documents}""")
def sidecar_override(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", "text", F.col("lang").alias("language"))
    side = d.filter("doc_id % 2 = 0").select("doc_id", F.expr("NULLIF(lang, 'en')").alias("text"), F.col("source").alias("language"))
    return release.sidecar_override(rows, side, "doc_id", ["text", "language"])


@query("""WITH a AS (SELECT source AS path, count(*) AS n, sha256(CAST(sum(n_chars) AS VARCHAR)) AS s FROM {documents} WHERE doc_id % 2 = 0 GROUP BY source)
SELECT 'p' || doc_id AS path, CASE WHEN doc_id % 3 = 0 THEN 'REMOTE_MISSING' ELSE 'REMOTE_SHA_MISMATCH' END AS error FROM {documents} WHERE doc_id % 3 = 0 OR (doc_id % 3 <> 0 AND doc_id % 7 = 0) UNION ALL SELECT 'extra/' || path, 'EXTRA_REMOTE_FILE' FROM a""")
def exact_set_diff(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    local = d.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"))
    remote = d.filter("doc_id % 3 <> 0").select(F.concat(F.lit("releases/r1/p"), F.col("doc_id").cast("string")).alias("path"), F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.sha2("text", 256)).alias("sha256"))
    more = d.filter("doc_id % 2 = 0").select("source").distinct().select(F.concat(F.lit("releases/r1/extra/"), "source").alias("path"), F.lit("y").alias("sha256"))
    other = d.select(F.concat(F.lit("releases/r2/q"), F.col("doc_id").cast("string")).alias("path"), F.lit("z").alias("sha256"))
    return publish.set_difference(local, publish.within_prefix(remote.unionByName(more).unionByName(other), "releases/r1"))


@query("""SELECT 'p' || doc_id AS path, sha256(text) AS sha256, n_chars AS size, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'changed' END AS change, FALSE AS mutable FROM {documents} WHERE doc_id % 3 = 0 OR doc_id % 7 = 0""")
def ledger_diff(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    tree = d.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"), F.col("n_chars").alias("size"))
    ledger = d.filter("doc_id % 3 <> 0").select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"), F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.sha2("text", 256)).alias("sha256"))
    return publish.to_upload(tree, ledger)


APPROVALS = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'd1' ELSE 'd2' END AS release_digest, 'd2' AS actual_digest, CASE WHEN o_orderkey % 5 = 0 THEN 'a/b' ELSE 'a/c' END AS repo_id, 'a/c' AS actual_repo, CASE WHEN o_orderkey % 7 = 0 THEN 'dev' ELSE 'main' END AS revision, o_orderkey % 11 <> 0 AS license_ack,
  CASE o_orderkey % 13 WHEN 0 THEN 'soon' WHEN 1 THEN '2020-01-01T00:00:00Z' ELSE '2030-01-01T00:00:00Z' END AS expires_utc, CAST(floor(o_totalprice) AS BIGINT) AS actual_bytes, CAST(400000 AS BIGINT) AS max_bytes, o_orderkey % 17 <> 0 AS ready FROM {orders}"""


@query("WITH a AS (" + APPROVALS + """) SELECT o_orderkey, array_to_string(list_filter([CASE WHEN release_digest <> actual_digest THEN 'RELEASE_DIGEST_MISMATCH' END, CASE WHEN repo_id <> actual_repo THEN 'REPO_ID_MISMATCH' END, CASE WHEN revision <> 'main' THEN 'REVISION_MISMATCH' END, CASE WHEN NOT license_ack THEN 'LICENSE_NOT_ACKNOWLEDGED' END,
  CASE WHEN expires_utc LIKE '2020%' THEN 'APPROVAL_EXPIRED' END, CASE WHEN expires_utc = 'soon' THEN 'APPROVAL_EXPIRY_UNPARSEABLE' END, CASE WHEN actual_bytes > max_bytes THEN 'RELEASE_EXCEEDS_BYTE_QUOTA' END, CASE WHEN NOT ready THEN 'RELEASE_NOT_READY' END], lambda x: x IS NOT NULL), '|') AS reasons FROM a""")
def approval_reasons(spark, sf_dir):  # noqa: ANN001, ANN201
    a = over(spark, sf_dir, APPROVALS)
    got = publish.approval_reasons({c: F.col(c) for c in a.columns}, F.lit("2025-06-01 00:00:00").cast("timestamp"), F.lit("main"))
    return a.select("o_orderkey", F.array_join(got, "|").alias("reasons"))


@query("""WITH l AS (SELECT 'p' || doc_id AS path, sha256(text) || '  p' || doc_id AS l FROM {documents}) SELECT count(*) AS n_files, sha256(string_agg(l, chr(10) ORDER BY path) || chr(10)) AS release_digest FROM l""")
def release_digest(spark, sf_dir):  # noqa: ANN001, ANN201
    """One digest over all lines: the manifest is one file, of a line per file of one release."""
    d = table(spark, sf_dir, "documents")
    return publish.checksum_lines(d.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256")))


@query("""WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS size, CASE WHEN o_orderkey % 3 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) + 1 WHEN o_orderkey % 3 = 1 THEN CAST(floor(o_totalprice) AS BIGINT) END AS expected, o_orderkey % 4 AS k FROM {orders})
SELECT o_orderkey, CASE WHEN expected IS NOT NULL AND expected <> size THEN 'SIZE_MISMATCH' WHEN k = 1 THEN 'SHA_MISMATCH' ELSE 'ok' END AS verdict, CAST(floor(size * 1.25) AS BIGINT) + 1048576 AS quota FROM o""")
def download_verify(spark, sf_dir):  # noqa: ANN001, ANN201
    o = over(spark, sf_dir, "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS size, CASE WHEN o_orderkey % 3 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) + 1 WHEN o_orderkey % 3 = 1 THEN CAST(floor(o_totalprice) AS BIGINT) END AS expected, CASE o_orderkey % 4 WHEN 0 THEN 'AB' WHEN 1 THEN 'cd' END AS esha FROM {orders}")
    return o.select("o_orderkey", publish.verify_download(F.col("size"), F.col("expected"), F.lit("ab"), F.col("esha")).alias("verdict"), publish.push_quota(F.col("size")).alias("quota"))


@query("""SELECT doc_id, 'AUD_' || lang || '_' || substr(sha256(sha256(text)), 1, 12) AS audio_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'anon_' || substr(sha256(sha256(source)), 1, 10) END AS speaker_id, 'RIGHTS_' || substr(sha256(source), 1, 10) AS rights_evidence_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS transcript FROM {documents}""")
def accepted_to_release(spark, sf_dir):  # noqa: ANN001, ANN201
    a = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("source_language"), F.sha2("text", 256).alias("audio_sha256"), F.sha2("source", 256).alias("source_sha256"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise("").alias("source_speaker_ref"), F.col("source").alias("source_id"), (F.col("doc_id") % 3 == 0).alias("segmented"), F.col("lang").alias("source_transcript"))
    return release.accepted_to_release(a).select("doc_id", "audio_id", "speaker_id", "rights_evidence_id", "transcript")
