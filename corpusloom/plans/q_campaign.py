"""Campaign compositions and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import campaign, dedup, evidence, policy
from corpusloom.plans import q_decisions, q_signal
from corpusloom.plans.base import over, query, table
from corpusloom.plans.q_reports import split_case


@query("""WITH m AS (SELECT doc_id, sha256(text) AS h, lang, source FROM {documents})
SELECT 'SRC_' || substr(sha256(h || chr(31) || 'abc'), 1, 16) AS source_id, 'hf://datasets/x@abc/' || doc_id AS source_uri, 'abc' AS source_revision, CAST(doc_id AS VARCHAR) AS original_file_id, h AS source_sha256, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE doc_id END AS source_bytes, source AS source_transcript,
  CASE WHEN doc_id % 3 = 0 THEN 'vi' ELSE lang END AS source_language, 'TRAIN_ONLY' AS rights_status, FALSE AS redistribution_permitted FROM m""")
def manifest_records(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    m = d.select(F.sha2("text", 256).alias("sha256"), F.concat(F.lit("hf://datasets/x@abc/"), i.cast("string")).alias("source_uri"), i.cast("string").alias("original_file_id"), F.when(i % 4 != 0, i).alias("size"), F.col("source").alias("source_transcript"), F.when(i % 3 != 0, F.col("lang")).otherwise("").alias("source_language"))
    return campaign.manifest_records(m, F.lit("abc"), F.lit("train_only"), F.lit(True))


@query(f"""SELECT doc_id AS audio_id, CASE WHEN doc_id % 5 = 0 THEN 'train' ELSE {split_case('source')} END AS split FROM documents""")
def split_assignment_join(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("audio_id"), "source", F.lit("train").alias("split"))
    a = d.filter("audio_id % 5 <> 0").select("audio_id", dedup.split_of("source").alias("split"))
    return campaign.assign_and_join(d, a).select("audio_id", "split")


@query(f"""WITH s AS (SELECT source, {split_case('source')} AS split, sha256(text) AS h FROM documents), d AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1)
SELECT count(*) AS n_accepted, count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'validation') AS n_validation, count(*) FILTER (WHERE split = 'test') AS n_test, 0 AS n_leaking, (SELECT count(*) FROM d) AS n_duplicate_groups, TRUE AS ok FROM s""")
def release_gate(spark, sf_dir):  # noqa: ANN001, ANN201
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("audio_id"), F.col("source").alias("group"), F.sha2("text", 256).alias("source_sha256"))
    return campaign.release_gate(a)


@query("""WITH r AS (SELECT (row_number() OVER (ORDER BY lang, doc_id) - 1) // 100 AS chunk, n_chars, CASE WHEN doc_id % 2 = 0 THEN 'mit' ELSE 'odbl' END AS l FROM {documents})
SELECT chunk, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS bytes, array_to_string(list_sort(list_distinct(list(l))), ',') AS licenses, 'j__b__c' || lpad(CAST(chunk AS VARCHAR), 5, '0') AS release_id FROM r GROUP BY chunk""")
def fanout_chunks(spark, sf_dir):  # noqa: ANN001, ANN201
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("audio_id"), F.col("lang").alias("split"), F.col("n_chars").alias("size"), F.when(F.col("doc_id") % 2 == 0, "mit").otherwise("odbl").alias("license"))
    return campaign.fanout(a, "j", "b")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'sha' || (o_custkey % 3) END AS pinned_sha,
  CASE WHEN o_orderkey % 7 = 0 THEN 'none' WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'still-blocked' ELSE 'pinned' END WHEN o_orderkey % 5 = 0 THEN 'remote-check-failed' WHEN o_custkey % 3 <> 1 THEN 'drift-reported' ELSE 'none' END AS action FROM {orders}""")
def pin_drift(spark, sf_dir):  # noqa: ANN001, ANN201
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    jobs = o.select(k.cast("string").alias("job_id"), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("sha"), (F.col("o_custkey") % 3).cast("string"))).alias("pinned_sha"))
    up = o.filter("o_orderkey % 7 <> 0").select(k.cast("string").alias("job_id"), F.when(k % 5 != 0, "sha1").alias("current"))
    return campaign.resume_actions(jobs, up)


@query("""WITH l AS (SELECT CAST(coalesce(sum(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE n_chars END), 0) AS BIGINT) AS b, count(*) AS n FROM {documents} WHERE doc_id % 11 <> 0), d AS (SELECT * FROM (VALUES ('a/b', 100, TRUE), ('a/c', NULL, FALSE), ('', 1000000000000, NULL)) d(repo_id, max_bytes, redistribution_confirmed))
SELECT repo_id, b AS current_bytes, n AS n_files, b + 5000 AS projected_bytes, array_to_string(list_filter([CASE WHEN repo_id = '' THEN 'NO_DESTINATION_REPO' END, CASE WHEN b + 5000 > max_bytes THEN 'DESTINATION_QUOTA_EXCEEDED' END], lambda x: x IS NOT NULL), '|') AS reasons,
  array_to_string(list_filter([CASE WHEN max_bytes IS NULL THEN 'QUOTA_NOT_DECLARED' END, CASE WHEN NOT coalesce(redistribution_confirmed, FALSE) THEN 'REDISTRIBUTION_NOT_CONFIRMED' END], lambda x: x IS NOT NULL), '|') AS warnings FROM d, l""")
def destination_preflight(spark, sf_dir):  # noqa: ANN001, ANN201
    listing = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 11 == 0, "dir").otherwise("file").alias("type"), F.when(F.col("doc_id") % 3 != 0, F.col("n_chars")).alias("size"))
    dest = spark.createDataFrame([("a/b", 100, True), ("a/c", None, False), ("", 1000000000000, None)], "repo_id string, max_bytes bigint, redistribution_confirmed boolean")
    out = campaign.preflight(dest, listing, F.lit(5000))
    return out.select("repo_id", "current_bytes", "n_files", "projected_bytes", F.array_join("reasons", "|").alias("reasons"), F.array_join("warnings", "|").alias("warnings"))


@query("""SELECT source AS release_id, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS total_bytes, arg_max('p' || doc_id, (n_chars, 'p' || doc_id)) AS largest FROM {documents} GROUP BY source""")
def upload_plan(spark, sf_dir):  # noqa: ANN001, ANN201
    f = table(spark, sf_dir, "documents").select(F.col("source").alias("release_id"), F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("bytes"))
    return campaign.upload_plan(f)


@query("SELECT CAST(sum(CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE n_chars * 2 END) AS BIGINT) AS expected_bytes FROM {documents}")
def expected_upload(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 3 != 0, F.col("n_chars") * 2).alias("accountable_bytes"), F.col("n_chars").alias("total_bytes"))
    return campaign.expected_upload(d)


METRICS = "SELECT user_id, CASE event_type WHEN 'view' THEN 'downloaded' WHEN 'click' THEN 'cache_hit' ELSE 'reused' END AS outcome, CAST(floor(value * 100) AS BIGINT) AS bytes, {us} AS us FROM {{events}}"


@query("WITH m AS (" + METRICS.format(us="epoch_us(ts) // 1000000").replace("{events}", "events") + """), a AS (SELECT user_id, count(*) AS n_items, count(*) FILTER (WHERE outcome = 'downloaded') AS n_downloaded, count(*) FILTER (WHERE outcome = 'cache_hit') AS n_cache_hit,
  CAST(coalesce(sum(bytes) FILTER (WHERE outcome = 'downloaded'), 0) AS BIGINT) AS network_bytes, CAST(coalesce(sum(bytes) FILTER (WHERE outcome = 'cache_hit'), 0) AS BIGINT) AS cached_bytes, max(us + 5) - min(us) AS wall_s FROM m GROUP BY user_id)
SELECT *, network_bytes::DOUBLE / wall_s / 1000000::DOUBLE AS mb_per_s, network_bytes::DOUBLE / wall_s / 1000000::DOUBLE * 8 AS mbit_per_s FROM a""")
def download_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    m = over(spark, sf_dir, METRICS.format(us="unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000000"))
    return campaign.download_metrics(m.withColumns({"began": F.col("us"), "ended": F.col("us") + 5}), "user_id")


@query("""WITH s AS (SELECT source AS name, CASE CAST(substr(source, 4) AS INT) % 4 WHEN 0 THEN 'FORBIDDEN' WHEN 1 THEN NULL WHEN 2 THEN 'TRAIN_ONLY' ELSE 'LICENSE_REVIEW' END AS r, doc_id FROM {documents})
SELECT name, coalesce(r, 'UNKNOWN') AS declared_rights, count(*) AS n_files, count(*) FILTER (WHERE doc_id % 3 = 0) AS quarantined, CASE WHEN coalesce(r, 'UNKNOWN') <> 'TRAIN_ONLY' THEN name || ': rights ' || coalesce(r, 'UNKNOWN') END AS blocker FROM s GROUP BY name, r""")
def source_validation(spark, sf_dir):  # noqa: ANN001, ANN201
    s = over(spark, sf_dir, "SELECT source AS name, CASE CAST(substr(source, 4) AS INT) % 4 WHEN 0 THEN 'FORBIDDEN' WHEN 1 THEN NULL WHEN 2 THEN 'TRAIN_ONLY' ELSE 'LICENSE_REVIEW' END AS declared_rights, CASE WHEN doc_id % 3 = 0 THEN 'QUARANTINE' ELSE 'INGESTED' END AS ingest_status FROM {documents}")
    return campaign.source_validation(s)


@query(f"WITH {q_decisions.CHECKS_SQL} SELECT count(*) FILTER (WHERE decision = 'ACCEPT') AS accepted, count(*) FILTER (WHERE decision <> 'ACCEPT') AS non_accepted FROM p")
def curate_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return campaign.curate_counts(q_decisions.decided(spark, sf_dir))


@query(f"WITH {q_decisions.CHECKS_SQL} SELECT source_id, count(*) AS n, count(*) FILTER (WHERE decision = 'ACCEPT')::DOUBLE / count(*) AS accept_coverage FROM p GROUP BY source_id")
def funnel_by_source(spark, sf_dir):  # noqa: ANN001, ANN201
    return campaign.funnel_by(q_decisions.decided(spark, sf_dir), "source_id")


ACCEPTED = """SELECT doc_id AS seq, source AS source_id, CAST(doc_id AS STRING) AS original_file_id, {sha}(text{bits}) AS source_sha256, 'r1' AS source_revision, concat('file:///d/', source, '/x.wav') AS source_uri, CAST(0 AS BIGINT) AS seg_start, n_chars AS seg_end,
  CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE 'said' END AS text, concat(lang, '-XX') AS language, CASE WHEN doc_id % 4 = 0 THEN source ELSE '' END AS speaker_ref, doc_id % 5 <> 0 AS transcript_verified, doc_id % 7 <> 0 AS language_verified, CASE WHEN doc_id % 11 = 0 THEN 'TRAIN_ONLY' ELSE 'REDISTRIBUTION_APPROVED' END AS rights_status, doc_id % 13 <> 0 AS redistribution_permitted,
  'train' AS split, CAST(n_chars AS DOUBLE) / 512 AS duration FROM documents"""
_EXPORT = f"""
a AS ({ACCEPTED.format(sha='sha256', bits='')}),
b AS (SELECT a.* EXCLUDE (text, speaker_ref), CASE WHEN seq % 6 = 0 THEN 'other' ELSE text END AS text, CASE WHEN seq % 6 = 0 THEN 'who' ELSE speaker_ref END AS speaker_ref FROM a),
j AS (SELECT *, CASE WHEN rights_status <> 'REDISTRIBUTION_APPROVED' THEN 'RIGHT_NOT_PERMITTED:' || rights_status WHEN NOT redistribution_permitted THEN 'REDISTRIBUTION_FLAG_FALSE' WHEN (seq % 6 <> 0 AND NOT transcript_verified) OR trim(text) = '' THEN 'TRANSCRIPT_UNVERIFIED' WHEN seq % 6 <> 0 AND NOT language_verified THEN 'LANGUAGE_UNVERIFIED' END AS reason FROM b),
k AS (SELECT *, 'identity-1' || chr(31) || 'r1' || chr(31) || source_id || chr(31) || source_sha256 || chr(31) || '0' || chr(31) || seg_end AS key FROM j)"""


def _export(spark, sf_dir):  # noqa: ANN001, ANN202
    a = over(spark, sf_dir, ACCEPTED.format(sha="sha2", bits=", 256").replace("FROM documents", "FROM {documents}"))
    side = a.filter("seq % 6 = 0").select("original_file_id", F.lit("other").alias("text"), "language", F.lit("who").alias("speaker_ref"), F.lit(True).alias("transcript_verified"), F.lit(True).alias("language_verified"))
    return campaign.export_samples(a, side, spark.createDataFrame([], "key string, id string"), 0)


@query(f"WITH {_EXPORT} SELECT source_id, original_file_id, reason FROM k WHERE reason IS NOT NULL")
def export_blocked(spark, sf_dir):  # noqa: ANN001, ANN201
    return _export(spark, sf_dir)[1]


@query(f"""WITH {_EXPORT}, f AS (SELECT key, min(seq) AS s FROM k WHERE reason IS NULL GROUP BY key), n AS (SELECT key, 'clip_' || lpad(CAST(row_number() OVER (ORDER BY s, key) AS VARCHAR), 7, '0') AS id FROM f)
SELECT n.id, 'audio/' || right(n.id, 2) || '/' || n.id || '.wav' AS audio, text, split(language, '-')[1] AS language, duration, split, 'spk_' || CASE WHEN speaker_ref <> '' THEN substr(sha256('speaker' || chr(31) || 'file:///d/' || source_id || chr(31) || speaker_ref), 1, 32) ELSE substr(sha256('sample' || chr(31) || k.key), 1, 32) END AS speaker FROM k JOIN n ON n.key = k.key WHERE reason IS NULL""")
def canonical_export(spark, sf_dir):  # noqa: ANN001, ANN201
    return _export(spark, sf_dir)[0].select("id", "audio", "text", "language", "duration", "split", "speaker")


@query("""SELECT 'SEG_' || substr(sha256(sha256(text) || chr(31) || 'tech'), 1, 16) AS segment_id, sha256(text) AS source_sha256, 0 AS interval_start_sample, 0 AS interval_end_sample, 16000 AS analysis_sample_rate, 'REJECT_TECH' AS decision, 'EMPTY_AUDIO' AS reason_codes FROM {documents} WHERE doc_id % 3 = 0
UNION ALL SELECT 'SEG_' || substr(sha256(sha256(text) || chr(31) || 'error' || chr(31) || 'NO_FILE'), 1, 16), sha256(text), 0, 0, 16000, 'ERROR', 'NO_FILE' FROM {documents} WHERE doc_id % 3 = 1
UNION ALL SELECT 'SEG_' || substr(sha256(sha256(text) || chr(31) || 'admission'), 1, 16), sha256(text), 0, 0, 16000, 'REJECT_TECH', 'SOURCE_RATE_CLASS:NARROWBAND_SOURCE:sr=8000|NARROWBAND_SOURCE' FROM {documents} WHERE doc_id % 3 = 2""")
def rejection_evidence(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("source_sha256"))
    both = evidence.rejected(d.filter("doc_id % 3 = 0"), "tech", F.array(F.lit("EMPTY_AUDIO"))).unionByName(evidence.rejected(d.filter("doc_id % 3 = 1"), "error", F.array(F.lit("NO_FILE")), "ERROR"))
    codes = F.array(F.lit("SOURCE_RATE_CLASS:NARROWBAND_SOURCE:sr=8000"), F.lit("NARROWBAND_SOURCE"))
    both = both.unionByName(evidence.rejected(d.filter("doc_id % 3 = 2"), "admission", codes))  # each document has one of three fates
    return both.withColumn("reason_codes", F.array_join("reason_codes", "|"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 3 = 0 THEN FALSE ELSE n_chars > 0 END AS usable FROM {documents}")
def probe_reuse(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    i, n = F.col("doc_id"), F.col("n_chars")
    return d.select("doc_id", evidence.probe_usable(n, F.when(i % 5 == 0, n + 1).when(i % 7 != 0, n), F.when(i % 3 != 0, "pcm")).alias("usable"))


_BEGIN, _END = "CAST(n_chars % 90 AS DOUBLE) / 8", "CAST(n_chars % 90 AS DOUBLE) / 8 + CAST(1 + n_chars % 40 AS DOUBLE) / 8"


@query(f"""WITH e AS (SELECT doc_id, {_BEGIN} AS b, {_END} AS e, CASE doc_id % 3 WHEN 0 THEN 'N3' WHEN 1 THEN 'N1' ELSE 'N2' END AS sev, CASE WHEN doc_id % 4 = 0 THEN 'MUSIC_ONLY' ELSE 'HISS_STATIC' END AS label FROM documents)
SELECT doc_id, CASE WHEN e > 2 AND b < 7 THEN greatest(b, 2) - 2 END AS start_s, CASE WHEN e > 2 AND b < 7 THEN least(e, 7) - 2 END AS end_s, greatest(0, least(e, 7) - greatest(b, 2)) / 5 AS speech_ratio, CAST(sev = 'N3' OR label = 'MUSIC_ONLY' AS INT) AS n_excluded FROM e""")
def segment_slices(spark, sf_dir):  # noqa: ANN001, ANN201
    """One event and one stretch of speech per document, cut to the segment from 2 to 7 seconds."""
    e = over(spark, sf_dir, f"SELECT doc_id, {_BEGIN} AS b, {_END} AS e, CASE doc_id % 3 WHEN 0 THEN 'N3' WHEN 1 THEN 'N1' ELSE 'N2' END AS sev, CASE WHEN doc_id % 4 = 0 THEN 'MUSIC_ONLY' ELSE 'HISS_STATIC' END AS label FROM {{documents}}")
    events = F.array(F.struct(F.col("label"), F.col("sev").alias("severity"), F.col("b").alias("start_s"), F.col("e").alias("end_s")))
    s, z = F.lit(2.0), F.lit(7.0)
    got = F.get(evidence.sliced(events, s, z), F.lit(0))
    return e.select("doc_id", got["start_s"].alias("start_s"), got["end_s"].alias("end_s"), evidence.speech_share(F.array(F.struct(F.col("b").alias("start"), F.col("e").alias("end"))), s, z).alias("speech_ratio"), F.size(evidence.excluded(events)).alias("n_excluded"))


@query()
def wav_evidence(spark, sf_dir):  # noqa: ANN001, ANN201
    """From bytes to decisions: one Arrow pass measures, the rest are expressions over exploded segments."""
    rows = evidence.assemble(q_signal.measured(spark, sf_dir), min_duration=0.5)
    none = {c: F.lit(None).cast("double") for c in ("sig", "bak", "ovrl")}
    full = rows.withColumns({"segment_id": F.concat_ws("_", F.lit("seg"), "doc_id", "segment_no"), "low_bandwidth_suspected": F.lit(False), "speaker_overlap_intervals": F.array().cast("array<double>"), "avail_music": F.lit(True), "avail_quality": F.lit(False), "avail_speaker": F.lit(False), "quality_status": F.lit("UNKNOWN"), "speaker_status": F.lit("UNKNOWN"), "transcript_match_status": F.when(F.col("transcript_trusted"), "OK").otherwise("UNKNOWN"), "rights_status": F.lit("REDISTRIBUTION_APPROVED"), "redistribution_permitted": F.lit(True)} | none)
    p = policy.Policy(required=tuple(c for c in policy.CHECKS if c != "quality_ok"), min_duration_s=0.5)
    return policy.decide(full.drop("measured"), p).select("segment_id", F.when(F.col("early").isNotNull(), "REJECT").otherwise(F.col("decision")).alias("decision"), F.array_join(F.coalesce("early", "reason_codes"), "|").alias("reason_codes"), "speech_ratio", "segmented")


ENTRIES = """SELECT doc_id AS seq, CASE doc_id % 6 WHEN 0 THEN concat('org/', source) WHEN 1 THEN concat('Org/', source) WHEN 2 THEN concat('org/', source, '@v1') WHEN 3 THEN concat('org/', source, '@v2') WHEN 4 THEN concat('org/x/', source) END AS ref,
  CASE WHEN doc_id % 4 = 0 THEN 'v1' END AS revision, CASE WHEN doc_id % 5 < 2 THEN concat('000000000000abc', CAST(n_chars % 3 AS STRING)) END AS pinned_sha FROM {documents}"""
JOBS = "SELECT 'old-job' AS job_id, 'org/src1' AS repo_id, 'v1' AS requested_revision, CAST(NULL AS STRING) AS pinned_sha UNION ALL SELECT 'old-pin', 'ORG/src2', NULL, '000000000000abc1'"


@query(f"""WITH e AS ({ENTRIES}), r AS (SELECT seq, CASE WHEN ref NOT LIKE 'org/x/%' THEN split_part(ref, '@', 1) END AS repo_id, coalesce(revision, nullif(split_part(ref, '@', 2), '')) AS requested_revision, pinned_sha,
  CASE WHEN ref IS NULL THEN 'NO_REFERENCE' WHEN ref LIKE 'org/x/%' THEN 'BAD_REFERENCE' END AS error FROM e),
k AS (SELECT *, lower(repo_id) || CASE WHEN pinned_sha IS NOT NULL THEN 'p' || pinned_sha ELSE 'r' || requested_revision END AS kind,
  CASE WHEN error IS NULL THEN replace(repo_id, '/', '--') || CASE WHEN pinned_sha IS NOT NULL THEN '-' || left(pinned_sha, 12) ELSE '-unpinned' END END AS own FROM r),
o AS (SELECT job_id, lower(repo_id) || CASE WHEN pinned_sha IS NOT NULL THEN 'p' || pinned_sha ELSE 'r' || requested_revision END AS kind FROM ({JOBS})),
f AS (SELECT k.*, o.job_id AS old, first_value(own) OVER w AS first, row_number() OVER w AS n FROM k LEFT JOIN o ON o.kind = k.kind WINDOW w AS (PARTITION BY coalesce(k.kind, CAST(seq AS VARCHAR)) ORDER BY seq))
SELECT seq, CASE WHEN error IS NULL THEN repo_id END AS repo_id, requested_revision, pinned_sha, coalesce(old, first) AS job_id, old IS NOT NULL OR n > 1 AS duplicate, CASE WHEN error IS NULL THEN CASE WHEN pinned_sha IS NOT NULL THEN 'CREATED' ELSE 'BLOCKED' END END AS status, error FROM f""")
def ensure_jobs(spark, sf_dir):  # noqa: ANN001, ANN201
    """Documents as entries of a campaign that has two jobs already."""
    return campaign.ensure_jobs(over(spark, sf_dir, ENTRIES), spark.sql(JOBS))


BATCHES = """SELECT concat('job-', source) AS job_id, concat('b-', CAST(doc_id AS STRING)) AS batch_id, CASE doc_id % 7 WHEN 0 THEN 'PLANNED' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'BATCH_PROCESSED' WHEN 3 THEN 'RELEASE_READY' WHEN 4 THEN 'DONE' WHEN 5 THEN 'BLOCKED' ELSE 'odd' END AS status,
  n_chars AS n_files, doc_id % 2 = 0 AS complete, CASE WHEN doc_id % 3 = 0 THEN 'r1' END AS release_id, doc_id % 5 = 0 AS verified FROM {documents}"""


@query(f"""SELECT job_id, batch_id, 'org/' || substr(job_id, 5) AS repo_id, sha256(substr(job_id, 5)) AS pinned_sha, status, n_files, CASE status WHEN 'DONE' THEN 'none' WHEN 'PLANNED' THEN 'download' WHEN 'IN_PROGRESS' THEN CASE WHEN complete THEN 'qc' ELSE 'download' END WHEN 'BATCH_PROCESSED' THEN 'gate'
  WHEN 'RELEASE_READY' THEN CASE WHEN release_id IS NULL THEN 'prepare-release' WHEN verified THEN 'cleanup' ELSE 'publish (awaiting approval)' END WHEN 'BLOCKED' THEN 'blocked' ELSE 'unknown:' || status END AS next_action FROM ({BATCHES})""")
def dry_run_plan(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("source").distinct()
    jobs = d.select(F.concat(F.lit("job-"), "source").alias("job_id"), F.concat(F.lit("org/"), "source").alias("repo_id"), F.sha2("source", 256).alias("pinned_sha"))
    return campaign.dry_run(jobs, over(spark, sf_dir, BATCHES))


@query("""WITH b AS (SELECT 'clip_' || user_id AS id, event_type AS source_uri, value AS duration, ts AS recorded, event_id % 2 AS new, event_id FROM {events}),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY recorded DESC, new DESC, event_id DESC) AS n FROM b) SELECT id, source_uri, duration FROM r WHERE n = 1""")
def provenance_upsert(spark, sf_dir):  # noqa: ANN001, ANN201
    """Events as recordings, those of odd ids being the newly found ones."""
    e = table(spark, sf_dir, "events")
    rows = lambda odd: e.filter(F.col("event_id") % 2 == odd).select(F.concat(F.lit("clip_"), "user_id").alias("id"), F.col("event_type").alias("source_uri"), F.col("value").alias("duration"), F.struct("ts", F.lit(odd).alias("n"), "event_id").alias("recorded"))
    return campaign.upsert_provenance(rows(0), rows(1)).select("id", "source_uri", "duration")
