"""Decisions: admission, the technical verdict, policy checks, review. Inputs are views that both engines read alike."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import admission, policy, rights
from corpusloom.plans.base import over, query, table

#: Documents as analysed segments: every branch of the policy is met by some row.
EVIDENCE = """
SELECT d.doc_id, concat('seg_', CAST(d.doc_id AS STRING)) AS segment_id, d.source AS source_id,
  CAST(0 AS BIGINT) AS interval_start_sample, CAST(CASE WHEN d.doc_id % 41 = 0 THEN 0 ELSE d.n_chars * 16 END AS BIGINT) AS interval_end_sample,
  CAST(16000 AS INT) AS analysis_sample_rate,
  CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE CAST(d.doc_id % 10 AS DOUBLE) / 8 END AS speech_ratio,
  CASE WHEN d.doc_id % 19 = 0 THEN NULL ELSE CAST(d.doc_id % 50 AS DOUBLE) / 4096 END AS clipping_ratio,
  d.doc_id % 13 = 0 AS low_bandwidth_suspected, CASE WHEN d.doc_id % 26 <> 0 THEN CAST(d.n_chars % 9000 AS DOUBLE) + CAST(d.doc_id % 4 AS DOUBLE) / 4 END AS effective_bandwidth_hz,
  CASE WHEN d.doc_id % 5 = 0 THEN 'CLIPPING_DISTORTION' WHEN d.doc_id % 5 = 1 THEN 'MUSIC_BACKGROUND' WHEN d.doc_id % 5 = 2 THEN 'HISS_STATIC' END AS ev_label,
  CASE WHEN d.doc_id % 7 = 6 THEN 'NX' ELSE concat('N', CAST(d.doc_id % 7 % 4 AS STRING)) END AS ev_severity,
  d.doc_id % 3 <> 0 AS ev_overlaps,
  d.doc_id % 29 <> 0 AS avail_music, d.doc_id % 31 <> 0 AS avail_quality, d.doc_id % 23 <> 0 AS avail_speaker,
  CASE WHEN d.doc_id % 37 = 0 THEN 'UNKNOWN' ELSE 'OK' END AS quality_status,
  CASE WHEN d.doc_id % 37 = 1 THEN 'UNKNOWN' ELSE 'OK' END AS speaker_status,
  CAST(d.n_chars % 400 AS DOUBLE) / 128 + 2 AS sig, CASE WHEN d.doc_id % 43 = 0 THEN NULL ELSE CAST(d.n_chars % 300 AS DOUBLE) / 128 + 2 END AS bak, CAST(d.n_chars % 500 AS DOUBLE) / 128 + 2 AS ovrl,
  d.doc_id % 11 = 0 AS overlapped,
  CASE WHEN l.quality IS NULL THEN 'UNKNOWN' WHEN l.quality = 1 THEN 'OK' WHEN l.toxic = 1 THEN 'ERROR' ELSE 'NOT_APPLICABLE' END AS transcript_match_status,
  CASE d.lang WHEN 'en' THEN 'REDISTRIBUTION_APPROVED' WHEN 'fr' THEN 'TRAIN_ONLY' WHEN 'de' THEN CASE WHEN d.doc_id % 2 = 0 THEN 'REDISTRIBUTION_APPROVED' ELSE 'FORBIDDEN' END ELSE CASE WHEN d.doc_id % 2 = 0 THEN 'LICENSE_REVIEW' ELSE 'UNKNOWN' END END AS rights_status,
  d.doc_id % 9 <> 0 AS redistribution_permitted
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""
POLICY = policy.Policy(single_speaker=True, floors={"sig": 2.25, "bak": 2.25, "ovrl": None}, required=tuple(c for c in policy.CHECKS if c != "no_interfering_speech"))


def evidence(spark, sf_dir):  # noqa: ANN001, ANN201
    e = over(spark, sf_dir, EVIDENCE)
    event = F.struct(F.col("ev_label").alias("label"), F.col("ev_severity").alias("severity"), F.col("ev_overlaps").alias("overlaps_speech"))
    none = F.array().cast("array<struct<label:string,severity:string,overlaps_speech:boolean>>")
    spans = F.array().cast("array<double>")
    return e.withColumns({"noise_events": F.when(F.col("ev_label").isNotNull(), F.array(event)).otherwise(none), "speaker_overlap_intervals": F.when(F.col("overlapped"), F.array(F.lit(1.0))).otherwise(spans)})


_RANK = "CASE ev_severity WHEN 'N0' THEN 0 WHEN 'N1' THEN 1 WHEN 'N2' THEN 2 ELSE 3 END"
#: The ten checks as SQL over EVIDENCE, written apart from the operators.
CHECKS_SQL = f"""
e AS ({EVIDENCE}),
c AS (SELECT e.*, interval_end_sample / 16000.0 AS dur,
  CASE WHEN speech_ratio IS NULL THEN 'UNKNOWN' WHEN speech_ratio < 0.5 THEN 'FAIL' ELSE 'PASS' END AS has_speech,
  CASE WHEN interval_end_sample <= 0 THEN 'UNKNOWN' WHEN interval_end_sample < 48000 OR interval_end_sample > 192000 THEN 'FAIL' ELSE 'PASS' END AS duration_ok,
  CASE WHEN low_bandwidth_suspected THEN 'UNKNOWN' ELSE 'PASS' END AS source_bandwidth_ok,
  CASE WHEN ev_label = 'CLIPPING_DISTORTION' AND ev_severity = 'N3' THEN 'FAIL' WHEN clipping_ratio > 0.01 THEN 'FAIL' ELSE 'PASS' END AS no_clipping,
  CASE WHEN NOT avail_music THEN 'UNKNOWN' WHEN ev_label = 'MUSIC_BACKGROUND' AND ev_overlaps AND {_RANK} >= 2 THEN 'FAIL' ELSE 'PASS' END AS no_confirmed_music_overlap,
  CASE WHEN ev_label = 'HISS_STATIC' AND ev_overlaps AND {_RANK} > 1 THEN 'FAIL' ELSE 'PASS' END AS no_severe_noise_overlap,
  CASE WHEN speaker_status = 'UNKNOWN' OR NOT avail_speaker THEN 'UNKNOWN' WHEN overlapped THEN 'FAIL' ELSE 'PASS' END AS no_interfering_speech,
  CASE WHEN NOT avail_quality OR quality_status <> 'OK' THEN 'UNKNOWN' WHEN sig < 2.25 THEN 'FAIL' WHEN bak IS NULL THEN 'UNKNOWN' WHEN bak < 2.25 THEN 'FAIL' ELSE 'PASS' END AS quality_ok,
  CASE WHEN transcript_match_status IN ('OK', 'NOT_APPLICABLE') THEN 'PASS' WHEN transcript_match_status = 'ERROR' THEN 'FAIL' ELSE 'UNKNOWN' END AS transcript_ok,
  CASE WHEN rights_status = 'REDISTRIBUTION_APPROVED' AND redistribution_permitted THEN 'PASS' ELSE 'FAIL' END AS rights_ok
  FROM e),
q AS (SELECT c.*, [has_speech, duration_ok, source_bandwidth_ok, no_clipping, no_confirmed_music_overlap, no_severe_noise_overlap, quality_ok, transcript_ok] AS need FROM c),
p AS (SELECT q.*, CASE
  WHEN rights_ok = 'FAIL' AND NOT list_contains(need, 'FAIL') THEN 'LICENSE_REVIEW'
  WHEN rights_ok = 'FAIL' OR list_contains(need, 'FAIL') THEN 'REJECT'
  WHEN rights_status IN ('LICENSE_REVIEW', 'UNKNOWN') THEN 'LICENSE_REVIEW'
  WHEN list_contains(need, 'UNKNOWN') THEN 'REVIEW' ELSE 'ACCEPT' END AS decision,
  list_filter([
    CASE WHEN has_speech = 'UNKNOWN' THEN 'SPEECH_RATIO_UNKNOWN' WHEN has_speech = 'FAIL' THEN 'NO_SPEECH:ratio=' || printf('%.2f', speech_ratio) END,
    CASE WHEN duration_ok = 'UNKNOWN' THEN 'DURATION_UNKNOWN' WHEN duration_ok = 'FAIL' THEN CASE WHEN interval_end_sample < 48000 THEN 'DURATION_TOO_SHORT:' || printf('%.2f', dur::DOUBLE) || 's<3.0s' ELSE 'DURATION_TOO_LONG:' || printf('%.2f', dur::DOUBLE) || 's>12.0s' END END,
    CASE WHEN source_bandwidth_ok = 'UNKNOWN' THEN 'SUSPECTED_UPSAMPLED_SOURCE' || coalesce(':eff_bw=' || printf('%.0f', effective_bandwidth_hz) || 'Hz', '') END,
    CASE WHEN no_clipping = 'FAIL' THEN CASE WHEN ev_label = 'CLIPPING_DISTORTION' AND ev_severity = 'N3' THEN 'CLIPPING_CONFIRMED_N3' ELSE 'CLIPPING_RATIO:' || printf('%.4f', clipping_ratio) END END,
    CASE no_confirmed_music_overlap WHEN 'UNKNOWN' THEN 'MUSIC_GATE_UNAVAILABLE' WHEN 'FAIL' THEN 'MUSIC_OVERLAP_CONFIRMED' END,
    CASE WHEN no_severe_noise_overlap = 'FAIL' THEN 'NOISE_OVERLAP_SEVERITY>N1' END,
    CASE no_interfering_speech WHEN 'UNKNOWN' THEN 'SPEAKER_GATE_UNAVAILABLE' WHEN 'FAIL' THEN 'INTERFERING_SPEECH_CONFIRMED' END,
    CASE WHEN quality_ok = 'UNKNOWN' THEN CASE WHEN NOT avail_quality OR quality_status <> 'OK' THEN 'QUALITY_MODEL_UNAVAILABLE' ELSE 'QUALITY_BAK_UNKNOWN' END WHEN quality_ok = 'FAIL' THEN CASE WHEN sig < 2.25 THEN 'QUALITY_SIG_BELOW:' || printf('%.2f', sig) || '<2.25' ELSE 'QUALITY_BAK_BELOW:' || printf('%.2f', bak) || '<2.25' END END,
    CASE transcript_ok WHEN 'FAIL' THEN 'TRANSCRIPT_MISMATCH' WHEN 'UNKNOWN' THEN 'TRANSCRIPT_UNVERIFIED' END,
    CASE WHEN rights_ok = 'FAIL' THEN 'RIGHTS_NOT_REDISTRIBUTABLE:' || rights_status END], lambda x: x IS NOT NULL) AS reasons FROM q)
"""


def decided(spark, sf_dir):  # noqa: ANN001, ANN201
    return policy.decide(evidence(spark, sf_dir), POLICY)


@query(f"WITH {CHECKS_SQL} SELECT segment_id, {', '.join(policy.CHECKS)} FROM p")
def policy_checks(spark, sf_dir):  # noqa: ANN001, ANN201
    d = decided(spark, sf_dir)
    return d.select("segment_id", *(F.col("observed_checks")[k].alias(k) for k in policy.CHECKS))


@query(f"WITH {CHECKS_SQL} SELECT segment_id, decision FROM p")
def policy_decision(spark, sf_dir):  # noqa: ANN001, ANN201
    return decided(spark, sf_dir).select("segment_id", "decision")


@query(f"WITH {CHECKS_SQL} SELECT segment_id, array_to_string(reasons, '|') AS reason_codes FROM p")
def reason_codes(spark, sf_dir):  # noqa: ANN001, ANN201
    return decided(spark, sf_dir).select("segment_id", F.array_join("reason_codes", "|").alias("reason_codes"))


@query(f"WITH {CHECKS_SQL} SELECT segment_id, source_id, decision, array_to_string(reasons, '|') AS reason_codes, 'evidence/' || segment_id || '.json' AS evidence_ref FROM p WHERE decision IN ('REVIEW', 'ERROR', 'LICENSE_REVIEW')")
def review_queue(spark, sf_dir):  # noqa: ANN001, ANN201
    return policy.review_queue(decided(spark, sf_dir)).select("segment_id", "source_id", "decision", F.array_join("reason_codes", "|").alias("reason_codes"), "evidence_ref")


@query(f"""WITH {CHECKS_SQL}, r AS (SELECT source_id, decision, row_number() OVER (PARTITION BY source_id ORDER BY CASE decision WHEN 'REJECT' THEN 3 WHEN 'ACCEPT' THEN 1 ELSE 2 END DESC, doc_id) AS n FROM p)
SELECT source_id, decision FROM r WHERE n = 1""")
def terminal_decision(spark, sf_dir):  # noqa: ANN001, ANN201
    return policy.terminal_decision(decided(spark, sf_dir), "source_id", "doc_id")


@query("""WITH e AS (SELECT rights_status, redistribution_permitted FROM (""" + EVIDENCE + """) x)
SELECT rights_status, redistribution_permitted, count(*) AS n,
  CASE WHEN rights_status IN ('REDISTRIBUTION_APPROVED', 'TRAIN_ONLY') THEN 'PASS' ELSE 'FAIL' END AS train_only FROM e GROUP BY ALL""")
def policy_train_only_rights(spark, sf_dir):  # noqa: ANN001, ANN201
    d = policy.decide(evidence(spark, sf_dir), policy.Policy(target="train_only"))
    return d.groupBy("rights_status", "redistribution_permitted", F.col("observed_checks")["rights_ok"].alias("train_only")).agg(F.count(F.lit(1)).alias("n"))


#: Documents as probed sources.
SOURCES = """
SELECT doc_id, CAST(CASE WHEN doc_id % 53 = 0 THEN NULL WHEN doc_id % 53 = 1 THEN 0 ELSE 7000 + n_chars * 5 END AS INT) AS rate,
  CASE doc_id % 6 WHEN 0 THEN 'pcm_s16le' WHEN 1 THEN 'MP3' WHEN 2 THEN ' flac ' WHEN 3 THEN 'opus' WHEN 4 THEN 'strange' END AS codec, doc_id % 7 = 0 AS low, CASE WHEN doc_id % 14 <> 0 THEN CAST(n_chars AS DOUBLE) / 8 END AS bandwidth
FROM {documents}
"""


@query("WITH s AS (" + SOURCES + """), k AS (SELECT *, coalesce(rate <= 0, TRUE) AS none,
  CASE WHEN rate >= 24000 THEN 'NATIVE_OR_HIGHER' WHEN rate >= 22050 THEN 'BELOW_MIN_NATIVE' WHEN rate >= 16000 THEN 'LOW_BANDWIDTH_SOURCE' ELSE 'NARROWBAND_SOURCE' END AS k,
  CASE lower(trim(codec)) WHEN 'pcm_s16le' THEN FALSE WHEN 'flac' THEN FALSE WHEN 'mp3' THEN TRUE WHEN 'opus' THEN TRUE END AS lossy FROM s)
SELECT doc_id, CASE WHEN NOT none THEN k END AS source_rate_class,
  CASE WHEN none THEN 'ERROR' WHEN k = 'NATIVE_OR_HIGHER' THEN 'IDENTITY' WHEN k = 'BELOW_MIN_NATIVE' THEN 'REJECT_BELOW_MIN_NATIVE' WHEN k = 'LOW_BANDWIDTH_SOURCE' THEN 'REJECT_LOW_BANDWIDTH' ELSE 'REJECT_NARROWBAND' END AS action,
  NOT none AND k = 'NATIVE_OR_HIGHER' AS admitted, lossy AS source_lossy,
  array_to_string(list_filter([CASE WHEN none THEN 'SOURCE_SAMPLE_RATE_UNMEASURABLE' ELSE 'SOURCE_RATE_CLASS:' || k || ':sr=' || rate END, CASE WHEN NOT none AND lossy THEN 'SOURCE_LOSSY:codec=' || codec END,
    CASE WHEN NOT none AND low THEN 'SUSPECTED_UPSAMPLED_SOURCE:eff_bw=' || coalesce(CAST(bandwidth AS VARCHAR), 'None') END, CASE WHEN NOT none AND k = 'BELOW_MIN_NATIVE' THEN 'BELOW_MIN_NATIVE:sr=' || rate || '<min=24000' END,
    CASE WHEN NOT none AND k IN ('LOW_BANDWIDTH_SOURCE', 'NARROWBAND_SOURCE') THEN k END], lambda x: x IS NOT NULL), '|') AS reason_codes FROM k""")
def rate_class_admission(spark, sf_dir):  # noqa: ANN001, ANN201
    s = over(spark, sf_dir, SOURCES)
    a = admission.admission(F.col("rate"), F.col("codec"), F.col("low"), bandwidth=F.col("bandwidth"))
    return s.select("doc_id", *(F.array_join(c, "|").alias(k) if k == "reason_codes" else c.alias(k) for k, c in a.items()))


#: Order lines as measured signals.
SIGNALS = """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE floor(l_quantity) * 8000 END AS BIGINT) AS n_samples, l_tax / 100 AS rms, l_discount / 8 AS clipping_ratio,
  (l_tax - 0.04) / 2 AS dc_offset, l_partkey % 101 = 0 AS has_nan, l_partkey % 103 = 0 AS has_inf, l_quantity / 2 AS duration_s, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity / 2 + 0.25 END AS declared_s,
  l_extendedprice / 4 AS bandwidth_hz, CASE WHEN l_linenumber = 1 THEN 8000 ELSE 24000 END AS sample_rate
FROM {lineitem}
"""


@query("WITH s AS (" + SIGNALS + """), b AS (SELECT *, n_samples = 0 OR has_nan OR has_inf AS broken, rms < 0.0001 AS quiet, clipping_ratio > 0.01 AS clipped, duration_s < 0.2 AS short, duration_s > 12 AS over,
  bandwidth_hz < 0.45 * least(sample_rate / 2.0, 12000.0) AS low FROM s),
v AS (SELECT *, CASE WHEN broken OR quiet OR clipped OR short THEN 'REJECT_TECH' WHEN over AND duration_s <= 600 THEN 'SEGMENT_CANDIDATE' WHEN over THEN 'REJECT_TECH' ELSE 'VALID' END AS verdict FROM b)
SELECT verdict, low AS low_bandwidth_suspected, array_to_string(list_filter([CASE WHEN has_nan THEN 'NAN_SAMPLES' END, CASE WHEN has_inf THEN 'INF_SAMPLES' END, CASE WHEN n_samples = 0 THEN 'EMPTY_AUDIO' END,
  CASE WHEN quiet THEN 'SILENT_OR_NO_SPEECH_LEVEL' END, CASE WHEN clipped THEN 'CLIPPING' END, CASE WHEN abs(dc_offset) > 0.02 THEN 'DC_OFFSET' END, CASE WHEN low THEN 'LOW_BANDWIDTH_SUSPECTED' END, CASE WHEN NOT broken AND short THEN 'TOO_SHORT' END,
  CASE WHEN NOT broken AND over AND duration_s <= 600 THEN 'OVER_MAX_DURATION_SEGMENT_CANDIDATE' END, CASE WHEN NOT broken AND over AND duration_s > 600 THEN 'TOO_LONG' END,
  CASE WHEN duration_s > 0 AND abs(declared_s - duration_s) > greatest(0.05, 0.02 * duration_s) THEN 'DURATION_MISMATCH' END], lambda x: x IS NOT NULL), '|') AS reason_codes, count(*) AS n FROM v GROUP BY ALL""")
def technical_verdict(spark, sf_dir):  # noqa: ANN001, ANN201
    s = over(spark, sf_dir, SIGNALS)
    v = admission.technical_verdict({c: F.col(c) for c in s.columns}, admission.Technical(segment_over_max=True))
    out = s.select(v["verdict"].alias("verdict"), v["low_bandwidth_suspected"].alias("low_bandwidth_suspected"), F.array_join(v["reason_codes"], "|").alias("reason_codes"))
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


DECLARED = """
SELECT * FROM (VALUES (1, 'src0', NULL, 'REDISTRIBUTION_APPROVED', TRUE, 'true', 'cc0-1.0'), (2, NULL, 'http://', 'LICENSE_REVIEW', FALSE, NULL, NULL), (3, NULL, 'http://th', 'TRAIN_ONLY', FALSE, 'false', 'mit'),
  (4, NULL, 'http://thr', 'TRAIN_ONLY', TRUE, 'false', 'mit'), (5, NULL, 'https://', 'REDISTRIBUTION_APPROVED', TRUE, 'true', 'cc-by-4.0'), (6, NULL, 'http://th', 'FORBIDDEN', FALSE, NULL, NULL), (7, 'src1', NULL, 'FORBIDDEN', FALSE, NULL, ''))
  AS d(seq, source_id, uri_prefix, rights_status, redistribution_permitted, commercial_training_permitted, source_license)
"""
PAGE_SOURCES = "SELECT page_id, concat('src', CAST(page_id % 20 AS STRING)) AS source_id, url AS source_uri, CASE WHEN page_id % 4 = 0 THEN 'odbl' ELSE '' END AS source_license FROM {pages}"


@query("WITH d AS (" + DECLARED + "), s AS (" + PAGE_SOURCES + """), m AS (SELECT s.*, d.seq, d.rights_status, d.redistribution_permitted AS flag, d.commercial_training_permitted AS com, d.source_license AS lic,
  row_number() OVER (PARTITION BY page_id ORDER BY d.seq IS NULL, d.source_id IS NULL, length(d.uri_prefix) DESC, d.seq) AS n FROM s LEFT JOIN d ON d.source_id = s.source_id OR starts_with(s.source_uri, d.uri_prefix))
SELECT page_id, CASE WHEN seq IS NULL OR (flag AND rights_status <> 'REDISTRIBUTION_APPROVED') THEN 'LICENSE_REVIEW' ELSE rights_status END AS rights_status,
  CASE WHEN seq IS NULL OR (flag AND rights_status <> 'REDISTRIBUTION_APPROVED') THEN FALSE ELSE flag END AS redistribution_permitted, coalesce(com, 'UNKNOWN') AS commercial_training_permitted,
  coalesce(nullif(source_license, ''), nullif(lic, ''), 'UNKNOWN') AS license FROM m WHERE n = 1""")
def rights_longest_prefix(spark, sf_dir):  # noqa: ANN001, ANN201
    out = rights.evaluate(over(spark, sf_dir, PAGE_SOURCES), spark.sql(DECLARED))
    return out.select("page_id", "rights_status", "redistribution_permitted", "commercial_training_permitted", "license")


@query("""WITH s AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN ' redistribution_approved' WHEN 1 THEN 'Train_Only' WHEN 2 THEN 'whatever' WHEN 3 THEN NULL ELSE 'FORBIDDEN' END AS s, doc_id % 2 = 0 AS f FROM {documents}),
k AS (SELECT doc_id, f, CASE WHEN upper(trim(s)) IN ('REDISTRIBUTION_APPROVED', 'TRAIN_ONLY', 'LICENSE_REVIEW', 'FORBIDDEN', 'UNKNOWN') THEN upper(trim(s)) ELSE 'UNKNOWN' END AS rights_status FROM s)
SELECT doc_id, rights_status, rights_status = 'REDISTRIBUTION_APPROVED' AND f AS redistribution_permitted FROM k""")
def job_rights(spark, sf_dir):  # noqa: ANN001, ANN201
    s = table(spark, sf_dir, "documents")
    status = F.expr("CASE doc_id % 5 WHEN 0 THEN ' redistribution_approved' WHEN 1 THEN 'Train_Only' WHEN 2 THEN 'whatever' WHEN 3 THEN NULL ELSE 'FORBIDDEN' END")
    return s.select("doc_id", *(c.alias(k) for k, c in rights.job_rights(status, F.col("doc_id") % 2 == 0).items()))


@query("""SELECT l.lang AS language, count(*) AS n_docs, count(DISTINCT source) AS n_sources, array_to_string(list_sort(list_distinct(list(lic))), ',') AS licenses, array_to_string(list_sort(list_distinct(list(st))), ',') AS statuses
FROM (SELECT lang, source, CASE doc_id % 3 WHEN 0 THEN 'mit' WHEN 1 THEN 'cc0-1.0' ELSE 'odbl' END AS lic, CASE WHEN doc_id % 2 = 0 THEN 'TRAIN_ONLY' ELSE 'UNKNOWN' END AS st FROM {documents}) l GROUP BY l.lang""")
def release_rights_report(spark, sf_dir):  # noqa: ANN001, ANN201
    d = over(spark, sf_dir, "SELECT lang, source, CASE doc_id % 3 WHEN 0 THEN 'mit' WHEN 1 THEN 'cc0-1.0' ELSE 'odbl' END AS license, CASE WHEN doc_id % 2 = 0 THEN 'TRAIN_ONLY' ELSE 'UNKNOWN' END AS rights_status FROM {documents}")
    per = d.groupBy(F.col("lang").alias("language")).agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("source").alias("n_sources"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.array_join(F.array_sort(F.collect_set("rights_status")), ",").alias("statuses"))
    return per


ERRORS = """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'GatedRepoError' WHEN 1 THEN 'OSError' ELSE 'HTTPError' END AS kind, CAST(CASE o_orderkey % 7 WHEN 0 THEN 404 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 401 END AS INT) AS status,
  CASE o_orderkey % 11 WHEN 0 THEN 'No space left on device' WHEN 1 THEN 'read timed out' WHEN 2 THEN 'Disk quota exceeded' WHEN 3 THEN 'Entry 404' ELSE NULL END AS message FROM {orders}"""


@query("WITH e AS (" + ERRORS + """) SELECT o_orderkey, CASE WHEN kind = 'GatedRepoError' OR coalesce(message, '') LIKE '%404%' OR coalesce(status IN (401, 403, 404), FALSE) THEN 'permanent' WHEN coalesce(status = 429, FALSE) THEN 'rate_limited'
  WHEN coalesce(status BETWEEN 500 AND 599, FALSE) THEN 'transient' WHEN lower(coalesce(message, '')) LIKE '%no space left%' OR lower(coalesce(message, '')) LIKE '%disk quota%' THEN 'disk_full' ELSE 'transient' END AS error_class FROM e""")
def error_class(spark, sf_dir):  # noqa: ANN001, ANN201
    e = over(spark, sf_dir, ERRORS)
    return e.select("o_orderkey", admission.classify_error(F.col("kind"), F.col("status"), F.col("message")).alias("error_class"))


@query("""WITH o AS (SELECT o_custkey % 50 AS job, CAST(floor(o_totalprice) * CASE WHEN o_custkey % 50 < 10 THEN 8000 ELSE 40 END AS BIGINT) AS size FROM {orders}),
a AS (SELECT job, count(*) AS n, count(*) FILTER (WHERE size <= 5242880) AS n_small, count(*) FILTER (WHERE size >= 524288000) AS n_large, sum(size) AS total_bytes FROM o GROUP BY job)
SELECT job, n, n_small, n_large, CAST(total_bytes AS BIGINT) AS total_bytes, CASE WHEN n_large > 0 AND n_large * 2 >= n THEN 'few_large' WHEN n_small * 2 >= n THEN 'many_small' ELSE 'mixed' END AS profile FROM a""")
def size_profile(spark, sf_dir):  # noqa: ANN001, ANN201
    o = over(spark, sf_dir, "SELECT o_custkey % 50 AS job, CAST(floor(o_totalprice) * CASE WHEN o_custkey % 50 < 10 THEN 8000 ELSE 40 END AS BIGINT) AS size FROM {orders}")
    return o.groupBy("job").agg(*(c.alias(k) for k, c in admission.size_profile(F.col("size")).items()))
