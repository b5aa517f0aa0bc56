"""Plans and campaign state. Folds have recursive SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.operators import planning, state
from corpusloom.plans.base import over, query, table

FILES = "SELECT source AS job, concat('f', lpad(CAST(doc_id AS STRING), 8, '0')) AS path, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE CAST(CASE WHEN doc_id % 47 = 0 THEN 50000 ELSE n_chars END AS BIGINT) END AS size FROM {documents}"
MAX_FILES, MAX_BYTES = 12, 20_000
BUDGET = planning.Budget(workspace=120_000, max_batch_bytes=20_000, max_files=12, unknown_estimate=4_000, max_unknown=2)

_ORDERED = f"f AS ({FILES}), o AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY path) AS i FROM f)"
PACK_SQL = f"""{_ORDERED},
s(job, i, path, size, batch_no, n, bytes, alone) AS (
  SELECT job, i, path, size, 0, 1, coalesce(size, 0), coalesce(size > {MAX_BYTES}, FALSE) FROM o WHERE i = 1
  UNION ALL
  SELECT o.job, o.i, o.path, o.size,
    CASE WHEN s.alone OR s.n >= {MAX_FILES} OR coalesce(s.bytes + o.size > {MAX_BYTES}, FALSE) THEN s.batch_no + 1 ELSE s.batch_no END,
    CASE WHEN s.alone OR s.n >= {MAX_FILES} OR coalesce(s.bytes + o.size > {MAX_BYTES}, FALSE) THEN 1 ELSE s.n + 1 END,
    CASE WHEN s.alone OR s.n >= {MAX_FILES} OR coalesce(s.bytes + o.size > {MAX_BYTES}, FALSE) THEN 0 ELSE s.bytes END + coalesce(o.size, 0),
    (s.alone OR s.n >= {MAX_FILES} OR coalesce(s.bytes + o.size > {MAX_BYTES}, FALSE)) AND coalesce(o.size > {MAX_BYTES}, FALSE)
  FROM s JOIN o ON o.job = s.job AND o.i = s.i + 1)"""
_FULL = "(s.n >= 12 OR s.bytes + coalesce(o.size, 4000) > 20000 OR (o.size IS NULL AND s.unknown >= 2))"
BUDGET_SQL = f"""{_ORDERED},
s(job, i, path, size, batch_no, n, bytes, unknown) AS (
  SELECT job, i, path, size, 0, 1, coalesce(size, 0), CASE WHEN size IS NULL THEN 1 ELSE 0 END FROM o WHERE i = 1
  UNION ALL
  SELECT o.job, o.i, o.path, o.size, s.batch_no + CAST({_FULL} AS INT), CASE WHEN {_FULL} THEN 1 ELSE s.n + 1 END, CASE WHEN {_FULL} THEN 0 ELSE s.bytes END + coalesce(o.size, 0), CASE WHEN {_FULL} THEN 0 ELSE s.unknown END + CASE WHEN o.size IS NULL THEN 1 ELSE 0 END
  FROM s JOIN o ON o.job = s.job AND o.i = s.i + 1)"""
_ID = "'b-' || substr(sha256('repo' || chr(0) || 'rev' || chr(0) || lpad(CAST(batch_no AS VARCHAR), 6, '0') || chr(0) || string_agg(path, chr(0) ORDER BY path)), 1, 16)"


def files(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, FILES)


@query(f"WITH RECURSIVE {PACK_SQL} SELECT job, path, size, CAST(batch_no AS BIGINT) AS batch_no FROM s")
def pack_batches(spark, sf_dir):  # noqa: ANN001, ANN201
    return planning.pack_files(files(spark, sf_dir), "job", "path", "size", ["path"], MAX_FILES, MAX_BYTES)


@query(f"""WITH RECURSIVE {BUDGET_SQL}, b AS (SELECT job, CAST(batch_no AS BIGINT) AS batch_no, count(*) AS n_files, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_bytes, count(*) FILTER (WHERE size IS NULL) AS n_unknown, {_ID} AS batch_id FROM s GROUP BY job, batch_no)
SELECT *, total_bytes + n_unknown * 4000 AS accountable_bytes, total_bytes + n_unknown * 4000 AS reserve_cache, total_bytes + n_unknown * 4000 AS reserve_staging, 2 * (total_bytes + n_unknown * 4000) AS reserve_qc, total_bytes + n_unknown * 4000 AS reserve_upload,
  CASE WHEN n_files = 1 AND 5 * (total_bytes + n_unknown * 4000) > 120000 THEN 'BLOCKED' ELSE 'PLANNED' END AS status FROM b""")
def pack_budget(spark, sf_dir):  # noqa: ANN001, ANN201
    return planning.batches(planning.pack_budget(files(spark, sf_dir), "job", "path", "size", BUDGET), "job", "path", "size", BUDGET)


@query(f"""SELECT source AS job, 'b-' || substr(sha256('org/name' || chr(0) || 'abc' || chr(0) || '000007' || chr(0) || string_agg('f' || doc_id, chr(0) ORDER BY 'f' || doc_id)), 1, 16) AS batch_id FROM documents GROUP BY source""")
def batch_ids(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    g = d.groupBy(F.col("source").alias("job")).agg(F.collect_list(F.concat(F.lit("f"), F.col("doc_id").cast("string"))).alias("files"))
    return g.select("job", ids.batch_id(F.lit("org/name"), F.lit("abc"), F.lit(7), F.col("files")).alias("batch_id"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY lang, doc_id) - 1) // 100 AS chunk FROM {documents}")
def chunk_accepted(spark, sf_dir):  # noqa: ANN001, ANN201
    d = over(spark, sf_dir, "SELECT doc_id, lang FROM {documents}")
    return planning.chunks(d, ["lang", "doc_id"], 100).select("doc_id", "chunk")


@query("SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 1000 AS shard, doc_id FROM {documents}")
def shard_index(spark, sf_dir):  # noqa: ANN001, ANN201
    return planning.chunks(over(spark, sf_dir, "SELECT doc_id FROM {documents}"), ["doc_id"], 1000, "shard").select("shard", "doc_id")


@query("""WITH RECURSIVE o AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS need, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM {events}),
s(user_id, event_id, i, used, admitted) AS (SELECT user_id, event_id, i, CASE WHEN need <= 400 THEN need ELSE 0 END, need <= 400 FROM o WHERE i = 1
  UNION ALL SELECT o.user_id, o.event_id, o.i, s.used + CASE WHEN s.used + o.need <= 400 THEN o.need ELSE 0 END, s.used + o.need <= 400 FROM s JOIN o ON o.user_id = s.user_id AND o.i = s.i + 1)
SELECT user_id, event_id, admitted FROM s""")
def admit_under_caps(spark, sf_dir):  # noqa: ANN001, ANN201
    e = over(spark, sf_dir, "SELECT user_id, event_id, ts, CAST(floor(value) AS BIGINT) AS need FROM {events}")
    return planning.admit(e, "event_id", ["ts", "event_id"], "need", 400, "user_id")


@query("""WITH s AS (SELECT user_id, event_id, CASE WHEN value < 20 THEN 'stop' WHEN value >= 60 THEN 'run' END AS signal, ts FROM {events})
SELECT user_id, event_id, coalesce(last_value(signal IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 'run') AS gate FROM s""")
def watermark_states(spark, sf_dir):  # noqa: ANN001, ANN201
    return planning.hysteresis(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value", 20, 60).select("user_id", "event_id", "gate")


@query("""WITH o AS (SELECT doc_id, n_chars, CASE WHEN n_chars % 3 = 0 THEN 'DONE' ELSE 'IN_PROGRESS' END AS status FROM {documents} WHERE doc_id % 2 = 0)
SELECT d.doc_id, CASE WHEN o.n_chars = d.n_chars - d.doc_id % 4 THEN o.status ELSE 'PLANNED' END AS status FROM {documents} d LEFT JOIN o ON o.doc_id = d.doc_id""")
def replan_keeps_progress(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    new = d.select("doc_id", (F.col("n_chars") - F.col("doc_id") % 4).alias("files"), F.lit("PLANNED").alias("status"))
    old = d.filter("doc_id % 2 = 0").select("doc_id", F.col("n_chars").alias("files"), F.when(F.col("n_chars") % 3 == 0, "DONE").otherwise("IN_PROGRESS").alias("status"))
    return planning.replan(new, old, "doc_id").select("doc_id", "status")


@query("SELECT doc_id, n_chars FROM {documents} WHERE n_chars > 20000")
def oversized_files(spark, sf_dir):  # noqa: ANN001, ANN201
    return planning.oversized(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 20_000)


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, bool_or(event_type IN ('purchase', 'signup')) AS done FROM {events} GROUP BY user_id")
def checkpoint_replay(spark, sf_dir):  # noqa: ANN001, ANN201
    return state.replay(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"], ("purchase", "signup"))


@query("WITH l AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM {events}) SELECT user_id FROM l WHERE n = 1 AND event_type IN ('purchase', 'signup')")
def done_set(spark, sf_dir):  # noqa: ANN001, ANN201
    return state.terminal(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"], ("purchase", "signup"))


@query("SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS seq FROM {events}")
def audit_resequence(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.struct("ts", "event_id").alias("local_seq"))
    return state.resequence(e, "user_id", "local_seq").select("event_id", "user_id", "seq")


BATCHES = """SELECT o_orderkey, o_custkey % 40 AS job, CASE o_orderkey % 7 WHEN 0 THEN 'DONE' WHEN 1 THEN 'PLANNED' WHEN 2 THEN 'IN_PROGRESS' WHEN 3 THEN 'BATCH_PROCESSED' WHEN 4 THEN 'RELEASE_READY' WHEN 5 THEN 'BLOCKED' ELSE 'ODD' END AS status,
  o_custkey % 2 = 0 AS complete, CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('rel-', CAST(o_orderkey AS STRING)) END AS release_id, o_orderkey % 5 <> 0 AS verified, o_orderkey % 3 <> 0 AS full_hash, o_orderkey % 11 <> 0 AS dir_ok, o_orderkey % 13 <> 0 AS digest_ok, o_orderkey % 17 <> 0 AS files_ok, o_orderkey % 19 = 0 AS held, o_orderkey % 23 <> 0 AS owned FROM {orders}"""


@query("WITH b AS (" + BATCHES + """) SELECT o_orderkey, CASE status WHEN 'DONE' THEN 'none' WHEN 'PLANNED' THEN 'download' WHEN 'IN_PROGRESS' THEN CASE WHEN complete THEN 'qc' ELSE 'download' END WHEN 'BATCH_PROCESSED' THEN 'gate'
  WHEN 'RELEASE_READY' THEN CASE WHEN coalesce(release_id, '') = '' THEN 'prepare-release' WHEN verified THEN 'cleanup' ELSE 'publish (awaiting approval)' END WHEN 'BLOCKED' THEN 'blocked' ELSE 'unknown:' || status END AS next_action FROM b""")
def next_action(spark, sf_dir):  # noqa: ANN001, ANN201
    b = over(spark, sf_dir, BATCHES)
    return b.select("o_orderkey", state.next_action(*map(F.col, ("status", "complete", "release_id", "verified"))).alias("next_action"))


@query("WITH b AS (" + BATCHES + """) SELECT o_orderkey, CASE WHEN status NOT IN ('RELEASE_READY', 'DONE') THEN 'batch-status-' || status WHEN coalesce(release_id, '') = '' THEN 'no-release' WHEN NOT verified THEN 'no-remote-receipt' WHEN NOT full_hash THEN 'sample-only-receipt'
  WHEN NOT dir_ok THEN 'release-dir-missing' WHEN NOT digest_ok OR NOT files_ok THEN 'release-dir-changed' WHEN held THEN 'batch-in-flight' WHEN NOT owned THEN 'ownership-violation' ELSE 'ok' END AS reason FROM b""")
def cleanup_reason(spark, sf_dir):  # noqa: ANN001, ANN201
    b = over(spark, sf_dir, BATCHES)
    return b.select("o_orderkey", state.cleanup_reason(*map(F.col, ("status", "release_id", "verified", "full_hash", "dir_ok", "digest_ok", "files_ok", "held", "owned"))).alias("reason"))


@query("WITH b AS (" + BATCHES + "), o AS (SELECT *, status NOT IN ('BATCH_PROCESSED', 'RELEASE_READY', 'DONE') AS open FROM b) SELECT job, o_orderkey, sum(open::INT) OVER (PARTITION BY job) - open::INT = 0 AS siblings_processed FROM o")
def siblings_processed(spark, sf_dir):  # noqa: ANN001, ANN201
    return state.siblings_processed(over(spark, sf_dir, BATCHES), "job", "o_orderkey")


@query("WITH b AS (" + BATCHES + ") SELECT status, count(*) AS n FROM b GROUP BY status")
def campaign_status(spark, sf_dir):  # noqa: ANN001, ANN201
    return state.status_counts(over(spark, sf_dir, BATCHES))


@query("""SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, coalesce(n.v, o.v) AS v FROM (SELECT doc_id, n_chars AS v FROM {documents} WHERE doc_id % 2 = 0) o FULL JOIN (SELECT doc_id, n_chars * 2 AS v FROM {documents} WHERE doc_id % 3 = 0) n ON n.doc_id = o.doc_id""")
def manifest_reconcile(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    return state.merge_last_wins(d.filter("doc_id % 2 = 0").select("doc_id", F.col("n_chars").alias("v")), d.filter("doc_id % 3 = 0").select("doc_id", (F.col("n_chars") * 2).alias("v")), "doc_id")


@query("SELECT doc_id FROM {documents} WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id FROM {documents} WHERE doc_id % 3 = 0 AND doc_id % 2 <> 0")
def append_new_rows(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id")
    return state.append_new(d.filter("doc_id % 2 = 0"), d.filter("doc_id % 3 = 0"), "doc_id")


@query("SELECT doc_id, source FROM {documents} WHERE source NOT IN ('src3', 'src7')")
def takedown_reissue(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return state.takedown(d, spark.createDataFrame([("src3",), ("src7",), ("src3",)], "source string"), "source")[0]


@query("WITH a AS (SELECT event_id, event_type, CAST((epoch_us(TIMESTAMP '2024-02-10') - epoch_us(ts)) // 86400000000 AS BIGINT) AS age FROM {events}) SELECT event_id, event_type FROM a WHERE (event_type = 'error' AND age > 20) OR (event_type = 'view' AND age > 30)")
def retention_due(spark, sf_dir):  # noqa: ANN001, ANN201
    e = over(spark, sf_dir, "SELECT event_id, event_type, (unix_micros(TIMESTAMP '2024-02-10 00:00:00') - unix_micros(CAST(ts AS TIMESTAMP))) DIV 86400000000 AS age FROM {events}")
    return state.retention_due(e, "event_type", "age", {"error": 20, "view": 30, "click": 0}).select("event_id", "event_type")


@query("WITH p AS (SELECT doc_id, 'p' || doc_id AS path FROM {documents} WHERE doc_id % 5 = 0) SELECT path FROM p WHERE doc_id % 10 = 0")
def parents_done(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    inv = d.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"))
    rows = d.filter("doc_id % 10 = 0").select("doc_id", F.explode(F.array(F.lit("0"), F.lit("1"))).alias("n")).select(F.concat(F.lit("p"), F.col("doc_id").cast("string"), F.lit("#row-"), "n").alias("path"))
    return state.parents_done(inv, rows)
