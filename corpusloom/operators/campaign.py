"""Campaign operators that combine others: the release gate, fan-out, resume, preflight, upload plans, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import short_id
from corpusloom.functions.text import chunk_name, job_id, language_code, repo_reference, sharded_path, slug, source_scope
from corpusloom.operators import dedup, planning, release, reports, rights, state
from corpusloom.operators.admission import reasons
from corpusloom.operators.skew import left_counted


def manifest_records(manifest: DataFrame, revision: Column, status: Column, redistribute: Column) -> DataFrame:
    """Source records of verified manifest rows: identity by the measured content, rights by the job, language vi if none is given."""
    lang = F.coalesce(F.when(F.col("source_language") != "", F.col("source_language")), F.lit("vi"))
    got = rights.job_rights(status, redistribute)
    return manifest.select(short_id("sha256", revision, prefix="SRC_").alias("source_id"), "source_uri", revision.alias("source_revision"), "original_file_id", F.col("sha256").alias("source_sha256"), F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("source_bytes"), "source_transcript", lang.alias("source_language"), *(c.alias(k) for k, c in got.items()))


def assign_and_join(accepted: DataFrame, assignment: DataFrame, key: str = "audio_id") -> DataFrame:
    """accepted with the split of the assignment; rows that it lacks keep theirs."""
    a = assignment.select(F.col(key).alias("__k"), F.col("split").alias("__s"))
    return accepted.join(a, F.col(key) == F.col("__k"), "left").withColumn("split", F.coalesce("__s", "split")).drop("__k", "__s")


def release_gate(accepted: DataFrame, key: str = "audio_id", group: str = "group", sha: str = "source_sha256") -> DataFrame:
    """One row: n_accepted, rows by split, leaking groups and duplicate groups. Duplicates are reported, not dropped."""
    split = accepted.withColumn("split", dedup.split_of(group))
    by = split.agg(F.count(F.lit(1)).alias("n_accepted"), *(F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "validation", "test")))
    leaks = dedup.leaking_groups(split, group).agg(F.count(F.lit(1)).alias("n_leaking"))
    twice = dedup.exact_groups(accepted, key, sha).agg(F.count(F.lit(1)).alias("n_duplicate_groups"))
    return by.crossJoin(leaks).crossJoin(twice).withColumn("ok", (F.col("n_accepted") > 0) & (F.col("n_leaking") == 0))  # three single rows


def fanout(accepted: DataFrame, job: str, batch: str, size: int = 100, key: str = "audio_id") -> DataFrame:
    """One row per chunk of accepted rows in order of (split, id): release_id, n_rows, bytes, licenses."""
    cut = planning.chunks(accepted, ["split", key], size)
    rid = chunk_name(F.lit(job), F.lit(batch), F.col("chunk"))
    return cut.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("bytes"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses")).withColumn("release_id", rid)


def resume_actions(jobs: DataFrame, upstream: DataFrame) -> DataFrame:
    """(job_id, action): what a resume does and reports; a pin never moves. upstream: job_id, current (null: unresolvable)."""
    u = upstream.select(F.col("job_id").alias("__j"), "current")
    pinned = F.coalesce(F.col("pinned_sha") != "", F.lit(False))
    seen = F.col("__j").isNotNull()
    action = F.when(~pinned & seen & F.col("current").isNotNull(), "pinned").when(~pinned & seen, "still-blocked").when(seen & F.col("current").isNull(), "remote-check-failed").when(seen & (F.col("current") != F.col("pinned_sha")), "drift-reported").otherwise("none")
    return jobs.join(u, F.col("job_id") == F.col("__j"), "left").select("job_id", "pinned_sha", action.alias("action"))


def preflight(destination: DataFrame, listing: DataFrame, projected: Column) -> DataFrame:
    """One row: current bytes and files of the destination, and reasons and warnings. destination: one row of repo_id, max_bytes, redistribution_confirmed."""
    now = listing.filter(F.col("type") == "file").agg(F.coalesce(F.sum(F.coalesce("size", F.lit(0))), F.lit(0)).alias("current_bytes"), F.count(F.lit(1)).alias("n_files"))
    d = destination.crossJoin(now).withColumn("projected_bytes", F.col("current_bytes") + projected)  # two single rows
    bad = reasons((F.coalesce(F.col("repo_id") == "", F.lit(True)), "NO_DESTINATION_REPO"), (F.col("projected_bytes") > F.col("max_bytes"), "DESTINATION_QUOTA_EXCEEDED"))
    warn = reasons((F.col("max_bytes").isNull(), "QUOTA_NOT_DECLARED"), (~F.coalesce(F.col("redistribution_confirmed"), F.lit(False)), "REDISTRIBUTION_NOT_CONFIRMED"))
    return d.withColumns({"reasons": bad, "warnings": warn}).withColumn("ok", F.size("reasons") == 0)


def upload_plan(files: DataFrame, by: str = "release_id") -> DataFrame:
    """(release, n_files, total_bytes, largest)."""
    return files.groupBy(by).agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("total_bytes"), F.max_by("path", F.struct("bytes", "path")).alias("largest"))


def expected_upload(batches: DataFrame) -> DataFrame:
    """Accountable bytes of all batches, the known ones where there is no reservation."""
    return batches.agg(F.coalesce(F.sum(F.coalesce("accountable_bytes", "total_bytes")), F.lit(0)).alias("expected_bytes"))


def download_metrics(items: DataFrame, by: str) -> DataFrame:
    """Per group: items by outcome, bytes from the network and the cache, and rates over the time that passed. items: outcome, bytes, began, ended (seconds)."""
    net, hit = F.col("outcome") == "downloaded", F.col("outcome") == "cache_hit"
    got = items.groupBy(by).agg(F.count(F.lit(1)).alias("n_items"), F.count_if(net).alias("n_downloaded"), F.count_if(hit).alias("n_cache_hit"), F.sum(F.when(net, F.col("bytes")).otherwise(0)).alias("network_bytes"), F.sum(F.when(hit, F.col("bytes")).otherwise(0)).alias("cached_bytes"), (F.max("ended") - F.min("began")).alias("wall_s"))
    rate = F.when(F.col("wall_s") > 0, F.col("network_bytes") / F.col("wall_s") / 1e6)
    return got.withColumns({"mb_per_s": rate, "mbit_per_s": rate * 8})


def source_validation(sources: DataFrame) -> DataFrame:
    """Per declared source: n_files, quarantined and blocker, if its rights need an operator. sources: name, declared_rights, ingest_status (null: no file)."""
    per = sources.groupBy("name", "declared_rights").agg(F.count("ingest_status").alias("n_files"), F.count_if(F.col("ingest_status") == "QUARANTINE").alias("quarantined"))
    rights_ = F.coalesce("declared_rights", F.lit("UNKNOWN"))
    return per.select("name", rights_.alias("declared_rights"), "n_files", "quarantined", F.when(rights_.isin("UNKNOWN", "LICENSE_REVIEW", "FORBIDDEN"), F.concat("name", F.lit(": rights "), rights_)).alias("blocker"))


def curate_counts(decided: DataFrame) -> DataFrame:
    ok = F.col("decision") == "ACCEPT"
    return decided.agg(F.count_if(ok).alias("accepted"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("non_accepted"))


def funnel_by(decided: DataFrame, by: str) -> DataFrame:
    return decided.groupBy(by).agg(F.count(F.lit(1)).alias("n"), reports.ratio(F.count_if(F.col("decision") == "ACCEPT"), F.count(F.lit(1))).alias("accept_coverage"))


def export_samples(accepted: DataFrame, sidecar: DataFrame, known: DataFrame, counter: int, key: str = "original_file_id", prefix: str = "clip", public: bool = True) -> tuple[DataFrame, DataFrame]:
    """(canonical rows, blocked samples) of accepted rows: sidecar, blockers, ids in order, speakers, paths.

    The ids of new keys are allocated for the whole batch at once; the caller commits them, then writes audio.
    """
    rows = release.sidecar_override(accepted, sidecar, key, ["text", "language", "speaker_ref", "transcript_verified", "language_verified"])
    judged = rows.withColumn("reason", release.export_blocker(public))
    blocked = judged.filter("reason is not null").select("source_id", key, "reason")
    ok = judged.filter("reason is null").withColumn("key", release.sample_key("identity-1", F.col("source_revision"), F.col("source_id"), F.col("source_sha256"), F.col("seg_start"), F.col("seg_end")))
    ids = release.allocate_ids(ok, known, counter, ["seq"], prefix)
    met = ok.join(ids, "key")
    path = sharded_path(F.col("id"))
    speaker = release.speaker_id(source_scope(F.col("source_uri"), F.col("source_revision")), F.coalesce("speaker_ref", F.lit("")), F.col("key"), F.coalesce(F.col("speaker_ref") != "", F.lit(False)))
    return met.select(path.alias("audio"), "text", path.alias("file_name"), speaker.alias("speaker"), "duration", language_code(F.col("language")).alias("language"), "split", "key", "id", "reused"), blocked


def ensure_jobs(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """(seq, repo_id, requested_revision, pinned_sha, job_id, duplicate, status, error): the job of each entry, in order of seq.

    entries: seq, ref, revision, pinned_sha (null if it can't be resolved); existing: job_id, repo_id,
    requested_revision, pinned_sha. An entry is a duplicate of a job, or of an entry before it, with the
    same repository and pin or, where neither has a pin, the same requested revision. An entry without
    a pin is BLOCKED, one whose reference can't be read has an error and no job.
    """
    text = lambda c: F.when(F.trim(c) != "", F.col(c))
    ref = repo_reference(F.col("ref"))
    rows = entries.select("seq", ref["repo_id"].alias("repo_id"), F.coalesce(text("revision"), ref["revision"]).alias("requested_revision"), text("pinned_sha").alias("pinned_sha"), F.when(F.coalesce(F.trim("ref") == "", F.lit(True)), "NO_REFERENCE").when(ref["repo_id"].isNull(), "BAD_REFERENCE").alias("error"))
    kind = F.concat(F.lower("repo_id"), F.when(F.col("pinned_sha").isNotNull(), F.concat(F.lit("\x1fp:"), "pinned_sha")).otherwise(F.concat(F.lit("\x1fr:"), "requested_revision")))
    own = F.when(F.col("pinned_sha").isNotNull(), job_id(F.col("repo_id"), F.col("pinned_sha"))).otherwise(F.concat(slug(F.col("repo_id")), F.lit("-unpinned")))
    rows = rows.withColumns({"kind": kind, "own": F.when(F.col("error").isNull(), own)})
    old = existing.withColumn("kind", kind).filter("kind is not null").select("kind", F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"), F.col("job_id").alias("own"))
    first = rows.filter("kind is not null").select("kind", "seq", "own").unionByName(old).groupBy("kind").agg(F.min(F.struct(F.col("seq").isNotNull().alias("new"), "seq", "own")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    out = left_counted(rows, first, "kind")
    duplicate = F.coalesce(F.col("f.seq").isNull() & F.col("f").isNotNull() | (F.col("seq") > F.col("f.seq")), F.lit(False))
    out = out.withColumns({"duplicate": duplicate, "job_id": F.coalesce("f.own", "own"), "status": F.when(F.col("error").isNull(), F.when(F.col("pinned_sha").isNotNull(), "CREATED").otherwise("BLOCKED"))})
    return out.select("seq", "repo_id", "requested_revision", "pinned_sha", "job_id", "duplicate", "status", "error")


def dry_run(jobs: DataFrame, batches: DataFrame) -> DataFrame:
    """What each batch would do next, and nothing done. batches: job_id, batch_id, status, n_files, complete, release_id, verified."""
    act = state.next_action(F.col("status"), F.col("complete"), F.col("release_id"), F.col("verified"))
    return batches.join(jobs.select("job_id", "repo_id", "pinned_sha"), "job_id").select("job_id", "batch_id", "repo_id", "pinned_sha", "status", act.alias("next_action"), "n_files")


def upsert_provenance(known: DataFrame, found: DataFrame, key: str = "id", order: str = "recorded") -> DataFrame:
    """One provenance row per id: that of the last recording, a found one before a known one of the same time."""
    both = known.withColumn("__new", F.lit(0)).unionByName(found.withColumn("__new", F.lit(1)))
    rest = [c for c in known.columns if c != key]
    last = both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, "__new")).alias("r"))
    return last.select(key, *(F.col("r")[c].alias(c) for c in rest))
