"""Campaign state from logs: replay, next actions, eligibility. Logs are tables; small state is written atomically."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DONE_STATES = ("RELEASED", "DONE", "QC_DONE", "DOWNLOADED")


def replay(log: DataFrame, item: str, state: str, seq: list[str], done: tuple[str, ...] = DONE_STATES) -> DataFrame:
    """(item, state, done): the last state, and whether it was ever a done one. Two aggregates, combined before the shuffle."""
    return log.groupBy(item).agg(F.max_by(state, F.struct(*seq)).alias("state"), F.bool_or(F.col(state).isin(*done)).alias("done"))


def terminal(log: DataFrame, item: str, state: str, seq: list[str], done: tuple[str, ...]) -> DataFrame:
    """Items whose last state is one of done."""
    return replay(log, item, state, seq, done).filter(F.col("state").isin(*done)).select(item)


def resequence(log: DataFrame, file_order: str, seq: str) -> DataFrame:
    """Events of several files as one log with a new dense seq: by file, then by the file's own seq."""
    from corpusloom.operators.dedup import numbered

    return numbered(log.withColumnRenamed(seq, "__seq"), [file_order, "__seq"], 0, "seq").drop("__seq")


def next_action(status: Column, complete: Column, release_id: Column, verified: Column) -> Column:
    yes = lambda c: F.coalesce(c, F.lit(False))
    no_release = F.coalesce(release_id == "", F.lit(True))
    return (
        F.when(status == "DONE", "none").when(status == "PLANNED", "download").when(status == "IN_PROGRESS", F.when(yes(complete), "qc").otherwise("download")).when(status == "BATCH_PROCESSED", "gate")
        .when(status == "RELEASE_READY", F.when(no_release, "prepare-release").when(yes(verified), "cleanup").otherwise("publish (awaiting approval)"))
        .when(status == "BLOCKED", "blocked").otherwise(F.concat(F.lit("unknown:"), F.coalesce(status, F.lit(""))))
    )


def cleanup_reason(status: Column, release_id: Column, receipt: Column, full_hash: Column, directory: Column, digest_ok: Column, files_ok: Column, held: Column, owned: Column, require_full: bool = True) -> Column:
    """ok, or the first reason that forbids deleting a batch's intermediates. A null condition forbids."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~yes(status.isin("RELEASE_READY", "DONE")), F.concat(F.lit("batch-status-"), F.coalesce(status, F.lit("")))).when(F.coalesce(release_id == "", F.lit(True)), "no-release").when(~yes(receipt), "no-remote-receipt")
        .when(F.lit(require_full) & ~yes(full_hash), "sample-only-receipt").when(~yes(directory), "release-dir-missing").when(~yes(digest_ok) | ~yes(files_ok), "release-dir-changed").when(yes(held), "batch-in-flight").when(~yes(owned), "ownership-violation").otherwise("ok")
    )


def siblings_processed(batches: DataFrame, job: str, key: str, status: str = "status") -> DataFrame:
    """(job, key, siblings_processed): every other batch of the job is processed at least. A job's unprocessed ones are counted, not listed."""
    open_ = ~F.col(status).isin("BATCH_PROCESSED", "RELEASE_READY", "DONE")
    per = batches.groupBy(job).agg(F.count_if(open_).alias("__open"))
    return batches.join(per, job).select(job, key, (F.col("__open") - open_.cast("int") == 0).alias("siblings_processed"))


def status_counts(jobs: DataFrame, by: str = "status") -> DataFrame:
    return jobs.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def merge_last_wins(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of either table by key; where both have a key the new row stays. Sorted by key."""
    both = old.withColumn("__v", F.lit(0)).unionByName(new.withColumn("__v", F.lit(1)))
    cols = [c for c in old.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*cols), "__v").alias("r")).select(key, "r.*").orderBy(key)


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and the rows of new whose key is not in it."""
    return old.unionByName(new.join(old.select(key).distinct(), key, "left_anti").select(old.columns))


def parents_done(inventory: DataFrame, rows: DataFrame, path: str = "path", mark: str = "#row-") -> DataFrame:
    """Parents of which expanded rows exist: their bytes may go."""
    parent = F.substring_index(F.col(path), mark, 1)
    made = rows.filter(F.col(path).contains(mark)).select(parent.alias(path)).distinct()
    return inventory.join(made, path, "left_semi")


def takedown(rows: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to reissue, sorted distinct ids to take down)."""
    gone = ids.select(key).distinct()
    return rows.join(gone, key, "left_anti"), gone.orderBy(key)


def retention_due(df: DataFrame, kind: str, age_days: str, windows: dict[str, int]) -> DataFrame:
    """Rows older than their kind's window in days; 0 or no window keeps for ever."""
    limit = F.lit(None).cast("int")
    for k, days in windows.items():
        limit = F.when(F.col(kind) == k, F.lit(days or None).cast("int")).otherwise(limit)
    return df.filter(F.col(age_days) > limit)


def save_state(path: str | Path, state: dict) -> None:
    """Replace a small JSON state atomically: a reader sees the old or the new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=path.parent, prefix=path.name)
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(state, f, sort_keys=True, ensure_ascii=False)
        f.flush()
        os.fsync(f.fileno())
    os.replace(tmp, path)


def load_state(path: str | Path) -> dict:
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError:
        return {}


def cached_results(items: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(items with a cached result, items to compute), by content key."""
    known = cache.groupBy(key).agg(F.max_by("result", "seq").alias("result"))
    return items.join(known, key), items.join(known, key, "left_anti")


def event_order(df: DataFrame, by: list[str]) -> DataFrame:
    """df with a dense seq per run, in the given order."""
    return df.withColumn("seq", F.row_number().over(Window.partitionBy("run_id").orderBy(*by)) - 1)
