"""Sinks: Parquet releases with embedded audio, TAR shards, JSON lines, checksums, markers, cards."""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import tarfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import hub_license
from corpusloom.operators.dedup import numbered
from corpusloom.operators.publish import checksum_lines

ROW_GROUP, SHARD = 512, 1000


def store(path: str | Path) -> tuple[fs.FileSystem, str]:
    """A file system and the place in it, for a URI (file:, hdfs:, s3: and the like) or a local path."""
    path = str(path)
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":/" in path else Path(path).absolute().as_uri())


def _sync(path: str) -> None:
    """Have the disk hold a local file or folder."""
    at = os.open(path, os.O_RDONLY)
    try:
        os.fsync(at)
    finally:
        os.close(at)


@contextmanager
def whole_file(path: str | Path) -> Iterator:
    """An output stream whose file appears at its path only when it is whole; attempts never share a name before."""
    at, name = store(path)
    at.create_dir(name.rsplit("/", 1)[0], recursive=True)
    part = f"{name}.{uuid.uuid4().hex}.part"
    try:
        with at.open_output_stream(part) as out:
            yield out
        if local := isinstance(at, fs.LocalFileSystem):  # other stores have what is closed
            _sync(part)
        at.move(part, name)
        if local:
            _sync(name.rsplit("/", 1)[0])
    except BaseException:
        if at.get_file_info(part).type != fs.FileType.NotFound:
            at.delete_file(part)
        raise


def write_atomic(path: str | Path, data: bytes) -> None:
    """Small driver-side files: written beside, closed, moved."""
    with whole_file(path) as out:
        out.write(data)


def write_files(df: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """Write each row's bytes to its path below folder; (path, size) of what was written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b["path"].to_pylist(), b["content"].to_pylist()):
                write_atomic(f"{folder.rstrip('/')}/{name}", data or b"")
            yield pa.RecordBatch.from_arrays([b["path"], pa.array([len(x or b"") for x in b["content"].to_pylist()], pa.int64())], names=["path", "size"])

    return df.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content")).mapInArrow(run, "path string, size bigint")


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as JSON lines with sorted keys; nulls are written."""
    df.select(*sorted(df.columns)).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_release(rows: DataFrame, audio: DataFrame, path: str, key: str = "audio_id") -> None:
    """A Parquet release with its audio bytes. Row groups stay small, as each row holds a clip; no rows are an error.

    The bytes meet their rows in a join by id and are written where they meet.
    """
    if rows.isEmpty():
        raise ValueError("no rows to release")
    full = rows.join(audio.select(key, F.col("content").alias("audio_bytes")), key)
    full.write.mode("overwrite").option("parquet.block.size", 64 << 20).option("maxRecordsPerFile", ROW_GROUP * 64).parquet(path)


def write_webdataset(rows: DataFrame, folder: str, key: str = "audio_id", order: list[str] | None = None, per_shard: int = SHARD) -> DataFrame:
    """TAR shards of <id>.wav and <id>.json in the rows' order; returns (shard, n, bytes).

    Rows are numbered globally, dealt by shard and written as streams by pyarrow's file systems, so
    folder may be any shared store. A shard is written under a name of its attempt and moved, so
    attempts of one task don't disturb each other, and written again in whole if its task is.
    """
    numbered_rows = numbered(rows, order or [key], 0, "__n").withColumn("shard", F.floor(F.col("__n") / per_shard).cast("int"))
    meta = F.to_json(F.struct(*sorted(c for c in rows.columns if c != "audio_bytes")))
    dealt = numbered_rows.select("shard", "__n", F.col(key).cast("string").alias("id"), "audio_bytes", meta.alias("meta")).repartition("shard").sortWithinPartitions("shard", "__n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("shard", "id", "audio_bytes", "meta"))))
        for shard, group in groupby(rows, key=lambda r: r[0]):
            n = 0
            with whole_file(f"{folder.rstrip('/')}/shard-{shard:05d}.tar") as out:
                with tarfile.open(fileobj=out, mode="w|") as tar:
                    for _, rid, data, text in group:
                        for suffix, part in (("wav", data or b""), ("json", text.encode())):
                            info = tarfile.TarInfo(f"{rid}.{suffix}")
                            info.size, info.mtime = len(part), 0
                            tar.addfile(info, io.BytesIO(part))
                        n += 1
                size = out.tell()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["shard", "n", "bytes"])

    return dealt.mapInArrow(run, "shard int, n bigint, bytes bigint")


def file_inventory(spark, root: str) -> DataFrame:  # noqa: ANN001
    """(path, sha256, size) of all files below root, with relative paths."""
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.substring_index("path", base, -1).alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def write_manifest(files: DataFrame, path: str | Path) -> str:
    """MANIFEST.sha256 of sorted lines; returns the release digest, which is the manifest's own hash."""
    lines = files.filter(F.col("path") != "MANIFEST.sha256").select("path", F.concat("sha256", F.lit("  "), "path").alias("l")).orderBy("path")
    sha = hashlib.sha256()
    with whole_file(path) as out:
        for r in lines.select("l").toLocalIterator():  # one file in order: a line at a time
            line = f"{r[0]}\n".encode()
            out.write(line)
            sha.update(line)
    return sha.hexdigest()


def set_marker(folder: str | Path, blockers: list[str], **payload) -> str:  # noqa: ANN003
    """RELEASE_READY.json or RELEASE_BLOCKED.json, never both; equal content keeps the file as it is."""
    ready = not blockers
    mine, other = ("RELEASE_READY.json", "RELEASE_BLOCKED.json")[:: 1 if ready else -1]
    at, base = store(folder)
    if at.get_file_info(f"{base}/{other}").type != fs.FileType.NotFound:
        at.delete_file(f"{base}/{other}")
    data = json.dumps(payload | ({} if ready else {"blockers": sorted(blockers)}), sort_keys=True, ensure_ascii=False).encode()
    if at.get_file_info(f"{base}/{mine}").type == fs.FileType.NotFound or at.open_input_stream(f"{base}/{mine}").read() != data:
        write_atomic(f"{str(folder).rstrip('/')}/{mine}", data)
    return mine


def card(rows: DataFrame, title: str, license_col: str = "license") -> str:
    """A dataset card from one aggregate row."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.round(F.sum("duration_s") / 3600, 3), F.lit(0.0)).alias("hours"), F.array_sort(F.collect_set("language")).alias("languages"), F.array_sort(F.collect_set(hub_license(F.col(license_col)))).alias("licenses"), F.array_sort(F.collect_set("split")).alias("splits")).first()
    head = ["---", f"pretty_name: {title}", "language:", *(f"  - {x}" for x in r["languages"] or ["und"]), "license:", *(f"  - {x}" for x in r["licenses"] or ["other"]), "---", ""]
    return "\n".join([*head, f"# {title}", "", f"{r['n']} clips, {r['hours']} hours; splits: {', '.join(r['splits'])}. All rows passed every required check.", ""])


def write_splits(rows: DataFrame, path: str) -> None:
    """Rows by split, sorted by file name within each: in ranges of names, so a split is as many tasks' as it needs, and its files follow each other."""
    rows.repartitionByRange("split", "file_name").sortWithinPartitions("split", "file_name").write.mode("overwrite").partitionBy("split").json(path)


def write_handoff(rows: DataFrame, path: str | Path) -> int:
    """manifest.jsonl sorted by split and id, byte-identical for equal rows: one file in order, a row at a time."""
    n = 0
    with whole_file(path) as out:
        for r in rows.select(*sorted(rows.columns)).orderBy("split", "id").toLocalIterator():
            out.write((json.dumps(r.asDict(), sort_keys=True, ensure_ascii=False) + "\n").encode())
            n += 1
    return n


def release_digest(files: DataFrame) -> str:
    return checksum_lines(files).first()["release_digest"]
