"""Sources: directories of audio, JSON-lines manifests, Parquet shards with embedded audio, inventories, canonical trees.

Everything is read by Spark's own readers with explicit schemas, so any store that Spark can open will
do, listing and splitting are Spark's, and columns that nothing asks for (the bytes above all) are
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.functions.ids import short_id
from corpusloom.functions.text import container, safe_name
from corpusloom.operators import rights

WAV_ONLY = (".wav",)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def audio_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = WAV_ONLY) -> DataFrame:
    """path, length, modificationTime, content of all files below root with one of the extensions."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.filter(extension(F.col("path")).isin(*extensions))


def json_lines(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = True) -> DataFrame:
    """Rows of a JSON-lines file or directory. Blank lines are skipped, a bad one raises, a missing file is empty."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except Exception as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def sidecar(meta: DataFrame, order: str, keys: tuple[str, ...] = ("file", "rfilename", "path")) -> DataFrame:
    """meta by its key, the first of `keys` that is not empty; of rows with the same key the last in order stays."""
    key = F.coalesce(*(F.when(F.col(k) != "", F.col(k)) for k in keys))
    cols = [c for c in meta.columns if c != order]
    return meta.withColumn("key", key).filter("key is not null").groupBy("key").agg(F.max_by(F.struct(*cols), order).alias("r")).select("key", "r.*")


def with_metadata(files: DataFrame, meta: DataFrame, relpath: str = "relpath") -> DataFrame:
    """files with meta (a struct): by relative path, else by base name."""
    m = meta.select(F.col("key").alias("__k"), F.struct(*[c for c in meta.columns if c != "key"]).alias("__m"))
    base = F.regexp_extract(F.col(relpath), r"([^/]+)$", 1)
    a = m.select(F.col("__k").alias("__ka"), F.col("__m").alias("__ma"))
    b = m.select(F.col("__k").alias("__kb"), F.col("__m").alias("__mb"))
    out = files.join(a, F.col(relpath) == F.col("__ka"), "left").join(b, base == F.col("__kb"), "left")
    return out.withColumn("meta", F.coalesce("__ma", "__mb")).drop("__ka", "__kb", "__ma", "__mb")


def source_records(files: DataFrame, meta: DataFrame, declarations: DataFrame, root: str, revision: str, name: str = "local") -> DataFrame:
    """One record per file: identity by content, metadata, rights, and INGESTED or, if rights are not settled, QUARANTINE.

    The bytes are hashed where they are read and dropped before the first join.
    """
    base = root.rstrip("/") + "/"
    seen = files.select("path", F.col("length").alias("source_bytes"), F.sha2("content", 256).alias("source_sha256"), container(F.col("content")).alias("source_container"))
    seen = seen.withColumn("relpath", F.when(F.contains("path", F.lit(base)), F.substring_index("path", base, -1)).otherwise(F.regexp_extract("path", r"([^/]+)$", 1)))
    seen = with_metadata(seen, meta)
    seen = seen.withColumns({"source_id": short_id("source_sha256", F.lit(revision), prefix="SRC_"), "source_uri": F.concat(F.lit("file://"), F.regexp_replace("path", r"^file:/*", "/")), "source_license": F.col("meta.source_license")})
    out = rights.evaluate(seen, declarations)
    status = F.when(F.col("rights_status").isin("LICENSE_REVIEW", "UNKNOWN", "FORBIDDEN"), "QUARANTINE").otherwise("INGESTED")
    lang = F.coalesce(F.col("meta.source_language"), F.lit("vi"))
    return out.select("source_id", "source_uri", F.lit(revision).alias("source_revision"), F.col("relpath").alias("original_file_id"), "source_sha256", "source_bytes", F.substring("source_container", F.lit(2), F.lit(8)).alias("source_container"), F.col("license").alias("source_license"), "rights_status", "redistribution_permitted", "commercial_training_permitted", F.col("meta.source_transcript").alias("source_transcript"), F.col("meta.source_speaker_ref").alias("source_speaker_ref"), lang.alias("source_language"), status.alias("ingest_status"))


def shard_clips(shards: DataFrame, audio: str = "audio", text: str | None = None, path_col: str = "__path") -> DataFrame:
    """Clips of Parquet shards: audio a struct {bytes, path} or the bytes themselves; empty blobs are skipped.

    (shard, row, name, content, sha256, size, transcript); row counts kept clips in the shard's order.
    A shard's clips are numbered in one task each, by numbers alone; the bytes are not part of the window.
    """
    from pyspark.sql import Window

    kind = shards.schema[audio].dataType
    blob, name = (F.col(f"{audio}.bytes"), F.col(f"{audio}.path")) if isinstance(kind, T.StructType) else (F.col(audio), F.col("path") if "path" in shards.columns else F.lit(None).cast("string"))
    shard = F.col(path_col) if path_col in shards.columns else F.input_file_name()
    order = F.col("__row") if "__row" in shards.columns else F.monotonically_increasing_id()
    kept = shards.select(shard.alias("shard"), order.alias("__o"), blob.alias("content"), name.alias("name"), (F.col(text) if text else F.lit(None).cast("string")).alias("transcript")).filter(F.length("content") > 0)
    nth = F.row_number().over(Window.partitionBy("shard").orderBy("__o")) - 1
    clips = kept.withColumn("row", nth)
    ext = F.coalesce(F.when(extension(F.col("name")) != "", extension(F.col("name"))), container(F.col("content")))
    stem = F.regexp_replace(F.coalesce("name", F.lit("")), r"(\.[^./]+)$", "")
    named = F.when(stem != "", F.concat(safe_name(stem), ext)).otherwise(F.concat(F.lit("clip_"), F.lpad(F.col("row").cast("string"), 6, "0"), ext))
    return clips.select("shard", "row", named.alias("name"), "content", F.sha2("content", 256).alias("sha256"), F.length("content").cast("bigint").alias("size"), "transcript")


def read_shards(spark: SparkSession, path: str, audio: str = "audio", text: str | None = None) -> DataFrame:
    df = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    return shard_clips(df, audio, text)


def arrow_files(spark: SparkSession, root: str, columns: list[str], schema: T.StructType) -> DataFrame:
    """Rows of Arrow IPC streams or files below root, one record batch at a time."""
    from collections.abc import Iterator

    import pyarrow as pa

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.arrow").load(root).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b["content"]:
                buf = content.as_buffer()
                try:
                    r = pa.ipc.open_file(buf)
                    parts = (r.get_batch(i) for i in range(r.num_record_batches))
                except pa.ArrowInvalid:
                    parts = iter(pa.ipc.open_stream(buf))
                for part in parts:
                    yield pa.RecordBatch.from_arrays([part[c] for c in columns], names=columns)

    return files.mapInArrow(run, schema)


def read_webdataset(spark: SparkSession, root: str) -> DataFrame:
    """(shard, nth, id, content, meta) of the TAR shards below root: each <id>.wav with its <id>.json. A shard is one task's."""
    import io
    import tarfile
    from collections.abc import Iterator

    import pyarrow as pa

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tar").load(root).select("path", "content")
    names = ["shard", "nth", "id", "content", "meta"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b["path"].to_pylist(), b["content"]):
                held: dict[str, dict] = {}
                done = 0
                with tarfile.open(fileobj=io.BytesIO(content.as_buffer()), mode="r") as tar:
                    for member in tar:
                        stem, _, suffix = member.name.rpartition(".")
                        held.setdefault(stem, {})[suffix] = tar.extractfile(member).read()
                        if len(held[stem]) == 2:
                            one = held.pop(stem)
                            row = (path.rsplit("/", 1)[-1], done, stem, one["wav"], one["json"].decode())
                            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()))], names=names)
                            done += 1

    return files.mapInArrow(run, "shard string, nth bigint, id string, content binary, meta string")


def merge_expanded(inventory: DataFrame, expanded: DataFrame, key: str = "path", mark: str = "#row-") -> DataFrame:
    """Inventory with the clips of shards: shards whose clips are there already are not expanded again; ids are unique, sorted."""
    parent = F.substring_index(F.col(key), mark, 1)
    done = inventory.filter(F.contains(key, F.lit(mark))).select(parent.alias("__p")).distinct()
    fresh = expanded.join(done, parent == F.col("__p"), "left_anti")
    return inventory.unionByName(fresh).dropDuplicates([key]).orderBy(key)


def loose_metadata(lines: DataFrame, audio: str, text: str) -> DataFrame:
    """(key, transcript) of a table of pipe- or comma-separated lines with a header: by path and by base name."""
    head = lines.filter("n = 0").select("value").first()
    if head is None:
        return lines.select(F.lit("").alias("key"), F.lit("").alias("transcript")).limit(0)
    sep = "|" if "|" in head[0] else ","
    names = [x.strip() for x in head[0].split(sep)]
    parts = F.split("value", f"\\{sep}", len(names))
    got = lines.filter("n > 0").select(F.trim(parts[names.index(audio)]).alias("p"), F.trim(parts[names.index(text)]).alias("transcript"))
    return got.select(F.explode(F.array_distinct(F.array("p", F.regexp_extract("p", r"([^/]+)$", 1)))).alias("key"), "transcript").filter("key <> ''").dropDuplicates(["key"])


def speaker_rule(fixed: str | None, column: str | None) -> Column:
    """A fixed speaker beats one from a column; neither is null."""
    if fixed:
        return F.lit(fixed)
    return F.when(F.col(column).cast("string") != "", F.concat(F.lit(f"{column}:"), F.col(column).cast("string"))) if column else F.lit(None).cast("string")


def inventory(listing: DataFrame, folders: str = "is_folder") -> DataFrame:
    """Files of a pinned listing: folders out, expected hashes only if they are whole SHA-256 in lower case, index by path."""
    from corpusloom.operators.dedup import numbered

    sha = F.lower("sha")
    files = listing.filter(~F.col(folders)).select("path", F.col("size").cast("bigint").alias("size"), F.when(sha.rlike("^[0-9a-f]{64}$"), sha).alias("expected_sha256"))
    return numbered(files, ["path"], 0, "index")


def split_filter(df: DataFrame, allowed: list[str] | None, split: str = "source_split") -> DataFrame:
    """Rows of allowed splits; an unknown split is never excluded."""
    return df.filter(F.col(split).isNull() | (F.col(split) == "") | F.col(split).isin(*allowed)) if allowed else df


def canonical_tree(spark: SparkSession, root: str) -> DataFrame:
    """Rows of <root>/<split>/metadata.jsonl, in the order of splits, with error where a row breaks the six-field contract."""
    lines = spark.read.text(f"{root.rstrip('/')}/*/metadata.jsonl").select("value", F.col("_metadata.file_path").alias("__f")).filter(F.trim("value") != "")
    keyed = lines.withColumn("split", F.regexp_extract("__f", r"/([^/]+)/metadata\.jsonl$", 1))
    order = F.array_position(F.array(*map(F.lit, schemas.SPLITS)), F.col("split"))
    both = keyed.select("split", F.from_json("value", schemas.CANONICAL_ROW).alias("r"), F.json_object_keys("value").alias("k"))
    names = F.array(*(F.lit(f.name) for f in schemas.CANONICAL_ROW))
    bad = F.when((F.size(F.array_except(names, "k")) > 0) | (F.size(F.array_except("k", names)) > 0) | F.col("k").isNull(), "SCHEMA")
    return both.select("split", "r.*", bad.alias("error"), order.alias("split_order")).orderBy("split_order", "file_name")
