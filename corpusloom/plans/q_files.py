"""Sinks and scans, written and read back, and clips whose samples a formula gives: each with a twin over the tables they came from."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.operators import dedup, signal
from corpusloom.operators.skew import scratch
from corpusloom.plans.base import over, query, spread, table
from corpusloom.plans.q_reports import split_case
from corpusloom.sources import scan, sinks


@query("""SELECT 'd' || (item_id % 3) || '/i' || item_id || '.WAV' AS relpath, sha256(text) AS sha256, octet_length(encode(text)) AS size FROM {benchmark} WHERE item_id % 4 <> 0""")
def scan_directory(spark, sf_dir):  # noqa: ANN001, ANN201
    """Benchmark items as files, three quarters of them with the extension that a scan takes by default."""
    root = scratch(spark, "files")
    name = F.concat(F.lit("d"), F.col("item_id") % 3, F.lit("/i"), F.col("item_id"), F.when(F.col("item_id") % 4 == 0, ".txt").otherwise(".WAV"))
    sinks.write_files(table(spark, sf_dir, "benchmark").select(name.alias("path"), F.col("text").alias("content")), root).count()
    found = scan.audio_files(spark, root)
    return found.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("relpath"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


@query("SELECT doc_id, source, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, n_chars FROM {documents}")
def json_lines_back(spark, sf_dir):  # noqa: ANN001, ANN201
    """Rows appended twice as JSON lines, nulls written, read with an explicit schema."""
    path = scratch(spark, "lines")
    rows = over(spark, sf_dir, "SELECT doc_id, source, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, n_chars FROM {documents}")
    for k in (0, 1):
        sinks.write_json_lines(rows.filter(F.pmod("doc_id", F.lit(2)) == k), path)
    return scan.json_lines(spark, path, rows.schema)


@query("""WITH t AS (SELECT 's' || source || '/d' || doc_id || '.wav' AS p, trim(lang || ', ' || n_chars) AS transcript FROM {documents})
SELECT unnest([p, regexp_extract(p, '([^/]+)$', 1)]) AS key, transcript FROM t""")
def loose_transcripts(spark, sf_dir):  # noqa: ANN001, ANN201
    """A table of lines with a header: the last column may hold the separator."""
    path = F.concat(F.lit("s"), "source", F.lit("/d"), "doc_id", F.lit(".wav"))
    lines = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("n"), F.concat(path, F.lit(","), "lang", F.lit(", "), "n_chars").alias("value"))
    return scan.loose_metadata(spark.createDataFrame([(0, "path,text")], lines.schema).unionByName(lines.withColumn("n", F.abs("n") + 1)), "path", "text")


@query("SELECT 'A' || doc_id AS audio_id, lang AS language, sha256(text) AS sha256 FROM {documents}")
def release_shards(spark, sf_dir):  # noqa: ANN001, ANN201
    """A Parquet release with its bytes, read back."""
    path = scratch(spark, "release")
    d = table(spark, sf_dir, "documents").withColumn("audio_id", F.concat(F.lit("A"), "doc_id"))
    sinks.write_release(d.select("audio_id", F.col("lang").alias("language")), d.select("audio_id", F.col("text").cast("binary").alias("content")), path)
    return spark.read.parquet(path).select("audio_id", "language", F.sha2("audio_bytes", 256).alias("sha256"))


@query("""WITH d AS (SELECT 'A' || doc_id AS id, sha256(text) AS sha256, n_chars, row_number() OVER (ORDER BY 'A' || doc_id) - 1 AS n FROM {documents})
SELECT 'shard-' || lpad(CAST(n // 300 AS VARCHAR), 5, '0') || '.tar' AS shard, n % 300 AS nth, id, sha256, n_chars FROM d""")
def tar_shards(spark, sf_dir):  # noqa: ANN001, ANN201
    """TAR shards of 300 rows, read back in their order."""
    root = scratch(spark, "tar")
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("A"), "doc_id").alias("audio_id"), "n_chars", F.col("text").cast("binary").alias("audio_bytes"))
    sinks.write_webdataset(d, root, per_shard=300).count()
    back = scan.read_webdataset(spark, root)
    return back.select("shard", "nth", "id", F.sha2("content", 256).alias("sha256"), F.get_json_object("meta", "$.n_chars").cast("bigint").alias("n_chars"))


SPLIT_ROWS = f"""SELECT 'audio/d' || doc_id || '.wav' AS audio, lang AS text, 'd' || doc_id || '.wav' AS file_name, source AS speaker, CAST(n_chars AS DOUBLE) AS duration, lang AS language, {split_case("source")} AS split FROM documents"""


@query(f"""SELECT split, file_name, speaker, duration, row_number() OVER (PARTITION BY split ORDER BY file_name) AS nth FROM ({SPLIT_ROWS})""")
def split_files(spark, sf_dir):  # noqa: ANN001, ANN201
    """Rows written by split; nth is a row's place in its split's files, read one after the other."""
    path = scratch(spark, "splits")
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.concat(F.lit("audio/d"), "doc_id", F.lit(".wav")).alias("audio"), F.col("lang").alias("text"), F.concat(F.lit("d"), "doc_id", F.lit(".wav")).alias("file_name"), F.col("source").alias("speaker"), F.col("n_chars").cast("double").alias("duration"), F.col("lang").alias("language"), dedup.split_of("source").alias("split"))
    sinks.write_splits(rows, path)
    back = spark.read.text(f"{path}/*/*.json").select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"))
    back = back.select(F.regexp_extract("f", "split=([a-z]+)/", 1).alias("split"), F.regexp_extract("f", "([^/]+)$", 1).alias("f"), "i", F.from_json("value", schemas.CANONICAL_ROW).alias("r"))
    back = dedup.numbered(back.select("split", "f", "i", "r.file_name", "r.speaker", "r.duration"), ["split", "f", "i"])
    first = back.groupBy("split").agg(F.min("number").alias("first"))  # three rows
    return back.join(F.broadcast(first), "split").select("split", "file_name", "speaker", "duration", (F.col("number") - F.col("first") + 1).alias("nth"))


@query("SELECT item_id, text FROM {benchmark}")
def arrow_back(spark, sf_dir):  # noqa: ANN001, ANN201
    """Arrow files and streams, some of several batches."""
    root = scratch(spark, "arrow")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, data = [], []
            for k in range(0, len(b), 7):
                out, part = io.BytesIO(), pa.Table.from_batches([b.slice(k, 7)])
                with (pa.ipc.new_file if k % 2 else pa.ipc.new_stream)(out, part.schema) as w:
                    w.write_table(part, max_chunksize=3)
                names.append(f"p{b['item_id'][k].as_py()}.arrow")
                data.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(data)], names=["path", "content"])

    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    sinks.write_files(items.mapInArrow(run, "path string, content binary"), root).count()
    return scan.arrow_files(spark, root, ["item_id", "text"], T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]))


RATE, HOP = 16000, 480
#: Clips of frames of HOP samples; all samples of a frame have one size, two of three are positive. Every fifth clip has
#: frames at full scale, every fourth is stereo with a silent right side, every seventeenth is no WAV file.
FRAMES = """frames AS (SELECT doc_id, f, CASE WHEN doc_id % 5 = 0 AND (doc_id + f) % 11 < 2 THEN 32767 ELSE ((doc_id * 31 + f * f * 7 + f * 3) % 13) * 700 + 50 END / CASE WHEN doc_id % 4 = 1 THEN 65536.0 ELSE 32768.0 END AS x
  FROM (SELECT doc_id, unnest(generate_series(0, 19 + n_chars % 60)) AS f FROM documents WHERE doc_id % 17 <> 0)),
e AS (SELECT *, 20 * log10(sqrt(x * x + 1e-12) + 1e-12) AS db FROM frames)"""


def stepped(doc_id: int, n_chars: int) -> bytes:
    if doc_id % 17 == 0:
        return b"bytes that are no clip, but longer than the header of one"
    f = np.arange(20 + n_chars % 60)
    size = np.where((doc_id % 5 == 0) & ((doc_id + f) % 11 < 2), 32767, (doc_id * 31 + f * f * 7 + f * 3) % 13 * 700 + 50)
    x = (np.repeat(size, HOP) * np.where(np.arange(len(f) * HOP) % 3 < 2, 1, -1)).astype("<i2")
    if doc_id % 4 != 1:
        return signal.write_wav(x, RATE)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes(np.stack([x, np.zeros_like(x)], 1).tobytes())
    return out.getvalue()


def frames_of(spark, sf_dir):  # noqa: ANN001, ANN201
    return spread(table(spark, sf_dir, "documents").select("doc_id", "n_chars"))


def measured(clips):  # noqa: ANN001, ANN201
    return signal.measure(clips, ("doc_id", "n_chars"), load=stepped)


@query(f"""WITH {FRAMES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY f) - row_number() OVER (PARTITION BY doc_id, x >= 0.997 ORDER BY f) AS g FROM e),
runs AS (SELECT doc_id, max(n) AS most FROM (SELECT doc_id, g, count(*) AS n FROM r WHERE x >= 0.997 GROUP BY doc_id, g) GROUP BY doc_id),
s AS (SELECT doc_id, CAST(count(*) * {HOP} AS BIGINT) AS n_samples, round(sqrt(avg(x * x)), 9) AS rms, max(x) AS peak, round(avg(x) / 3, 9) AS dc_offset, round(avg(CAST(x >= 0.997 AS INT)), 9) AS clipping_ratio, round(quantile_cont(db, 0.1), 6) AS noise_floor_db FROM e GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN s.doc_id IS NULL THEN 'DECODE_FAILED:Error' ELSE 'OK' END AS status, CASE WHEN s.doc_id IS NOT NULL THEN CASE WHEN d.doc_id % 4 = 1 THEN 2 ELSE 1 END END AS channels, n_samples, rms, peak, dc_offset, clipping_ratio,
  CASE WHEN s.doc_id IS NOT NULL THEN CAST(coalesce(most, 0) * {HOP} AS INT) END AS max_clipped_run, noise_floor_db
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN runs ON runs.doc_id = d.doc_id""")
def wav_statistics(spark, sf_dir):  # noqa: ANN001, ANN201
    m = measured(frames_of(spark, sf_dir))
    c = lambda n, digits=None: (F.col(f"measured.{n}") if digits is None else F.round(f"measured.{n}", digits)).alias(n)
    return m.select("doc_id", c("status"), c("channels"), c("n_samples"), c("rms", 9), c("peak"), c("dc_offset", 9), c("clipping_ratio", 9), c("max_clipped_run"), c("noise_floor_db", 6))


SPEECH = f"""{FRAMES}, q AS (SELECT doc_id, quantile_cont(db, 0.15) AS lo, quantile_cont(db, 0.95) AS hi FROM e GROUP BY doc_id),
o AS (SELECT e.doc_id, f, f - row_number() OVER (PARTITION BY e.doc_id ORDER BY f) AS g FROM e JOIN q ON q.doc_id = e.doc_id WHERE db > least(lo + 12.0, lo + 0.25 * (hi - lo))),
i AS (SELECT doc_id, min(f) * {HOP}::DOUBLE / {RATE}::DOUBLE AS s, (max(f) + 1) * {HOP}::DOUBLE / {RATE}::DOUBLE AS t FROM o GROUP BY doc_id, g),
j AS (SELECT *, CASE WHEN s - lag(t) OVER w <= 0.3::DOUBLE THEN 0 ELSE 1 END AS fresh FROM i WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS part FROM j),
v AS (SELECT doc_id, min(s) AS s, max(t) AS t FROM k GROUP BY doc_id, part HAVING max(t) - min(s) >= 0.15::DOUBLE)"""


@query(f"WITH {SPEECH} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS n, s AS start, t AS \"end\" FROM v")
def wav_speech(spark, sf_dir):  # noqa: ANN001, ANN201
    """Energy-gate speech of each clip."""
    return measured(frames_of(spark, sf_dir)).select("doc_id", F.posexplode("measured.speech").alias("n", "v")).select("doc_id", F.col("n").cast("bigint").alias("n"), "v.start", "v.end")


@query(f"""WITH {SPEECH} SELECT doc_id, round(greatest(s - 0.05::DOUBLE, 0), 6) AS start_s, round(t + 0.05::DOUBLE, 6) AS end_s, FALSE AS uncertain FROM v WHERE doc_id % 5 <> 0 AND t + 0.05::DOUBLE - greatest(s - 0.05::DOUBLE, 0) >= 0.4::DOUBLE""")
def wav_segments(spark, sf_dir):  # noqa: ANN001, ANN201
    """Segments of clips without frames at full scale: speech with its margins."""
    m = measured(frames_of(spark, sf_dir).filter("doc_id % 5 <> 0")).filter("measured.max_clipped_run = 0")
    return m.select("doc_id", F.explode("measured.segments").alias("s")).select("doc_id", "s.start_s", "s.end_s", "s.uncertain")


@query(f"""SELECT doc_id, CAST(CASE WHEN doc_id % 17 = 0 THEN 0 ELSE (20 + n_chars % 60) * {HOP} END AS BIGINT) AS n_samples, CAST(0 AS BIGINT) AS clipped, CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN 'mean' ELSE 'none' END AS downmix, CASE WHEN doc_id % 17 = 0 THEN 'DECODE_FAILED:Error' ELSE 'PASS' END AS status FROM documents""")
def wav_render_states(spark, sf_dir):  # noqa: ANN001, ANN201
    """Mono 16-bit renderings: their lengths, how they were mixed and whether they read back."""
    return signal.render(frames_of(spark, sf_dir), ("doc_id", "n_chars"), load=stepped).select("doc_id", "rendered.n_samples", "rendered.clipped", "rendered.downmix", "rendered.status")
