"""WARC archives and their index, merged externally by loser trees.

Captures are written to WARC 1.1 archives, one gzip member a record. Of equal payloads of at least
min_revisit bytes the capture of the largest id is a response, the others are revisits that refer
to it; smaller payloads are always responses. With each archive its task writes a capture run, a file
of the archive's index entries sorted by URL key, time and id, in blocks. The merged index is made from
the runs as they are: groups of about FAN_IN runs are merged to longer runs, in as many passes as it
takes to have FAN_IN runs at most; then the key space is cut into ranges at some blocks' first keys, and
each range's slices of all runs are merged, each read from the block in which it begins. A merge is a
loser tree over streams and holds one block of each run, whatever the size of the runs.

Archives and runs lie in the folder that all executors share, under names that no other attempt of a
task uses; only those that a finished task reported are read, so lost executors leave nothing wrong.

Defined results: ids are whole numbers, what is none counts as null; a null payload is empty, a null URL
has the key '' and no target line; captures of equal key and time are in the order of their ids, as
numbers, a null id last; repeated rows give a record each (the rows of the response's id are all
responses); a very long payload is one record, held whole; an empty table gives no rows; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

MIN_REVISIT = 1000
#: Bytes after which a new archive is begun; entries of one block of a run; runs merged at once.
ARCHIVE_BYTES, BLOCK, FAN_IN = 64 << 20, 2_000, 256
#: Entries of one range of the merged index: the least and the most, between which it is a fair share of a task.
RANGE_ENTRIES = (10_000, 1_000_000)
#: Rows up to which the table of repeated payloads may be broadcast (60 bytes each); copies of one payload that meet in a task.
BROADCAST_ROWS, HOT = 200_000, 500
#: The id that stands for null in runs: the last of all.
NO_ID = 2**63 - 1
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> str:
    """Host labels in reverse order, then path and query; lower case, no port, no leading www."""
    try:
        u = urlsplit(url.strip().lower())
        host = (u.hostname or "").removeprefix("www.")
    except ValueError:
        return url.strip().lower()
    return ",".join(reversed(host.split("."))) + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def record(rid: str, url: str, when: str, payload: bytes, sha1: str, refers: str | None) -> bytes:
    """One WARC record; a revisit has the response's headers and no payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:capture:{rid}>", f"WARC-Date: {when}"]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:capture:{refers}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """What a record says of its capture; a response's digest is worked out from its payload and compared."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    body = data[end + 4 : end + 4 + int(head["Content-Length"])]
    cut = body.index(b"\r\n\r\n") + 4
    http = dict(x.split(": ", 1) for x in body[: cut - 4].decode().split("\r\n")[1:])
    said = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    out = {"id": _urn(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"), "date": head["WARC-Date"], "type": head["WARC-Type"], "refers_to": None, "bytes": int(http["Content-Length"]), "digest": said, "payload": None}
    if out["type"] == "revisit":
        out["refers_to"] = _urn(head["WARC-Refers-To"])
    else:
        out["payload"] = body[cut:]
        if len(out["payload"]) != out["bytes"] or hashlib.sha1(out["payload"]).hexdigest() != said:
            raise ValueError(f"record {out['id']}: payload and digest differ")
    return out


def _urn(x: str) -> str:
    return x.removeprefix("<urn:capture:").removesuffix(">")


def read_archive(stream) -> Iterator[tuple[int, bytes]]:  # noqa: ANN001
    """(place, record) of an archive, one gzip member each, read in pieces."""
    left, z, out, begin, seen = b"", zlib.decompressobj(31), [], 0, 0
    while True:
        piece = left
        if not piece:
            piece = stream.read(1 << 20)
            seen += len(piece)
        left = b""
        if not piece:
            if out:
                raise ValueError("the archive ends within a record")
            return
        out.append(z.decompress(piece))
        if z.eof:
            yield begin, b"".join(out)
            left, z, out = z.unused_data, zlib.decompressobj(31), []
            begin = seen - len(left)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the path in it, for file:, hdfs:, s3: and the like, or a plain path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":/" in path else f"file://{path}")


KEY = T.StructType([T.StructField("urlkey", T.StringType()), T.StructField("ts", T.StringType()), T.StructField("id", T.LongType())])
ENTRY = T.StructType([*KEY.fields, T.StructField("archive", T.StringType()), T.StructField("at", T.LongType()), T.StructField("size", T.LongType())])
#: A run's file, its number of entries and the key of each block's first entry.
RUN = T.StructType([T.StructField("run", T.StringType()), T.StructField("n", T.LongType()), T.StructField("firsts", T.ArrayType(KEY))])
_ENTRY = pa.schema([("urlkey", pa.string()), ("ts", pa.string()), ("id", pa.int64()), ("archive", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
_KEY = pa.struct(list(_ENTRY)[:3])
_RUN = pa.schema([("run", pa.string()), ("n", pa.int64()), ("firsts", pa.list_(_KEY))])


def batched(entries: Iterable[tuple], size: int) -> Iterator[pa.RecordBatch]:
    """Entries as batches of `size`."""
    entries = iter(entries)
    while rows := list(islice(entries, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)


def write_run(fs: pafs.FileSystem, base: str, entries: Iterable[tuple], size: int) -> pa.RecordBatch:
    """Write sorted entries as a run, in blocks of `size`; its row of RUN."""
    name, n, firsts = f"{uuid.uuid4().hex}.run", 0, []
    with fs.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_file(out, _ENTRY) as file:
        for b in batched(entries, size):
            file.write_batch(b)
            firsts.append({c: b[c][0].as_py() for c in KEY.names})
            n += len(b)
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((name, n, firsts), _RUN)], schema=_RUN)


def read_run(fs: pafs.FileSystem, path: str, block: int = 0, lo: tuple | None = None, hi: tuple | None = None) -> Iterator[tuple]:
    """The entries of a run whose keys are from lo to below hi, from a block on that begins before them; one block is held."""
    with fs.open_input_file(path) as f:
        file = pa.ipc.open_file(f)
        for k in range(block, file.num_record_batches):
            for e in zip(*(c.to_pylist() for c in file.get_batch(k).columns)):
                if hi is not None and e[:3] >= hi:
                    return
                if lo is None or e[:3] >= lo:
                    yield e


def _writing(folder: str, size: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        out, entries, at, name = None, [], 0, ""
        for b in batches:
            for rid, url, when, payload, sha1, refers in zip(*(b[c].to_pylist() for c in ("id", "url", "ts", "payload", "sha1", "refers"))):
                if out is None:
                    name, entries, at = f"{uuid.uuid4().hex}.warc.gz", [], 0
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}")
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = z.compress(record("" if rid is None else str(rid), url, when, payload, sha1, None if refers is None else str(refers))) + z.flush()
                out.write(data)
                entries.append((url_key(url), when, NO_ID if rid is None else rid, name, at, len(data)))
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield write_run(fs, base, sorted(entries), size).append_column("archive", pa.array([name]))
        if out is not None:
            out.close()
            yield write_run(fs, base, sorted(entries), size).append_column("archive", pa.array([name]))

    return run


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write df's rows as records under folder: a row of RUN for each archive, with the archive's name.

    Without a time column a capture's time is EPOCH plus its id in seconds.
    """
    C.prepare(df.sparkSession)
    key = F.col(f"`{id_col}`").try_cast("long")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    when = F.col(f"`{time_col}`").cast("timestamp") if time_col else F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.coalesce(F.abs(key), F.lit(0)) % 3_000_000_000)
    src = df.select(key.alias("id"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), payload.alias("payload"))
    src = src.withColumn("sha1", F.sha1("payload"))
    # Repeated payloads: counted by digest and combined before the shuffle, without the payloads.
    twice = src.filter(F.length("payload") >= min_revisit).groupBy("sha1").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = C.materialise(twice, "repeated")
    if twice.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        src = src.join(F.broadcast(twice), "sha1", "left")
    else:  # the most frequent payloads stay where they are, as do short ones; the others meet their digests, few rows each
        hot = C.hottest(twice, "n", HOT)
        met = src.join(F.broadcast(hot), "sha1", "left")
        done = F.col("n").isNotNull() | (F.length("payload") < min_revisit)
        src = met.filter(done).unionByName(met.filter(~done).drop("last", "n").join(twice, "sha1", "left"))
    refers = F.when((F.length("payload") >= min_revisit) & ~F.col("id").eqNullSafe(F.col("last")), F.col("last"))
    src = src.select("id", "url", "ts", "payload", "sha1", refers.alias("refers"))
    return C.materialise(src.mapInArrow(_writing(folder, BLOCK), T.StructType([*RUN.fields, T.StructField("archive", T.StringType())])), "runs")


class LoserTree:
    """Merges sorted streams: each match's loser stays in its node, the winner goes up; one path per step."""

    def __init__(self, runs: Iterable[Iterable]) -> None:
        self.runs = [iter(x) for x in runs]
        self.heads = [next(x, None) for x in self.runs]
        self.k = len(self.runs)
        self.tree = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            if self.tree[node] == -1:
                self.tree[node] = i
                return
            if self._beats(self.tree[node], i):
                self.tree[node], i = i, self.tree[node]
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator:
        while self.k:
            i = self.tree[0]
            if self.heads[i] is None:
                return
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            self._play(i)


def _joining(folder: str, size: int):  # noqa: ANN202
    """Merge each row's runs to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        for b in batches:
            for names in b["runs"].to_pylist():
                yield write_run(fs, base, LoserTree(read_run(fs, f"{base}/{x}") for x in sorted(names)), size)

    return run


def _seeking(bounds: list[tuple]):  # noqa: ANN202
    """For each range from a bound to the next, the block of each run in which its slice begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, firsts in zip(b["run"].to_pylist(), b["firsts"].to_pylist()):
                keys = [tuple(x.values()) for x in firsts]
                blocks = [max(0, bisect_left(keys, lo) - 1) if lo else 0 for lo in bounds]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(bounds)), pa.int32()), pa.array([name] * len(bounds)), pa.array(blocks, pa.int32())], names=["range_no", "run", "block"])

    return run


def _merging(folder: str, bounds):  # noqa: ANN001, ANN202
    """Merge each range's slices of its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        for b in batches:
            for no, parts in zip(b["range_no"].to_pylist(), b["parts"].to_pylist()):
                lo, hi = bounds.value[no], bounds.value[no + 1] if no + 1 < len(bounds.value) else None
                done = 0
                for out in batched(LoserTree(read_run(fs, f"{base}/{x['run']}", x["block"], lo, hi) for x in parts), BLOCK):
                    n = len(out)
                    yield out.append_column("range_no", pa.array([no] * n, pa.int32())).append_column("position", pa.array(range(done, done + n), pa.int64()))
                    done += n

    return run


def merged_index(runs: DataFrame, folder: str, range_entries: int | None = None, fan_in: int | None = None) -> DataFrame:
    """The entries of all runs in order of URL key, time and id, as (ENTRY, range_no, position): ordered by the last two."""
    spark, fan_in = runs.sparkSession, fan_in or FAN_IN
    runs, n_runs = runs.select(RUN.names), runs.count()
    while n_runs > fan_in:
        n_runs = -(-n_runs // fan_in)
        groups = runs.groupBy(F.pmod(F.xxhash64("run"), F.lit(n_runs)).alias("g")).agg(F.collect_list("run").alias("runs"))
        runs = C.materialise(C.dealt(groups, n_runs).mapInArrow(_joining(folder, BLOCK), RUN), "runs")
    cores = spark.sparkContext.defaultParallelism
    total = runs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    per = range_entries or min(max(total // (2 * cores), RANGE_ENTRIES[0]), RANGE_ENTRIES[1])
    # A bound for about each `per` entries: chosen among the blocks' first keys by their hash, so they follow the keys' distribution.
    firsts = runs.select(F.explode("firsts").alias("k"))
    bounds = [None, *sorted(tuple(r["k"]) for r in firsts.filter(F.pmod(F.xxhash64("k"), F.lit(max(1, per // BLOCK))) == 0).distinct().collect())]
    slices = runs.mapInArrow(_seeking(bounds), "range_no int, run string, block int")
    jobs = slices.groupBy("range_no").agg(F.sort_array(F.collect_list(F.struct("run", "block"))).alias("parts"))
    schema = T.StructType([*ENTRY.fields, T.StructField("range_no", T.IntegerType()), T.StructField("position", T.LongType())])
    return C.materialise(C.dealt(jobs, len(bounds)).mapInArrow(_merging(folder, spark.sparkContext.broadcast(bounds)), schema), "index")


CAPTURE = T.StructType([T.StructField(n, t) for n, t in (("archive", T.StringType()), ("page_id", T.LongType()), ("url", T.StringType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.LongType()), ("at", T.LongType()))])


def _reading(folder: str):  # noqa: ANN202
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        for b in batches:
            for name in b["archive"].to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}") as f:
                    for at, data in read_archive(f):
                        r = parse_record(data)
                        rows.append((name, int(r["id"]) if r["id"] else None, r["url"], r["bytes"], r["digest"], r["type"], int(r["refers_to"]) if r["refers_to"] else None, at))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[f.name for f in CAPTURE])

    return run


def read_archives(runs: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives that were written (CAPTURE), read back from the files."""
    return C.dealt(runs.select("archive"), runs.count()).mapInArrow(_reading(folder), CAPTURE)


def capture_history(df: DataFrame, **names: str) -> DataFrame:
    """Write, merge and read back: CAPTURE with each capture's urlkey, ts and number in the merged index (capture_no, from 1)."""
    spark = df.sparkSession
    folder = C.new_path(spark, "archives")
    runs = write_archives(df, folder, **names)
    index = merged_index(runs, folder)
    found = C.materialise(read_archives(runs, folder), "captures")
    # There are as many ranges as range_entries goes into the index: their sizes are summed up in order.
    sizes = C.materialise(index.groupBy("range_no").agg(F.count(F.lit(1)).alias("n")), "sizes", folded=True)
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = index.join(F.broadcast(first), "range_no").select("archive", "at", "urlkey", "ts", (F.col("first") + F.col("position") + 1).cast("long").alias("capture_no"))
    return found.join(order, ["archive", "at"])
