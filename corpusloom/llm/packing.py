"""Best-fit packing by patterns and non-negative least squares.

Documents become token ids followed by an end id; one that is longer than a sequence is cut into
full pieces (its first piece takes the rest). Pieces are packed by their lengths alone: patterns are
the ways to fill a sequence exactly with at most three lengths; repeat counts of patterns are
fitted to the histogram of lengths by non-negative least squares (multiplicative updates, which
stay sparse: a pattern touches three lengths), rounded down, and what the patterns leave over is
packed best-fit by decreasing length, run by run of equal lengths.

The histogram has max_len entries and the plan at most that many times a constant, whatever the
number of documents, so both may be on the driver. Pieces learn their place from their rank among
pieces of their length: an offset per writing task and length, and a count within the task. No
shuffle carries tokens, and no piece of a hot length meets all others in one task.

Defined results: a null text is an empty one, a single end id; a very long text is encoded whole,
in memory that grows with it alone; pieces of equal length are alike to the plan, so ties may fall
either way; repeated rows are packed each; an empty table gives no rows; columns of the input other
than id and text are not read, so their names may be any (pack: names that begin with __ are taken).
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

MAX_LEN = 1024
#: Steps of the least-squares fit.
FIT_STEPS = 300
#: Characters on which the two tokenizers of the same vocabulary are tested to agree (printable Latin, line feed, tab).
PLAIN = re.compile(r"[\t\n\x20-\x7e\xa1-\xac\xae-ɏ]*\Z")
_encoders: dict[str, tuple] = {}


def encoders(path: str) -> tuple:
    """(slow, fast) for a byte-level BPE file; fast is None if the same vocabulary isn't there as ranks."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        slow, fast = Tokenizer.from_file(path), None
        try:
            import base64

            import public_tokenizers
            import tiktoken

            with open(re.sub(r"json$", "tiktoken", path), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, OSError):
            pass
        special = [t.content for t in slow.get_added_tokens_decoder().values()]
        _encoders[path] = slow, fast, special
    return _encoders[path]


def token_ids(text: str, path: str) -> np.ndarray:
    """The ids of a text as tokenizers gives them.

    Where the text has only characters for which the same vocabulary in tiktoken is tested to give
    the same ids, that faster encoder makes them.
    """
    slow, fast, special = encoders(path)
    if fast is not None and PLAIN.match(text) and not any(s in text for s in special):
        return np.array(fast.encode_ordinary(text), np.uint32)
    return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def cut(n: int, max_len: int = MAX_LEN) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, but the first may be shorter."""
    first = n % max_len
    starts = ([0] if first else []) + list(range(first, n, max_len))
    return [(s, (first if first and s == 0 else max_len)) for s in starts]


def _piecing(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, max_len: int, end_id: int, with_ids: bool):  # noqa: ANN202
    """(texts, the pass that makes pieces of them, its schema): see pieces."""
    C.prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    fields = [T.StructField(id_col, src.schema["__id"].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    fields += [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in enumerate(b["__text"].to_pylist()):
                ids = np.append(token_ids(text, tokenizer), np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), max_len)):
                    part = ids[s : s + n]
                    rows.append((i, k, s, n, zlib.crc32(part.tobytes()), *([part] * with_ids)))
            cols = list(zip(*rows)) if rows else [[]] * len(fields)
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([b["__id"].take(arrays[0]), *arrays[1:]], names=[f.name for f in fields])

    return src, run, T.StructType(fields)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    src, run, schema = _piecing(docs, tokenizer, id_col, text_col, max_len, end_id, with_ids)
    return src.mapInArrow(run, schema)


def patterns(max_len: int, present: np.ndarray) -> np.ndarray:
    """All rows (a <= b <= c) of present lengths that sum to max_len; 0 stands for no document."""
    have = np.zeros(max_len + 1, bool)
    have[present] = True
    out = [np.array([[0, 0, max_len]])] if have[max_len] else []
    have[0] = True
    a, b = np.triu_indices(max_len // 2 + 1)
    c = max_len - a - b
    ok = (b > 0) & (c >= b) & (c < max_len) & have[a] & have[b] & have[np.clip(c, 0, max_len)]
    out.append(np.stack([a[ok], b[ok], c[ok]], 1))
    return np.concatenate(out)


def fit_counts(pats: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring the least squares of (A x - histogram) down."""
    size = len(histogram)
    if not len(pats):
        return np.empty(0)
    real = (pats > 0).astype(float)
    goal = histogram.astype(float)
    # long lengths leave the least room elsewhere: their errors weigh more
    weight = np.arange(size) + 1.0
    weight /= weight.max()
    weight[0] = 0

    def onto(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(pats[:, k], weights=x * real[:, k], minlength=size) for k in range(3))

    def back(y: np.ndarray) -> np.ndarray:
        return sum(y[pats[:, k]] * real[:, k] for k in range(3))

    x = np.ones(len(pats)) * max(goal.sum(), 1) / max(real.sum(), 1)
    up = back(weight * goal)
    for _ in range(steps):
        x *= up / np.maximum(back(weight * onto(x)), 1e-9)
    return x


#: Shares of the fitted counts that are tried; the rest is left to the residuals.
SHARES = (1.0, 0.98, 0.9, 0.7)


def plan(histogram: np.ndarray, max_len: int = MAX_LEN) -> tuple[np.ndarray, int]:
    """The plan of fewest sequences among those that take the SHARES of the fitted repeat counts (see rounded)."""
    pats = patterns(max_len, np.flatnonzero(histogram))
    x = fit_counts(pats, histogram)
    return min((rounded(histogram, pats, x * s, max_len) for s in SHARES), key=lambda r: r[1])


def rounded(histogram: np.ndarray, pats: np.ndarray, x: np.ndarray, max_len: int) -> tuple[np.ndarray, int]:
    """The plan for a histogram (count of pieces by length), and its number of sequences.

    A row (length, first rank, how many, first sequence, per sequence, offset) says: so many pieces
    of that length from that rank on lie in consecutive sequences, `per` of them in each, the first
    of them at that offset.
    """
    left = histogram.astype(np.int64).copy()
    taken = np.zeros_like(left)
    rows: list[tuple[int, int, int, int, int, int]] = []
    n_seq = 0

    def place(length: int, many: int, seq: int, per: int, offset: int) -> None:
        rows.append((length, int(taken[length]), many, seq, per, offset))
        taken[length] += many
        left[length] -= many

    x = np.floor(x + 1e-6).astype(np.int64)
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 1:
            break
        lengths = [int(v) for v in pats[k] if v]
        need = {v: lengths.count(v) for v in lengths}
        n = min([int(x[k]), *(int(left[v]) // c for v, c in need.items())])
        if n < 1:
            continue
        offset = 0
        for v, c in need.items():
            place(v, n * c, n_seq, c, offset)
            offset += v * c
        n_seq += n
    # Residuals: best fit by decreasing length; sequences of equal room form runs [first sequence, count].
    room: dict[int, list[list[int]]] = {}
    for length in range(max_len, 0, -1):
        while left[length]:
            best = next((r for r in range(length, max_len) if room.get(r)), None)
            many = int(left[length])
            if best is None:
                per = max_len // length
                whole, some = divmod(many, per)
                for n, c in ((whole, per), (1 if some else 0, some)):
                    if n:
                        place(length, n * c, n_seq, c, 0)
                        if max_len - c * length:
                            room.setdefault(max_len - c * length, []).append([n_seq, n])
                        n_seq += n
                continue
            run = room[best][-1]
            per = best // length
            n = min(run[1], max(1, many // per))
            c = min(per, many)
            place(length, n * c, run[0], c, max_len - best)
            if best - c * length:
                room.setdefault(best - c * length, []).append([run[0], n])
            run[0] += n
            run[1] -= n
            if not run[1]:
                room[best].remove(run)
    return np.array(rows, np.int64).reshape(-1, 6), n_seq


def _ranking(n: int, kept: list[str]):  # noqa: ANN202
    """Add a name of this attempt of this task, and each row's rank among the attempt's rows of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, seen = uuid.uuid4().hex, np.zeros(n, np.int64)
        for b in batches:
            lengths = b["length"].to_numpy(zero_copy_only=False)
            rank = np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            u, first, many = np.unique(lengths[order], return_index=True, return_counts=True)
            rank[order] = np.arange(len(lengths)) - np.repeat(first, many) + np.repeat(seen[u], many)
            seen[u] += many
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array([name] * len(lengths), pa.string()), pa.array(rank)], names=[*kept, "__part", "__rank"])

    return run


def _placing(shared, kept: list[str], starts):  # noqa: ANN001, ANN202
    """Replace rank by the place that the plan gives it; starts: the first rank of each length in each part, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = shared.value
        key = rows[:, 0] * (1 << 44) + rows[:, 1]
        for b in batches:
            lengths, rank = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            if starts is not None:
                part = b["__part"].dictionary_encode()
                names, which = part.dictionary.to_pylist(), part.indices.to_numpy()
                if names:
                    rank = rank + np.stack([starts.value[x] for x in names])[which, lengths]
            k = np.searchsorted(key, lengths * (1 << 44) + rank, side="right") - 1
            _, first, _, seq, per, offset = rows[k].T
            nth = rank - first
            place = [pa.array(seq + nth // per), pa.array(offset + nth % per * lengths)]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), *place], names=[*kept, "sequence_id", "offset"])

    return run


#: Parts (written by a task each) up to which their counts (max_len numbers each) go to the driver.
MAX_PARTS = 512


def pack(parts: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """parts (any rows with a long column length from 1 to max_len) with sequence_id and offset; columns of these names are replaced.

    Rows are ranked as they are written, by the attempt of a task that wrote them: only the files of
    attempts that finished are read, and neither the order nor the split in which they are read matters.
    """
    C.prepare(parts.sparkSession)
    src = parts.select([c for c in parts.columns if c not in ("sequence_id", "offset")])
    return _packed(src.mapInArrow(_ranking(max_len + 1, src.columns), _ranked(src.schema)), src.schema, max_len)


def _ranked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("__part", T.StringType()), T.StructField("__rank", T.LongType())])


def _packed(ranked: DataFrame, kind: T.StructType, max_len: int) -> DataFrame:
    """The rows that _ranking made, of this kind before it, with their places."""
    spark, kept = ranked.sparkSession, kind.names
    parts = C.materialise(ranked, "pieces")
    counts = C.materialise(parts.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("n")), "counts", folded=True)
    histogram = np.zeros(max_len + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # max_len rows at most
        histogram[r["length"]] = r["n"]
    rows, _ = plan(histogram, max_len)
    if not len(rows):
        return parts.select(*kept, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = spark.sparkContext.broadcast((rows[np.lexsort((rows[:, 1], rows[:, 0]))], max_len))
    starts, ranked = None, parts
    if counts.select("__part").distinct().limit(MAX_PARTS + 1).count() <= MAX_PARTS:
        first, upto = {}, np.zeros(max_len + 1, np.int64)
        by_part = counts.groupBy("__part").agg(F.collect_list("length").alias("l"), F.collect_list("n").alias("n")).orderBy("__part")
        for r in by_part.toLocalIterator():
            first[r["__part"]] = upto.copy()
            upto[r["l"]] += r["n"]
        starts = spark.sparkContext.broadcast(first)
    else:  # more parts than the driver should know of: the first rank of each length in each part, by a window over the parts of a length
        before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        begin = counts.select("__part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
        ranked = parts.join(begin, ["__part", "length"]).withColumn("__rank", F.col("__rank") + F.col("__first")).drop("__first")
    schema = T.StructType([*kind.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*kept, "__part", "__rank").mapInArrow(_placing(shared, kept, starts), schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents (see pieces) with sequence_id and offset. One Python worker makes a task's pieces and ranks them."""
    src, run, kind = _piecing(docs, tokenizer, id_col, text_col, max_len, end_id, with_ids)
    rank = _ranking(max_len + 1, kind.names)
    return _packed(src.mapInArrow(lambda batches: rank(run(batches)), _ranked(kind)), kind, max_len)
