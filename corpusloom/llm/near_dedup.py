"""Near-duplicate classes by DartMinHash over weighted five-word shingles.

A text is the multiset of its shingles of five words (runs of letters and digits in lower case). Its
elements are weighted by their counts. Darts are thrown at a plane of weight times rank: each unit
of an element's weight is a region in which the ranks of darts form a Poisson process that only a
hash of the element and the unit determines; a dart has a coordinate of the signature and, in a
unit that the weight fills in part, counts if it falls into that part. Of each coordinate the
earliest dart stays. Two texts have the same dart in a coordinate with the probability of their
weighted Jaccard similarity. Rank is cut so that k (ln k + 2) darts are expected whatever the size
of the text, which makes signing linear in its shingles; if a coordinate has no dart, the cut doubles.

Signatures are joined by bands. In a bucket each member is first compared with one hub, the member
whose buckets hold the most texts (of a base text and its variants, the base): candidates whose
signatures agree are verified by the exact weighted Jaccard similarity of the whole texts, and the
verified links join members into classes, so a group of copies is never expanded into its pairs.
Then, in each bucket that still holds more than one class, all members of different classes are
compared exactly, whatever was estimated. Classes are the connected components of all links.

A bucket, hub, class or text that a large share of all rows have is no task's alone: the most frequent
ones are broadcast by count, all others have few rows; a hub's text is sent once to each HUB_MEMBERS of
its members.

Copies (equal words in the same order) are collapsed first. Defined results: a similarity that equals
the threshold is a link; null and empty texts are like nothing, each is a class of its own; a text
without words is like its exact copies only; a text of fewer than five words is one shingle; a very
long text is signed and compared whole, in memory that grows with it alone; a null id counts as an id
above all others; repeated rows are in one class; an empty table gives no rows; columns of any other
names are not read, and kept by drop_near_duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C
from corpusloom.llm.decontaminate import normalise

WORDS = 5
BANDS, ROWS = 24, 5
THRESHOLD = 0.8
#: Agreement of signatures from which a member and its hub are verified.
ESTIMATE = 0.6
#: Shingles of a bucket's members that one task holds, twice, to compare them with each other.
BLOCK_UNITS = 300_000
#: Shingles of texts, each as often as it occurs, that are signed together; a longer text is signed alone.
UNITS = 100_000
#: Rows up to which a table of ids may be broadcast: 48 bytes each. Rows of one bucket, hub, class or text that meet in a task.
BROADCAST_ROWS, HOT = 50_000, 2_000
#: Members that are compared with one copy of their hub's text.
HUB_MEMBERS = 500
#: Rows up to which a table of keys and nodes is written by few tasks: some tens of bytes each.
FOLD_ROWS = 2_000_000
_G = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2**64."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1 << 16)
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x))
        _POWERS, _INVERSE = out
    return _POWERS[:n], _INVERSE[:n]


def shingles(sym: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the shingles of a normalised text: hashes of the stretch from a word to the fourth after it."""
    if not len(sym):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    gaps = np.flatnonzero(sym == 32)
    begin, end = np.concatenate(([0], gaps + 1)), np.append(gaps, len(sym))
    w = min(words, len(begin))
    begin, end = begin[: len(begin) - w + 1], end[w - 1 :]
    power, inverse = _powers(len(sym) + 1)
    total = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum((sym.astype(np.uint64) + np.uint64(7)) * power[:-1], out=total[1:])
    return np.unique(C.mix((total[end] - total[begin]) * inverse[begin]), return_counts=True)


def dart_signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[np.ndarray]:
    """k 64-bit values for each weighted set (elements, weights above 0); none for a set of no weight.

    All sets throw their darts together, round by round: a round throws the next dart of each
    region that has not yet passed its set's cut.
    """
    sizes = np.array([len(e) for e, _ in sets])
    if not sizes.sum():
        return [np.empty(0, np.uint64)] * len(sets)
    weights = np.concatenate([np.asarray(w, float) for _, w in sets])
    elements, of = np.concatenate([e for e, _ in sets]), np.repeat(np.arange(len(sets)), sizes)
    total = np.bincount(of, weights=weights, minlength=len(sets))
    units = np.ceil(weights).astype(np.int64)
    unit = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
    part = np.minimum(np.repeat(weights, units) - unit, 1.0)
    base, of = C.mix(np.repeat(elements, units) + unit.astype(np.uint64) * _G), np.repeat(of, units)
    whole = bool((part >= 1).all())
    rank, value = np.full(len(sets) * k, np.inf), np.zeros(len(sets) * k, np.uint64)
    cut = k * (np.log(k) + 2) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        alive = np.arange(len(base)) if todo.all() else np.flatnonzero(todo[of])
        at, j = np.zeros(len(alive)), 0
        while len(alive):
            odd, even = (np.uint64((int(_G) * n) & 0xFFFFFFFFFFFFFFFF) for n in (2 * j + 1, 2 * j + 2))
            u = C.mix(base[alive] + odd)
            r = at - np.log(((u >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
            near = r < cut[of[alive]]
            alive, at, j = alive[near], r[near], j + 1
            if not len(alive):
                break
            v = C.mix(base[alive] + even)
            place = of[alive] * k + (((v & np.uint64(0xFFFFFFFF)) * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
            good = at < rank[place]
            if not whole:
                good &= (v >> np.uint64(32)).astype(float) * 2.0**-32 < part[alive]
            p, rr, dd = place[good], at[good], v[good]
            order = np.argsort(-rr)  # of equal places the last, earliest dart is what stays
            rank[p[order]], value[p[order]] = rr[order], dd[order]
        todo &= ~np.isfinite(rank.reshape(len(sets), k)).all(1)
        cut[todo] *= 2
    return [C.mix(value[i * k : (i + 1) * k] ^ _G) if total[i] > 0 else np.empty(0, np.uint64) for i in range(len(sets))]


def dart_signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    return dart_signatures([(elements, weights)], k)[0]


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different for equal values in different bands."""
    h = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for r in range(rows):
        h = C.mix(h * _G + signature.reshape(bands, rows)[:, r])
    return h


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 0.0


_SIGNED = pa.schema([("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        node, bands, sig = [], [], []
        sets, size = [], 0
        for i, text in enumerate(texts := b["__text"].to_pylist()):
            sym, _ = normalise(text)
            if len(sym):
                node.append(hashlib.blake2b(sym.tobytes(), digest_size=16).digest())
            else:
                node.append(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16, person=b"text").digest() if text else None)
            sets.append(shingles(sym))
            size += int(sets[-1][1].sum())  # a region for each time that a shingle occurs
            if size > UNITS or i == len(texts) - 1:
                for s in dart_signatures(sets, BANDS * ROWS):
                    bands.append(band_keys(s).view(np.int64) if len(s) else [])
                    sig.append((s >> np.uint64(56)).astype(np.uint8).tobytes())
                sets, size = [], 0
        cols = [pa.array(x, t) for x, t in zip((node, bands, sig), _SIGNED.types)]
        yield pa.RecordBatch.from_arrays([b["__id"], b["__sum"], *cols], names=["__id", "__sum", *_SIGNED.names])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose texts are alike: a hub's row (no a) is followed by its members'."""
    have = None
    for b in batches:
        keep = []
        for member, text in zip(b["a"].to_pylist(), b["text"].to_pylist()):
            mine = shingles(normalise(text)[0])
            if member is None:
                have = mine
            keep.append(member is not None and similarity(mine, have) >= THRESHOLD)
        yield pa.RecordBatch.from_arrays([b["a"], b["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the share of equal coordinates of both signatures."""
    for b in batches:
        same = [float((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).mean()) for x, y in zip(b["sig"].to_pylist(), b["hub_sig"].to_pylist())]
        yield pa.RecordBatch.from_arrays([b["node"], b["hub"], pa.array(same, pa.float64())], names=["node", "hub", "same"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of texts as sets: of a shingle that occurs c times, c elements. Weighted similarity is that of these sets."""
    for b in batches:
        out = []
        for text in b["text"].to_pylist():
            e, c = shingles(normalise(text)[0])
            nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            out.append(C.mix(np.repeat(e, c) + nth.astype(np.uint64) * _G).tobytes())
        yield pa.RecordBatch.from_arrays([b["node"], pa.array(out, pa.binary())], names=["node", "units"])


def linked(sets: list[np.ndarray], labels: list[bytes], sides: list[int]) -> list[tuple[bytes, bytes]]:
    """Links of labels that join all members of different labels that are alike; of two sides only members of different ones meet."""
    cls = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)[1]
    side, total = np.array(sides), np.array([len(x) for x in sets])
    cross = len(set(sides)) > 1
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(total)[:-1])
    mark, out = np.zeros(total.sum(), np.uint8), []
    for x in range(len(sets) - 1):
        can = cls[x + 1 :] != cls[x]
        can &= np.minimum(total[x + 1 :], total[x]) / np.maximum(total[x + 1 :], total[x]) >= THRESHOLD  # no similarity is above this
        if cross:
            can &= side[x + 1 :] != side[x]
        ys = np.flatnonzero(can) + x + 1
        if not len(ys):
            continue
        mark[ids[x]] = 1
        both = np.add.reduceat(mark[np.concatenate([ids[y] for y in ys])], np.cumsum(total[ys]) - total[ys], dtype=np.int64)
        mark[ids[x]] = 0
        for y in ys[both / (total[ys] + total[x] - both) >= THRESHOLD]:
            if cls[y] != cls[x]:
                out.append((labels[x], labels[y]))
                cls[cls == cls[y]] = cls[x]
    return out


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each (key, i, j), whose rows follow each other: in one block if i is j, else between the two."""
    names = ("key", "i", "j")

    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(zip(*(b[c].to_pylist() for c in names)), b["side"].to_pylist(), b["label"].to_pylist(), b["units"].to_pylist())

    for (_, i, j), group in groupby(rows(), key=lambda r: r[0]):
        _, sides, labels, sets = zip(*group)
        if i != j and len(set(sides)) < 2:
            continue
        links = linked([np.frombuffer(x, np.uint64) for x in sets], list(labels), list(sides))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], names=["a", "b"])


def counted(df: DataFrame, what: str, most: int | None = None):  # noqa: ANN201
    """(df written, its rows, a hint): the hint broadcasts a side of at most BROADCAST_ROWS rows, and else leaves the choice to Spark.

    most: the rows that df may have, if that is known.
    """
    df = C.materialise(df, what, few(most))
    n = df.count()
    return df, n, F.broadcast if n <= BROADCAST_ROWS else (lambda x: x)


def few(most: int | None) -> bool:
    """Whether a table of so many rows may be written by few tasks."""
    return most is not None and most <= FOLD_ROWS


def candidates(reps: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int]:
    """(pairs, buckets, rows of buckets) of so many representatives: pairs (a, b) of nodes whose signatures agree, b being a's hub in some bucket, and all rows (key, node) of buckets of two or more.

    Signatures meet only pairs, and each pair once, however many buckets it shares.
    """
    sigs = reps.select("node", "sig")
    rows = reps.select(F.explode("bands").alias("key"), "node")
    sizes = C.materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes", few(BANDS * most))
    buckets, n_rows, small = counted(C.join_counted(rows, sizes, "key", "n", HOT), "buckets", BANDS * most)
    rows = C.materialise(buckets.join(small(buckets.groupBy("node").agg(F.sum("n").alias("pop"))), "node").select("key", "node", "pop"), "popular", few(n_rows))
    hubs = C.materialise(rows.groupBy("key").agg(F.max(F.struct("pop", "node")).alias("h"), F.count(F.lit(1)).alias("n")).select("key", F.col("h.node").alias("hub"), "n"), "hubs", few(n_rows))
    met, n, small = counted(C.join_counted(rows, hubs, "key", "n", HOT).filter(F.col("node") != F.col("hub")).select("node", "hub").distinct(), "met", n_rows)
    pairs = sigs.join(small(met), "node").withColumnRenamed("sig", "node_sig")
    per = met.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    theirs = C.materialise(sigs.select(F.col("node").alias("hub"), F.col("sig").alias("hub_sig")).join(small(per), "hub"), "hub_sigs", few(n))
    pairs = C.join_counted(C.materialise(pairs, "met_sigs", few(n)), theirs, "hub", "n", HOT).select("node", F.col("node_sig").alias("sig"), "hub", "hub_sig")
    kind = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("hub", T.BinaryType()), T.StructField("same", T.DoubleType())])
    pairs = C.materialise(pairs.mapInArrow(_agreeing, kind), "agreeing", few(n))
    return pairs.filter(F.col("same") >= ESTIMATE).select(F.col("node").alias("a"), F.col("hub").alias("b")), buckets.select("key", "node"), n_rows


def compared(pairs: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    """Of so many pairs (a, b), b being a hub, those whose texts are alike. A hub of many members has a salt for each HUB_MEMBERS of them."""
    hubs = C.materialise(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).withColumn("salts", F.ceil(F.col("n") / HUB_MEMBERS).cast("int")), "hubs", few(most))
    salted = C.join_counted(pairs, hubs, "b", "n", HOT).withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    members = salted.select("a", "b", "salt").join(texts.withColumnRenamed("node", "a"), "a")
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    theirs = hubs.join(texts.withColumnRenamed("node", "b"), "b").select(F.lit(None).cast("binary").alias("a"), "b", every.alias("salt"), "text")
    both = theirs.unionByName(members).repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    return C.materialise(both.select("a", "b", "text").mapInArrow(_compare, T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])), "links", few(most))


def rest(buckets: DataFrame, labels: DataFrame, texts_of, most: int) -> DataFrame:  # noqa: ANN001
    """Of buckets with so many rows, links (a, b) of labels between all members of a bucket that the labels do not join yet.

    A bucket whose members have one label is done. In any other each two members of different labels
    are compared exactly, but for those that links found before them have joined. A large bucket is
    dealt into blocks of BLOCK_UNITS shingles by a hash of the node, and each two blocks meet in a
    task's memory; only links, fewer than the members, come out.
    """
    rows = C.materialise(buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled", few(most))
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi").select("key", "n")
    rows, n, small = counted(C.join_counted(rows, C.materialise(mixed, "mixed_keys", few(most)), "key", "n", HOT).drop("n"), "mixed", most)
    kind = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("units", T.BinaryType())])
    sets = C.materialise(texts_of(rows.select("node").distinct(), n).mapInArrow(_units, kind), "units")
    rows = rows.join(small(sets.select("node", (F.length("units") / 8).alias("w"))), "node")
    rows = C.materialise(rows, "weighed", few(n))
    blocks = C.materialise(rows.groupBy("key").agg(F.ceil(F.sum("w") / BLOCK_UNITS).alias("nb"), F.count(F.lit(1)).alias("n")), "blocks", few(n))
    rows = C.join_counted(rows, blocks, "key", "n", HOT).withColumn("side", F.pmod(F.xxhash64("node"), F.col("nb")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    rows = rows.select("node", "label", "side", F.struct("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")).alias("task"))
    rows = rows.select("node", "label", "side", F.xxhash64("task.key", "task.i", "task.j").alias("deal"), "task")
    met = rows.join(sets, "node").select("deal", F.col("task.key").alias("key"), F.col("task.i").alias("i"), F.col("task.j").alias("j"), "side", "label", "units")
    met = met.repartition("deal").sortWithinPartitions("deal", "key", "i", "j")
    return C.materialise(met.mapInArrow(_rest, T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])), "rest")


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(node, label) of all nodes of (at most so many) links (a, b): the least node that each is connected to.

    Labels spread along the links and then jump to the label of the label, so a class of any
    diameter takes a number of rounds near its logarithm. Each round is written to the shared folder.
    """
    edges, n, small = counted(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", None if most is None else 2 * most)
    labels = C.materialise(edges.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("node"), F.least("a", "l").alias("label")), "labels", few(n))
    degrees = None if n <= BROADCAST_ROWS else C.materialise(edges.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "degrees", few(n))
    while True:
        named = labels.select(F.col("node").alias("b"), "label")
        if degrees is not None:  # a hub has as many edges as its class has members
            named = C.materialise(named.join(degrees, "b"), "named", few(n))
        met = edges.join(F.broadcast(named), "b") if degrees is None else C.join_counted(edges, named, "b", "n", HOT)
        near = met.groupBy("a").agg(F.min("label").alias("l"))
        once = C.materialise(labels.join(small(near.withColumnRenamed("a", "node")), "node").select("node", F.col("label").alias("was"), F.least("label", "l").alias("mid")), "once", few(n))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        if degrees is None:
            met = once.join(F.broadcast(jump), "mid")
        else:
            met = C.join_counted(once, C.materialise(jump.join(once.groupBy("mid").agg(F.count(F.lit(1)).alias("n")), "mid"), "jump", few(n)), "mid", "n", HOT)
        new = C.materialise(met.select("node", "was", F.least("mid", "far").alias("label")), "labels", few(n))
        labels = new.select("node", "label")
        if new.filter(F.col("was") != F.col("label")).isEmpty():
            return labels


def signed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __sum, node, bands, sig) of each row; __sum is a hash of the text, node one of its words, or of the text if it has none; null if it is empty."""
    C.prepare(df.sparkSession)
    src = df.select(F.col(id_col).alias("__id"), text_sum(text_col).alias("__sum"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    schema = T.StructType([src.schema["__id"], src.schema["__sum"], T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType())])
    return C.materialise(src.mapInArrow(_sign, schema), "signed")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, class_id (the least id of its class), class_size, kept (its row stays).

    kept is true for the rows of the least id; repeated rows of that id are all kept.
    """
    return classes(df, id_col, text_col).drop("__sum")


def classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates with __sum, which tells rows of the same id apart."""
    all_rows = signed(df, id_col, text_col)
    # Of a node's rows one, with its id, stands for all: combined before the shuffle, however many copies there are.
    reps = C.materialise(all_rows.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "bands", "sig")).alias("r"), F.count(F.lit(1)).alias("n")).select("node", "r.__id", "r.bands", "r.sig", "n"), "reps")
    n_reps = reps.count()
    found, buckets, n_rows = candidates(reps.select("node", "bands", "sig"), n_reps)
    pairs, n_pairs, _ = counted(found, "pairs")

    def texts_of(nodes: DataFrame, most: int) -> DataFrame:
        """(node, text) of at most so many nodes: only texts that are compared go through the shuffle."""
        wanted = C.materialise(nodes.join(reps.select("node", text_key("__id").alias("__k")), "node"), "wanted", few(most))
        src = df.select(text_key(id_col).alias("__k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        texts = semi(src, wanted.select("__k").distinct(), "__k")
        kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("node", T.BinaryType())])
        return texts.mapInArrow(_named, kind).join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))

    texts = C.materialise(texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 2 * n_pairs), "texts")
    first = components(compared(pairs, texts, n_pairs), n_pairs)
    final = components(rest(buckets, first, texts_of, n_rows)).select(F.col("node").alias("first"), F.col("label").alias("final"))
    # Nodes to first classes to final ones: counted on each step, as a class may hold a large share of all texts or rows.
    nodes = C.materialise(reps.select("node", "__id", "n").join(first.withColumnRenamed("label", "first"), "node", "left").withColumn("first", F.coalesce("first", "node")), "nodes", few(n_reps))
    firsts = nodes.groupBy("first").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"))).alias("c"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("nodes"))
    firsts = C.materialise(firsts.join(final, "first", "left").withColumn("label", F.coalesce("final", "first")).drop("final"), "firsts", few(n_reps))
    found = C.materialise(firsts.groupBy("label").agg(F.min("c").alias("c"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "found", few(n_reps))
    named = C.join_counted(firsts.select("first", "label", "nodes"), found, "label", "n", HOT).select("first", "nodes", F.col("c.id").alias("class_id"), "size")
    known = C.join_counted(nodes.select("node", "first", "n"), C.materialise(named, "named", few(n_reps)), "first", "nodes", HOT).select("node", "n", "class_id", "size")
    ids = all_rows.select("__id", "__sum", "node")
    some = C.join_counted(ids.filter("node is not null"), C.materialise(known, "known", few(n_reps)), "node", "n", HOT).select("__id", "__sum", "class_id", "size")
    none = ids.filter("node is null").select("__id", "__sum", F.col("__id").alias("class_id"), F.lit(1).cast("long").alias("size"))
    cid = F.col("class_id")
    return some.unionByName(none).select(F.col("__id").alias(id_col), "class_id", F.col("size").cast("long").alias("class_size"), F.coalesce(F.col("__id").eqNullSafe(cid), F.lit(False)).alias("kept"), "__sum")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        nodes = [hashlib.blake2b(normalise(t)[0].tobytes(), digest_size=16).digest() for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["text"], pa.array(nodes, pa.binary())], names=["text", "node"])


def text_key(c: str):  # noqa: ANN201
    """An id as text, null as a text that no id is: joins compare it."""
    return F.coalesce(F.col(c).cast("string"), F.lit("\x00null"))


def text_sum(c: str):  # noqa: ANN201
    return F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))


def semi(df: DataFrame, ids: DataFrame, key: str | list[str], how: str = "left_semi") -> DataFrame:
    """df with (or, left_anti, without) the ids. They are broadcast only if they are counted and few; else both sides are shuffled."""
    ids = C.materialise(ids, "ids")
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if small else ids, key, how)


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each class, all its columns kept.

    The row of the least id stays. Rows of one id are told apart by their texts; of equal ones one stays.
    """
    found = C.materialise(classes(df, id_col, text_col).select(text_key(id_col).alias("__k"), "__sum", "kept"), "classes")
    per = found.groupBy("__k", "__sum").agg(F.max("kept").alias("k"), F.count(F.lit(1)).alias("n"))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), text_key(id_col).alias("__k"), text_sum(text_col).alias("__sum"))
    out = semi(rows, per.filter(~F.col("k")).select("__k", "__sum"), ["__k", "__sum"], "left_anti")
    twice = per.filter("k and n > 1").select("__k", "__sum")
    if not twice.isEmpty():
        out = semi(out, twice, ["__k", "__sum"], "left_anti").unionByName(semi(out, twice, ["__k", "__sum"]).dropDuplicates(["__k", "__sum"]))
    return out.select(*(F.col("row").getField(c).alias(c) for c in df.columns))
