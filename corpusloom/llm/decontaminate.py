"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as runs of lower-case letters and digits with one space between them. A
benchmark item of m symbols may differ from a region of a document by e = floor(error * m) edits.
By the q-gram lemma such a region shares at least m + 1 - q (e + 1) of the item's q-grams, on
diagonals (position in the text minus position in the item) at most e apart. So shared q-grams are
counted in diagonal bands of 2 (e + 1), which overlap by half: any e + 1 diagonals lie in one of
them. Bands that reach the bound are verified by an alignment confined to their diagonals.

The index of an item set is bounded: items go to the executors in blocks of at most max_symbols
symbols (a benchmark of any size is a stated query set that is run against all rows). Texts are read
once: each batch is prepared once and meets the blocks one after the other, of which a worker holds
one at a time. A text is processed whole and by itself, so nothing is shuffled.

Defined results: a null or empty text or item matches nothing; an item too short for e edits gets
the largest budget at which the lemma still bounds (an item of fewer than q symbols can't be found
by q-grams and is searched for literally, as whole words); of overlapping alignments of an item the
one of fewest edits stays (ties: the first); repeated rows and items give repeated results; a very
long text takes time and memory in proportion to its length and its matches; empty tables give no
rows. Columns that are not named are not read by find_regions, and kept by clean, whatever their
names; if the ids of texts and items have one name, the item's column is called item_<name>.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

#: Symbols of a q-gram, and edits per symbol of an item. The lemma needs q (e + 1) <= m.
Q = 8
ERROR = 0.1
BLOOM_BITS = 21
#: Shared q-grams of a text and a block that are held at a time.
HITS = 2_000_000
_B = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a text (letters and digits in lower case, 32 for what is between words) and their places."""
    low = text.lower()
    if len(low) != len(text):  # a few letters grow when lowered: keep places exact
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    cp = C.codepoints(low)
    word = ((cp >= 97) & (cp <= 122)) | ((cp >= 48) & (cp <= 57)) | ((cp >= 0xC0) & (cp != 0xD7) & (cp != 0xF7) & ~((cp >= 0x2000) & (cp <= 0x206F)) & (cp != 0x3000))
    keep = word.copy()
    if len(cp):
        keep[1:] |= word[:-1]  # one place after each word stands for the gap
    sym = np.where(word, cp, np.uint32(32))[keep]
    at = np.flatnonzero(keep)
    if len(sym) and sym[-1] == 32:
        sym, at = sym[:-1], at[:-1]
    return sym, at


def hashes(sym: np.ndarray, q: int = Q) -> np.ndarray:
    """One 64-bit hash per q-gram."""
    n = len(sym) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h, size = sym.astype(np.uint64), 1
    while size < q:  # a hash of twice as many symbols, or of two overlapping halves at the end
        step = min(size, q - size)
        x = h[: len(h) - step] * _B
        x ^= x >> np.uint64(31)
        x += h[step:]
        h, size = x * _B, size + step
    return h


def budget(m: int, q: int = Q, error: float = ERROR) -> tuple[int, int]:
    """(edits, least shared q-grams) of an item of m symbols; edits shrink until the bound is 1 at least."""
    e = int(error * m)
    while e > 0 and m + 1 - q * (e + 1) < 1:
        e -= 1
    return e, max(1, m + 1 - q * (e + 1))


class Text:
    """A text as symbols, with what every block of items asks of it."""

    def __init__(self, text: str, q: int = Q) -> None:
        self.q = q
        self.sym, self.at = normalise(text)
        self.hashes = hashes(self.sym, q)

    @cached_property
    def padded(self) -> str:
        return " " + "".join(map(chr, self.sym)) + " "


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple], q: int = Q, error: float = ERROR) -> None:
        self.q, self.ids, self.sym, self.short = q, [], [], []
        for item_id, text in items:
            sym, _ = normalise(text or "")
            if len(sym) >= q:
                self.ids.append(item_id)
                self.sym.append(sym)
            elif len(sym):
                self.short.append((item_id, sym))
        sizes = np.array([len(s) for s in self.sym], np.int64)
        self.size = sizes
        self.edits, self.least = (np.array(x, np.int64) for x in (zip(*(budget(int(m), q, error) for m in sizes)) if len(sizes) else ((), ())))
        self.most = int(sizes.max()) if len(sizes) else 0
        self.reach = self.most + int(self.edits.max(initial=0)) + q
        h = np.concatenate([hashes(s, q) for s in self.sym]) if self.sym else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(self.sym)), np.maximum(sizes - q + 1, 0))
        pos = np.concatenate([np.arange(len(s) - q + 1) for s in self.sym]) if self.sym else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.pos = item[order].astype(np.int64), pos[order].astype(np.int64)
        self.key, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.bloom = np.zeros(1 << BLOOM_BITS, bool)
        self.bloom[self.key >> np.uint64(64 - BLOOM_BITS)] = True

    def bands(self, h: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first diagonal, last diagonal, shared) of runs of bands that reach the bound, for a text's q-gram hashes."""
        at = np.flatnonzero(self.bloom[h >> np.uint64(64 - BLOOM_BITS)]) if len(h) and len(self.key) else np.empty(0, np.int64)
        if not len(at):
            return []
        got = h[at]
        k = np.searchsorted(self.key, got)
        k[k == len(self.key)] = 0
        ok = self.key[k] == got
        at, k = at[ok], k[ok]
        if len(at) < int(self.least.min()):
            return []
        ends = np.cumsum(self.count[k])
        found: list[tuple[int, int]] = []
        lo = 0
        while lo < len(at):  # texts and items that repeat themselves share many q-grams: so many are held at a time
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + HITS, side="right"))
            hi = max(hi, int(np.searchsorted(at, at[lo] + 2 * self.reach)))
            found += self._good(at[lo:hi], k[lo:hi])
            if hi == len(at):
                break
            # a region has less than `reach` symbols: it lies within one of the stretches
            lo = int(np.searchsorted(at, at[hi] - self.reach))
        out: list[tuple[int, int, int, int]] = []
        for band, shared in sorted(found):  # neighbouring bands are one region
            i, c = band >> 40, band & ((1 << 40) - 1)
            w = int(self.edits[i]) + 1
            lo, hi = c * w - self.most, (c + 2) * w - 1 - self.most
            if out and out[-1][0] == i and lo <= out[-1][2] + 1:
                out[-1] = (i, out[-1][1], max(out[-1][2], hi), max(out[-1][3], shared))
            else:
                out.append((i, lo, hi, shared))
        return out

    def _good(self, at: np.ndarray, k: np.ndarray) -> list[tuple[int, int]]:
        """(band, shared) of the bands (item << 40 | number) that reach the bound; q-gram k[i] is at place at[i] of the text."""
        n = self.count[k]
        ends = np.cumsum(n)
        into = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(self.first[k], n)
        item = self.item[into]
        band = item * np.int64(1 << 40) + (np.repeat(at, n) - self.pos[into] + self.most) // (self.edits[item] + 1)
        order = np.argsort(band, kind="stable")  # the hits of a band, and those of its neighbour, follow each other
        place = self.pos[into][order]
        key, begin, shared = np.unique(band[order], return_index=True, return_counts=True)
        pair = shared.copy()
        near = np.flatnonzero(key[1:] == key[:-1] + 1)
        pair[near] += shared[near + 1]
        least = self.least[key >> np.int64(40)]
        # a q-gram of the item counts once, however often the text has it on these diagonals
        return [(int(key[g]), int(pair[g])) for g in np.flatnonzero(pair >= least) if len(np.unique(place[begin[g] : begin[g] + pair[g]])) >= least[g]]

    def find(self, text: str | Text) -> list[tuple]:
        """(item id, start, end, edits, shared q-grams) of all regions of a text, places in code points."""
        t = text if isinstance(text, Text) else Text(text, self.q)
        out = []
        for i, lo, hi, shared in self.bands(t.hashes):
            for a, b, d in align(self.sym[i], t.sym, lo, hi, int(self.edits[i])):
                out.append((self.ids[i], int(t.at[a]), int(t.at[b - 1]) + 1, d, shared))
        for item_id, s in self.short:
            needle = " " + "".join(map(chr, s)) + " "
            k = t.padded.find(needle)
            while k >= 0:
                out.append((item_id, int(t.at[k]), int(t.at[k + len(s) - 1]) + 1, 0, 0))
                k = t.padded.find(needle, k + 1)
        return out


def align(item: np.ndarray, sym: np.ndarray, lo: int, hi: int, most: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of the item's best alignments in a text on diagonals lo - most to hi + most.

    The item is aligned as a whole, the text's ends are free. Row i of the table holds the text
    positions i + lo - most to i + hi + most. Of overlapping regions the one with the fewest edits
    stays (ties: the first).
    """
    m, n = len(item), len(sym)
    literal, found = item.tobytes(), []
    lo, hi = max(lo - most, -m), min(hi + most, n)
    window = np.ascontiguousarray(sym[max(lo, 0) : min(n, hi + m)])
    k = window.tobytes().find(literal)
    while k >= 0 and k % item.itemsize:
        k = window.tobytes().find(literal, k + 1)
    if k >= 0 and hi - lo <= 4 * (most + 1) + 2 * most:  # one band or two: the literal match is the best region
        a = max(lo, 0) + k // item.itemsize
        return [(a, a + m, 0)]
    width = hi - lo + 1
    big = 1 << 20
    cols = np.arange(width)
    end = lo + cols  # text length used in row 0
    cost = np.where((end >= 0) & (end <= n), 0, big)
    begin = end.copy()
    padded = np.full(m + width + 2, -1, np.int64)
    s0, s1 = max(lo, 0), min(n, hi + m)
    if s1 > s0:
        padded[s0 - lo : s1 - lo] = sym[s0:s1]
    for i in range(1, m + 1):
        end = lo + i + cols
        same = padded[i - 1 : i - 1 + width] == item[i - 1]
        diag = np.where(end - 1 >= 0, cost + np.where(same, 0, 1), big)
        up = np.append(cost[1:], big) + 1  # the item's symbol has no partner
        take = up < diag
        c = np.where(take, up, diag)
        b = np.where(take, np.append(begin[1:], 0), begin)
        c = np.where((end >= 0) & (end <= n), c, big)
        # a text symbol has no partner: runs to the right
        low = np.minimum.accumulate(c - cols)
        src = np.maximum.accumulate(np.where(c - cols == low, cols, 0))
        cost = np.minimum(low + cols, big)
        begin = b[src]
        cost = np.where((end >= 0) & (end <= n), cost, big)
    end = lo + m + cols
    hits = np.flatnonzero(cost <= most)
    for j in hits[np.lexsort((end[hits], cost[hits]))]:
        a, z = int(begin[j]), int(end[j])
        k = bisect(found, (a, z, 0))  # found is in order and free of overlaps: only two neighbours can touch
        if z > a and (k == 0 or found[k - 1][1] <= a) and (k == len(found) or found[k][0] >= z):
            found.insert(k, (a, z, int(cost[j])))
    return found


def blocks(items: DataFrame, id_col: str, text_col: str, max_symbols: int) -> Iterator[list[tuple]]:
    """The items in blocks of at most max_symbols symbols (one longer item is a block of its own)."""
    block, size = [], 0
    rows = items.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).orderBy(*[1, 2])
    for i, text in rows.toLocalIterator():
        if block and size + len(text) > max_symbols:
            yield block
            block, size = [], 0
        block.append((i, text))
        size += len(text)
    if block:
        yield block


def find_regions(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = Q, error: float = ERROR, max_symbols: int = 4_000_000) -> DataFrame:
    """One row per region of a document that holds an item: id, item id, start, end, edits, shared.

    Columns: id_col, item_id, region_start, region_end, edits, shared_qgrams.
    """
    spark = docs.sparkSession
    C.prepare(spark)
    src = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    named = item_id if item_id != id_col else f"item_{item_id}"
    kinds = [(id_col, docs.schema[id_col].dataType), (named, items.schema[item_id].dataType), *((c, T.LongType()) for c in ("region_start", "region_end", "edits", "shared_qgrams"))]
    schema = T.StructType([T.StructField(*k) for k in kinds])
    indexes = [spark.sparkContext.broadcast(Index(block, q, error)) for block in blocks(items, item_id, item_text, max_symbols)]
    if not indexes:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = prepared(b["__text"].to_pylist(), q, len(indexes))
            for ix in one_by_one(indexes):
                take, rows = [], []
                for k, text in enumerate(texts):
                    for r in ix.find(text):
                        take.append(k)
                        rows.append(r)
                if rows:
                    yield pa.RecordBatch.from_arrays([b["__id"].take(pa.array(take)), *(pa.array(c) for c in zip(*rows))], names=[k for k, _ in kinds])

    return src.mapInArrow(run, schema)


def prepared(texts: list[str | None], q: int, passes: int) -> Iterable[Text]:
    """The texts of a batch; they are held only if there are several passes over them."""
    out = (Text(t or "", q) for t in texts)
    return list(out) if passes > 1 else out


def one_by_one(indexes: list) -> Iterator[Index]:
    """The values of broadcasts; of several, a worker keeps one at a time and reads the next from its local copy."""
    for x in indexes:
        yield x.value
        if len(indexes) > 1:
            x.__dict__.pop("_value", None)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = Q, error: float = ERROR, max_symbols: int = 4_000_000) -> DataFrame:
    """The documents that hold no item, with all their columns. Row by row: nothing is shuffled."""
    spark = docs.sparkSession
    C.prepare(spark)
    at = docs.columns.index(text_col)
    indexes = [spark.sparkContext.broadcast(Index(block, q, error)) for block in blocks(items, item_id, item_text, max_symbols)]
    if not indexes:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, good = prepared(b.column(at).to_pylist(), q, len(indexes)), np.ones(len(b), bool)
            for ix in one_by_one(indexes):
                for k, text in enumerate(texts):
                    good[k] = good[k] and not ix.find(text)
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
