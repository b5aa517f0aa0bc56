"""Toxicity from subword-bag embeddings, averaged into a linear softmax, trained jointly in numpy.

A text is cut into windows of WINDOW words. A window's vector is the average of the vectors of its
words' character n-grams (lengths NGRAMS, with a mark on either side of a word, hashed into
2**BITS buckets); a softmax over two classes scores it, and the text's score is that of its worst
window, so a few words count as much in a long text as in a short one. Embeddings and softmax are
trained together: first windows inherit their text's label, then (labels belong to texts) only the
worst window of a text is adjusted. A misspelling that was never seen shares most of its n-grams
with the word, and so its vector.

Because the softmax is linear in the average, a trained model scores with one number per bucket;
scoring is a pass of array operations over the code points of whole texts, whatever their
vocabulary.

The model is fitted on a bounded sample of labelled rows (max_positive, max_negative, max_chars: the
texts of least hash, whole, each text once however many rows have it). A very long text is scored
stretch by stretch (STRETCH characters, cut at white space, windows counted anew in each), so its arrays
are bounded unless it is one word. Defined results: a text without words scores 0; without labelled
rows of both kinds every score is 0; a score that equals the threshold is predicted 1; of several labels
of an id the highest counts; a null id is not held out and has no label; repeated rows give repeated
results; an empty table gives no rows; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

NGRAMS = (3, 4, 5, 6)
BITS = 18
DIM = 8
WINDOW = 4
#: Characters of a text that are scored together, about.
STRETCH = 1 << 20
MARK = np.uint64(1)
_B = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(r"\s")


def grams(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket, window) of each n-gram of a text, and the number of windows.

    Words are runs of letters and digits in lower case; everything else becomes one mark.
    """
    cp = C.codepoints(text.lower())
    if not len(cp):
        return np.empty(0, np.uint32), np.empty(0, np.int64), 0
    # letters and digits: ASCII ones, and everything from U+00AA on but a few signs and spaces
    word = ((cp >= 97) & (cp <= 122)) | ((cp >= 48) & (cp <= 57)) | ((cp >= 0xAA) & (cp != 0xD7) & (cp != 0xF7) & ~((cp >= 0x2000) & (cp <= 0x206F)) & (cp != 0x3000) & ((cp > 0xBF) | (cp == 0xAA) | (cp == 0xBA)))
    pad = np.zeros(len(cp) + 2, bool)
    pad[1:-1] = word
    sym = np.zeros(len(cp) + 2, np.uint64)
    sym[1:-1] = cp
    sym[~pad] = MARK
    # keep words and a single mark between them: every n-gram of the kept row spans one word if it has no inner mark
    keep = pad.copy()
    keep[1:] |= pad[:-1]
    keep[:1] = True
    sym, isw = sym[keep], pad[keep]
    starts = np.concatenate(([False], isw[1:] & ~isw[:-1]))
    number = np.cumsum(starts)  # the word that a letter belongs to, from 1
    n_words = int(number[-1]) if len(number) else 0
    if not n_words:
        return np.empty(0, np.uint32), np.empty(0, np.int64), 0
    marks = np.cumsum(~isw)
    out_b, out_w = [], []
    h = sym * _B
    for n in range(2, max(NGRAMS) + 1):
        if n > len(sym):
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * _B + sym[n - 1 :]
        if n < min(NGRAMS):
            continue
        # an n-gram may begin and end with a mark but have none inside
        last = len(sym) - n
        ok = marks[n - 2 : n - 2 + last + 1] == marks[: last + 1]
        x = h[ok]
        x = (x ^ (x >> np.uint64(32))) * _B
        out_b.append((x >> np.uint64(64 - BITS)).astype(np.uint32))
        out_w.append(number[1 : 1 + last + 1][ok])  # its second symbol is a letter of its word
    words = np.concatenate(out_w) if out_w else np.empty(0, np.int64)
    buckets = np.concatenate(out_b) if out_b else np.empty(0, np.uint32)
    return buckets, (words - 1) // WINDOW, (n_words + WINDOW - 1) // WINDOW


def stretches(text: str, size: int | None = None) -> Iterator[str]:
    """A text in pieces of at least `size` characters (but the last), each up to and with a white space."""
    at, size = 0, size or STRETCH
    while len(text) - at > size and (m := _SPACE.search(text, at + size - 1)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


@dataclass
class Model:
    """value: the log odds that each bucket adds where it stands alone; bias: those of no evidence."""

    value: np.ndarray
    bias: float
    trained: bool = True

    def window_logits(self, text: str) -> np.ndarray:
        b, w, n = grams(text)
        if not n:
            return np.empty(0)
        total = np.bincount(w, weights=self.value[b], minlength=n)
        count = np.bincount(w, minlength=n)
        return total / np.maximum(count, 1) + self.bias

    def score(self, text: str | None) -> float:
        if not self.trained:
            return 0.0
        z = max((float(x.max()) for x in map(self.window_logits, stretches(text or "")) if len(x)), default=None)
        if z is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(texts: list[str], labels: list[int], epochs: int = 8, rate: float = 0.5, seed: int = 7) -> Model:
    """Train embeddings (2**BITS x DIM) and the softmax jointly with Adagrad.

    Epoch 0 lets windows inherit their text's label (a bounded random choice of windows per text);
    the others use each text's worst window, and for label 0 some random windows too.
    """
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BITS, np.float32), 0.0, trained=False)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.05, (1 << BITS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.5, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    g_emb, g_soft, g_bias = np.full(1 << BITS, 1e-4, np.float32), np.full((2, DIM), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    docs = []
    for t in texts:
        b, w, n = grams(t)
        order = np.argsort(w, kind="stable")
        docs.append((b[order], np.searchsorted(w[order], np.arange(n + 1))))
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    weight = np.sqrt(weight)

    def step(bags: list[np.ndarray], target: np.ndarray, ws: np.ndarray) -> None:
        nonlocal emb, soft, bias
        sizes = np.array([len(b) for b in bags])
        if not sizes.sum():
            return
        ids, at = np.concatenate(bags), np.repeat(np.arange(len(bags)), sizes)
        inv = (1 / np.maximum(sizes, 1)).astype(np.float32)
        rows = emb[ids]
        mean = np.stack([np.bincount(at, weights=rows[:, d], minlength=len(bags)) for d in range(DIM)], 1) * inv[:, None]
        z = mean @ soft.T + bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        d = p
        d[np.arange(len(bags)), target] -= 1
        d *= (ws / len(bags))[:, None]
        gs, gb = d.T @ mean, d.sum(0)
        ge = ((d @ soft) * inv[:, None]).astype(np.float32)
        uniq, back = np.unique(ids, return_inverse=True)
        grad = np.stack([np.bincount(back, weights=ge[at, k], minlength=len(uniq)) for k in range(DIM)], 1).astype(np.float32)
        # each bucket's step is scaled by the gradients it has had: rare n-grams learn as fast as common ones
        grad *= len(bags)
        g_emb[uniq] += (grad**2).mean(1)
        emb[uniq] -= rate * 0.3 * grad / np.sqrt(g_emb[uniq])[:, None]
        g_soft[:] += gs**2
        soft -= (rate * 0.2 * gs / np.sqrt(g_soft)).astype(np.float32)
        g_bias[:] += gb**2
        bias -= (rate * 0.2 * gb / np.sqrt(g_bias)).astype(np.float32)

    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), 64):
            bags, target, ws = [], [], []
            value = emb @ (soft[1] - soft[0]) if epoch else None
            for i in order[lo : lo + 64]:
                b, cut = docs[i]
                n = len(cut) - 1
                if n < 1 or not len(b):
                    continue
                if epoch == 0:
                    pick = rng.choice(n, min(n, 24), replace=False)
                    share = weight[i] / len(pick)
                else:
                    sums = np.add.reduceat(np.append(value[b], 0), np.minimum(cut[:-1], len(b)))
                    size = np.diff(cut)
                    mean = np.where(size > 0, sums / np.maximum(size, 1), -1e9)
                    pick, share = [int(mean.argmax())], weight[i]
                    if not y[i]:
                        pick += list(rng.choice(n, min(n, 2), replace=False))
                for k in pick:
                    bags.append(b[cut[k] : cut[k + 1]])
                    target.append(int(y[i]))
                    ws.append(share)
            if bags:
                step(bags, np.array(target), np.array(ws))
    return Model((emb @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]))


def sample(learn: DataFrame, marked: DataFrame, max_positive: int, max_negative: int, max_chars: int) -> tuple[list[str], list[int]]:
    """Different texts of least hash and their labels: so many of each label, and characters in all, at most.

    learn: __id, __text; marked: __lid, __y. Hashes, ids and lengths are joined with the labels; only
    the texts of the chosen ids (max_positive + max_negative at most) leave the scan.
    """
    keyed = learn.select("__id", F.xxhash64("__text").alias("key"), F.length("__text").alias("n"))
    known = keyed.join(marked, F.col("__id") == F.col("__lid")).groupBy("key", F.col("__y").cast("int").alias("y")).agg(F.min("__id").alias("__id"), F.max("n").alias("n"))
    rows = []
    for label, most in ((1, max_positive), (0, max_negative)):
        rows += known.filter(F.col("y") == label).orderBy("key", "__id").limit(most).collect()
    share = min(1.0, max_chars / max(1, sum(r["n"] for r in rows)))
    chosen: dict = {}
    for label in (1, 0):  # whole texts, in order of hash, until the label's share of the characters is used up
        mine = [r for r in rows if r["y"] == label]
        room = share * sum(r["n"] for r in mine)
        for r in mine:
            if room <= 0:
                break
            room -= r["n"]
            chosen[r["__id"], r["key"]] = label
    if not chosen:
        return [], []
    spark = learn.sparkSession
    ids = spark.createDataFrame([(i, k) for i, k in chosen], f"__id {learn.schema['__id'].dataType.simpleString()}, key bigint")
    met = learn.withColumn("key", F.xxhash64("__text")).join(F.broadcast(ids), ["__id", "key"]).select("__id", "key", "__text")
    found = {(r["__id"], r["key"]): r["__text"] for r in met.toLocalIterator()}
    order = sorted(found, key=lambda x: (x[1], str(x[0])))
    return [found[k] for k in order], [chosen[k] for k in order]


def apply(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """df with a column of scores in [0, 1]; an input column of that name is replaced."""
    spark = df.sparkSession
    C.prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # 2**BITS floats, whatever the data
    keep = [c for c in df.columns if c != out_col]
    at = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = pa.array([m.score(t) for t in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, out_col])

    kept = df.select(*(F.col(f"`{c}`") for c in keep))
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out_col, T.DoubleType())]))


def held_out(id_col: str = "doc_id"):  # noqa: ANN201
    return (F.crc32(F.col(id_col).cast("string")) % 4) == 2


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_positive: int = 3000, max_negative: int = 5000, max_chars: int = 40_000_000, threshold: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted for each row of docs; learns from the rows that are not held out.

    A null id belongs to no fold and is not held out; it joins no label.
    """
    marked = labels.select(F.col(id_col).alias("__lid"), F.col(label_col).cast("int").alias("__y")).filter("__y in (0, 1)").groupBy("__lid").agg(F.max("__y").alias("__y"))
    src = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    model = fit(*sample(src.filter(~held_out("__id")), marked.filter(~held_out("__lid")), max_positive, max_negative, max_chars))
    scored = apply(src.select("__id", "__text", F.coalesce(held_out("__id"), F.lit(False)).alias("held_out")), model, "__text")
    return scored.select(F.col("__id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
