import bisect
import random
import zlib

import numpy as np
import pytest

from corpusloom.llm import packing as P
from corpusloom.llm.queries import tokenizer_path

PATH = tokenizer_path()


def fill(rows):
    """Sequences of a plan, as {sequence: [(offset, length)]}."""
    out = {}
    for length, _, many, seq, per, offset in rows.tolist():
        for i in range(many):
            out.setdefault(seq + i // per, []).append((offset + i % per * length, length))
    return out


def best_fit(h, size):
    """Sequences that best fit by decreasing length takes, one piece after the other."""
    rooms, n = [], 0
    for length in range(size, 0, -1):
        for _ in range(h[length]):
            k = bisect.bisect_left(rooms, length)
            if k == len(rooms):
                n, room = n + 1, size
            else:
                room = rooms.pop(k)
            if room > length:
                bisect.insort(rooms, room - length)
    return n


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_whole_and_gapless(seed):
    r = np.random.default_rng(seed)
    size = [16, 64, 1024][seed % 3]
    h = np.zeros(size + 1, np.int64)
    for n in r.integers(1, size + 1, int(r.integers(1, 400))):
        h[n] += int(r.integers(1, 6))
    rows, n = P.plan(h, size)
    got = np.zeros_like(h)
    for seq, parts in (s := fill(rows)).items():
        at = 0
        for o, length in sorted(parts):
            assert o == at
            at += length
            got[length] += 1
        assert at <= size and seq < n
    assert (got == h).all() and len(s) == n
    assert n <= best_fit(h, size) + 2
    for length in np.flatnonzero(h):  # ranks are dealt out once each
        mine = sorted((f, f + m) for le, f, m, *_ in rows.tolist() if le == length)
        assert mine[0][0] == 0 and mine[-1][1] == h[length] and all(a[1] == b[0] for a, b in zip(mine, mine[1:]))


def test_fast_encoder_gives_the_same_ids():
    slow, fast, _ = P.encoders(PATH)
    assert fast is not None
    r = random.Random(1)
    chars = [chr(c) for c in range(0x250) if P.PLAIN.match(chr(c))]
    assert all(fast.encode_ordinary(a) == slow.encode(a, add_special_tokens=False).ids for a in chars)
    for _ in range(4000):
        t = "".join(r.choice([*r.sample(chars, 5), " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "the", " of", "12"]) for _ in range(r.randint(0, 30)))
        assert fast.encode_ordinary(t) == slow.encode(t, add_special_tokens=False).ids, t
    for t in ("日本語 テキスト", "a<|endoftext|>b", "x y\x1cz", "😀", "", "a" * 5000, " " * 3000):
        assert P.token_ids(t, PATH).tolist() == slow.encode(t, add_special_tokens=False).ids


def test_cut():
    assert P.cut(5) == [(0, 5)] and P.cut(1024) == [(0, 1024)] and P.cut(2049) == [(0, 1), (1, 1024), (1025, 1024)] and P.cut(3, 2) == [(0, 1), (1, 2)]


def rows():
    r = random.Random(3)
    texts = [" ".join(r.choice(["the", "stone", "über", "Zx9", "\n"]) for _ in range(r.choice([3, 40, 300, 900, 2500]))) for _ in range(120)]
    return [*enumerate(texts), (500, None), (501, ""), (502, "word " * 60_000), (0, texts[0]), (None, "no id")]


@pytest.mark.parametrize("most", [512, 0])
def test_pack_documents(spark, monkeypatch, most):
    monkeypatch.setattr(P, "MAX_PARTS", most)
    df = spark.createDataFrame(rows(), "doc_id bigint, text string").withColumn("length", P.F.lit("clash")).repartition(5)
    got = P.pack_documents(df, PATH, with_ids=True).collect()
    slow = P.encoders(PATH)[0]
    want = []
    for i, t in rows():
        ids = [*slow.encode(t or "", add_special_tokens=False).ids, 2]
        want += [(str(i), k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(P.cut(len(ids)))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    assert len(seqs) <= best_fit(np.bincount([n for *_, n, _ in want], minlength=1025), 1024) + 1


@pytest.mark.parametrize("most", [512, 0])
def test_wide_rows(spark, monkeypatch, most):
    """Files of several row groups, each read by several tasks: every piece has a place of its own."""
    monkeypatch.setattr(P, "MAX_PARTS", most)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(1 << 20))
    try:
        r = np.random.default_rng(5)
        wide = P.F.concat(*(P.F.sha2(P.F.concat("id", P.F.lit(str(k))), 512) for k in range(32)))
        lengths = [int(x) for x in r.integers(1, 1025, 40)] + [512] * 20
        parts = spark.range(9000).select("id", wide.alias("wide"), P.F.get(P.F.lit(lengths), P.F.col("id").cast("int") % 60).cast("long").alias("length")).repartition(2)
        got = P.pack(parts).select("id", "length", "sequence_id", "offset").toPandas()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert sorted(got["id"]) == list(range(9000))
    got = got.sort_values(["sequence_id", "offset"])
    before = got.groupby("sequence_id")["length"].cumsum() - got["length"]
    assert (before == got["offset"]).all() and (got["offset"] + got["length"]).max() <= 1024


def test_empty(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0
