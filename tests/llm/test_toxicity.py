import random
import zlib

import numpy as np

from corpusloom.llm import toxicity as X

BAD = ["idiot", "moron", "scum", "pathetic"]


def words(r, n):
    return [r.choice(["the", "and", "of", "ther", "onth", "ered", "anth", "inth", "stble", "handes", "tionly"]) for _ in range(n)]


def corpus(n=400, seed=1, bad=BAD):
    r, rows = random.Random(seed), []
    for i in range(n):
        w, y = words(r, r.randint(5, 300)), int(i % 5 == 0)
        for _ in range(r.randint(1, 3) if y else 0):
            w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((i, " ".join(w), y))
    return rows


def test_learns_and_knows_misspellings():
    rows = corpus()
    m = X.fit([t for _, t, _ in rows], [y for _, _, y in rows])
    fresh = corpus(seed=9)
    s = np.array([m.score(t) for _, t, _ in fresh])
    y = np.array([y for _, _, y in fresh])
    assert (s[y == 1] >= 0.3).mean() > 0.95 and (s[y == 0] >= 0.3).mean() < 0.05
    r = random.Random(3)
    odd = [m.score(" ".join([*words(r, 40), w, *words(r, 40)])) for w in ("idiots", "moronn", "pathetics", "idiott")]
    clean = [m.score(" ".join(words(r, 80))) for _ in range(20)]
    assert min(odd) > max(clean)


def test_grams_stay_within_words():
    b1, w1, n1 = X.grams("Idiot, the")
    b2, w2, n2 = X.grams("idiot")
    assert n1 == 1 and set(b2) <= set(b1) and n2 == 1 and X.grams("") [2] == 0 and X.grams("!!! ,") [2] == 0
    assert len(b2) == 5 + 4 + 3 + 2  # n-grams of 3 to 6 symbols in seven symbols with their marks


def test_query_shape(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (1002, "idiot " * 30_000, "x"), (1, rows[1][1], "x")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None)], "doc_id bigint, toxic int")
    got = X.toxicity(docs, labels).collect()
    assert len(got) == 204
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1002] > 0.5 and by[1000] == by[1001] == 0


def test_long_texts_are_scored_in_stretches(monkeypatch):
    rows = corpus(200)
    m = X.fit([t for _, t, _ in rows], [y for _, _, y in rows])
    r = random.Random(4)
    for size in (7, 50, 1000):
        for _ in range(20):
            text = " ".join(words(r, r.randint(0, 300)))
            parts = list(X.stretches(text, size))
            assert "".join(parts) == text and all(len(p) >= size and p[-1] == " " for p in parts[:-1])
    assert list(X.stretches("x" * 100, 7)) == ["x" * 100]
    clean = " ".join(words(r, 4000))
    monkeypatch.setattr(X, "STRETCH", 500)
    assert m.score(f"{clean} idiot {clean}") >= 0.3 > m.score(clean)
    assert abs(m.score(clean) - max(m.score(p) for p in X.stretches(clean))) < 1e-12


def test_copies_do_not_fill_the_sample(spark):
    rows = corpus(100)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000 + i, rows[0][1]) for i in range(300)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1000 + i, 1) for i in range(300)], "lid bigint, y int")
    texts, labels = X.sample(docs.select(X.F.col("doc_id").alias("__id"), X.F.col("text").alias("__text")), marks.toDF("__lid", "__y"), 10, 20, 10**9)
    assert len(texts) == len(set(texts)) == 30 and sum(labels) == 10


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r["score"] for r in X.toxicity(docs, none).collect()] == [0.0]
    assert X.toxicity(docs.limit(0), none).count() == 0


def test_held_out_labels_are_not_read(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    flip = lambda on: spark.createDataFrame([(i, 1 - y if on and zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, _, y in rows], "doc_id bigint, toxic int")
    a, b = ({r["doc_id"]: r["score"] for r in X.toxicity(docs, flip(on)).collect()} for on in (False, True))
    assert a == b
