import random

import numpy as np

from corpusloom.llm import near_dedup as N
from corpusloom.llm.decontaminate import normalise


def prose(r, n):
    return [f"w{r.randrange(4000)}" for _ in range(n)]


def changed(r, w, share):
    return [f"x{r.randrange(10**6)}" if r.random() < share else x for x in w]


def truth(rows):
    """Classes by the exact similarity of all pairs."""
    sh = [N.shingles(normalise(t or "")[0]) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if N.similarity(sh[i], sh[j]) >= N.THRESHOLD:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, (d, _) in enumerate(rows)}


def fixture(seed=1):
    r, rows = random.Random(seed), []
    common = prose(r, 120)
    for _ in range(40):
        base = prose(r, r.randint(30, 300))
        rows.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 3, 8])):
            rows.append(" ".join(changed(r, base, r.choice([0, 0.005, 0.01, 0.03, 0.1]))))
    rows += [" ".join([*prose(r, 120), *common]) for _ in range(60)]  # half of each text is the same passage
    rows += ["", None, "one two", "One, two!", "one two three", "!!!"]
    r.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def test_classes_equal_all_pairs(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("class_id", N.F.lit("clash")).repartition(5)
    got = {r["doc_id"]: r for r in N.near_duplicates(df).collect()}
    want = truth(rows)
    assert {d: r["class_id"] for d, r in got.items()} == want
    sizes = {}
    for c in want.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (d == r["class_id"]) for d, r in got.items())


def test_drop_keeps_one_and_columns(spark):
    rows = fixture(2)
    df = spark.createDataFrame([(i, t, "en", i) for i, t in rows], "doc_id bigint, text string, lang string, kept bigint")
    out = N.drop_near_duplicates(df)
    want = truth(rows)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == sorted(d for d, c in want.items() if d == c)
    twice = df.unionByName(df.limit(3))
    assert N.drop_near_duplicates(twice).count() == out.count()
    assert N.drop_near_duplicates(df.limit(0)).count() == 0 and N.near_duplicates(df.limit(0)).count() == 0


def test_large_groups(spark):
    r = random.Random(6)
    base = prose(r, 150)
    rows = [(i, " ".join(base)) for i in range(300)] + [(300 + i, " ".join(changed(r, base, 0.008))) for i in range(300)] + [(900, " ".join(prose(r, 100)))]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = truth(rows[299:])
    least = {d: (0 if c == 299 else c) for d, c in want.items()}
    assert {x["doc_id"]: x["class_id"] for x in got if x["doc_id"] >= 299} == least
    assert all(x["class_id"] == 0 for x in got if x["doc_id"] < 299)


def test_darts_estimate_weighted_similarity():
    rng, off = np.random.default_rng(0), []
    for _ in range(40):
        e = rng.integers(0, 2**63, 300).astype(np.uint64)
        a = rng.random(300) * 3 + 0.01
        b = np.where(rng.random(300) < 0.3, rng.random(300) * 3 + 0.01, a)
        sa, sb = N.dart_signatures([(e, a), (e, b)], 256)
        off.append((sa == sb).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.015
    one = np.array([5], np.uint64)
    assert len(N.dart_signature(one, np.array([0.01]), 64)) == 64 and len(N.dart_signature(one[:0], np.empty(0), 64)) == 0
    alone, together = N.dart_signature(e, a, 64), N.dart_signatures([(one, np.ones(1)), (e, a)], 64)[1]
    assert (alone == together).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(100)], "a binary, b binary")
    assert {bytes(r["label"]) for r in N.components(links).collect()} == {b"\x00"}


def test_null_ids(spark):
    r = random.Random(8)
    base = prose(r, 200)
    rows = [(None, " ".join(changed(r, base, 0.003))), (5, " ".join(base)), (None, " ".join(prose(r, 50))), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((str(x["doc_id"]), str(x["class_id"]), x["class_size"]) for x in N.near_duplicates(df).collect())
    assert got == [("5", "5", 2), ("None", "5", 2), ("None", "None", 1), ("None", "None", 1)]
    assert sorted(str(x["doc_id"]) for x in N.drop_near_duplicates(df).collect()) == ["5", "None", "None"]
    same = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(changed(r, base, 0.003))), (2, " ".join(prose(r, 60))), (2, " ".join(base))], "doc_id bigint, text string")
    assert sorted(x["doc_id"] for x in N.drop_near_duplicates(same).collect()) == [1, 2]


def test_without_broadcasts(spark, monkeypatch):
    rows = fixture(9)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = truth(rows)
    monkeypatch.setattr(N, "BROADCAST_ROWS", -1)
    assert {r["doc_id"]: r["class_id"] for r in N.near_duplicates(df).collect()} == want
    for name, value in (("HOT", 3), ("HUB_MEMBERS", 2)):
        monkeypatch.setattr(N, name, value)
    monkeypatch.setattr(N.C, "HOT_KEYS", 5)
    assert {r["doc_id"]: r["class_id"] for r in N.near_duplicates(df).collect()} == want


def test_clashing_names(spark):
    rows = fixture(3)
    names = ("__k", "__sum", "__id", "__text", "row", "node", "class_id", "a.b")
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: N.F.lit(f"own {c}") for c in names})
    out = N.drop_near_duplicates(df.unionByName(df.limit(5)))
    want = truth(rows)
    got = out.collect()
    assert out.columns == df.columns and {tuple(r[c] for c in names) for r in got} == {tuple(f"own {c}" for c in names)}
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, c in want.items() if d == c)


def classes_of(spark, rows):
    return {r["doc_id"]: r["class_id"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_variants_of_an_absent_base(spark):
    """Members that are mostly 0.7 to 0.8 like any hub, and some of them 0.8 like each other."""
    r = random.Random(12)
    base = prose(r, 600)
    rows = [(i, " ".join(changed(r, base, 0.02))) for i in range(300)]
    assert classes_of(spark, rows) == truth(rows)


def test_pairs_under_a_hot_template(spark):
    """Each text is an edited template, and a third of them have a copy: all links are found, as by all pairs."""
    r, texts = random.Random(5), []
    base = prose(r, 400)
    for i in range(225):
        one = changed(r, base, 0.0135)
        texts.append(" ".join(one))
        if i < 75:
            texts.append(" ".join(changed(r, one, 0.0195)))
    rows = list(enumerate(texts))
    assert classes_of(spark, rows) == truth(rows)


def test_blocks_of_a_bucket_meet(spark, monkeypatch):
    r = random.Random(5)
    base = prose(r, 400)
    rows = [(i, " ".join(changed(r, base, 0.018))) for i in range(60)]
    monkeypatch.setattr(N, "BLOCK_UNITS", 4000)
    assert classes_of(spark, rows) == truth(rows)


def test_copies_without_words(spark):
    rows = [(1, "!!! ***"), (2, "!!! ***"), (3, "***"), (4, "!!! ***"), (5, ""), (6, ""), (7, "one two")]
    assert classes_of(spark, rows) == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6, 7: 7}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in N.drop_near_duplicates(df).collect()) == [1, 3, 5, 6, 7]
