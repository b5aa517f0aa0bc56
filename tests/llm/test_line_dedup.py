import random
import re
from collections import defaultdict

from corpusloom.llm import line_dedup as L


def brute(rows, ratio, least):
    pages, seen = defaultdict(int), defaultdict(int)
    clean = lambda x: re.sub(r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+\Z", "", x)
    for _, host, text in rows:
        pages[host] += 1
        for x in {clean(x) for x in (text or "").split("\n")} - {""}:
            seen[host, x] += 1
    bad = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for i, host, text in rows:
        lines = [] if text is None else text.split("\n")
        keep = [x for x in lines if (host, clean(x)) not in bad]
        out.append((i, None if text is None else "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def rows():
    r, out = random.Random(1), []
    for i in range(400):
        host = r.choice(["a", "a", "a", "b", "c", None])
        lines = [f"line {r.randrange(10**6)}" for _ in range(r.randint(0, 6))]
        if r.random() < 0.3:
            lines.insert(0, f"  license of {host}\t")
        if host == "a" and r.random() < 0.1:
            lines += ["menu", "menu"]
        if r.random() < 0.2:
            lines += ["", "  "]
        out.append((i, host, "\n".join(lines)))
    return out + [(900, "z", "only\npage"), (901, "a", None), (902, "b", ""), (903, "a", "menu"), (904, "c", "long line " * 30_000), (0, *out[0][1:])]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(rows(), "doc_id bigint, source string, text string").withColumn("pages", L.F.lit("clash")).repartition(4)
    for ratio, least in ((0.08, 5), (0.25, 3), (0.0, 1)):
        got = L.dedup_lines(df, ratio=ratio, min_pages=least, counts=True)
        assert got.columns == [*df.columns, "n_lines", "n_dropped"]
        have = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=str)
        want = sorted(((i, t, max(n, 0), d) for i, t, n, d in brute(rows(), ratio, least)), key=str)
        assert have == want


def test_both_joins_agree(spark, monkeypatch):
    df = spark.createDataFrame(rows(), "doc_id bigint, source string, text string")
    a = sorted(map(str, L.dedup_lines(df, counts=True).collect()))
    for name, value in (("SLOT_LINES", 1), ("BROADCAST_LINES", 0), ("SALT_PAGES", 20), ("HOT_LINES", 1)):
        monkeypatch.setattr(L, name, value)
        assert sorted(map(str, L.dedup_lines(df, counts=True).collect())) == a
    for most in (1, 0):
        monkeypatch.setattr(L.C, "HOT_KEYS", most)
        assert sorted(map(str, L.dedup_lines(df, counts=True).collect())) == a


def test_clashing_names(spark):
    names = ("n_lines", "n_dropped", "host", "row", "slots", "kept", "salt", "no", "key", "a.b")
    df = spark.createDataFrame(rows(), "doc_id bigint, source string, text string").withColumns({c: L.F.lit(f"own {c}") for c in names})
    out = L.dedup_lines(df)
    assert out.columns == df.columns and {tuple(r[c] for c in names) for r in out.collect()} == {tuple(f"own {c}" for c in names)}
    more = L.dedup_lines(df, counts=True)
    assert more.columns == [*(c for c in df.columns if c not in ("n_lines", "n_dropped")), "n_lines", "n_dropped"]
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in more.collect()), key=str) == sorted(brute(rows(), L.RATIO, L.MIN_PAGES), key=str)


def test_empty_and_native(spark):
    none = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert L.dedup_lines(none).count() == 0
    plan = L.dedup_lines(spark.createDataFrame(rows(), none.schema))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
