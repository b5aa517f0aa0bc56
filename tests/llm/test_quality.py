import math
import random
import re
import unicodedata
from collections import Counter

from corpusloom.llm import quality as Q

SYL = "th er on an re he in ed nd ha at en es of or".split()


def prose(r, n):
    return " ".join(r.choice(["the", "of", "and", "in"]) if r.random() < 0.2 else "".join(r.choice(SYL) for _ in range(r.randint(1, 4))) + ("." if r.random() < 0.1 else "") for _ in range(n))


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if win[tuple(w[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def texts():
    r = random.Random(1)
    out = [prose(r, r.randint(1, 400)) for _ in range(250)]
    out += ["".join(f"{w}{r.choice(['***', '$$$', '&&&'])} " for w in prose(r, 80).split()) for _ in range(12)]
    out += [" ".join(f"{w.upper()}!!" for w in prose(r, 80).split()) for _ in range(12)]
    out += [" | ".join("".join(r.choice(SYL) for _ in range(4)) for _ in range(80)) for _ in range(12)]
    line = prose(r, 12)
    out += ["\n".join([line] * 9 + [prose(r, 12)]) for _ in range(12)]
    out += [None, "", "  \n\t ", "a b c d e a b c d e", "a " * 30, "x\x85y\xa0z \x0b\x0c\r\n q\x00 é\U0001f600", "l\nl\n\nl\n \n ", "word " * 40_000, prose(r, 20_000)]
    return out


def test_base_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("quality", Q.F.lit("clash")).withColumn("n_words", Q.F.lit("clash"))
    got = {r["doc_id"]: r for r in Q.quality_report(df).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        b, g = brute(t), got[i]
        assert tuple(g[c] for c in Q.BASE) == b, (i, t and t[:60])
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        assert g["base_failed"] == failed and not (failed and g["kept"]) and 0 <= g["quality"] <= 1


def test_keeps_good_drops_bad(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, kept string")
    got = {r["doc_id"] for r in Q.keep_good(df).collect()}
    assert got == {r["doc_id"] for r in Q.quality_report(df.drop("kept")).collect() if r["kept"]}
    good = [i for i, t in rows[:250] if len(t.split()) >= 30]
    assert sum(i in got for i in good) >= 0.98 * len(good) and not any(250 <= i < 298 and i in got for i, _ in rows)
    assert Q.keep_good(df).columns == df.columns


def test_clashing_names(spark):
    names = ("__t", "__w", "__l", "__row", "__text", "__v_bangs", "__m_n_words", "quality", "kept", "a.b")
    df = spark.createDataFrame(list(enumerate(texts()))[200:], "doc_id bigint, text string").withColumns({c: Q.F.lit(f"own {c}") for c in names})
    out = Q.keep_good(df)
    assert out.columns == df.columns and {tuple(r[c] for c in names) for r in out.collect()} == {tuple(f"own {c}" for c in names)}
    report = Q.quality_report(df)
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in report.collect() if r["kept"]}
    assert {r["a.b"] for r in Q.quality_report(df.withColumn("a.b", Q.F.col("doc_id") + 1), "a.b").collect()} == {r["doc_id"] + 1 for r in report.collect()}


def brute_em(votes, iterations):
    """The same model, vote by vote."""
    n, k = len(votes), len(votes[0])
    prior, says = 0.8, [(0.98, 0.7)] * k
    for _ in range(iterations):
        p = []
        for v in votes:
            z = math.log(prior / (1 - prior))
            for x, (g, b) in zip(v, says):
                z += 0 if x is None else math.log(g / b) if x else math.log((1 - g) / (1 - b))
            p.append(1 / (1 + math.exp(-z)))
        prior = (sum(p) + 1) / (n + 2)
        says = [tuple((sum(w(q) for v, q in zip(votes, p) if v[j] == 1) + 1) / (sum(w(q) for v, q in zip(votes, p) if v[j] is not None) + 2) for w in (lambda q: q, lambda q: 1 - q)) for j in range(k)]
    return prior, says


def brute_votes(text):
    """The votes of the rules, from what plain Python counts."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols, dup, repeats = brute(t)
    upper = sum(unicodedata.category(c) == "Lu" and ord(c) < 0x590 for c in t)
    common, stops = sum(x.lower() in Q.COMMON for x in w), sum(x[-1] in ".!?:" for x in w)
    vote = lambda good, bad: 0 if bad else 1 if good else None
    of = lambda a, b: a / max(b, 1)
    sym, du, rep, up, com, dis, per, ban, sto = of(symbols, n), of(dup, len(lines)), of(repeats, n), of(upper, chars), of(common, n), of(len(set(w)), n), of(chars, n), of(t.count("!"), n), of(n, stops)
    return (
        vote(sym < 0.02, sym > 0.1), vote(du < 0.1 and len(lines) > 2, du > 0.34), vote(rep < 0.05 and n > 50, rep > 0.2), vote(0 < up < 0.1, up > 0.3), vote(com > 0.08, com < 0.03 and n > 30),
        vote(dis > 0.4 and n > 30, dis < 0.25 and n < 2000), vote(3.5 < per < 7, per < 2 or per > 9), vote(ban < 0.02, ban > 0.1), vote(sto < 40, sto > 100 and n > 100),
    )


def brute_kept(texts):
    """Which texts are kept: votes, expectation-maximisation and posterior without Spark."""
    votes = [brute_votes(t) for t in texts]
    prior, says = brute_em(votes, Q.ITERATIONS)
    out = []
    for t, v in zip(texts, votes):
        n, *_, repeats = brute(t)
        z = math.log(prior / (1 - prior)) + sum(0 if x is None else math.log(g / b) if x else math.log((1 - g) / (1 - b)) for x, (g, b) in zip(v, says))
        out.append(n >= 10 and 100 * repeats <= 20 * n and 1 / (1 + math.exp(-z)) >= 0.5)
    return out


def test_verdicts_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r["kept"] for r in Q.quality_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i] for i, _ in rows] == brute_kept([t for _, t in rows])


def test_em_equals_brute_force(spark):
    r = random.Random(3)
    votes = [tuple(r.choice([None, int(r.random() < (0.95 if good else 0.4))]) for _ in range(4)) for good in (r.random() < 0.8 for _ in range(300))]
    df = spark.createDataFrame(votes, ", ".join(f"__v_{j} int" for j in range(4)))
    prior, says = Q.estimate(df, 6)
    want, ws = brute_em(votes, 6)
    assert abs(prior - want) < 1e-9 and all(abs(a - b) < 1e-9 for j in range(4) for a, b in zip(says[f"__v_{j}"], ws[j]))


def test_native_and_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert Q.quality_report(none).count() == 0 and Q.keep_good(none).count() == 0
    plan = Q.votes(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
