import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import secret_scan as S

KEY, HEXES, MIXED = "AKIA" + "ABCDEFGH12345678", "0123456789abcdef" * 2, "xK9vQ2mZ7pL4wR8tB3nY6cD1"
TEXTS = [
    (1, "a", "en", f"password = 'hunter22hunter' and {KEY} {HEXES}"),
    (2, "a", "en", f"api_key: {MIXED}\nTOKEN=short secret:longenough1"),
    (3, "b", "en", f"copied {KEY} and é {MIXED}x1 end"),
    (4, "c", "fr", f"another {MIXED}x1 copy"),
    (5, "c", "fr", None),
    (6, None, None, ""),
    (7, "d", "en", "z" * 50_000 + f" mine {MIXED}y2 " + "deadbeef " * 2000),
    (1, "a", "en", f"password = 'hunter22hunter' and {KEY} {HEXES}"),
]


def brute_base(text):
    """The contract's words, spelt out: all leftmost matches of each kind, failing ones dropped."""
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_base_equals_brute_force(spark):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, source string, lang string, text string").withColumn("spans", F.lit("clash")).withColumn("hash", F.lit(0))
    got = S.secret_scan(df, repo=F.concat_ws("/", "source", "lang")).collect()
    assert len(got) == len(TEXTS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by[1]) == 2
    for i, _, _, t in TEXTS:
        base = brute_base(t or "")
        said = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base)
        for r in by[i]:
            assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, _, n, _ in base) for k in ("assign", "access", "hex")]
            assert [x for x in r["spans"].split(",") if x and not x.startswith("string")] == [x for x in said.split(",") if x]


def test_ownership_separates_copies(spark):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, source string, lang string, text string")
    got = {r["doc_id"]: r for r in S.secret_scan(df, repo=F.concat_ws("/", "source", "lang")).collect()}
    assert "string" not in got[3]["spans"] and got[3]["n_copied"] == 2  # held by b and c, and by a and b
    assert got[4]["spans"] == "" and got[4]["n_copied"] == 1
    assert got[7]["spans"].startswith("string:") and got[7]["n_live"] == 1  # d alone holds it
    assert got[2]["n_live"] >= 1 and got[5]["spans"] == "" and got[6]["n_live"] == 0


def test_random_texts(spark):
    r = random.Random(5)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", '"', "'", " ", ":", "=", "abcdefgh", "AKIA", "A1B2C3D4E5F6", "0af9" * 8, "é", "x" * 9, "\n", "-"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(500)]
    for t in texts:
        assert [(s, k, e) for s, k, e, _ in S.base_matches(t)] == [(s, k, e) for s, k, _, e in brute_base(t)], t


@pytest.mark.parametrize("most", [200_000, 2, 0])
def test_ownership_equals_brute_force(spark, monkeypatch, most):
    """Counts by distinct owners and repositories of all candidates, one of which a third of all rows hold; and repeated rows."""
    monkeypatch.setattr(S, "HOT", 20)
    monkeypatch.setattr(S.C, "HOT_KEYS", most)
    r = random.Random(8)
    values = ["".join(r.choice("abcdefgh0123456789XYZ") for _ in range(24)) for _ in range(30)]
    rows = [(i, r.choice("abc"), r.choice(["en", "fr", None]), " ; ".join([values[0]] * (i % 3 == 0) + r.sample(values, r.randint(0, 3)) + [f"token={r.choice(values)}"] * (i % 4 == 0))) for i in range(400)]
    rows += [rows[0]] * 30
    repo = F.concat_ws("/", "source", "lang")
    got = S.secret_scan(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string"), repo=repo).collect()
    found = []
    for i, owner, lang, text in rows:
        base = S.base_matches(text)
        strings = [(m.start(), 3, m.end(), m[0]) for m in S.STRING.finditer(text) if S.looks_random(m[0]) and not any(a < m.end() and m.start() < z for a, _, z, _ in base)]
        found.append((i, owner, f"{owner}/{lang}" if lang else owner, sorted(base + strings)))
    owners, repos = {}, {}
    for _, owner, at, spans in found:
        for *_, v in spans:
            owners.setdefault(v, set()).add(owner)
            repos.setdefault(v, set()).add((owner, at))
    own = lambda v: len(owners[v]) <= 1 and len(repos[v]) <= 3
    text = lambda spans: ",".join(f"{S.KINDS[k]}:{a}:{z}" for a, k, z, _ in spans)
    want = sorted((i, text([x for x in spans if x[1] < 3 or own(x[3])]), sum(own(x[3]) and S.looks_random(x[3]) for x in spans), sum(not own(x[3]) for x in spans)) for i, _, _, spans in found)
    assert sorted((x["doc_id"], x["spans"], x["n_live"], x["n_copied"]) for x in got) == want


def test_long_texts_are_linear():
    text = " ".join(f"{'0af9' * 8} x{i:07d}{'qwertzuiopASDFG'} password=verylongvalue{i}" for i in range(20_000))
    begin = time.process_time()
    base = S.base_matches(text)
    assert len(base) == 40_000 and len(S.extra_matches(text, base)) > 10_000
    assert time.process_time() - begin < 10


def test_empty(spark):
    assert S.secret_scan(spark.createDataFrame([], "doc_id bigint, source string, text string")).count() == 0
