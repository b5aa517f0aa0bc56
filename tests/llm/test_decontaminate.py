import random
import time

import numpy as np

from corpusloom.llm import decontaminate as D

SYL = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(r, n):
    return " ".join("".join(r.choice(SYL) for _ in range(r.randint(1, 4))) for _ in range(n))


def distance(a, b):
    """Least edits of a against any stretch of b."""
    prev = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return min(prev)


def edited(r, text, n):
    for _ in range(n):
        k, c = r.randrange(1, len(text) - 1), r.choice("abcxyz")
        text = r.choice([text[:k] + c + text[k:], text[:k] + text[k + 1 :], text[:k] + c + text[k + 1 :]])
    return text


def norm(t):
    return "".join(map(chr, D.normalise(t)[0]))


def test_equals_brute_force():
    r = random.Random(2)
    items = [(i, prose(r, r.randint(8, 30))) for i in range(12)]
    ix = D.Index(items)
    for k in range(60):
        i, t = items[k % 12]
        text = f"{prose(r, 40)} {edited(r, t, r.randint(0, 30))} {prose(r, 40)}"
        want = {j for j, s in items if distance(norm(s), norm(text)) <= D.budget(len(norm(s)))[0]}
        got = {j for j, *_ in ix.find(text)}
        assert got == want, k


def levenshtein(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_places_and_edits_equal_brute_force():
    """A region's edits are the distance of its own text; the best region is the best of all stretches; regions don't overlap."""
    r = random.Random(12)
    for k in range(40):
        item = prose(r, r.randint(8, 20))
        parts = [prose(r, 15)] + [p for _ in range(r.randint(1, 3)) for p in (edited(r, item, r.randint(0, 5)), prose(r, 10))]
        text = " ".join(parts)
        hits = D.Index([(1, item)]).find(text)
        assert hits and all(levenshtein(norm(item), norm(text[a:z])) == d for _, a, z, d, _ in hits), k
        assert min(d for *_, d, _ in hits) == distance(norm(item), norm(text)), k
        spans = sorted((a, z) for _, a, z, *_ in hits)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_long_texts_are_linear():
    r = random.Random(6)
    item = prose(r, 25)
    for text in (" ".join(f"{item} w{k}" for k in range(8_000)), " ".join(f"{item} {prose(r, 12)}" for _ in range(4_000)), "a" * 300_000, "the of and " * 30_000):
        begin = time.process_time()
        D.Index([(1, item), (2, "the of and " * 20), (3, "a" * 200)]).find(text)
        assert time.process_time() - begin < 30


def test_stretches_find_what_the_whole_finds(monkeypatch):
    r = random.Random(13)
    items = [(i, prose(r, r.randint(5, 40))) for i in range(6)] + [(9, "ab " * 30)]
    texts = [" ".join(edited(r, r.choice(items)[1], r.randint(0, 4)) if r.random() < 0.5 else prose(r, 20) for _ in range(30)) for _ in range(20)]
    whole = [sorted(D.Index(items).find(t)) for t in texts]
    assert sum(map(len, whole)) > 100
    for hits in (1, 50, 400):
        monkeypatch.setattr(D, "HITS", hits)
        assert [sorted(D.Index(items).find(t)) for t in texts] == whole


def test_lemma_bound():
    for m in range(8, 400):
        e, least = D.budget(m)
        assert least >= 1 and (least == m + 1 - D.Q * (e + 1) or e == 0)


def test_places_and_case():
    ix = D.Index([(1, "The quick brown fox jumps over the lazy dog again and again today")])
    text = "İé! " + "THE  QUICK brown-fox jumps,\nover the lazy dog AGAIN and again today." + " end"
    (hit,) = ix.find(text)
    assert hit[0] == 1 and hit[3] == 0 and text[hit[1] : hit[2]].startswith("THE") and text[hit[1] : hit[2]].endswith("today")


def test_repeats_short_and_long():
    r = random.Random(4)
    item = prose(r, 25)
    ix = D.Index([(1, item), (2, "abc"), (3, ""), (4, None)])
    assert sum(h[0] == 1 for h in ix.find(f"{item} {prose(r, 30)} {item}")) == 2
    assert [h[0] for h in ix.find("x abc y")] == [2] and ix.find("xabcy") == [] and ix.find("") == []
    long = f"{prose(r, 20_000)} {item} {prose(r, 20_000)}"
    assert {h[0] for h in ix.find(long)} == {1}


def test_frames(spark):
    r = random.Random(5)
    items = [(i, prose(r, 20)) for i in range(6)]
    docs = [(i, f"{prose(r, 30)} {items[i % 6][1] if i % 3 == 0 else ''} {prose(r, 30)}", i) for i in range(30)] + [(90, None, 0), (91, "", 0), (0, items[0][1], 7)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    b = spark.createDataFrame([*items, (7, None)], "item_id bigint, text string")
    whole = {(x["doc_id"], x["item_id"]) for x in D.find_regions(d.drop("item_id"), b).collect()}
    assert whole == {(i, i % 6) for i in range(0, 30, 3)}
    blocks = D.find_regions(d.drop("item_id"), b, max_symbols=150)
    assert {(x["doc_id"], x["item_id"]) for x in blocks.collect()} == whole
    few = D.clean(d, b, max_symbols=150)
    assert sorted(x["doc_id"] for x in few.collect()) == sorted(x["doc_id"] for x in D.clean(d, b).collect())
    same = D.find_regions(d.select("doc_id", "text"), b.withColumnRenamed("item_id", "doc_id"), item_id="doc_id")
    assert same.columns[:2] == ["doc_id", "item_doc_id"] and {(x[0], x[1]) for x in same.collect()} == whole
    kept = D.clean(d, b)
    assert kept.columns == d.columns and sorted(x["doc_id"] for x in kept.collect()) == sorted(i for i, *_ in docs if i % 3 or i > 29)
    assert D.find_regions(d.limit(0), b).count() == 0 and D.find_regions(d, b.limit(0)).count() == 0 and D.clean(d, b.limit(0)).count() == len(docs)


def test_align_prefers_fewest_edits():
    a = D.normalise("alpha beta gamma delta epsilon")[0]
    t = D.normalise("xx alpha beta gamma delta epsilon yy")[0]
    assert D.align(a, t, -40, 40, 3) == [(3, 3 + len(a), 0)]
    assert D.align(a, np.empty(0, np.uint32), -5, 5, 3) == []
