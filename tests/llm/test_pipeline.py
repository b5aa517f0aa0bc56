"""run() against brute-force versions of its stages, none of which calls the code under test."""

import random
import re
from collections import Counter

import corpus_pipeline
from tokenizers import Tokenizer

from tests.llm import test_line_dedup
from tests.llm.test_quality import brute_kept, prose


def brute_classes(rows):
    """The least id of each class: components of all pairs whose five-word shingles are 0.8 alike."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[a-z0-9]+", t.lower())
        sets.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    label = {i: i for i, _ in rows}
    for a in range(len(rows)):
        for b in range(a):
            common = (sets[a] & sets[b]).total()
            if common and common / (sets[a].total() + sets[b].total() - common) >= 0.8:
                x, y = sorted((label[rows[a][0]], label[rows[b][0]]))
                label = {i: x if c == y else c for i, c in label.items()}
    return label


def plain(t):
    return " ".join(re.findall(r"[a-z0-9]+", t.lower()))


def test_pipeline_equals_brute_force(spark, tmp_path):
    r = random.Random(7)
    bench = [(i, prose(r, 40)) for i in range(5)]
    texts = [prose(r, r.randint(30, 250)) for _ in range(80)]
    texts += [t for t in texts[:6]] + [" ".join(w if r.random() > 0.01 else "zzzz" for w in t.split()) for t in texts[6:16]]
    texts += [f"{prose(r, 60)} {bench[i % 5][1]} {prose(r, 60)}" for i in range(8)]
    texts += [f"{prose(r, 40)}\nAll rights of this site are reserved.\n{prose(r, 40)}" for _ in range(40)]
    texts += [" ".join(f"{w.upper()}!!" for w in prose(r, 60).split()) for _ in range(6)] + ["", "short text", None]
    docs = [(i, t, "en", "s1" if i % 3 else "s2", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()

    good = brute_kept(texts)
    rows = [(i, s, t) for (i, t, _, s, _), k in zip(docs, good) if k]
    rows = [(i, t) for i, t, *_ in test_line_dedup.brute(rows, corpus_pipeline.line_dedup.RATIO, corpus_pipeline.line_dedup.MIN_PAGES)]
    assert not any("All rights" in t for _, t in rows)
    classes = brute_classes(rows)
    left = {i: t for i, t in rows if classes[i] == i and not any(plain(item) in plain(t) for _, item in bench)}
    assert {x["doc_id"] for x in got} == set(left) and 0 < len(left) < len(set(classes.values())) < len(rows) < len(docs)
    tokenizer = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    places = {}
    for i, t in left.items():
        mine = sorted((x["piece"], x["start"], x["length"]) for x in got if x["doc_id"] == i)
        assert sum(n for *_, n in mine) == len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        assert [a for _, a, _ in mine] == [sum(n for *_, n in mine[:k]) for k in range(len(mine))]
    for x in got:
        places.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for parts in places.values():
        assert [a for a, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024


def test_stages_keep_the_columns(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, f"file://{tmp_path}")
        assert out.columns == none.columns and out.count() == 0
    assert corpus_pipeline.packed(spark, none, str(tmp_path)).count() == 0
