import hashlib
import heapq
import io
import random

import pytest

from corpusloom.llm import _common as C
from corpusloom.llm import warc as W


def rows():
    r = random.Random(1)
    big = ["<p>" + "x" * r.randint(1000, 5000) + "</p>" for _ in range(8)]
    out = [(i, r.choice(["http://www.a.com/x?b=1", "https://b.org:80/", "http://a.com/y#f", "weird url\r\n", None, f"http://h{i % 7}.net/p/{i}"]), r.choice([*big, *big, "small", "é" * 499 + "x", "é" * 500, None, ""])) for i in range(150)]
    return out + [(149, out[149][1], out[149][2]), (200, "http://a.com/", "z" * 300_000), (None, "http://n.com/", "no id")]


def test_round_trip(spark):
    df = spark.createDataFrame(rows(), "page_id bigint, url string, html string").withColumn("archive", W.F.lit("clash")).repartition(5)
    got = W.capture_history(df).collect()
    assert len(got) == len(rows())
    last = {}
    for i, _, h in rows():
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            last[p] = max(i, last.get(p, -1))
    want = sorted((str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "revisit" if i is not None and last.get((h or "").encode(), i) != i else "response", str(last[(h or "").encode()]) if i is not None and last.get((h or "").encode(), i) != i else "None") for i, _, h in rows())
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == want
    order = [(r["urlkey"], r["ts"]) for r in sorted(got, key=lambda r: r["capture_no"])]
    assert order == sorted(order) and sorted(r["capture_no"] for r in got) == list(range(1, len(got) + 1))


def test_without_broadcast(spark, monkeypatch):
    df = spark.createDataFrame(rows() + [(900 + i, "u", "y" * 2000) for i in range(60)], "page_id bigint, url string, html string")
    have = lambda: sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in W.capture_history(df).collect())
    a = have()
    monkeypatch.setattr(W, "BROADCAST_ROWS", -1)
    assert have() == a
    monkeypatch.setattr(W, "HOT", 10)
    assert have() == a


def test_index_over_many_ranges_archives_and_passes(spark, monkeypatch):
    pages = [(i, f"http://h{i * 7919 % 50}.net/{i % 3}", "p" * (i % 50)) for i in range(400)]
    pages += [(k, "http://same.net/", "q") for k in (9, 10, 100, None, 9)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("t", W.F.lit("2024-05-06 07:08:09")).repartition(6)
    monkeypatch.setattr(W, "BLOCK", 7)
    want = sorted((W.url_key(u), "2024-05-06T07:08:09Z", W.NO_ID if i is None else i) for i, u, _ in pages)
    for fan_in in (256, 4, 2):
        folder = C.new_path(spark, "archives")
        runs = W.write_archives(df, folder, time_col="t")
        index = W.merged_index(runs, folder, range_entries=40, fan_in=fan_in).orderBy("range_no", "position").collect()
        assert [(r["urlkey"], r["ts"], r["id"]) for r in index] == want and len({r["range_no"] for r in index}) > 5


def test_ids_that_are_no_numbers(spark):
    got = W.capture_history(spark.createDataFrame([("x", "u", "p" * 2000), ("7", "u", "p" * 2000), (None, "u", None)], "page_id string, url string, html string")).collect()
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in got) == [("7", "response", "None"), ("None", "response", "None"), ("None", "revisit", "7")]


def test_loser_tree_equals_heap_merge():
    r = random.Random(2)
    for k in (0, 1, 2, 3, 7, 40):
        runs = [sorted((r.randrange(20), i) for i in range(r.randint(0, 30))) for _ in range(k)]
        assert list(W.LoserTree(iter(x) for x in runs)) == list(heapq.merge(*runs))


def test_archive_reader():
    import zlib

    def member(b):
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        return z.compress(b) + z.flush()

    parts = [W.record(str(i), "u", "2024-01-01T00:00:00Z", bytes([65 + i]) * (i * 700_000), hashlib.sha1(bytes([65 + i]) * (i * 700_000)).hexdigest(), None) for i in range(4)]
    data = b"".join(map(member, parts))
    got = list(W.read_archive(io.BytesIO(data)))
    assert [b for _, b in got] == parts and got[1][0] == len(member(parts[0]))
    assert [W.parse_record(b)["bytes"] for _, b in got] == [0, 700_000, 1_400_000, 2_100_000]
    with pytest.raises(ValueError):
        list(W.read_archive(io.BytesIO(data[:-20])))
    with pytest.raises(ValueError):
        W.parse_record(parts[1].replace(b"BBBB", b"BBBC", 1))


def test_empty_and_keys(spark):
    assert W.capture_history(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
    assert W.url_key("HTTP://www.Example.com:80/A?q=1#f") == "com,example)/a?q=1" and W.url_key("") == ")/"
