"""Clips are made, measured and rendered a few at a time, and once."""

import hashlib

import numpy as np
import pytest

from corpusloom.operators import signal
from corpusloom.plans import base, catalog, q_signal
from tests.test_oracle import SF, pytestmark  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wav_render_holds_few_clips(spark):
    """Arrow batches of 10,000 clips were gigabytes in a worker."""
    df = catalog.queries()["wav_render"](spark, SF)
    assert "ArrowEvalPython" not in plan(df) and plan(df).count("BatchEvalPython") == 1
    sizes = {r["doc_id"]: r["n_chars"] for r in base.table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r for r in df.collect()}
    assert got.keys() == sizes.keys()
    for i in sorted(got)[:10]:
        wav = q_signal.made(i, sizes[i])  # of one channel: its rendering has the same samples but for the scale
        x = signal.read_wav(wav)[0]
        assert got[i]["sha256"] == hashlib.sha256(signal.write_wav(signal.to_pcm16(x)[0], q_signal.RATE)).hexdigest() and got[i]["n_samples"] == len(x) and got[i]["status"] == "PASS"


def test_wav_render_states_holds_few_clips(spark):
    df = catalog.queries()["wav_render_states"](spark, SF)
    assert "ArrowEvalPython" not in plan(df) and plan(df).count("BatchEvalPython") == 1


def test_wav_segments_measures_once(spark):
    """Its filters and its generator had each clip measured a second time, before rows were dealt to tasks."""
    got = plan(catalog.queries()["wav_segments"](spark, SF))
    assert got.count("EvalPython") == got.count("BatchEvalPython") == 1 and got.index("BatchEvalPython") < got.index("RoundRobinPartitioning")


def test_segment_plan_measures_once(spark):
    got = plan(catalog.queries()["segment_plan"](spark, SF))
    assert got.count("EvalPython") == got.count("BatchEvalPython") == 1 and got.index("BatchEvalPython") < got.index("RoundRobinPartitioning")


def test_spectra_of_shared_frames(monkeypatch):
    """A frame that the clip and its first window share is transformed once, and few are held together."""
    blocks, rfft = [], np.fft.rfft
    monkeypatch.setattr(np.fft, "rfft", lambda x, **k: (blocks.append(x.shape), rfft(x, **k))[1])
    signal.measure_one(q_signal.made(2, 1))  # a second of noise
    n, frames = 16000, {s: sum(a for a, b in blocks if b == s) for s in (1024, 4096)}
    assert frames == {s: 1 + (n - s) // (s // 2) for s in (1024, 4096)}
    signal.measure_one(signal.write_wav(np.arange(60 * n) % 99, n))
    assert max(a * b for a, b in blocks) <= signal.TOGETHER


@pytest.mark.parametrize("n", [256, 1023, 1024, 1025, 5000, 40001])
@pytest.mark.parametrize("head", [0, 300, 1024, 4000])
def test_density_frame_by_frame(n, head):
    x, size, head = np.random.default_rng(n).standard_normal(n) + 3, min(1024, n), min(head, n)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)

    def plain(x):
        parts = [x[k : k + size] for k in range(0, len(x) - size + 1, size - size // 2)]
        p = np.mean([np.abs(np.fft.rfft((a - a.mean()) * window)) ** 2 for a in parts], 0) / (8000 * (window**2).sum())
        p[1 : None if size % 2 else -1] *= 2
        return p

    _, p, begun = signal.psd(x, 8000, 1024, head)
    assert np.allclose(p, plain(x), rtol=1e-9) and np.allclose(begun, plain(x[:head]) if size <= head else 0, rtol=1e-9)


def test_wav_fingerprints_without_spectra(spark, monkeypatch):
    """The query's keys are those of the measured fingerprints, and nothing else is measured for them."""
    sizes = base.table(spark, SF, "documents").select("doc_id", "n_chars").limit(40)
    whole = {r["doc_id"]: r["fp"] for r in signal.measure(sizes, ("doc_id", "n_chars"), load=q_signal.made).select("doc_id", "measured.fingerprint").toDF("doc_id", "fp").collect()}
    assert {r["doc_id"]: r["fp"] for r in signal.fingerprints(sizes, ("doc_id", "n_chars"), "fp", load=q_signal.made).collect()} == whole
    monkeypatch.setattr(signal, "measure", None)
    assert catalog.queries()["wav_fingerprints"](spark, SF).columns == ["doc_id", "n_bins", "keys"]
    junk = spark.createDataFrame([(1, bytearray(b"junk")), (2, None)], "id int, content binary")
    assert [tuple(r) for r in signal.fingerprints(junk).orderBy("id").collect()] == [(1, None), (2, None)]


def test_copies_are_measured_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(signal, "REMEMBERED", 2)
    run = signal.once(lambda c: (calls.append(c), len(c or b""))[1])
    assert [run(c) for c in (b"a", b"bb", b"a", b"ccc", b"a", b"bb", None, None)] == [1, 2, 1, 3, 1, 2, 0, 0]
    assert calls == [b"a", b"bb", b"ccc", b"bb", None, None]  # the one that came last of all is forgotten first
    long = bytes(signal.SHORT + 1)
    assert run(long) == run(long) and calls[-2:] == [long, long]
    seen = spark.sparkContext.accumulator(0)
    sizes = base.table(spark, SF, "documents").select("doc_id", "n_chars").coalesce(1)

    def load(i, n):
        seen.add(1)
        return q_signal.made(i, n)

    got = {r["doc_id"]: r["measured"] for r in signal.measure(sizes, ("doc_id", "n_chars"), load=load).collect()}
    assert seen.value == len(got) == sizes.count()
    for i, n in sizes.limit(60).collect():
        want = signal.measure_one(q_signal.made(i, n))
        assert got[i]["rms"] == want["rms"] and [e.asDict() for e in got[i]["noise_events"]] == want["noise_events"]
