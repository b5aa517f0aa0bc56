"""Queries see their whole tables and whole texts."""

import pytest

from corpusloom.operators import state
from corpusloom.plans import base, catalog
from tests.test_oracle import SF, pytestmark  # noqa: F401


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def test_error_rate_of_whole_texts(spark):
    got = catalog.queries()["char_error_rate_whole"](spark, SF)
    assert got.count() == base.table(spark, SF, "conversations").count()
    some = got.orderBy("conv_id", "turn").limit(25).collect()
    assert max(len(r["reference"]) for r in some) > 60
    for r in some:
        a, b = r["reference"], r["hypothesis"]
        assert r["cer"] == pytest.approx(edits(a, b) / len(a) if a else float(bool(b)))


def test_parents_done_sees_the_whole_inventory(spark, monkeypatch):
    seen, run = [], state.parents_done
    monkeypatch.setattr(state, "parents_done", lambda inv, rows: (seen.append(inv.count()), run(inv, rows))[1])
    catalog.queries()["parents_done"](spark, SF)
    assert seen == [base.table(spark, SF, "documents").count()]


def test_merge_expanded_of_the_whole_inventory(spark):
    want = []
    for (i,) in base.table(spark, SF, "documents").select("doc_id").collect():
        want += [f"p{i}#row-0"] if i % 4 == 0 else [f"p{i}", f"p{i}#row-1"]
    assert [r["path"] for r in catalog.queries()["merge_expanded"](spark, SF).collect()] == sorted(want)
