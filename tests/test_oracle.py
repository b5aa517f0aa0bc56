"""Every query with a SQL twin gives what DuckDB gives, on the small tables."""

import os

import duckdb
import pytest

from corpusloom.plans import base, catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in base.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def text(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9)) if not v.is_integer() else str(int(v))
    return str(v)


def rows(cols, got):
    at = [cols.index(c) for c in sorted(cols)]
    return sorted(tuple(text(r[i]) for i in at) for r in got)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_twin(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    cur = con.execute(catalog.oracle_sql()[name])
    want_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(want_cols)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want_cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_no_python_in_declared_queries(spark):
    """Queries with twins stay in the JVM, but for normalising, which has no built-in, folds over a job's files and products of matrices."""
    for name in ("policy_decision", "split_stats", "exact_duplicate_groups", "interval_union", "rate_class_admission"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan, name


def test_scan_reads_only_what_is_asked(spark):
    plan = catalog.queries()["percentile_floor"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string,n_chars:bigint>" in plan
