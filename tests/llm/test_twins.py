"""The queries with SQL twins give what DuckDB gives on the small tables."""

import duckdb
import pytest

from corpusloom.llm import queries
from tests.test_oracle import SF, base, pytestmark, rows  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twin(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in base.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE_SQL[name])
    want = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(want)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want, cur.fetchall())
