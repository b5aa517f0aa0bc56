"""Shell patterns, against SQL and the standard library's."""

import fnmatch

import duckdb
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.plans import catalog

URLS = [f"http://a.net/{k}/{'7' * n}{tail}" for k in ("en", "de") for n in range(8) for tail in ("", "\n", ".html", "?ref=x", "/")]
URLS += ["http://a.com/x", "http://a.com/x\n", "http://a.com/ref=x", "http://a.com/ref=x\n", "http://a.com", "123456", "/123456", "a/12x45", "a/x12345", "a\n/12345", "a/1\n2", "a/٣٤", "ref=x", "", None]


def test_glob_filter_takes_numbers_of_any_length(spark, tmp_path):
    spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [r[0] for r in catalog.queries()["glob_filter"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = [r[0] for r in con.execute(catalog.oracle_sql()["glob_filter"]).fetchall()]
    assert sorted(got) == sorted(want) and URLS.index("/123456") in got


def test_globs_as_the_standard_library(spark):
    texts = ["a", "b", "a\n", "^", "!", "]", "[", "\\", "&", "-", "a/b", "ab", ".", "é", "😀", "", "1", "12"]
    globs = ["[!a]", "[^a]", "[]]", "[!]]", "[!]a]", "[[]", "[a&&b]", "[a-c]", "[\\]", "[a", "?", "*", "a", "*.", "[0-9]", "a?b", "[a-]", "[!"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for g in globs:
        got = {r[0] for r in df.filter(F.col("t").rlike(text.glob_regex(g))).collect()}
        assert got == {t for t in texts if fnmatch.fnmatchcase(t, g)}, g
