"""Duplicates, splits and identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.operators import dedup
from corpusloom.plans.base import over, query, table
from corpusloom.plans.q_reports import SPLIT_SQL, split_case

PLANES = dedup.hyperplanes(64)
THRESHOLD = 0.4


def hashed(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.sha2("text", 256).alias("sha"))


@query("SELECT sha256(text) AS sha, count(*) AS n, array_to_string(list_sort(list(doc_id)), ',') AS members FROM {documents} GROUP BY sha256(text) HAVING count(*) > 1")
def exact_duplicate_groups(spark, sf_dir):  # noqa: ANN001, ANN201
    return dedup.exact_groups(hashed(spark, sf_dir), "doc_id", "sha").withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query("""WITH f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first FROM {documents}) SELECT doc_id, CASE WHEN first < doc_id THEN first END AS duplicate_of FROM f""")
def ingest_first_wins(spark, sf_dir):  # noqa: ANN001, ANN201
    return dedup.first_wins(hashed(spark, sf_dir), "doc_id", "sha").select("doc_id", "duplicate_of")


@query("""WITH d AS (SELECT doc_id, sha256(text) AS sha FROM {documents}), o AS (SELECT DISTINCT sha FROM d WHERE doc_id % 3 = 0) SELECT min(doc_id) AS doc_id FROM d WHERE doc_id % 3 <> 0 AND sha NOT IN (SELECT sha FROM o) GROUP BY sha""")
def ingest_new_rows(spark, sf_dir):  # noqa: ANN001, ANN201
    """Documents of a second delivery whose text no document of the first has."""
    d = hashed(spark, sf_dir)
    return dedup.new_rows(d.filter("doc_id % 3 <> 0"), d.filter("doc_id % 3 = 0"), "sha", "doc_id").select("doc_id")


@query(f"SELECT doc_id, {SPLIT_SQL.replace('{g}', 'source')} AS at, {split_case('source')} AS split FROM documents")
def hash_split(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", ids.hash_fraction(dedup.SPLIT_SEED, "source").alias("at"), dedup.split_of("source").alias("split"))


@query(f"""SELECT source, count(DISTINCT split) AS n_splits, array_to_string(list_sort(list_distinct(list(split))), ',') AS splits FROM (SELECT source, {split_case('CAST(doc_id AS VARCHAR)')} AS split FROM documents) GROUP BY source HAVING count(DISTINCT split) > 1""")
def split_leakage(spark, sf_dir):  # noqa: ANN001, ANN201
    """What leaks if items are split by themselves and not by their source."""
    d = table(spark, sf_dir, "documents").select("source", dedup.split_of("doc_id").alias("split"))
    return dedup.leaking_groups(d, "source")


@query("""SELECT doc_id, CASE WHEN lang <> '' AND doc_id % 2 = 0 THEN lang WHEN doc_id % 3 <> 0 THEN source ELSE CAST(doc_id AS VARCHAR) END AS group_key FROM {documents}""")
def group_keys(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    speaker, source = F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(""), F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return d.select("doc_id", dedup.group_key(speaker, source, F.col("doc_id")).alias("group_key"))


def _planes_sql() -> str:
    """The planes as VALUES (t, p, list): literals of the operator's own fixed size."""
    return ", ".join(f"({t}, {p}, {[float(x) for x in PLANES[t][:, p]]}::DOUBLE[])" for t in range(PLANES.shape[0]) for p in range(PLANES.shape[2]))


_ALL = "embeddings"
#: Of equal vectors the one of the least id.
_REPS = "(SELECT min(vec_id) AS vec_id, embedding FROM embeddings GROUP BY embedding)"


def _lsh_sql(vectors: str) -> str:
    return f"""
planes(t, p, v) AS (VALUES {_planes_sql()}),
k AS (SELECT e.vec_id, t, CAST(sum(CASE WHEN list_dot_product(CAST(e.embedding AS DOUBLE[]), v) >= 0 THEN pow(2, p) ELSE 0 END) AS BIGINT) AS key FROM {vectors} e CROSS JOIN planes GROUP BY e.vec_id, t),
c AS (SELECT DISTINCT x.vec_id AS a, y.vec_id AS b FROM k x JOIN k y ON x.t = y.t AND x.key = y.key AND x.vec_id < y.vec_id)"""


def _similar_sql(vectors: str) -> str:
    return f"""{_lsh_sql(vectors)}, s AS (SELECT a, b FROM c JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b WHERE list_dot_product(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) >= {THRESHOLD})"""


@query(f"WITH {_lsh_sql(_ALL)} SELECT vec_id, array_to_string(list(key ORDER BY t), ',') AS keys FROM k GROUP BY vec_id")
def lsh_keys(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.array_join(dedup.sign_keys(F.col("embedding"), PLANES).cast("array<string>"), ",").alias("keys"))


@query(f"WITH {_lsh_sql(_REPS)} SELECT a, b FROM c")
def lsh_candidates(spark, sf_dir):  # noqa: ANN001, ANN201
    return dedup.candidate_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", PLANES)


@query(f"WITH {_similar_sql(_REPS)} SELECT a, b FROM s")
def similar_pairs(spark, sf_dir):  # noqa: ANN001, ANN201
    return dedup.similar_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", PLANES, THRESHOLD).select("a", "b")


@query(f"""WITH RECURSIVE {_similar_sql(_ALL)}, e AS (SELECT a, b FROM s UNION SELECT b, a FROM s), r(node, reach) AS (SELECT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
l AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT component, count(*) AS n, array_to_string(list_sort(list(node)), ',') AS members FROM l GROUP BY component""")
def near_duplicate_groups(spark, sf_dir):  # noqa: ANN001, ANN201
    g = dedup.near_groups(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", PLANES, THRESHOLD)
    return g.withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query("""SELECT doc_id, 'SRC_' || substr(sha256(sha256(text) || chr(31) || 'rev1'), 1, 16) AS source_id, 'anon_' || substr(sha256(sha256(text)), 1, 10) AS anonymous_speaker, 'RIGHTS_' || substr(sha256(source), 1, 10) AS rights_id,
  'AUD_' || lang || '_' || substr(sha256(sha256(text)), 1, 12) AS audio_id, replace(source, '/', '--') || '-' || substr(sha256(source), 1, 12) AS job_id FROM {documents}""")
def hash_identities(spark, sf_dir):  # noqa: ANN001, ANN201
    from corpusloom.functions import text

    d = table(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256))
    return d.select("doc_id", ids.short_id("sha", F.lit("rev1"), prefix="SRC_").alias("source_id"), ids.short_id("sha", length=10, prefix="anon_").alias("anonymous_speaker"), ids.short_id("source", length=10, prefix="RIGHTS_").alias("rights_id"), F.concat(F.lit("AUD_"), "lang", F.lit("_"), ids.short_id("sha", length=12)).alias("audio_id"), text.job_id(F.col("source"), F.sha2("source", 256)).alias("job_id"))


@query("""SELECT doc_id, sha256('{"lang":"' || lang || '","n":' || n_chars || ',"none":null,"source":"' || source || '"}') AS digest FROM {documents}""")
def canonical_json(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", ids.canonical_json_hash(source=F.col("source"), n=F.col("n_chars"), lang=F.col("lang"), none=F.lit(None).cast("string")).alias("digest"))


@query("SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY lang, doc_id) AS number FROM {documents}")
def dense_numbers(spark, sf_dir):  # noqa: ANN001, ANN201
    return dedup.numbered(over(spark, sf_dir, "SELECT doc_id, lang, n_chars FROM {documents}"), ["lang", "doc_id"])
