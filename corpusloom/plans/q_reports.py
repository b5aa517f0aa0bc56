"""Reports: funnel, calibration, strata, histograms, percentiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import reports
from corpusloom.plans.base import over, query, table
from corpusloom.plans.q_decisions import CHECKS_SQL, decided


@query(f"""WITH {CHECKS_SQL} SELECT 'candidates' AS section, 'total' AS item, count(*) AS n FROM p
UNION ALL SELECT 'decision', decision, count(*) FROM p GROUP BY decision UNION ALL SELECT 'reason', r, count(*) FROM (SELECT unnest(reasons) AS r FROM p) GROUP BY r""")
def funnel_report(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.funnel(decided(spark, sf_dir))


@query(f"WITH {CHECKS_SQL} SELECT count(*) AS n_total, count(*) FILTER (WHERE decision = 'ACCEPT') AS n_accept, count(*) FILTER (WHERE decision = 'ACCEPT') / count(*) AS accept_coverage FROM p")
def accept_coverage(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.accept_coverage(decided(spark, sf_dir))


GOLD = """SELECT l.doc_id, d.source, d.lang, l.quality = 1 AS is_clean, l.toxic = 1 AS toxic, d.n_chars % 3 = 0 AS said, CASE WHEN l.doc_id % 4 = 0 THEN 'heldout' ELSE 'calibration' END AS split,
  CASE d.n_chars % 4 WHEN 0 THEN 'ACCEPT' WHEN 1 THEN 'REJECT' WHEN 2 THEN 'REVIEW' ELSE 'REJECT_TECH' END AS decision FROM {labels} l JOIN {documents} d ON d.doc_id = l.doc_id"""


def gold(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, GOLD)


@query("WITH g AS (" + GOLD + """), c AS (SELECT lang, count(*) FILTER (WHERE toxic AND said) AS tp, count(*) FILTER (WHERE NOT toxic AND said) AS fp, count(*) FILTER (WHERE toxic AND NOT said) AS fn, count(*) FILTER (WHERE NOT toxic AND NOT said) AS tn FROM g GROUP BY lang),
r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fn) END AS recall FROM c)
SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r""")
def confusion_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.confusion(gold(spark, sf_dir), F.col("toxic"), F.col("said"), ["lang"])


@query("WITH g AS (" + GOLD + """) SELECT count(*) FILTER (WHERE NOT is_clean AND decision = 'ACCEPT')::DOUBLE / count(*) FILTER (WHERE NOT is_clean) AS false_accept_rate,
  count(*) FILTER (WHERE is_clean AND decision IN ('REJECT', 'REJECT_TECH'))::DOUBLE / count(*) FILTER (WHERE is_clean) AS false_reject_rate FROM g""")
def far_frr(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.error_rates(gold(spark, sf_dir), ~F.col("is_clean"))


@query("WITH g AS (" + GOLD + ") SELECT count(*) AS n_total, count(*) FILTER (WHERE decision = 'ACCEPT')::DOUBLE / count(*) AS accept_fraction, count(*) FILTER (WHERE decision = 'REVIEW')::DOUBLE / count(*) AS review_fraction FROM g")
def decision_coverage(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.coverage(gold(spark, sf_dir))


@query("WITH g AS (" + GOLD + """) SELECT 'split' AS section, split AS item, count(*) AS n FROM g GROUP BY split UNION ALL SELECT 'domain', source, count(*) FROM g GROUP BY source
UNION ALL SELECT 'label', l, count(*) FROM (SELECT unnest(CASE WHEN toxic THEN ['TOXIC', lang] ELSE [lang] END) AS l FROM g) GROUP BY l UNION ALL SELECT 'quality', CASE WHEN is_clean THEN 'clean' ELSE 'noisy' END, count(*) FROM g GROUP BY is_clean""")
def stratify_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    g = gold(spark, sf_dir).withColumns({"domain": F.col("source"), "labels": F.when(F.col("toxic"), F.array(F.lit("TOXIC"), "lang")).otherwise(F.array("lang"))})
    return reports.strata(g)


@query("WITH g AS (" + GOLD + """) SELECT 'source' AS kind, source AS shared FROM g GROUP BY source HAVING bool_or(split = 'calibration') AND bool_or(split <> 'calibration')
UNION ALL SELECT 'speaker', lang FROM g GROUP BY lang HAVING bool_or(split = 'calibration') AND bool_or(split <> 'calibration')
UNION ALL SELECT 'family', CAST(doc_id AS VARCHAR) FROM g GROUP BY doc_id HAVING bool_or(split = 'calibration') AND bool_or(split <> 'calibration')""")
def goldset_separation(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.shared_keys(gold(spark, sf_dir), {"source": "source", "speaker": "lang", "family": "doc_id"})


@query("""SELECT l_returnflag AS codec, l_linestatus AS container, CAST(floor(l_quantity) AS BIGINT) // 10 AS rate_class, count(*) AS n, count(*) FILTER (WHERE l_quantity < 24) AS n_low FROM {lineitem} GROUP BY ALL""")
def format_histogram(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("codec"), F.col("l_linestatus").alias("container"), F.expr("CAST(l_quantity AS BIGINT) DIV 10").alias("rate_class")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") < 24).alias("n_low"))


@query("""WITH c AS (SELECT source, lang, count(*) AS k FROM {documents} GROUP BY source, lang), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k DESC, lang) AS i FROM c)
SELECT source, CAST(sum(k) AS BIGINT) AS n, count(*) AS n_values, count(*) = 1 AS homogeneous, max(lang) FILTER (WHERE i = 1) AS mode FROM r GROUP BY source""")
def format_homogeneity(spark, sf_dir):  # noqa: ANN001, ANN201
    return reports.homogeneity(table(spark, sf_dir, "documents"), "source", "lang")


@query("SELECT source, round(quantile_cont(n_chars::DOUBLE, 0.1), 4) AS p10, round(quantile_cont(n_chars::DOUBLE, 0.15), 4) AS p15, round(quantile_cont(n_chars::DOUBLE, 0.2), 4) AS p20, round(quantile_cont(n_chars::DOUBLE, 0.95), 4) AS p95 FROM {documents} GROUP BY source")
def percentile_floor(spark, sf_dir):  # noqa: ANN001, ANN201
    p = reports.percentiles(table(spark, sf_dir, "documents"), "source", "n_chars", (0.1, 0.15, 0.2, 0.95))
    return p.select("source", *(F.round(c, 4).alias(c) for c in p.columns[1:]))


SPLIT_SQL = "CAST(CAST('0x' || substr(sha256('20260924:' || {g}), 1, 16) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0"


def split_case(group: str) -> str:
    at = SPLIT_SQL.replace("{g}", group)
    return f"CASE WHEN {at} < 0.8 THEN 'train' WHEN {at} < 0.8 + 0.1 THEN 'validation' ELSE 'test' END"


@query(f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents), s AS (SELECT *, {split_case("source")} AS split FROM f WHERE r = 1)
SELECT split, count(*) AS n_rows, count(DISTINCT source) AS n_speakers, array_to_string(list_sort(list_distinct(list(lang))), ',') AS languages, CAST(sum(n_chars) AS BIGINT) AS total_duration FROM s GROUP BY split""")
def split_stats(spark, sf_dir):  # noqa: ANN001, ANN201
    """The flagship: distinct documents, split by the hash of their source, and what each split holds."""
    from corpusloom.operators import dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.sha2("text", 256).alias("sha"))
    # of each text the first, by an aggregate that combines before its shuffle; the text itself stays behind
    first = docs.groupBy("sha").agg(F.min_by(F.struct("source", "lang", "n_chars"), "doc_id").alias("r")).select("r.*")
    return reports.split_statistics(first.withColumn("split", dedup.split_of("source")), "n_chars", "source", "lang")


@query("""WITH r AS (SELECT source, doc_id, n_chars, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY source) AS c, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS s, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS l
  FROM {documents} WINDOW w AS (PARTITION BY source ORDER BY doc_id)),
k AS (SELECT DISTINCT r.source, floor(g.k * r.c / 6.0)::BIGINT AS i FROM r CROSS JOIN (SELECT unnest(range(6)) AS k) g WHERE r.i = 0)
SELECT source, doc_id, n_chars FROM r WHERE c <= 6 OR s = 1 OR l = 1 OR EXISTS (SELECT 1 FROM k WHERE k.source = r.source AND k.i = r.i)""")
def stratified_sample(spark, sf_dir):  # noqa: ANN001, ANN201
    """A sampling operator: eight documents of each source at most."""
    return reports.stratified_sample(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), "doc_id", "n_chars", 8, "source")


@query("SELECT o_orderstatus AS status, CAST(o_custkey % 4 AS BIGINT) AS stage, count(*) AS n, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS total_bytes FROM {orders} GROUP BY ALL")
def byte_sums(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 4).alias("stage")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("CAST(floor(o_totalprice) AS BIGINT)")).alias("total_bytes"))
