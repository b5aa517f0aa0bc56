"""Interval algebra over events as timed intervals, in integer microseconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import intervals
from corpusloom.plans.base import over, query, table

HOUR = 3_600_000_000
#: unix_micros and epoch_us are the engines' names for the same number.
_SPAN = "SELECT user_id AS key, event_id, event_type, {us} AS start, {us} + CAST(CAST(floor(value) AS BIGINT) % 97 * 600000000 + 60000000 AS BIGINT) AS `end` FROM {{events}}"
SPANS = _SPAN.format(us="unix_micros(CAST(ts AS TIMESTAMP))")
SPANS_SQL = _SPAN.format(us="epoch_us(ts)").replace("`", '"').replace("{events}", "events")


def merged_sql(source: str, name: str, gap: int = 0) -> str:
    """CTEs that give the merged intervals of a relation (key, start, end) under a name."""
    return f"""{name}_m AS (SELECT key, start, "end", max("end") OVER (PARTITION BY key ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_g AS (SELECT *, sum(CASE WHEN start - reach <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY key ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS g FROM {name}_m),
{name} AS (SELECT key, min(start) AS start, max("end") AS "end" FROM {name}_g GROUP BY key, g)"""


def spans(spark, sf_dir):  # noqa: ANN001, ANN201
    return over(spark, sf_dir, SPANS)


def of_type(spark, sf_dir, kinds: tuple[str, ...]):  # noqa: ANN001, ANN201
    return spans(spark, sf_dir).filter(F.col("event_type").isin(*kinds)).select("key", "start", "end")


A_SQL = f"a AS (SELECT key, start, \"end\" FROM ({SPANS_SQL}) x WHERE event_type IN ('view', 'click'))"
B_SQL = f"b AS (SELECT key, start, \"end\" FROM ({SPANS_SQL}) x WHERE event_type NOT IN ('view', 'click'))"


def a_and_b(spark, sf_dir):  # noqa: ANN001, ANN201
    s = spans(spark, sf_dir)
    kinds = F.col("event_type").isin("view", "click")
    return s.filter(kinds).select("key", "start", "end"), s.filter(~kinds).select("key", "start", "end")


@query(f"WITH e AS ({SPANS_SQL}), {merged_sql('e', 'u')} SELECT * FROM u")
def interval_union(spark, sf_dir):  # noqa: ANN001, ANN201
    return intervals.merge(spans(spark, sf_dir))


@query(f"WITH e AS ({SPANS_SQL}), {merged_sql('e', 'u', HOUR)} SELECT * FROM u")
def merge_gaps(spark, sf_dir):  # noqa: ANN001, ANN201
    return intervals.merge(spans(spark, sf_dir), gap=HOUR)


@query(f"WITH e AS ({SPANS_SQL}), {merged_sql('e', 'u')} SELECT key, CAST(sum(\"end\" - start) AS BIGINT) AS covered, count(*) AS n_islands FROM u GROUP BY key")
def total_covered(spark, sf_dir):  # noqa: ANN001, ANN201
    return intervals.covered(spans(spark, sf_dir))


_MOST = 1_706_000_000_000_000


@query(f"WITH e AS (SELECT key, greatest(0, start - {HOUR // 4}) AS start, least({_MOST}, \"end\" + {HOUR // 4}) AS \"end\" FROM ({SPANS_SQL}) x), {merged_sql('e', 'u')} SELECT * FROM u")
def interval_dilate(spark, sf_dir):  # noqa: ANN001, ANN201
    return intervals.dilate(spans(spark, sf_dir), HOUR // 4, _MOST)


@query(f"WITH {A_SQL}, {B_SQL}, {merged_sql('a', 'ua')}, {merged_sql('b', 'ub')} SELECT ua.key, greatest(ua.start, ub.start) AS start, least(ua.\"end\", ub.\"end\") AS \"end\" FROM ua JOIN ub ON ua.key = ub.key AND ua.start < ub.\"end\" AND ub.start < ua.\"end\"")
def interval_intersect(spark, sf_dir):  # noqa: ANN001, ANN201
    return intervals.intersect(*a_and_b(spark, sf_dir), width=12 * HOUR)


@query(f"""WITH {A_SQL}, {B_SQL}, {merged_sql('a', 'ua')}, {merged_sql('b', 'ub')},
gaps AS (SELECT key, "end" AS start, lead(start) OVER (PARTITION BY key ORDER BY start) AS "end" FROM ub UNION ALL SELECT key, 0, min(start) FROM ub GROUP BY key UNION ALL SELECT key, 0, NULL FROM (SELECT DISTINCT key FROM ua) k WHERE key NOT IN (SELECT key FROM ub)),
f AS (SELECT key, start, coalesce("end", 9000000000000000000) AS "end" FROM gaps)
SELECT ua.key, greatest(ua.start, f.start) AS start, least(ua."end", f."end") AS "end" FROM ua JOIN f ON ua.key = f.key AND ua.start < f."end" AND f.start < ua."end" """)
def interval_subtract(spark, sf_dir):  # noqa: ANN001, ANN201
    return intervals.subtract(*a_and_b(spark, sf_dir))


@query("""WITH d AS (SELECT doc_id AS key, n_chars AS d FROM {documents}), w AS (SELECT key, d, unnest(range(CASE WHEN d <= 1500 THEN 1 ELSE CAST(ceil((d - 1500) / 750.0) AS BIGINT) + 1 END)) AS n FROM d)
SELECT key, CAST(n AS INT) AS n, CAST(n * 750 AS BIGINT) AS start, CAST(least(n * 750 + 1500, d) AS BIGINT) AS "end" FROM w""")
def plan_windows(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "n_chars")
    return intervals.windows(d, "n_chars", 1500, 750).select("key", F.col("n").cast("int").alias("n"), F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


@query("""WITH n AS (SELECT user_id AS key, value >= 50 AS active, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM {events}), g AS (SELECT key, i, i - row_number() OVER (PARTITION BY key ORDER BY i) AS g FROM n WHERE active)
SELECT key, CAST(min(i) AS INT) AS first, count(*) AS length FROM g GROUP BY key, g HAVING count(*) >= 2""")
def active_runs(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "events").withColumn("o", F.struct("ts", "event_id")).withColumnRenamed("user_id", "key")
    return intervals.active_runs(e, "o", F.col("value") >= 50, least=2)


@query("""WITH n AS (SELECT user_id AS key, value >= 50 AS active, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM {events}), g AS (SELECT key, i, i - row_number() OVER (PARTITION BY key ORDER BY i) AS g FROM n WHERE active), r AS (SELECT key, count(*) AS k FROM g GROUP BY key, g)
SELECT key, max(k) AS longest, count(*) AS n_runs FROM r GROUP BY key""")
def longest_run(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "events").withColumn("o", F.struct("ts", "event_id")).withColumnRenamed("user_id", "key")
    return intervals.active_runs(e, "o", F.col("value") >= 50).groupBy("key").agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n_runs"))


@query(f"WITH {A_SQL}, {B_SQL} SELECT DISTINCT a.key, a.start, a.\"end\" FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.key = a.key AND a.start < b.\"end\" AND b.start < a.\"end\")")
def overlap_semijoin(spark, sf_dir):  # noqa: ANN001, ANN201
    a, b = a_and_b(spark, sf_dir)
    return intervals.overlap_join(a, b, 12 * HOUR).select("key", F.col("a_start").alias("start"), F.col("a_end").alias("end")).distinct()


SEGMENTS_SQL = f"SELECT user_id AS key, unnest([1704067200000000, 1704672000000000, 1705276800000000]) AS start FROM (SELECT DISTINCT user_id FROM events) u"


@query(f"""WITH e AS (SELECT DISTINCT key, start, "end" FROM ({SPANS_SQL}) x), s AS (SELECT key, start, start + {48 * HOUR} AS "end" FROM ({SEGMENTS_SQL}) y)
SELECT e.key, s.start AS seg_start, s."end" AS seg_end, greatest(e.start, s.start) - s.start AS start, least(e."end", s."end") - s.start AS "end" FROM e JOIN s ON e.key = s.key AND e.start < s."end" AND s.start < e."end" """)
def slice_events(spark, sf_dir):  # noqa: ANN001, ANN201
    e = spans(spark, sf_dir).select("key", "start", "end").distinct()
    starts = F.explode(F.array(*(F.lit(x).cast("bigint") for x in (1704067200000000, 1704672000000000, 1705276800000000))))
    s = e.select("key").distinct().select("key", starts.alias("start")).withColumn("end", F.col("start") + 48 * HOUR)
    return intervals.clip_events(e, s, 12 * HOUR)


@query(f"""WITH p AS (SELECT DISTINCT user_id AS key, epoch_us(ts) AS point FROM events WHERE event_type = 'click'), t AS (SELECT DISTINCT user_id AS key, epoch_us(ts) AS t FROM events WHERE event_type <> 'click'),
r AS (SELECT t.key, t.t, p.point, row_number() OVER (PARTITION BY t.key, t.t ORDER BY abs(p.point - t.t), p.point) AS n FROM t LEFT JOIN p ON p.key = t.key)
SELECT key, t, CASE WHEN abs(point - t) <= {2 * HOUR} THEN point END AS point FROM r WHERE n = 1""")
def nearest_point(spark, sf_dir):  # noqa: ANN001, ANN201
    e = over(spark, sf_dir, "SELECT user_id AS key, event_type, unix_micros(CAST(ts AS TIMESTAMP)) AS us FROM {events}")
    p = e.filter("event_type = 'click'").select("key", F.col("us").alias("point")).distinct()
    t = e.filter("event_type <> 'click'").select("key", F.col("us").alias("t")).distinct()
    return intervals.nearest(p, t, 2 * HOUR)


@query("""WITH n AS (SELECT user_id, event_id, value, lag(value) OVER w AS p, lead(value) OVER w AS x FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), f AS (SELECT user_id, quantile_cont(value, 0.2) AS f FROM {events} GROUP BY user_id)
SELECT n.user_id AS key, event_id, value FROM n JOIN f ON n.user_id = f.user_id WHERE value <= f AND value <= p AND value <= x""")
def local_minima(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "event_id", "value", F.struct("ts", "event_id").alias("o"))
    return intervals.local_minima(e, "o", "value").drop("o")


@query(f"""WITH t AS (SELECT user_id AS key, epoch_us(ts) AS t FROM events), n AS (SELECT key, t, CASE WHEN t - lag(t) OVER (PARTITION BY key ORDER BY t) <= {12 * HOUR} THEN 0 ELSE 1 END AS new FROM t),
g AS (SELECT key, t, sum(new) OVER (PARTITION BY key ORDER BY t RANGE UNBOUNDED PRECEDING) AS session_no FROM n)
SELECT key, CAST(session_no AS BIGINT) AS session_no, min(t) AS start, max(t) AS "end", count(*) AS n FROM g GROUP BY key, session_no""")
def sessions(spark, sf_dir):  # noqa: ANN001, ANN201
    e = over(spark, sf_dir, "SELECT user_id AS key, unix_micros(CAST(ts AS TIMESTAMP)) AS t FROM {events}")
    return intervals.sessions(e, "t", 12 * HOUR)
