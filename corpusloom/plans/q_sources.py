"""Sources: shards, sidecars, inventories, joins by fallback, closed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import text
from corpusloom.plans.base import over, query, table
from corpusloom.sources import scan


@query("""SELECT doc_id, sha256(text) AS source_sha256, CAST(octet_length(encode(text)) AS BIGINT) AS source_bytes, 'SRC_' || substr(sha256(sha256(text) || chr(31) || 'r1'), 1, 16) AS source_id, CASE WHEN n_chars % 5 = 0 THEN 'QUARANTINE' ELSE 'INGESTED' END AS ingest_status FROM {documents}""")
def source_records(spark, sf_dir):  # noqa: ANN001, ANN201
    """Documents as files of a directory, with metadata and rights: the record builder without its scan."""
    d = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("file:/data/d"), F.col("doc_id").cast("string"), F.lit(".wav"))
    content = F.col("text").cast("binary")
    files = d.select(path.alias("path"), F.length(content).cast("bigint").alias("length"), content.alias("content"))
    none = F.lit(None).cast("string")
    meta = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("key"), none.alias("source_license"), none.alias("source_language"), none.alias("source_transcript"), F.col("source").alias("source_speaker_ref"))
    ids = d.filter("n_chars % 5 = 0").select(F.concat(F.lit("file:///data/d"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("uri_prefix")).withColumns({"rights_status": F.lit("FORBIDDEN"), "redistribution_permitted": F.lit(False)})
    rest = spark.createDataFrame([("file:///data/", "REDISTRIBUTION_APPROVED", True)], "uri_prefix string, rights_status string, redistribution_permitted boolean")
    decl = ids.unionByName(rest).withColumns({"seq": F.lit(1), "source_id": none, "commercial_training_permitted": none, "source_license": none})
    out = scan.source_records(files, meta, decl, "file:/data", "r1")
    return out.select(F.regexp_extract("original_file_id", r"d(\d+)\.wav", 1).cast("bigint").alias("doc_id"), "source_sha256", "source_bytes", "source_id", "ingest_status")


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'by-path' ELSE 'by-name' END AS found FROM {documents}""")
def metadata_fallback_join(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id")
    name = F.concat(F.lit("x"), F.col("doc_id").cast("string"), F.lit(".wav"))
    files = d.withColumn("relpath", F.concat(F.lit("sub/"), name))
    meta = d.filter("doc_id % 7 <> 0 AND doc_id % 3 = 0").select(F.concat(F.lit("sub/"), name).alias("key"), F.lit("by-path").alias("v")).unionByName(d.filter("doc_id % 7 <> 0").select(name.alias("key"), F.lit("by-name").alias("v")))
    return scan.with_metadata(files, meta).select("doc_id", F.col("meta.v").alias("found"))


SIDE = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat('f', CAST(doc_id % 100 AS STRING)) ELSE '' END AS file, CASE WHEN doc_id % 3 = 1 THEN concat('r', CAST(doc_id % 100 AS STRING)) END AS rfilename, CASE WHEN doc_id % 6 = 2 THEN concat('p', CAST(doc_id % 100 AS STRING)) ELSE '' END AS path, n_chars AS v FROM {documents}"


@query("WITH s AS (" + SIDE + "), k AS (SELECT *, coalesce(nullif(file, ''), nullif(rfilename, ''), nullif(path, '')) AS key, FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id DESC) AS n FROM k WHERE key IS NOT NULL) SELECT key, v FROM r WHERE n = 1")
def sidecar_last_wins(spark, sf_dir):  # noqa: ANN001, ANN201
    return scan.sidecar(over(spark, sf_dir, SIDE), "doc_id").select("key", "v")


@query("""WITH r AS (SELECT source AS shard, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM {documents} WHERE doc_id % 10 <> 3)
SELECT shard, CAST(i AS INT) AS row, CASE WHEN doc_id % 4 = 0 THEN 'clip_' || lpad(CAST(i AS VARCHAR), 6, '0') || '.wav' ELSE 'a_b_' || doc_id || '.flac' END AS name, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM r""")
def shard_clips(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    blob = F.when(F.col("doc_id") % 10 == 3, F.lit("")).otherwise(F.col("text")).cast("binary")
    path = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("a b_"), F.col("doc_id").cast("string"), F.lit(".flac")))
    rows = d.select(F.struct(blob.alias("bytes"), path.alias("path")).alias("audio"), F.col("lang").alias("transcription"), F.col("source").alias("__path"), F.col("doc_id").alias("__row"))
    return scan.shard_clips(rows, "audio", "transcription").select("shard", F.col("row").cast("int").alias("row"), "name", "sha256", "size")


#: First bytes of files, and the kinds that they tell of; '.wav' stands for what is unknown. Fixed values.
HEADS = (("524946460000000057415645", ".wav"), ("664C614300", ".flac"), ("4F67675300", ".ogg"), ("49443300", ".mp3"), ("FFFB90", ".mp3"), ("FFE3", ".mp3"), ("FF10", ".wav"), ("0000001866747970", ".wav"), ("00000018667479704D344120", ".m4a"), ("", ".wav"))


@query(f"SELECT doc_id, {[ext for _, ext in HEADS]}[doc_id % 10 + 1] AS ext FROM documents")
def container_sniff(spark, sf_dir):  # noqa: ANN001, ANN201
    """Documents behind the first bytes of a file of some kind; of one kind the bytes end too soon."""
    head = F.get(F.lit([h for h, _ in HEADS]), (F.col("doc_id") % 10).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", text.container(F.concat(F.unhex(head), F.when(F.col("doc_id") % 10 == 7, F.lit("")).otherwise(F.col("text")).cast("binary"))).alias("ext"))


LISTING = "SELECT concat('d/', source, '/', CAST(doc_id AS STRING)) AS path, n_chars AS size, CASE WHEN doc_id % 5 = 0 THEN 'xyz' WHEN doc_id % 5 = 1 THEN NULL ELSE upper({h}) END AS sha, doc_id % 17 = 0 AS is_folder FROM documents"


@query("WITH l AS (" + LISTING.replace("{h}", "sha256(text)") + ") SELECT path, size, CASE WHEN regexp_matches(lower(sha), '^[0-9a-f]{64}$') THEN lower(sha) END AS expected_sha256, row_number() OVER (ORDER BY path) - 1 AS index FROM l WHERE NOT is_folder".replace("{64}", "{{64}}").replace("{{64}}", "{64}"))
def inventory(spark, sf_dir):  # noqa: ANN001, ANN201
    d = over(spark, sf_dir, LISTING.replace("{h}", "sha2(text, 256)").replace("FROM documents", "FROM {documents}"))
    return scan.inventory(d)


@query("SELECT doc_id FROM {documents} WHERE doc_id % 9 = 0 OR lang IN ('en', 'fr')")
def split_filter(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("lang")).alias("source_split"))
    return scan.split_filter(d, ["en", "fr"]).select("doc_id")


@query("""SELECT page_id FROM {pages} WHERE (regexp_matches(url, '\\.com/') OR regexp_matches(url, '/[0-9]+$')) AND NOT regexp_matches(url, '/de/') AND NOT regexp_matches(url, '(^|/)[^/]*ref=x$')""")
def glob_filter(spark, sf_dir):  # noqa: ANN001, ANN201
    """A number of any length is a base name that is not empty and holds nothing but digits."""
    p, url, ignore = table(spark, sf_dir, "pages"), F.col("url"), ["*/de/*", "*ref=x"]
    number = text.matches_globs(url, ["*/*"], ignore) & text.matches_globs(text.base_name(url), ["?*"], ["*[!0-9]*"])
    return p.filter(text.matches_globs(url, ["*.com/*"], ignore) | number).select("page_id")


KEYED = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN '{"k": 1, "v": "x"}' ELSE '{"v": "x", "w": 1, "a": null}' END AS value FROM {events}"""


@query("WITH e AS (" + KEYED + "), k AS (SELECT event_id, list_sort(json_keys(value)) AS k FROM e) SELECT event_id, CASE WHEN k <> ['k', 'v'] THEN 'KEYS:missing=' || array_to_string(list_sort(list_filter(['k', 'v'], lambda x: NOT list_contains(k, x))), ',') || ';extra=' || array_to_string(list_sort(list_filter(k, lambda x: NOT list_contains(['k', 'v'], x))), ',') END AS error FROM k")
def closed_rows(spark, sf_dir):  # noqa: ANN001, ANN201
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    rows = schemas.closed_rows(over(spark, sf_dir, KEYED), schema, keep=["event_id"])
    return rows.select("event_id", "error")


@query("""SELECT unnest(CASE WHEN doc_id % 4 = 0 THEN ['p' || doc_id || '#row-0'] ELSE ['p' || doc_id, 'p' || doc_id || '#row-1'] END) AS path FROM {documents}""")
def merge_expanded(spark, sf_dir):  # noqa: ANN001, ANN201
    """The inventory of all documents; shards with id % 4 = 0 were expanded before: their new clips are not taken."""
    d = table(spark, sf_dir, "documents")
    p = F.concat(F.lit("p"), F.col("doc_id").cast("string"))
    inv = d.select(F.when(F.col("doc_id") % 4 == 0, F.concat(p, F.lit("#row-0"))).otherwise(p).alias("path"))
    return scan.merge_expanded(inv, d.select(F.concat(p, F.lit("#row-1")).alias("path")))


@query("""WITH c AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS s FROM {documents}) SELECT doc_id, CASE WHEN s <> '' THEN 's:' || s END AS by_column, 'fixed' AS by_rule FROM c""")
def speaker_rule(spark, sf_dir):  # noqa: ANN001, ANN201
    c = over(spark, sf_dir, "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS s FROM {documents}")
    return c.select("doc_id", scan.speaker_rule(None, "s").alias("by_column"), scan.speaker_rule("fixed", "s").alias("by_rule"))
