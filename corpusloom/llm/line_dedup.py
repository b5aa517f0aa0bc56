"""Line dedup by site-relative frequency, in DataFrame operations only.

Pages are grouped by host. For each line the pages of the host that contain it are counted and
divided by all pages of the host; a line above `ratio` is boilerplate of that site and is dropped
from all its pages. A line on fewer than `min_pages` pages is never boilerplate, so hosts of a few
pages lose nothing that they do not clearly repeat.

Lines are compared after trimming, by two independent hashes. Counts are combined before their
shuffle, so a host or a line that a third of all pages share sends one row per task. The boilerplate
of a host has at most (lines per page / ratio) lines, dealt into slots by their hash, so a line of a
page is compared with a few of them. Hosts with their lines are broadcast only if they are counted
and few, and texts are not shuffled then; else pages meet them in a join in which a host has a salt
for each SALT_PAGES of its pages.

Defined results: a null host is a host of its own; a null text stays null and has no lines; lines of
white space alone are kept; a page counts once for a line however often it has it; a share that
equals the ratio is not above it; repeated rows count as pages each; a very long text is split and
joined whole, in memory that grows with it alone; an empty table gives no rows. Columns of any name
are kept as they are; with counts, n_lines and n_dropped replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import _common as C

RATIO, MIN_PAGES = 0.08, 5
#: Lines up to which the table of boilerplate is broadcast: 12 bytes each, and the host.
BROADCAST_LINES = 200_000
#: Pages of a host that meet its lines in one task; counted lines of a host that meet its number of pages in one task.
SALT_PAGES, HOT_LINES = 20_000, 100_000
#: Lines of a host's boilerplate per slot, about.
SLOT_LINES = 4
BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """64 + 32 bits of a trimmed line, as one comparable struct; null for a blank one."""
    clean = (F.ascii(line) > 32) & (F.ascii(F.substring(line, -1, 1)) > 32)  # most lines have nothing to trim
    t = F.when(clean, line).otherwise(F.btrim(line, F.lit(BLANKS)))
    return F.when(t != "", F.struct(F.xxhash64(t).alias("a"), F.hash(t).alias("b")))


def host_key(host: str) -> Column:
    """A host as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`").cast("string")), F.lit(""))


def boilerplate(df: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, key, pages, host_pages) of the lines above the ratio; host is a host_key."""
    src = df.select(host_key(host_col).alias("host"), F.col(f"`{text_col}`").cast("string").alias("text"))
    keys = F.array_distinct(F.transform(F.split("text", "\n", -1), line_key))
    lines = src.select("host", F.explode(keys).alias("key")).filter("key is not null").groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    lines = C.materialise(lines, "lines")
    sizes = lines.groupBy("host").agg(F.count(F.lit(1)).alias("host_lines"))
    hosts = C.materialise(src.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).join(sizes, "host"), "hosts")
    return C.join_counted(lines, hosts, "host", "host_lines", HOT_LINES).drop("host_lines").filter(F.col("pages") > ratio * F.col("host_pages"))


def slots(found: DataFrame) -> DataFrame:
    """(host, slots): each host's lines, line k in slot pmod(k.a, number of slots)."""
    n = found.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / SLOT_LINES).cast("int").alias("n"), F.collect_list("key").alias("keys"))
    slot = lambda k, n: F.pmod(k["a"], n).cast("int")
    dealt = n.select("host", "n", F.explode("keys").alias("k")).groupBy("host", slot(F.col("k"), F.col("n")).alias("slot")).agg(F.collect_list("k").alias("keys"))
    none = n.select("host", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("slot"))
    every = none.join(dealt, ["host", "slot"], "left").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("slot", "keys"))).alias("s"))
    return every.select("host", F.transform("s", lambda x: x["keys"]).alias("slots"))


def dedup_lines(df: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """df with its text without the boilerplate lines of its host (and, if asked for, n_lines and n_dropped)."""
    found = C.materialise(boilerplate(df, host_col, text_col, ratio, min_pages), "boilerplate")
    drops = slots(found)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), host_key(host_col).alias("host"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if found.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES:
        out = rows.join(F.broadcast(drops), "host", "left")
    else:
        hot = C.hottest(found.groupBy("host").agg(F.max("host_pages").alias("n")), "n", SALT_PAGES).select("host", F.ceil(F.col("n") / SALT_PAGES).cast("int").alias("salts"))
        salts = F.coalesce("salts", F.lit(1))
        salted = drops.join(F.broadcast(hot), "host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
        dealt = rows.withColumn("no", F.monotonically_increasing_id()).join(F.broadcast(hot), "host", "left").withColumn("salt", F.pmod(F.xxhash64("no"), salts).cast("int"))
        out = dealt.join(salted, ["host", "salt"], "left")
    lines = F.split("text", "\n", -1)
    dropped = lambda k: F.array_contains(F.get("slots", F.pmod(k["a"], F.size("slots")).cast("int")), k)
    keyed = F.transform(lines, lambda x: F.struct(x.alias("x"), line_key(x).alias("k")))
    keep = F.transform(F.filter(keyed, lambda p: ~F.coalesce(dropped(p["k"]), F.lit(False))), lambda p: p["x"])
    out = out.withColumn("kept", F.when(F.col("slots").isNull(), lines).otherwise(keep))
    cols = {c: F.col("row").getField(c) for c in df.columns}
    cols[text_col] = F.when(F.col("text").isNotNull(), F.array_join("kept", "\n"))
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0))
        cols = {c: x for c, x in cols.items() if c not in ("n_lines", "n_dropped")} | {"n_lines": F.greatest(n, F.lit(0)).cast("long"), "n_dropped": F.greatest(n - F.size("kept"), F.lit(0)).cast("long")}
    return out.select(*(x.alias(c) for c, x in cols.items()))
