"""Secret scan with corpus-wide ownership frequency.

Every text gives candidates: assignments of a secret's name, access key ids, long hex strings, and
other long mixed strings of high entropy. Only a hash of each candidate leaves the text. Over the
whole corpus a hash is counted by distinct owners and distinct repositories: a string that several
owners hold is a copied example (a manual's sample key, a test vector), one that a single owner
holds and that looks random is a live-looking credential. Base kinds are always reported; strings
of the extra kind are reported only if they are owner-specific.

Defined results: a null text is an empty text, a null owner or repository is ''. A text is scanned whole,
in time and memory that grow with its length. Matches that begin at the same place are in the order
of KINDS. Repeated rows give repeated results. An empty table gives no rows. Columns of the input
other than those named are not read, so clashing names do not matter.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

KINDS = ("assign", "access", "hex", "string")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
STRING = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: A random-looking string: so many digits and letters, and bits of entropy per character, at least.
MIN_DIGITS, MIN_LETTERS, MIN_ENTROPY = 3, 3, 3.2
#: Rows of one hash that may meet in a task.
HOT = 500


def entropy(value: str) -> float:
    """Shannon entropy in bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    return sum(c.isdigit() for c in value) >= MIN_DIGITS and sum(c.isalpha() for c in value) >= MIN_LETTERS and entropy(value) >= MIN_ENTROPY


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, secret) of the base kinds in order of start, then kind.

    For each kind the matches are leftmost and do not overlap. A run of hex digits (or of what may
    follow AKIA) below the least length can't become longer, so the least length stands in the
    pattern; an assignment is matched first and then dropped if its value is short.
    """
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def extra_matches(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking strings that overlap no base match."""
    out, k, upto = [], 0, 0
    for m in STRING.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            upto, k = max(upto, base[k][2]), k + 1
        if upto <= m.start() and looks_random(m[0]):  # none that begins before its end goes beyond its start
            out.append((m.start(), 3, m.end(), m[0]))
    return out


def spans_text(matches: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in matches)


CANDIDATE = T.StructType([T.StructField(n, t) for n, t in (("start", T.LongType()), ("kind", T.IntegerType()), ("end", T.LongType()), ("hash", T.StringType()), ("random", T.BooleanType()))])
_ARROW = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("hash", pa.string()), ("random", pa.bool_())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n_rows = uuid.uuid4().hex, 0
    for b in batches:
        rows = []
        for text in b["__text"].to_pylist():
            base = base_matches(text)
            found = sorted(base + extra_matches(text, base))
            n = Counter(k for _, k, _, _ in base)
            said = spans_text(base)
            n_rows += 1
            cands = [{"start": s, "kind": k, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32], "random": looks_random(v)} for s, k, e, v in found]
            rows.append((n[0], n[1], n[2], hashlib.sha256(said.encode()).hexdigest(), f"{task}:{n_rows}", cands))
        cols = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(_ARROW))
        yield pa.RecordBatch.from_arrays([b["__id"], b["__owner"], b["__repo"], *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["__id", "__owner", "__repo", "n_assign", "n_access", "n_hex", "base_sha256", "row_key", "cands"])


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | str = "source", repo: Column | str = "source") -> DataFrame:
    """One row per input row: counts and digest of the base kinds and all candidates, without the text.

    row_key names the row, other rows with equal contents have others; it stays only if the result is written.
    """
    C.prepare(df.sparkSession)
    text = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).alias("__id"), text(owner).alias("__owner"), text(repo).alias("__repo"), text(text_col).alias("__text"))
    fields = [*src.schema.fields[:3], *(T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")), T.StructField("base_sha256", T.StringType()), T.StructField("row_key", T.StringType()), T.StructField("cands", T.ArrayType(CANDIDATE))]
    return src.mapInArrow(_scan, T.StructType(fields))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n) of all candidates; n counts them.

    Three aggregations, each combined before its shuffle, so a hash that a third of all rows hold
    sends a row per task, not a row per holder.
    """
    held = found.select("__owner", "__repo", F.explode("cands.hash").alias("hash")).groupBy("hash", "__owner", "__repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = held.groupBy("hash", "__owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n"))


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | str = "source", repo: Column | str = "source", max_owners: int = 1, max_repos: int = 3) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, live_spans.

    spans holds all base matches and the extra strings held by max_owners owners and max_repos
    repositories at most; live_spans those of any kind that are so rare and look random; n_copied
    counts the candidates that more owners or repositories hold.
    """
    found = C.materialise(candidates(df, id_col, text_col, owner, repo), "secrets")
    base = ["__id", "n_assign", "n_access", "n_hex", "base_sha256"]
    some = found.filter(F.size("cands") > 0).select(*base, "row_key", F.explode("cands").alias("c"))
    own = F.col("n_owners") <= max_owners
    own &= F.col("n_repos") <= max_repos
    seen = C.join_counted(some.withColumn("hash", F.col("c.hash")), C.materialise(ownership(found), "owned"), "hash", "n", HOT)
    seen = seen.select(*base, "row_key", F.struct("c.start", "c.kind", "c.end", own.alias("own"), F.col("c.random").alias("random")).alias("c"))
    rows = seen.groupBy("row_key", *base).agg(F.sort_array(F.collect_list("c")).alias("one"))  # the candidates of one row
    names = F.array(*map(F.lit, KINDS))

    def joined(keep) -> Column:  # noqa: ANN001
        return F.array_join(F.transform(F.filter("one", keep), lambda c: F.concat_ws(":", names[c["kind"]], c["start"], c["end"])), ",")

    live = lambda c: c["own"] & c["random"]
    out = rows.select(F.col("__id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256", joined(lambda c: (c["kind"] < 3) | c["own"]).alias("spans"), F.size(F.filter("one", live)).cast("long").alias("n_live"), F.size(F.filter("one", lambda c: ~c["own"])).cast("long").alias("n_copied"), joined(live).alias("live_spans"))
    none = found.filter(F.size("cands") == 0).select(F.col("__id").alias(id_col), *base[1:], F.lit("").alias("spans"), F.lit(0).cast("long").alias("n_live"), F.lit(0).cast("long").alias("n_copied"), F.lit("").alias("live_spans"))
    return out.unionByName(none)
