"""Scalar functions over text: tags, licences, references, paths, transcripts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Licence names that a hub accepts as they are. Fixed values.
HUB_LICENSES = ("mit", "apache-2.0", "cc0-1.0", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0", "cc-by-nc-nd-4.0", "odc-by", "gpl-3.0", "lgpl-3.0", "artistic-2.0", "other")
SECRET_PATTERN = r"hf_[A-Za-z0-9]{20,}|AKIA[0-9A-Z]{16}|-----BEGIN|token\s*[:=]"


def language_code(tag: Column) -> Column:
    """vi-VN and vi_VN give vi; a blank tag gives null, never a default."""
    code = F.lower(F.trim(F.get(F.split(F.replace(F.trim(tag), F.lit("_"), F.lit("-")), "-"), F.lit(0))))
    return F.when(code != "", code)


def hub_license(name: Column) -> Column:
    """The licence id if a hub knows it, else other."""
    low = F.coalesce(F.lower(F.trim(name)), F.lit(""))
    return F.when(low.isin(*HUB_LICENSES), low).otherwise("other")


def has_secret(text: Column) -> Column:
    return F.coalesce(text.rlike(SECRET_PATTERN), F.lit(False))


def source_scope(uri: Column, revision: Column) -> Column:
    """The scope of speaker names: the part of a hub URI before its path with the revision, a file's directory, else the URI."""
    revision = F.coalesce(revision, F.lit(""))
    head = F.regexp_extract(uri, r"^hf://datasets/([^/]*)", 1)
    hub = F.when(F.contains(head, F.lit("@")), F.concat(F.lit("hf://datasets/"), head)).otherwise(F.concat(F.lit("hf://datasets/"), head, F.lit("@"), revision))
    folder = F.regexp_extract(uri, r"^file://(.*)/[^/]*$", 1)
    blank = F.coalesce(uri == "", F.lit(True))
    return F.when(blank, F.concat(F.lit("rev:"), revision)).when(uri.startswith("hf://datasets/"), hub).when(uri.startswith("file://"), F.concat(F.lit("file://"), F.when((folder == "") & uri.rlike(r"^file:///[^/]*$"), F.lit("/")).otherwise(folder))).otherwise(uri)


def repo_reference(ref: Column) -> dict[str, Column]:
    """(repo_id, revision) of a bare id, id@revision or dataset URL of the hub; both null for what is none of them."""
    raw = F.trim(ref)
    url = raw.contains("://")
    seg = r"^https?://[^/?#]*huggingface\.co(?::[0-9]+)?/+datasets/+([^/?#]+)/+([^/?#]+)"
    from_url = F.concat(F.regexp_extract(raw, seg, 1), F.lit("/"), F.regexp_extract(raw, seg, 2))
    tree = F.regexp_extract(raw, seg + r"/+(?:tree|blob|resolve)/+([^/?#]+)", 3)
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.split_part(raw, F.lit("@"), F.lit(1))), r"^/+|/+$", ""), r"^datasets/", "")
    parts = F.regexp_extract(bare, r"^\s*([^/]*[^/\s])\s*/\s*([^/]*[^/\s])\s*$", 1), F.regexp_extract(bare, r"^\s*([^/]*[^/\s])\s*/\s*([^/]*[^/\s])\s*$", 2)
    from_bare = F.concat(parts[0], F.lit("/"), parts[1])
    rid = F.when(url, from_url).otherwise(from_bare)
    ok = (rid != "/") & ~rid.contains("..")
    at = F.trim(F.regexp_extract(raw, r"^[^@]*@(.*)$", 1))
    return {"repo_id": F.when(ok, rid), "revision": F.when(ok & url & (tree != ""), tree).when(ok & ~url & (at != ""), at)}


def is_full_sha(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).rlike(r"^[0-9a-f]{40}$"), F.lit(False))


def slug(repo_id: Column) -> Column:
    return F.replace(repo_id, F.lit("/"), F.lit("--"))


def safe_name(c: Column, most: int = 120) -> Column:
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), 1, most)


def job_id(repo_id: Column, sha: Column) -> Column:
    return F.concat(slug(repo_id), F.lit("-"), F.substring(sha, 1, 12))


def sharded_path(clip_id: Column) -> Column:
    """audio/<shard>/<id>.wav: last two digits of a sequential id, first two hex digits of a legacy one, null for neither."""
    digits = F.regexp_extract(clip_id, r"^[A-Za-z]+_([0-9]{7,})$", 1)
    legacy = F.regexp_extract(clip_id, r"^[a-z]+_([0-9a-f]{32})$", 1)
    shard = F.when(legacy != "", F.substring(legacy, 1, 2)).when(digits != "", F.right(digits, F.lit(2)))
    return F.concat(F.lit("audio/"), shard, F.lit("/"), clip_id, F.lit(".wav"))


def release_names(campaign: Column, job: Column, batch: Column, staging: str = "staging") -> dict[str, Column]:
    """Names of a batch's release; null if a component is empty, begins with a dot or holds a slash."""
    parts = (campaign, job, batch)
    unsafe = F.lit(False)
    for c in parts:
        unsafe = unsafe | F.coalesce((c == "") | c.startswith(".") | c.contains("/"), F.lit(True))
    rid = F.when(~unsafe, F.concat_ws("--", *parts))
    return {"release_id": rid, "staging_revision": F.concat(F.lit(f"{staging}/"), rid), "path_prefix": F.concat(F.lit("releases/"), rid)}


def chunk_name(job: Column, batch: Column, chunk: Column) -> Column:
    """The name of one chunk's release."""
    return F.concat_ws("__", job, batch, F.concat(F.lit("c"), F.lpad(chunk.cast("string"), 5, "0")))


@F.pandas_udf(T.StringType())
def nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Canonical composition; Spark has no built-in for it."""
    for s in batches:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def normalize_transcript(c: Column, compose: bool = True) -> Column:
    """Composed, lower case, without what is neither word nor space, white space as one space."""
    c = nfc(c) if compose else c
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def fixed(x: Column, digits: int) -> Column:
    """A finite number of 0 or more with so many decimals: of its exact value, halves to the even digit.

    Its product with the power of ten may be rounded onto a half; the rest that the product lost, which
    double numbers can hold, then tells on which side the exact value lies.
    """
    x, ten = x.cast("double"), float(10**digits)
    p = x * ten
    c = x * 134217729.0  # splits x into halves whose products with the power are exact
    hi = c - (c - x)
    lost = (hi * ten - p) + (x - hi) * ten
    low = F.floor(p).cast("double")
    n = F.when((p - low == 0.5) & (lost > 0), low + 1).when((p - low == 0.5) & (lost < 0), low).otherwise(F.rint(p))
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", n / ten))


def char_error_rate(reference: Column, hypothesis: Column, compose: bool = True) -> Column:
    """Edits per character of the reference, both normalised; an empty reference gives 0 for an empty hypothesis, else 1."""
    reference, hypothesis = normalize_transcript(reference, compose), normalize_transcript(hypothesis, compose)
    n = F.length(reference)
    return F.when(n == 0, F.when(F.length(hypothesis) == 0, 0.0).otherwise(1.0)).otherwise(F.levenshtein(reference, hypothesis) / n)


def transcript_status(transcript: Column, verified: Column, hypothesis: Column, rate: Column, most: float = 0.35) -> Column:
    blank = F.coalesce(F.trim(transcript) == "", F.lit(True))
    return F.when(blank, "NOT_APPLICABLE").when(F.coalesce(verified, F.lit(False)), "OK").when(hypothesis.isNull(), "UNKNOWN").when(rate > most, "ERROR").otherwise("UNKNOWN")


def container(content: Column) -> Column:
    """File kind by its first bytes; wav if unknown."""
    h = F.upper(F.hex(F.substring(content, 1, 12)))
    return (
        F.when(h.startswith("52494646"), ".wav").when(h.startswith("664C6143"), ".flac").when(h.startswith("4F676753"), ".ogg").when(h.startswith("494433"), ".mp3")
        .when(h.rlike("^FF[EF]"), ".mp3").when((F.substring(h, 9, 8) == "66747970") & (F.length(content) >= 12), ".m4a").otherwise(".wav")
    )


def glob_regex(pattern: str) -> str:
    """A shell pattern as a regular expression of whole texts; * crosses slashes, and in brackets only !, - and the closing one mean anything."""
    out, i = "", 0
    while i < len(pattern):
        c, j = pattern[i], pattern.find("]", i + (3 if pattern[i + 1 : i + 2] == "!" else 2)) if pattern[i] == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif j > 0:
            no = pattern[i + 1] == "!"
            out += ("[^" if no else "[") + re.sub(r"([\\\[\]^&~|])", r"\\\1", pattern[i + 1 + no : j]) + "]"
            i = j
        else:
            out += "\\" + c if not c.isalnum() and c != "_" else c
        i += 1
    return f"^(?s:{out})\\z"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def matches_globs(path: Column, allow: list[str], ignore: list[str]) -> Column:
    """A path or its base name matches an allowed pattern (none: all do) and no ignored one."""
    base = base_name(path)

    def any_of(patterns: list[str]) -> Column:
        out = F.lit(False)
        for p in patterns:
            r = glob_regex(p)
            out = out | path.rlike(r) | base.rlike(r)
        return out

    return (any_of(allow) if allow else F.lit(True)) & ~any_of(ignore)
