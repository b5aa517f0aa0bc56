"""Publishing as queries: approvals, diffs by ledger, exact-set comparison, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.admission import reasons

MUTABLE = ("README.md", "MANIFEST.sha256", "RELEASE_READY.json")


def approval_reasons(a: dict[str, Column], now: Column, revision: Column | None = None) -> Column:
    """All reasons against an approval, in order. An expiry that can't be read is a reason, not an error."""
    expires = F.try_to_timestamp(a["expires_utc"], F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    differs = lambda x, y: ~x.eqNullSafe(y)
    return reasons(
        (differs(a["release_digest"], a["actual_digest"]), "RELEASE_DIGEST_MISMATCH"), (differs(a["repo_id"], a["actual_repo"]), "REPO_ID_MISMATCH"), (differs(a["revision"], revision) if revision is not None else F.lit(False), "REVISION_MISMATCH"), (~F.coalesce(a["license_ack"], F.lit(False)), "LICENSE_NOT_ACKNOWLEDGED"),
        (now > expires, "APPROVAL_EXPIRED"), (expires.isNull(), "APPROVAL_EXPIRY_UNPARSEABLE"), (a["actual_bytes"] > a["max_bytes"], "RELEASE_EXCEEDS_BYTE_QUOTA"), (~F.coalesce(a["ready"], F.lit(False)), "RELEASE_NOT_READY"),
    )


def set_difference(local: DataFrame, remote: DataFrame, path: str = "path", sha: str = "sha256", ignore: tuple[str, ...] = ()) -> DataFrame:
    """(path, error) of an exact comparison: missing, extra and changed files."""
    a = local.select(F.col(path).alias("__a"), F.col(sha).alias("__x"))
    b = remote.filter(~F.col(path).isin(*ignore)) if ignore else remote
    b = b.select(F.col(path).alias("__b"), F.col(sha).alias("__y"))
    met = a.join(b, F.col("__a") == F.col("__b"), "full_outer")
    error = F.when(F.col("__b").isNull(), "REMOTE_MISSING").when(F.col("__a").isNull(), "EXTRA_REMOTE_FILE").when(~F.col("__x").eqNullSafe(F.col("__y")), "REMOTE_SHA_MISMATCH")
    return met.select(F.coalesce("__a", "__b").alias("path"), error.alias("error")).filter("error is not null")


def within_prefix(remote: DataFrame, prefix: str, path: str = "path") -> DataFrame:
    """Files below a prefix, with paths relative to it; siblings are not seen."""
    p = prefix.strip().strip("/") + "/"
    return remote.filter(F.col(path).startswith(p)).withColumn(path, F.substring(F.col(path), F.lit(len(p) + 1), F.length(path)))


def to_upload(tree: DataFrame, ledger: DataFrame, mutable: tuple[str, ...] = MUTABLE) -> DataFrame:
    """(path, sha256, size, change): files that the ledger lacks or has otherwise; mutable ones last in a push."""
    seen = ledger.select(F.col("path").alias("__p"), F.col("sha256").alias("__s"))
    met = tree.join(seen, F.col("path") == F.col("__p"), "left")
    change = F.when(F.col("__p").isNull(), "new").when(~F.col("sha256").eqNullSafe(F.col("__s")), "changed")
    return met.select("path", "sha256", "size", change.alias("change"), F.col("path").isin(*mutable).alias("mutable")).filter("change is not null")


def push_quota(n_bytes: Column) -> Column:
    """A quarter more than the bytes and a mebibyte."""
    return (n_bytes * 1.25).cast("bigint") + F.lit(1 << 20)


def preflight(expected: Column, present: Column, quota: Column, writable: Column) -> Column:
    return reasons((~F.coalesce(writable, F.lit(False)), "DESTINATION_NOT_WRITABLE"), (expected + present > quota, "DESTINATION_QUOTA_EXCEEDED"), (expected == 0, "NOTHING_TO_UPLOAD"))


def verify_download(size: Column, expected_size: Column, sha: Column, expected_sha: Column) -> Column:
    """ok, or what differs: size first, then the hash if one is expected."""
    return F.when(expected_size.isNotNull() & ~size.eqNullSafe(expected_size), "SIZE_MISMATCH").when(expected_sha.isNotNull() & ~sha.eqNullSafe(F.lower(expected_sha)), "SHA_MISMATCH").otherwise("ok")


def checksum_lines(files: DataFrame, path: str = "path", sha: str = "sha256") -> DataFrame:
    """One row: the digest of the sorted lines `<sha>  <path>` of all files but the manifest itself."""
    line = F.concat(F.col(sha), F.lit("  "), F.col(path))
    rows = files.filter(F.col(path) != "MANIFEST.sha256").select(F.struct(F.col(path).alias("p"), line.alias("l")).alias("x"))
    return rows.agg(F.count(F.lit(1)).alias("n_files"), F.sha2(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["l"]), "\n"), F.lit("\n")), 256).alias("release_digest"))
