"""Identity functions: hashes of joined parts, exact across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
TWO_64 = 18446744073709551616.0


def text(c: Column | str) -> Column:
    """A column as text, null as the empty string (concat_ws would skip a null part)."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def short_id(*parts: Column | str, length: int = 16, prefix: str = "") -> Column:
    """The first hex digits of the SHA-256 of the parts, joined by a unit separator."""
    digest = F.substring(F.sha2(F.concat_ws(SEPARATOR, *map(text, parts)), 256), 1, length)
    return F.concat(F.lit(prefix), digest) if prefix else digest


def hash_fraction(seed: int | str, group: Column | str) -> Column:
    """A number in [0, 1) from the first 64 bits of SHA-256("seed:group")."""
    hexes = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), text(group)), 256), 1, 16)
    return F.conv(hexes, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(TWO_64)


def canonical_json_hash(**columns: Column) -> Column:
    """SHA-256 of compact JSON with sorted keys; nulls stay as null."""
    return F.sha2(F.to_json(F.struct(*(columns[k].alias(k) for k in sorted(columns))), {"ignoreNullFields": "false"}), 256)


def batch_id(repo: Column | str, revision: Column | str, index: Column | str, files: Column) -> Column:
    """b- and 16 hex digits of repository, revision, six-digit index and the sorted files."""
    index = F.col(index) if isinstance(index, str) else index
    joined = F.concat_ws("\x00", text(repo), text(revision), F.lpad(index.cast("string"), 6, "0"), F.array_join(F.array_sort(files), "\x00"))
    return F.concat(F.lit("b-"), F.substring(F.sha2(joined, 256), 1, 16))
