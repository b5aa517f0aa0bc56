"""Order-dependent plans: packing files into batches, admission under caps, hysteresis, chunks.

What a file gets depends on all files of its job before it. A job's files meet in one task, sorted, and
pass a few counters as a stream of Arrow batches: linear in the files, in the memory of one batch.
Jobs are independent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ids import batch_id
from corpusloom.operators.dedup import numbered

STAGES = ("cache", "staging", "qc", "upload")


@dataclass(frozen=True)
class Budget:
    """Bytes and files that one batch and the workspace may hold, and what a byte takes in each stage."""

    workspace: int
    max_batch_bytes: int = 10 << 30
    max_files: int = 500
    unknown_estimate: int = 512 << 20
    max_unknown: int = 50
    min_free: int = 0
    factors: dict[str, float] = field(default_factory=lambda: {"cache": 1.0, "staging": 1.0, "qc": 2.0, "upload": 1.0})
    caps: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if min(self.workspace, self.max_batch_bytes, self.max_files) < 1 or self.min_free < 0:
            raise ValueError("a budget's bounds must be positive")

    @classmethod
    def from_workspace(cls, workspace: int, disk_free: int, min_free: int = 0) -> Budget:
        """What fits both the workspace and the disk; a quarter of it for one batch's bytes, a share for each stage by its factor."""
        usable = min(workspace, max(0, disk_free - min_free))
        if usable < 1:
            raise ValueError("no space for a workspace")
        base = cls(usable, min_free=min_free)
        total = sum(base.factors.values())
        return cls(usable, max_batch_bytes=min(10 << 30, max(1, usable // 4)), min_free=min_free, caps={s: int(usable * f / total) for s, f in base.factors.items()})


class Greedy:
    """A batch closes before a file that would exceed its files or known bytes; a lone oversize file closes at once."""

    def __init__(self, max_files: int, max_bytes: int) -> None:
        self.max_files, self.max_bytes = max_files, max_bytes
        self.batch = self.n = self.bytes = 0

    def put(self, size: int | None) -> int:
        known = size if size is not None and size >= 0 else 0
        if self.n and (self.n >= self.max_files or known and self.bytes + known > self.max_bytes):
            self.batch, self.n, self.bytes = self.batch + 1, 0, 0
        at = self.batch
        self.n, self.bytes = self.n + 1, self.bytes + known
        if self.n == 1 and known > self.max_bytes:
            self.batch, self.n, self.bytes = self.batch + 1, 0, 0
        return at


class Budgeted:
    """A file of unknown size is tested with its estimate but adds no bytes to the batch; unknown files are counted too."""

    def __init__(self, b: Budget) -> None:
        self.b = b
        self.batch = self.n = self.bytes = self.unknown = 0

    def put(self, size: int | None) -> int:
        blind = size is None or size < 0
        need = self.b.unknown_estimate if blind else size
        if self.n and (self.n >= self.b.max_files or self.bytes + need > self.b.max_batch_bytes or blind and self.unknown >= self.b.max_unknown):
            self.batch += 1
            self.n = self.bytes = self.unknown = 0
        self.n, self.bytes, self.unknown = self.n + 1, self.bytes + (0 if blind else size), self.unknown + blind
        return self.batch


class Capped:
    """First come first served under a cap; a request that does not fit is passed over, one of unknown need is never admitted."""

    def __init__(self, cap: int) -> None:
        self.left = cap

    def put(self, need: int | None) -> bool:
        ok = need is not None and need <= self.left
        self.left -= need if ok else 0
        return ok


def _in_order(df: DataFrame, by: str, order: list[str], keep: list[str], value: str, start, name: str, kind: T.DataType) -> DataFrame:  # noqa: ANN001
    """(by, keep, name): what start().put(value) says of each row in its group's order."""
    cols = {"by": F.col(by), "value": F.col(value).cast("bigint")} | {f"k{i}": F.col(c) for i, c in enumerate(keep)} | {f"o{i}": F.col(c) for i, c in enumerate(order)}
    rows = df.select(*(c.alias(n) for n, c in cols.items())).repartition("by").sortWithinPartitions("by", *(n for n in cols if n[0] == "o"), *(n for n in cols if n[0] == "k"))
    kept = [n for n in cols if n[0] == "k"]
    schema = T.StructType([T.StructField(by, rows.schema["by"].dataType), *(T.StructField(c, rows.schema[n].dataType) for n, c in zip(kept, keep)), T.StructField(name, kind)])
    arrow = pa.bool_() if kind == T.BooleanType() else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, None
        for b in batches:
            out = []
            for g, v in zip(b["by"].to_pylist(), b["value"].to_pylist()):
                if state is None or g != group:
                    group, state = g, start()
                out.append(state.put(v))
            yield pa.RecordBatch.from_arrays([b["by"], *(b[n] for n in kept), pa.array(out, arrow)], names=schema.names)

    return rows.select("by", "value", *kept).mapInArrow(run, schema)


def pack_files(df: DataFrame, job: str, path: str, size: str, order: list[str], max_files: int = 500, max_bytes: int = 10 << 30) -> DataFrame:
    """(job, path, size, batch_no): greedy packing in order (see Greedy)."""
    return _in_order(df, job, order, [path, size], size, lambda: Greedy(max_files, max_bytes), "batch_no", T.LongType())


def pack_budget(df: DataFrame, job: str, path: str, size: str, b: Budget) -> DataFrame:
    """(job, path, size, batch_no): budget packing by path (see Budgeted)."""
    return _in_order(df, job, [path], [path, size], size, lambda: Budgeted(b), "batch_no", T.LongType())


def footprint(accountable: Column, b: Budget) -> dict[str, Column]:
    return {s: (accountable * f).cast("bigint") for s, f in b.factors.items()}


def batches(packed: DataFrame, job: str, path: str, size: str, b: Budget, repo: str = "repo", revision: str = "rev") -> DataFrame:
    """One row per batch: files, known bytes, unknown files, reservation by stage, status (BLOCKED if a lone file exceeds the workspace) and batch_id."""
    got = packed.groupBy(job, "batch_no").agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum(F.when(F.col(size) >= 0, F.col(size))), F.lit(0)).alias("total_bytes"), F.count_if(F.coalesce(F.col(size) < 0, F.lit(True))).alias("n_unknown"), F.collect_list(path).alias("__files"))
    got = got.withColumn("accountable_bytes", F.col("total_bytes") + F.col("n_unknown") * b.unknown_estimate)
    got = got.withColumns({f"reserve_{s}": c for s, c in footprint(F.col("accountable_bytes"), b).items()})
    over = (F.col("n_files") == 1) & (sum((F.col(f"reserve_{s}") for s in STAGES[1:]), F.col("reserve_cache")) > b.workspace)
    return got.withColumns({"status": F.when(over, "BLOCKED").otherwise("PLANNED"), "batch_id": batch_id(F.lit(repo), F.lit(revision), "batch_no", F.col("__files"))}).drop("__files")


def admit(df: DataFrame, key: str, order: list[str], need: str, cap: int, by: str) -> DataFrame:
    """(by, key, admitted): see Capped."""
    return _in_order(df, by, order, [key], need, lambda: Capped(cap), "admitted", T.BooleanType())


def hysteresis(df: DataFrame, by: str, order: list[str], free: str, high: float, low: float) -> DataFrame:
    """df with gate: stop once free falls below high, run again from low on. The state is the last signal seen."""
    signal = F.when(F.col(free) < high, "stop").when(F.col(free) >= low, "run")
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("gate", F.coalesce(F.last(signal, ignorenulls=True).over(w), F.lit("run")))


def chunks(df: DataFrame, order: list[str], size: int, name: str = "chunk") -> DataFrame:
    """df with the number of its chunk of `size` rows in the given order (see numbered)."""
    return numbered(df, order, 0, "__row").withColumn(name, F.floor(F.col("__row") / size).cast("bigint")).drop("__row")


def replan(new: DataFrame, old: DataFrame, key: str = "batch_id", files: str = "files", state: list[str] | None = None) -> DataFrame:
    """A new plan that keeps the progress of batches with the same id and files."""
    state = state or ["status"]
    was = old.select(F.col(key).alias("__k"), F.col(files).alias("__f"), *(F.col(c).alias(f"__{c}") for c in state))
    out = new.join(was, (F.col(key) == F.col("__k")) & F.col(files).eqNullSafe(F.col("__f")), "left")
    return out.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in state}).drop("__k", "__f", *(f"__{c}" for c in state))


def oversized(df: DataFrame, size: str, most: int = 500 << 30) -> DataFrame:
    return df.filter(F.col(size) > most)
