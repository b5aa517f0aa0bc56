"""Chat formatting with a grammar round trip.

A turn is rendered as  <|role|>ROLE<|text|>TEXT<|end|>\\n . Control strings of this and of common
other templates that stand in a role or text are escaped by a mark behind their first character,
and marks themselves are doubled, so the rendered text can always be parsed: a deterministic parser
splits it by the grammar, takes the escapes out and compares the turns with the source. A turn that
does not come back identical is escaped character by character until it does, so formatting never
loses text. The loss mask covers the texts of assistant turns.

Rows of a conversation are ordered by turn (ties: role, then text). Turns are rendered and parsed
one by one, then hashed as a stream in their order: a conversation of any length needs the memory
of one batch, and a very long text that of its batch alone. Defined results: null roles and texts are
empty; rows of a null conversation id are one conversation; a null turn is before all others; repeated
rows are turns of their own; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import _common as C

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>\n"
#: What no text may hold as it is: the grammar's own marks, and those of templates that a trainer may add. Fixed values.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "### ")
#: Stands behind the first character of an escaped control string; itself it is doubled.
MARK = "\\"
FIRST = frozenset(c[0] for c in CONTROL)
_CONTROL = re.compile("|".join(map(re.escape, (MARK, *sorted(CONTROL, key=len, reverse=True)))))


def escape(text: str) -> str:
    """Reversible: no control string is left. Two marks are a mark; one is dropped."""
    out = _CONTROL.sub(lambda m: MARK * 2 if m[0] == MARK else m[0][0] + MARK + m[0][1:], text)
    if unescape(out) == text and not any(c in out for c in CONTROL):
        return out
    # control strings overlap: mark every character that may begin one
    return "".join(MARK * 2 if c == MARK else c + MARK if c in FIRST else c for c in text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(role: str, text: str) -> str:
    return f"{ROLE}{escape(role)}{TEXT}{escape(text)}{END}"


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation; raises if the grammar doesn't cover it."""
    out, at = [], 0
    while at < len(rendered):
        a = rendered.find(TEXT, at)
        z = rendered.find(END, a)
        if not rendered.startswith(ROLE, at) or a < 0 or z < 0:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(rendered[at + len(ROLE) : a]), unescape(rendered[a + len(TEXT) : z])))
        at = z + len(END)
    return out


def rendered_turn(role: str, text: str) -> str:
    """A turn's text; its round trip is checked."""
    out = render(role, text)
    if parse(out) != [(role, text)]:
        raise ValueError("a turn doesn't come back identical")
    return out


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [rendered_turn(r, t) for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist())]
        yield pa.RecordBatch.from_arrays([b["conv"], b["turn"], b["role"], pa.array(out, pa.string())], names=["conv", "turn", "role", "rendered"])


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, rendered), one row per turn. A conversation's formatted text is their join in order."""
    C.prepare(df.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    return src.mapInArrow(_render, T.StructType([*src.schema.fields[:3], T.StructField("rendered", T.StringType())]))


def said() -> Column:
    """The text of a rendered turn, read back from the column rendered."""
    begin = F.locate(TEXT, F.col("rendered")) + len(TEXT)
    raw = F.substring(F.col("rendered"), begin, F.length("rendered") - begin + 1 - len(END))
    return F.regexp_replace(raw, r"\\(\\?)", "$1")


class _Digest:
    """What is read back from one formatted conversation, turn by turn."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.size = 0

    def add(self, rendered: str, loss_role: str) -> None:
        for role, text in parse(rendered):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == loss_role:
                self.chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.size += len(rendered)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.chars, self.loss.hexdigest(), self.size


DIGEST = (("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))


def _digests(loss_role: str, name: str):  # noqa: ANN202
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            done, kind = [], b.schema.field("conv").type
            for conv, rendered in zip(b["conv"].to_pylist(), b["rendered"].to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *state.row()))
                    now, state = conv, _Digest()
                state.add(rendered, loss_role)
            if done:
                yield _batch(done, kind)
        if state is not None:
            yield _batch([(now, *state.row())], kind)

    def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [kind, *kinds])], names=[name, *(n for n, _ in DIGEST)])

    return run


def chat_format(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation with what is read back from its formatted text: see DIGEST.

    Conversations are dealt by their id and ordered within a task; a conversation's hash is of all
    its turns in a row, so its turns meet in one task, but as a stream that is never held.
    """
    turns = format_turns(df, conv_col, turn_col, role_col, text_col)
    dealt = turns.repartition("conv").withColumn("text", said()).sortWithinPartitions("conv", "turn", "role", "text").drop("text")
    schema = T.StructType([T.StructField(conv_col, turns.schema["conv"].dataType), *(T.StructField(n, t) for n, t in DIGEST)])
    return dealt.mapInArrow(_digests(loss_role, conv_col), schema)
