"""Conversations formatted by a compiled template, and read back.

The template marks turns and loss; control strings inside roles and texts are
escaped with a backslash, reversibly.  Rows are grouped by sorting: a task reads
one conversation's turns in order and writes formatted parts of bounded size, so
a conversation of any length needs the memory of a part, never of the whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage
from .template import compile_template

TEMPLATE = ('{% for m in messages %}{{ "### " ~ (m.role | escape_role) ~ ": " }}'
            '{% if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}'
            '{% else %}{{ m.text | escape }}{% endif %}{{ "</turn>" ~ "\\n" }}{% endfor %}')
PART_CHARS = 1 << 18                    # a formatted part is closed at the first turn's end beyond this

_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_ROLE = re.compile(r"\\|###|</turn>|:")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)

FORMATTED = "conv_id long, part long, formatted string, loss array<struct<start: int, stop: int>>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return _CONTROL_ROLE.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@lru_cache(maxsize=16)
def renderer(template: str) -> Callable:
    return compile_template(template, {"escape": escape, "escape_role": escape_role})


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (as tuples) of sorted batches."""
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, formatted, loss): the formatted text of each conversation
    in parts of whole turns, with the character spans of each part that the
    template marks as generation.

    Turns go by ``turn``, ties (repeated rows too, each of which is a turn) by role
    and text.  Null texts and roles count as empty, a null turn comes first, and
    rows with a null conv_id form one conversation."""
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = renderer(template)
        turns = by_key(batches)
        ahead = next(turns, None)

        def batch(conv, part, text, spans) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([part], pa.int64()), pa.array([text], pa.string()),
                 pa.array([spans], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
                names=["conv_id", "part", "formatted", "loss"])

        while ahead is not None:
            conv, pulled, seen = ahead[0], 0, 0

            def messages() -> Iterator[dict]:
                nonlocal ahead, pulled
                while ahead is not None and ahead[0] == conv:
                    now = {"role": ahead[2], "text": ahead[3]}
                    ahead = next(turns, None)
                    pulled += 1
                    yield now
                pulled += 1

            mine = messages()
            held, spans, size, part = [], [], 0, 0
            for text, marked in render({"messages": mine}):
                # the loop asks for the next message before it renders one, so a
                # new count means that this piece begins a turn
                if pulled != seen and size >= PART_CHARS:
                    yield batch(conv, part, "".join(held), spans)
                    held, spans, size, part = [], [], 0, part + 1
                seen = pulled
                if marked and text:
                    spans.append({"start": size, "stop": size + len(text)})
                held.append(text)
                size += len(text)
            for _ in mine:                                      # turns that the template does not show
                pass
            yield batch(conv, part, "".join(held), spans)
    return map_batches(rows, kernel, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, parsed from its formatted parts: turns and their digest,
    length and digest of the text under the loss mask, formatted length."""
    rows = formatted.select("conv_id", "part", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        cols: list[list] = [[] for _ in names]
        now: list = []

        def close() -> None:
            for c, v in zip(cols, (now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])):
                c.append(v)

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
            for c in cols:
                c.clear()
            return out

        for conv, _, text, loss in by_key(batches):
            if not now or now[0] != conv:
                if now:
                    close()
                if len(cols[0]) >= 4096:
                    yield flush()
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            at = 0
            for m in _TURN.finditer(text):
                if m.start() != at:
                    raise ValueError(f"conversation {conv}: no turn at character {at}")
                now[1] += 1
                now[2].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                at = m.end()
            if at != len(text):
                raise ValueError(f"conversation {conv}: no turn at character {at}")
            for span in loss:
                plain = unescape(text[span["start"]:span["stop"]])
                now[3] += len(plain)
                now[4].update(plain.encode("utf-8", "surrogatepass"))
            now[5] += len(text)
        if now:
            close()
        yield flush()
    return map_batches(rows, kernel, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def round_trip(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format all conversations into the shared folder and read them back."""
    return read_back(stage(format_conversations(conversations, template), "chat"))
