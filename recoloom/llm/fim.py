"""Fill-in-middle: texts cut at unit ends into prefix, middle and suffix, by SWAR words.

A batch of texts is one UTF-8 buffer, viewed as uint64 words.  Unit-ending bytes
are marked eight at a time by carry-free arithmetic and counted with
``bitwise_count``; a cut is found by searching the running counts for its word and
then selecting the marked byte inside the word.  Code points are counted the same
way.  All texts of a batch are cut together, and no text is split into units.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Rules:
    """Which texts are transformed, and how: ``seed`` goes into the hash, ``rate``
    per cent of all texts are transformed, ``spm`` per cent of these suffix first;
    units end after ``end`` (a byte below 128)."""
    seed: int = 7
    rate: int = 100
    spm: int = 50
    end: str = "\n"


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian uint64 words, filled up with zeros."""
    padded = np.zeros(-(-len(data) // 8) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """Words with the high bit of each byte set where that byte equals ``byte``."""
    x = words ^ (_ONES * np.uint64(byte))
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def point_bytes(words: np.ndarray) -> np.ndarray:
    """High bits of the bytes that begin a code point (not 10xxxxxx)."""
    return (~words | (words << np.uint64(1))) & _HIGH


class Ranks:
    """Rank and select over the marked bytes of a buffer."""

    def __init__(self, marks: np.ndarray):
        self.marks = np.append(marks, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes ahead of byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = ~(_FULL << (byte * np.uint64(8)))
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Position of the ``k``-th marked byte (from 0) of the buffer."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left, mark = k - self.before[word], self.marks[word]
        for _ in range(7):                                      # drop the marks ahead of it, at most seven
            more = left > 0
            mark = np.where(more, mark & (mark - np.uint64(1)), mark)
            left = left - more
        lowest = mark & (~mark + np.uint64(1))
        return word * 8 + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """h1 to h4 of a document; a null id counts as no digits."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[i:i + 8], 16) for i in range(0, 32, 8))


def cut_batch(data: np.ndarray, offsets: np.ndarray, ids: list, rules: Rules) -> tuple:
    """(units, h3, h4, first cut, second cut, prefix and middle code points) of each
    text of a buffer; ``offsets`` has one entry more than texts, cuts are positions in the buffer."""
    words = words_of(data)
    ends, points = Ranks(equal_bytes(words, ord(rules.end))), Ranks(point_bytes(words))
    start, stop = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    first = ends.rank(start)
    closed = ends.rank(stop) - first                            # units that end with the mark
    size = stop - start
    open_end = (size > 0) & (data[np.maximum(stop - 1, 0)] != ord(rules.end)) if len(data) else np.zeros(len(start), bool)
    n = closed + open_end
    h = np.array([draws(rules.seed, i) for i in ids], np.int64).reshape(-1, 4)
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)

    def after(k: np.ndarray) -> np.ndarray:
        """Position behind ``k`` units."""
        at = np.where(k == n, stop, start)
        inner = (k > 0) & (k < n)
        at[inner] = ends.select((first + k - 1)[inner]) + 1
        return at
    p, m = after(np.minimum(a, b)), after(np.maximum(a, b))
    base, mid = points.rank(p), points.rank(m)
    return n, h[:, 2], h[:, 3], p, m, base - points.rank(start), mid - base


def transform(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``.

    A null text counts as empty; texts that are empty or hold one of the three
    markers stay plain, as do those that the rate spares.  A null id has draws of
    its own; repeated rows give repeated rows; other columns are not looked at."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    P, S, M = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1).cast(pa.large_binary())
            _, where, held = text.buffers()
            offsets = np.frombuffer(where, np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
            data = (np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None and offsets[-1] > offsets[0]
                    else np.zeros(0, np.uint8))
            offsets = offsets - offsets[0]
            ids = batch.column(0).to_pylist()
            n, h3, h4, p, m, prefix, middle = cut_batch(data, offsets, ids, rules)
            whole = data.tobytes()
            out, form = [], []
            for i in range(len(ids)):
                a, z = int(offsets[i]), int(offsets[i + 1])
                t = whole[a:z]
                if not t or P in t or S in t or M in t or h3[i] % 100 >= rules.rate:
                    form.append(PLAIN)
                    out.append(t)
                    continue
                pre, mid, suf = whole[a:int(p[i])], whole[int(p[i]):int(m[i])], whole[int(m[i]):z]
                spm = h4[i] % 100 < rules.spm
                form.append(SPM if spm else PSM)
                out.append(b"".join((S, suf, P, pre, M, mid) if spm else (P, pre, S, suf, M, mid)))
            plain = np.array([f == PLAIN for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64(), mask=plain),
                 pa.array(middle, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return map_batches(rows, kernel, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The exact text, from the transformed one and its form alone.  A transformed
    text holds each marker once, so the parts between markers are its cuts."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (F.when(form == PSM, F.concat(part[1], part[3], part[2]))
            .when(form == SPM, F.concat(part[2], part[3], part[1])).otherwise(output))


def round_trip(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Digests of the transformed texts and of the texts restored from them."""
    return transform(docs, rules).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))
