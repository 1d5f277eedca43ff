"""Hierarchical multi-length packing.

Documents are routed to tiers of window lengths by their token count: whole
windows of the longest tier are cut off a long document, and what is left goes
to the tier of the smallest window that holds it.  Each tier packs its pieces,
longest tier first; a window's gap is filled from shorter tiers, best fit
first, and closed by cutting a shorter piece to the gap.  The sequences are
then dealt to step groups of about equal tokens.

Packing runs inside each input split over bounded pools of tokens: no shuffle,
no state that grows with the corpus, and the same split gives the same rows
when it is computed again.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import map_batches
from .library_words import encoder

TIERS = (1024, 512, 256, 128)           # window lengths, longest first; powers of two
POOL_TOKENS = 1 << 20                   # tokens packed together; bounds a task's memory
STEP_TOKENS = 1 << 16                   # tokens of one step group

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "window long, step_group long")

Piece = tuple[int, int, int]            # document's place in the pool, start, length


class Packer:
    """Packs the pieces of one pool; pieces that do not fill a window stay for the next."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.shelves: list[list[tuple[int, int, int]]] = [[] for _ in tiers]     # (length, document, start), sorted
        self.sequences: list[tuple[int, list[Piece]]] = []

    def add(self, doc: int, start: int, length: int) -> None:
        longest = self.tiers[0]
        while length >= longest:
            self.sequences.append((longest, [(doc, start, longest)]))
            start, length = start + longest, length - longest
        if length:
            self._shelve(doc, start, length)

    def _shelve(self, doc: int, start: int, length: int) -> None:
        """To the smallest window that holds the piece."""
        k = max(i for i, w in enumerate(self.tiers) if w >= length)
        insort(self.shelves[k], (length, doc, start))

    def _fit(self, k: int, gap: int) -> tuple[int, int, int] | None:
        """From tier ``k`` and shorter ones, the longest piece that fits the gap;
        if none does, a piece cut to it."""
        for shelf in self.shelves[k:]:
            i = bisect_right(shelf, (gap, 1 << 62, 0))
            if i:
                return shelf.pop(i - 1)
        for shelf in reversed(self.shelves[k:]):
            if shelf:
                length, doc, start = shelf.pop()
                self._shelve(doc, start + gap, length - gap)
                return gap, doc, start
        return None

    def pack(self, last: bool) -> None:
        """Close every window that can be filled; at the end of the input the
        tokens left over go to windows of smaller powers of two, so that no
        sequence needs padding."""
        for k, window in enumerate(self.tiers):
            shelf = self.shelves[k]
            while shelf:
                held, pieces = 0, []
                while held < window and (got := self._fit(k, window - held)):
                    pieces.append((got[1], got[2], got[0]))
                    held += got[0]
                if held == window:
                    self.sequences.append((window, pieces))
                elif last:
                    self._binary(pieces)
                else:                                           # no tier has more: keep for the next pool
                    for doc, start, length in pieces:
                        self._shelve(doc, start, length)
                    return

    def _binary(self, pieces: list[Piece]) -> None:
        total = sum(p[2] for p in pieces)
        rest = list(reversed(pieces))
        for bit in reversed(range(total.bit_length())):
            if not total >> bit & 1:
                continue
            need, own = 1 << bit, []
            while need:
                doc, start, length = rest.pop()
                take = min(need, length)
                own.append((doc, start, take))
                if take < length:
                    rest.append((doc, start + take, length - take))
                need -= take
            self.sequences.append((1 << bit, own))


def deal_steps(windows: list[int], step_tokens: int) -> list[int]:
    """A step group for each sequence: longest first, always to the group that
    holds the fewest tokens, so groups get like totals and like mixes of lengths."""
    groups = max(1, round(sum(windows) / step_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: (-windows[i], i)):
        load, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (load + windows[i], g))
    return out


def pack_stream(docs: Iterator[tuple[int | None, np.ndarray]], tiers: tuple[int, ...], pool_tokens: int,
                step_tokens: int, first_id: int) -> Iterator[list[list]]:
    """Columns of SCHEMA for a stream of (doc_id, ids), one pool at a time."""
    packer = Packer(tiers)
    held: dict[int, tuple[int | None, np.ndarray]] = {}
    tokens, sequence, step, place = 0, first_id, first_id, 0

    def flush(last: bool) -> list[list]:
        nonlocal sequence, step, tokens
        packer.pack(last)
        cols: list[list] = [[] for _ in range(9)]
        groups = deal_steps([w for w, _ in packer.sequences], step_tokens)
        for (window, pieces), g in zip(packer.sequences, groups):
            offset = 0
            for doc, start, length in pieces:
                doc_id, ids = held[doc]
                crc = zlib.crc32(ids[start:start + length].tobytes()) & 0xFFFFFFFF
                for c, v in zip(cols, (doc_id, start, length, crc, len(ids), sequence, offset, window, step + g)):
                    c.append(v)
                offset += length
            sequence += 1
        step += max(groups, default=-1) + 1
        packer.sequences = []
        waiting = {doc for shelf in packer.shelves for _, doc, _ in shelf}
        for doc in [d for d in held if d not in waiting]:
            del held[doc]
        tokens = 0
        return cols

    for doc_id, ids in docs:
        held[place] = (doc_id, ids)
        packer.add(place, 0, len(ids))
        place, tokens = place + 1, tokens + len(ids)
        if tokens >= pool_tokens:
            yield flush(False)
    yield flush(True)


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, tiers: tuple[int, ...] = TIERS,
         pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece (see SCHEMA).  Null texts count as empty: a document of
    the end id alone.  Repeated rows are packed as often as they occur; a null id
    stays null.  Sequence and step ids are unique and grow within a split."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.array([end_id], "<i4")

        def ids() -> Iterator[tuple[int | None, np.ndarray]]:
            for b in batches:
                got = enc.encode([t or "" for t in b.column(1).to_pylist()])
                for doc_id, x in zip(b.column(0).to_pylist(), got):
                    yield doc_id, np.concatenate([x, end])

        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for cols in pack_stream(ids(), tiers, pool_tokens, step_tokens, first):
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=[f.split()[0] for f in SCHEMA.split(", ")])
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")),
                       kernel, SCHEMA)
