"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments.  Two fingerprints within ``t``
bits agree, in at least one segment, up to that segment's share of ``t``; so each
fingerprint is filed under its segment values, looks up the small Hamming ball
around each of them, and what it meets is verified on all 64 bits.

Only distinct fingerprints take part (copies are one row), a ball is searched
from the smaller value of a pair alone, and a segment value shared by many
fingerprints is not joined: its members are split into tiles of bounded size, and
each tile gives a spanning forest of its links instead of all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, stage
from .components import components

SHINGLE, MAX_BITS, SEGMENTS = 4, 4, 3
CROWD = 8                               # a segment value with more fingerprints is worked on in tiles
TILE = 4096                             # fingerprints of one side of a tile


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles as an unsigned 64-bit number: XXH64 with
    seed 42 of each shingle, repeats included; a bit is set where more than half
    of the hashes have it.  No words: zero; fewer words than a shingle: the whole
    sequence is the one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()       # bytes: ASCII case and blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(lens + 1) - lens - 1
    k = min(shingle, len(words))
    end = (start + lens)[k - 1:]
    h64 = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(end), 1 << 16):                              # bounds the bit matrix
        a, b = start[at:min(at + (1 << 16), len(end))].tolist(), end[at:at + (1 << 16)].tolist()
        h = np.array([h64(joined[x:y], 42) for x, y in zip(a, b)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(end), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """All columns of ``docs`` and ``out``: the fingerprint of ``text`` as a
    signed long; null text counts as no words."""
    text = docs.columns.index("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t or "", shingle) for t in b.column(text).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))], names=[*b.schema.names, out])
    return map_batches(docs, kernel, T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())]))


def segments(max_bits: int, parts: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment.  The radii plus one add up to
    ``max_bits`` plus one, so a pair beyond every radius differs in more bits."""
    out, at = [], 0
    for i in range(parts):
        width = 64 // parts + (i < 64 % parts)
        out.append((at, width, (max_bits + 1) // parts + (i < (max_bits + 1) % parts) - 1))
        at += width
    return out


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all of ``fps`` (distinct) that links within
    ``max_bits`` connect: a search from each fingerprint over those not reached."""
    rest, out = fps, []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                hit, rest = rest[near], rest[~near]
                out += [(x, y) for y in hit]
                todo += list(hit)
    return out


def tile_links(members: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """(u, v) links of crowded segment values, from (k, fp) members.  A value of
    more than ``tile`` members is split by hash into chunks; every two chunks
    meet in one tile, so a task holds two chunks at most."""
    size = members.groupBy("k").agg(F.count("*").alias("n"))
    chunks = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = (members.join(size.select("k", chunks.alias("chunks")), "k").withColumn("c", mine)
             .withColumn("other", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
                 F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != F.col("c")))))
             .select("k", F.least("c", "other").alias("a"), F.greatest("c", "other").alias("b"), "fp"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(parts: list[np.ndarray]) -> pa.RecordBatch:
            got = np.array(forest(np.unique(np.concatenate(parts)), max_bits), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["u", "v"])

        key, held = None, []
        for b in batches:
            k, a, c = (np.asarray(b.column(i)) for i in range(3))
            fp = np.asarray(b.column(3)).view(np.uint64)
            cut = np.flatnonzero((k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (c[1:] != c[:-1])) + 1
            for x, y in zip([0, *cut], [*cut, len(k)]):
                if x == y:
                    continue
                own = (k[x], a[x], c[x])
                if own != key and held:
                    yield links(held)
                    held = []
                key = own
                held.append(fp[x:y])
        if held:
            yield links(held)
    return map_batches(dealt.repartition("k", "a", "b").sortWithinPartitions("k", "a", "b"), kernel, "u long, v long")


def ball(value: Column, masks: list[int], segment: int) -> Column:
    """The keys around a segment value that lie above it: of a pair in different
    cells, one looks up the other."""
    near = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))
    return F.transform(F.filter(near, lambda k: k > value), lambda k: k.bitwiseOR(F.lit(segment << 40)))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD, tile: int = TILE) -> DataFrame:
    """(u, v): links that connect all distinct fingerprints (column ``fp``) within
    ``max_bits`` of one another, directly or through others."""
    homes, probes = [], []
    for s, (at, width, radius) in enumerate(segments(max_bits)):
        value = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1)) if radius >= 0 else None
        if value is None:
            continue
        homes.append(value.bitwiseOR(F.lit(s << 40)))
        masks = [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(width), r)]
        if masks:
            probes.append(ball(value, masks, s))
    home = distinct.select("fp", F.explode(F.array(*homes)).alias("k"))
    look = home.union(distinct.select("fp", F.explode(F.concat(*probes)).alias("k"))) if probes else home
    crowded = home.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("k")
    a, b = look.alias("a"), home.join(crowded, "k", "left_anti").alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    few = (a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.fp") != F.col("b.fp")) & near)
           .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    return few.union(tile_links(look.join(crowded, "k", "left_semi"), max_bits, tile))


def classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component): the group of each distinct value of column ``fp``."""
    distinct = stage(fps.select("fp").distinct(), "simhash-distinct")
    linked = components(links(distinct, max_bits), "simhash-links")
    return stage(distinct.join(linked, distinct["fp"] == linked["id"], "left")
                 .select("fp", F.coalesce("component", "fp").alias("component")), "simhash-classes")


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: component_id is the
    smallest doc_id whose fingerprint can be reached by links of at most
    ``max_bits`` differing bits.  Documents without words share fingerprint zero
    and are linked like any others; rows with a null id belong to a group but do
    not name it, unless no other row does (then the group is null)."""
    fps = stage(with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle)
                .select("doc_id", "fp"), "simhash")
    named = classes(fps, max_bits).join(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    label = stage(named.join(least, "component").select("fp", "component_id"), "simhash-label")
    return fps.join(label, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each group left: the one with the
    smallest doc_id (a null id only if the group has no other), and of rows that
    repeat it the one written first.  Texts are read once; what decides is one
    number per row."""
    taken = {c.lower() for c in docs.columns}                   # names differ by more than case
    fp, row = (next(n for n in (f"{x}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken) for x in ("fp", "row"))
    kept = stage(with_fingerprint(docs, shingle, fp).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    small = kept.select(F.col(fp).alias("fp"), F.struct(F.isnull("doc_id"), F.col("doc_id"), F.col(row)).alias("rank"))
    first = small.groupBy("fp").agg(F.min("rank").alias("rank"))
    least = (classes(small, max_bits).join(first, "fp").groupBy("component").agg(F.min("rank").alias("rank"))
             .select(F.col(f"rank.{row}").alias(row)))
    return kept.join(least, row, "left_semi").select(*docs.columns)
