"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors a cosine of at least ``c`` is a squared distance of at most
2 - 2c.  A rotation spreads that distance evenly, the rotated vector is cut into
blocks of a few dimensions, and of two linked vectors at least one block is
within the block's proportional share.  Each block is range-joined on its own: a
grid over the block's leading coordinates, with cells wider than the block's
radius, brings every such pair together once.  Candidates of all blocks are then
verified exactly on the original components in double precision.

A pair that several blocks find is counted only by the first block within its
share, which every task can tell by itself, so links are counted without listing
or comparing pairs between tasks.  Cells of any size are split into tiles of
bounded bytes, and a tile returns one row per vector: links and a local root.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage
from .components import components

BLOCK_DIM = 16                          # dimensions of a block
TILE_BYTES = 8 << 20                    # components (as doubles) of one side of a tile
STRIP, PAIRS = 512, 1 << 15             # rows and candidate pairs worked on at once
SLACK, EDGE = 1e-5, 1e-12               # margins of the single-precision sieve and of the exact share


class Subspaces:
    """Rotation, blocks and grid for vectors of one length."""

    def __init__(self, dim: int, cosine: float, block_dim: int = BLOCK_DIM):
        self.dim = dim
        self.wide = max(1 << (dim - 1).bit_length(), 1)
        self.block = min(block_dim, self.wide)
        self.blocks = self.wide // self.block
        self.share = (2 - 2 * cosine) * self.block / self.wide + EDGE
        self.radius = float(np.sqrt(self.share)) + 1e-9
        self.cell = 2 * self.radius
        self.signs = np.random.default_rng(dim).choice([-1.0, 1.0], (2, self.wide))

    def rotate(self, X: np.ndarray) -> np.ndarray:
        """Unit vectors turned by two rounds of random signs and a Walsh-Hadamard
        transform.  Additions run element by element in a fixed order, so a vector
        turns to the same bits in every task."""
        Y = np.zeros((len(X), self.wide))
        Y[:, :self.dim] = X / np.sqrt((X * X).sum(1))[:, None]
        for s in self.signs:
            Y *= s
            h = 1
            while h < self.wide:
                Z = Y.reshape(len(Y), -1, 2, h)
                Y = np.stack([Z[:, :, 0] + Z[:, :, 1], Z[:, :, 0] - Z[:, :, 1]], axis=2).reshape(len(Y), -1)
                h *= 2
            Y = Y / np.sqrt(self.wide)
        return Y

    def cells(self, Y: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, home): each row's own cell, and the cells ahead of it that
        hold rows within the radius.  A pair of neighbouring cells meets once, as
        one of them is ahead of the other."""
        at = block * self.block
        x = Y[:, at]
        y = Y[:, at + 1] if self.block > 1 else np.zeros(len(Y))
        cx, cy = np.floor(x / self.cell).astype(np.int64), np.floor(y / self.cell).astype(np.int64)
        right = (cx + 1) * self.cell - x <= self.radius
        up, down = (cy + 1) * self.cell - y <= self.radius, y - cy * self.cell <= self.radius
        rows, keys, home = [], [], []
        for dx, dy, near in ((0, 0, None), (0, 1, up), (1, 0, right), (1, 1, right & up), (1, -1, right & down)):
            r = np.arange(len(Y)) if near is None else np.flatnonzero(near)
            rows.append(r)
            keys.append(((cx[r] + dx) << 32) + (cy[r] + dy))
            home.append(np.full(len(r), near is None))
        return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


@lru_cache(maxsize=64)
def subspaces(dim: int, cosine: float) -> Subspaces:
    return Subspaces(dim, cosine)


def matrix(col: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors in double precision.  Those whose squared norm could overflow or
    lose digits are divided by the power of two of their largest component, which
    changes no direction and rounds nothing."""
    X = np.asarray(col.flatten()).astype(np.float64).reshape(len(col), dim)
    top = np.abs(X).max(1, initial=0.0)
    far = (top > 1e100) | (top < 1e-100)
    if far.any():
        X[far] = np.ldexp(X[far], -np.frexp(top[far])[1][:, None])
    return X


class Union:
    """Disjoint sets over a tile's members, joined by whole arrays of pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            far = ra != rb
            if not far.any():
                return
            a, b, ra, rb = a[far], b[far], ra[far], rb[far]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def tile_result(space: Subspaces, block: int, cosine: float, same: bool, X: np.ndarray, side: np.ndarray,
                home: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each member of a tile.  ``side`` tells the two chunks of
    a tile apart; in a tile of one chunk all its members meet each other."""
    n = len(X)
    links, union = np.zeros(n, np.int64), Union(n)
    left = np.arange(n) if same else np.flatnonzero(side == 0)
    right = np.arange(n) if same else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return links, union.root
    Y = space.rotate(X)
    norm = np.sqrt((X * X).sum(1))
    U = (X / norm[:, None]).astype(np.float32)
    cut = slice(block * space.block, (block + 1) * space.block)
    P = Y[:, cut]
    half, one = -(P * P).sum(1, keepdims=True) / 2, np.ones((n, 1))
    Q, R = np.hstack([P, half, one]).astype(np.float32), np.hstack([P, one, half]).astype(np.float32)[right]
    limit = np.float32(-(space.share + SLACK) / 2)              # Q @ R.T is minus half the squared distance
    for at in range(0, len(left), STRIP):
        rows = left[at:at + STRIP]
        other = R[at:] if same else R
        i, j = np.divmod(np.flatnonzero(Q[rows] @ other.T >= limit), len(other))
        i, j = rows[i], right[j + at if same else j]
        keep = home[i] | home[j]
        if same:
            keep &= i < j
        i, j = i[keep], j[keep]
        for x in range(0, len(i), PAIRS):
            a, b = i[x:x + PAIRS], j[x:x + PAIRS]
            close = np.einsum("ij,ij->i", U[a], U[b]) >= cosine - SLACK         # spares most pairs the exact work
            a, b = a[close], b[close]
            part = ((Y[a] - Y[b]) ** 2).reshape(len(a), space.blocks, space.block).sum(2) <= space.share
            first = part[:, block] & ~part[:, :block].any(1)
            a, b = a[first], b[first]
            ok = np.einsum("ij,ij->i", X[a], X[b]) / (norm[a] * norm[b]) >= cosine
            a, b = a[ok], b[ok]
            links += (np.bincount(a, weight[b], n) + np.bincount(b, weight[a], n)).astype(np.int64)
            union.join(a, b)
    return links, union.root


def tile_links(nodes: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root) rows of all tiles, from (node, copies, dim, vector)."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.asarray(b.column(2))
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                space = subspaces(int(dim), cosine)
                Y = space.rotate(matrix(own.column(3), int(dim)))
                for block in range(space.blocks):
                    r, key, home = space.cells(Y, block)
                    for at in range(0, len(r), 4096):
                        part = own.take(pa.array(r[at:at + 4096]))
                        m = part.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [part.column(2), pa.array(np.full(m, block, np.int32)), pa.array(key[at:at + m]),
                             pa.array(home[at:at + m]), part.column(0), part.column(1), part.column(3)],
                            names=["dim", "block", "cell", "home", "node", "copies", "vector"])

    kind = dict(nodes.dtypes)["vector"]
    cell = ["dim", "block", "cell"]
    filed = map_batches(nodes.select("node", "copies", "dim", "vector"), deal,
                        f"dim int, block int, cell long, home boolean, node long, copies long, vector {kind}")
    size = filed.groupBy(*cell).agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    chunks = F.ceil(F.col("n") * F.col("dim") * 8 / TILE_BYTES).cast("int")
    dealt = (filed.join(size.where("n > 1 and homes > 0").select(*cell, chunks.alias("chunks")), cell)
             .withColumn("c", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select(*cell, F.least("c", "other").alias("a"), F.greatest("c", "other").alias("b"),
                     (F.col("c") > F.col("other")).cast("int").alias("side"), "home", "node", "copies", "vector"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(key: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            dim, block, _, a, b = key
            col = lambda name: t.column(name).to_numpy()
            X = np.concatenate([matrix(c, dim) for c in t.column("vector").chunks])
            node = col("node")
            links, root = tile_result(subspaces(dim, cosine), block, cosine, a == b, X, col("side"),
                                      t.column("home").to_pandas().to_numpy(bool), col("copies").astype(np.float64))
            has = links > 0
            return pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(links[has]), pa.array(node[root[has]])],
                                              names=["node", "links", "root"])

        key, held = None, []
        for batch in batches:
            k = [np.asarray(batch.column(i)) for i in range(5)]
            change = np.zeros(max(0, batch.num_rows - 1), bool)
            for c in k:
                change |= c[1:] != c[:-1]
            cut = np.flatnonzero(change) + 1
            for x, y in zip([0, *cut], [*cut, batch.num_rows]):
                if x == y:
                    continue
                own = tuple(int(c[x]) for c in k)
                if own != key and held:
                    yield result(key, held)
                    held = []
                key = own
                held.append(batch.slice(x, y - x))
        if held:
            yield result(key, held)

    tile = [*cell, "a", "b"]
    return map_batches(dealt.repartition(*tile).sortWithinPartitions(*tile), meet, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, as do vectors of different lengths.  Equal vectors are worked on
    once and link with each other.  Rows that repeat an id are vectors of their
    own; a null id is kept and names no component unless it is alone in it (then
    the component is null and ``kept`` is false)."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vector"))
    fine = (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    distinct = rows.where("fine").groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    nodes = stage(distinct.withColumn("node", F.monotonically_increasing_id())
                  .withColumn("dim", F.size("vector")), "vectors")               # written once: node numbers stay
    found = stage(tile_links(nodes, cosine), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "vector-components")
    named = (nodes.select("node", "copies", "first", "vector").join(links, "node", "left")
             .join(linked.select(F.col("id").alias("node"), "component"), "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    label = stage(named.join(least, "component").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "vector-labels")
    good = rows.where("fine").join(label, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
