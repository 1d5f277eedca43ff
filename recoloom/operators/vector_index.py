"""A stored vector index: coarse cells, product-quantised codes, exact re-rank (M-2, SNK-3, ST-5).

Built once and loaded by every search.  A vector is filed under its nearest centroid;
what is left of it is cut into subspaces, and each part is coded by the number of its
nearest codebook entry: one byte for several dimensions.  The index is one Parquet
table, partitioned by cell, with the codes, the vector's true squared norm, the distance
to the coded vector, and the vector itself.  A search reads codes and norms of the cells
it probes, keeps a shortlist per query, and reads full vectors for that list only.

Centroids and codebooks are fitted on a bounded, hash-chosen sample; every row is
indexed.  They are a few megabytes at most (``MOST_CELLS`` centroids), whatever the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import knn as K
from .sampling import broadcast_if_small

SAMPLE_ROWS, MOST_CELLS = 65_536, 16_384
CODES = 256                             # entries of a codebook: a code is one byte
QUERY_BLOCK, SUB_BLOCK = 16_384, 512
FEW = 512                               # queries that leave most items no place: what they need is found by the codes first


def kmeans(X: np.ndarray, k: int, seed: int = 42, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``X`` (all distinct rows, if fewer)."""
    C = np.unique(X, axis=0)
    if len(C) <= k:
        return C
    C = C[np.sort(np.random.default_rng(seed).choice(len(C), k, replace=False))]
    for _ in range(rounds):
        own = nearest(X, C)
        size = np.bincount(own, minlength=len(C))
        sums = np.stack([np.bincount(own, X[:, j], len(C)) for j in range(X.shape[1])], axis=1)
        C = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], C)
    return C


def squared(Q: np.ndarray, X: np.ndarray) -> np.ndarray:
    return np.maximum((Q * Q).sum(1)[:, None] + (X * X).sum(1) - 2 * (Q @ X.T), 0.0)


def nearest(X: np.ndarray, C: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """The row of ``C`` nearest to each row of ``X``, in blocks of products that stay in the cache."""
    step, half, T = max(1, block // len(C)), (C * C).sum(1) / 2, np.ascontiguousarray(C.T)
    return np.concatenate([(half - X[i:i + step] @ T).argmin(1) for i in range(0, len(X), step)]) if len(X) else np.zeros(0, int)


@dataclass
class Quantizer:
    centroids: np.ndarray               # cells x dimensions
    books: list[np.ndarray]             # per subspace: entries x its dimensions

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def cuts(self) -> list[slice]:
        ends = np.cumsum([b.shape[1] for b in self.books])
        return [slice(e - b.shape[1], e) for e, b in zip(ends, self.books)]

    def encode(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, codes, error) of each row: error is the distance to the decoded vector."""
        cell = nearest(X, self.centroids)
        rest = X - self.centroids[cell]
        codes = np.stack([nearest(rest[:, c], b) for c, b in zip(self.cuts(), self.books)], axis=1).astype(np.uint8)
        return cell, codes, np.sqrt(((X - self.decode(cell, codes)) ** 2).sum(1))

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.centroids[cell] + np.concatenate([b[codes[:, j]] for j, b in enumerate(self.books)], axis=1)


def fit(vectors: DataFrame, cells: int | None = None, subspaces: int = 32, sample_rows: int = SAMPLE_ROWS, seed: int = 42) -> Quantizer:
    """Fit on at most ``sample_rows`` of the (id, vec) rows, those with the lowest hash."""
    rows = vectors.where("vec is not null")
    n = rows.count()
    picked = rows.select(F.xxhash64("id", "vec").alias("h"), "vec").orderBy("h").limit(sample_rows).select("vec").toArrow()
    if not picked.num_rows:
        raise ValueError("no vectors to fit an index on")
    X = K.matrix(picked.column("vec"))
    C = kmeans(X, min(MOST_CELLS, cells or max(1, round(n ** 0.5))), seed)
    rest = X - C[nearest(X, C)]
    edges = np.linspace(0, X.shape[1], min(subspaces, X.shape[1]) + 1).astype(int)
    return Quantizer(C, codebooks(vectors.sparkSession, rest, [slice(a, b) for a, b in zip(edges, edges[1:])], seed))


def codebooks(spark: SparkSession, rest: np.ndarray, cuts: list[slice], seed: int) -> list[np.ndarray]:
    """The codebook of each subspace of the sample, one task a subspace."""
    sent = spark.sparkContext.broadcast(rest)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in b.column(0).to_pylist():
                book = kmeans(sent.value[:, cuts[j]], CODES, seed + cuts[j].start)
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int64()), pa.array([book.tobytes()], pa.binary())], names=["id", "book"])
    spaces = spark.range(len(cuts)).repartitionById(len(cuts), F.col("id").cast("int"))
    books = {r["id"]: np.frombuffer(r["book"]) for r in spaces.mapInArrow(kernel, "id long, book binary").collect()}
    sent.destroy()
    return [books[j].reshape(-1, c.stop - c.start).copy() for j, c in enumerate(cuts)]


def save_model(spark: SparkSession, q: Quantizer, path: str) -> None:
    parts = [("cell", -1, i, c) for i, c in enumerate(q.centroids)] + [("code", j, i, c) for j, b in enumerate(q.books) for i, c in enumerate(b)]
    kind, space, number, vec = zip(*parts)
    rows = pa.table({"kind": pa.array(kind), "space": pa.array(space, pa.int32()), "number": pa.array(number, pa.int32()), "vec": pa.array(vec, pa.list_(pa.float64()))})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> Quantizer:
    rows = spark.read.parquet(f"{path}/model").orderBy("kind", "space", "number").collect()       # bounded by MOST_CELLS and CODES
    spaces = sorted({r["space"] for r in rows if r["kind"] == "code"})
    return Quantizer(np.array([r["vec"] for r in rows if r["kind"] == "cell"]),
                     [np.array([r["vec"] for r in rows if r["space"] == s]) for s in spaces])


def filed(vectors: DataFrame, q: Quantizer) -> DataFrame:
    """(id, vec) rows with their cell, codes, squared norm and error.  Null vectors are left out; a
    vector of another length fails the job."""
    kind = vectors.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("codes", T.BinaryType()),
                           T.StructField("norm2", T.DoubleType()), T.StructField("error", T.DoubleType()), T.StructField("cell", T.IntegerType())])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                X = np.asarray(part.column(1).flatten(), np.float64)
                if len(X) != part.num_rows * q.dim or (np.diff(np.asarray(part.column(1).offsets)) != q.dim).any():
                    raise ValueError(f"expected vectors of {q.dim} dimensions")
                X = X.reshape(-1, q.dim)
                cell, codes, error = q.encode(X)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(np.arange(len(X) + 1, dtype=np.int32) * q.dim, pa.array(X.ravel())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array((X * X).sum(1)), pa.array(error), pa.array(cell, pa.int32())],
                    names=["id", "vec", "codes", "norm2", "error", "cell"])
    return vectors.select("id", F.col("vec").cast("array<double>").alias("vec")).where("vec is not null").mapInArrow(kernel, schema)


def add(vectors: DataFrame, path: str, q: Quantizer, writer: str, batch: int) -> None:
    """File (id, vec) rows as one batch; a replayed batch replaces itself.  Rows are
    range-partitioned by cell and id, so a crowded cell is written by several tasks."""
    rows = filed(vectors, q).repartitionByRange("cell", "id")
    rows.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows/_writer={writer}/_batch={batch}")


def build(vectors: DataFrame, path: str, **fitting) -> Quantizer:
    """Fit, save the model, and index every row of ``vectors`` (id, vec)."""
    q = fit(vectors, **fitting)
    save_model(vectors.sparkSession, q, path)
    add(vectors, path, q, "build", 0)
    return q


def index_stream(stream: DataFrame, path: str, checkpoint: str, writer: str = "stream"):
    """ST-5: arriving (id, vec) rows are filed under the saved cells and codes; the next
    search finds them, and nothing is fitted anew.  An id is to be sent once; changed
    vectors belong into a new build."""
    from ..streaming.ingest import start
    spark = stream.sparkSession
    q = load_model(spark, path)
    return start(stream.writeStream.foreachBatch(lambda rows, batch: add(rows, path, q, writer, batch))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True), spark)


def rows_of(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the index: id, vec, codes, norm2, error, cell; only the columns asked for are read."""
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("_writer", "_batch")


def probe(queries: DataFrame, q: Quantizer, probes: int, blocks: int = 1) -> DataFrame:
    """(qid, qvec, blk, first, bits): for each block of neighbouring cells that holds some of
    a query's ``probes`` nearest ones, which of its cells, from ``first`` on, they are."""
    schema = T.StructType([queries.schema["qid"], T.StructField("qvec", T.ArrayType(T.DoubleType())), T.StructField("blk", T.IntegerType()),
                           T.StructField("first", T.IntegerType()), T.StructField("bits", T.BinaryType())])
    cells = len(q.centroids)
    k = min(probes, cells)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                D = squared(K.matrix(part.column(1), q.dim), q.centroids)
                asked = np.zeros(D.shape, bool)
                np.put_along_axis(asked, np.argpartition(D, k - 1, axis=1)[:, :k], True, axis=1)
                for blk in range(blocks):
                    lo, hi = blk * cells // blocks, (blk + 1) * cells // blocks
                    rows = np.flatnonzero(asked[:, lo:hi].any(1))
                    if len(rows):
                        bits = [r.tobytes() for r in np.packbits(asked[rows, lo:hi], axis=1)]
                        own = pa.array(rows)
                        yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(1).take(own), pa.array(np.full(len(rows), blk, np.int32)),
                                                          pa.array(np.full(len(rows), lo, np.int32)), pa.array(bits, pa.binary())], names=[f.name for f in schema])
    return queries.select("qid", F.col("qvec").cast("array<double>").alias("qvec")).where("qvec is not null").mapInArrow(kernel, schema)


CODED = ["id", "codes", "norm2", "error", "cell"]


class _Coded:
    """A tile's queries against coded items.  The estimate of a squared distance takes both
    norms as they are and the inner product with the decoded vector, which is the sum of
    the query's table entries at the item's codes; for a batch of items it is one matrix
    product with the decoded block.  It is off by at most twice the query's norm times
    ``error``."""

    def __init__(self, held: pa.Table, q: Quantizer, k: int):
        self.qids, self.Q, self.q = held.column("qid").combine_chunks(), K.matrix(held.column("qvec")), q
        self.norm2 = (self.Q * self.Q).sum(1)
        self.k, self.best = k, [K.Best(min(SUB_BLOCK, len(self.Q) - a), k) for a in range(0, len(self.Q), SUB_BLOCK)]
        self.fits = [bool((self.norm2[rows] < K.NARROW ** 2).all()) for _, rows in self.slices()]
        self.kind = None

    def slices(self) -> list[tuple[K.Best, slice]]:
        return [(best, slice(a, a + best.n)) for best, a in zip(self.best, range(0, len(self.Q), SUB_BLOCK))]

    def read(self, items: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        col = lambda c: items.column(c).to_numpy(zero_copy_only=False)
        codes = np.frombuffer(b"".join(items.column("codes").to_pylist()), np.uint8).reshape(items.num_rows, -1)
        self.kind = items.column("id").type
        return K.sort_ids(items.column("id")), self.q.decode(col("cell"), codes), col("norm2"), col("error"), col("cell")

    def estimates(self, rows: slice, X: np.ndarray, norm2: np.ndarray) -> np.ndarray:
        return self.norm2[rows, None] + norm2 - 2 * (self.Q[rows] @ X.T)

    def screened(self, screen: K.Screen, B: np.ndarray, norm2: np.ndarray, counted: Callable) -> Iterator[tuple[K.Best, slice, slice, tuple | None]]:
        """Each portion of queries with each lot of items: the places that can be at most the
        queries' k-th score so far; none are named where single precision does not do."""
        for own, lot, size in screen.lots(B):
            fits = norm2[own].max() < K.NARROW ** 2 and size < 2 * K.NARROW ** 2
            for (best, rows), holds in zip(self.slices(), self.fits):
                qq, found = self.norm2[rows], None
                if fits and holds:
                    found = screen.pick(rows, lot, size, best.worst - qq, 1e-12 * (qq + norm2[own].max()), best.k,
                                        lambda free, S: counted(rows, own, free, S))
                    if len(found[0]) > best.n * max(4 * best.k, len(lot) // 4):
                        found = None
                yield best, rows, own, found


class _Shortlist(_Coded):
    """Of the probed cells' items each query's ``k`` with the smallest coded distance."""

    def __init__(self, held: pa.Table, q: Quantizer, k: int):
        super().__init__(held, q, k)
        bits = held.column("bits").to_pylist()
        self.first = held.column("first")[0].as_py()
        self.asked = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).view(bool)
        self.screen = K.Screen(np.hstack([-2 * self.Q, np.ones((len(self.Q), 1))]), SUB_BLOCK)

    def add(self, items: pa.RecordBatch) -> None:
        ids, X, norm2, _, cell = self.read(items)
        for own, _ in K.parted(norm2 < K.NARROW ** 2):
            self.meet(ids[own], X[own], norm2[own], cell[own])

    def meet(self, ids: np.ndarray, X: np.ndarray, norm2: np.ndarray, cell: np.ndarray) -> None:
        at = cell - self.first

        def counted(rows, own, free, S):
            S[~self.asked[rows.start + free][:, at[own]]] = np.inf
            return S
        for best, rows, own, found in self.screened(self.screen, np.hstack([X, norm2[:, None]]), norm2, counted):
            if found is None:
                d = self.estimates(rows, X[own], norm2[own])
                d[~self.asked[rows, :][:, at[own]]] = np.nan
                i, j = K._candidates(d, best.worst, best.k, np.zeros(best.n))
                best.add(i, d[i, j], ids[own][j], cell[own][j])
                continue
            i, j = found
            j += own.start
            asked = self.asked[rows.start + i, at[j]]
            i, j = i[asked], j[asked]
            d = K.of_pairs(lambda a, b: self.norm2[rows.start + a] + norm2[b] - 2 * np.einsum("ij,ij->i", self.Q.take(rows.start + a, 0), X.take(b, 0)), i, j)
            better = (d <= best.worst[i]) | ~best.full[i]
            best.add(i[better], d[better], ids[j[better]], cell[j[better]])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for best, rows in self.slices():
            kept = best.merge()
            if kept:
                row, near, ids, cell = kept
                yield pa.RecordBatch.from_arrays([self.qids.take(pa.array(rows.start + row)), K.given_ids(ids, self.kind), pa.array(cell, pa.int32()), pa.array(near)],
                                                 names=["qid", "id", "cell", "near"])


class _Needed(_Coded):
    """The items that can be among some query's ``k`` nearest: no nearer than its k-th far bound."""

    def __init__(self, held: pa.Table, q: Quantizer, k: int, tile: pa.Table):
        super().__init__(held, q, k)
        self.tile = [tile.column(c)[0] for c in ("blk", "qc")]

    def add(self, items: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, X, norm2, error, cell = self.read(items)
        needed = np.zeros(len(ids), bool)
        for best, rows in self.slices():
            d, off = self.estimates(rows, X, norm2), 2 * np.sqrt(self.norm2[rows])[:, None] * error
            i, j = K._candidates(d + off, best.worst, best.k, np.zeros(best.n))
            best.add(i, (d + off)[i, j], ids[j])
            if len(ids) >= best.k or best.full.any():
                best.merge()
            needed |= (d - off <= np.where(best.full, best.worst, np.inf)[:, None] + 1e-9).any(0)
        own = pa.array(np.flatnonzero(needed))
        n = len(own)
        yield pa.RecordBatch.from_arrays([pa.array([self.tile[0].as_py()] * n, pa.int32()), pa.array([self.tile[1].as_py()] * n, pa.int32()),
                                          items.column("cell").take(own), items.column("id").take(own)], names=["blk", "qc", "cell", "id"])

    def rows(self) -> Iterator[pa.RecordBatch]:
        return iter(())


class _Exact(_Coded):
    """Each query's ``k`` nearest among items read in full, of which the codes' bounds spare
    most pairs the exact work."""

    def __init__(self, held: pa.Table, q: Quantizer, k: int):
        super().__init__(held, q, k)
        self.far = 2 * np.sqrt(self.norm2)                      # what an estimate is off for each unit of error
        self.screen = K.Screen(np.hstack([-2 * self.Q, np.ones((len(self.Q), 1)), -self.far[:, None]]), SUB_BLOCK)

    def add(self, items: pa.RecordBatch) -> None:
        ids, X, norm2, error, _ = self.read(items)
        V = K.matrix(items.column("vec"), self.q.dim)
        for own, _ in K.parted((norm2 < K.NARROW ** 2) & (error < K.NARROW)):
            self.meet(ids[own], X[own], V[own], norm2[own], error[own])

    def meet(self, ids: np.ndarray, X: np.ndarray, V: np.ndarray, norm2: np.ndarray, error: np.ndarray) -> None:
        counted = lambda rows, own, free, S: S + 2 * self.far[rows][free, None] * error[own]
        for best, rows, own, found in self.screened(self.screen, np.hstack([X, norm2[:, None], error[:, None]]), norm2, counted):
            if found is None:
                d, off = self.estimates(rows, X[own], norm2[own]), self.far[rows, None] * error[own]
                far, limit = d + off, best.worst
                if far.shape[1] > best.k:
                    limit = np.minimum(limit, np.partition(far, best.k - 1, axis=1)[:, best.k - 1])
                found = np.nonzero(d - off <= limit[:, None] + 1e-9)
            i, j = found
            j += own.start

            def exact(a, b):
                apart = self.Q.take(rows.start + a, 0)
                apart -= V.take(b, 0)
                return np.einsum("ij,ij->i", apart, apart)
            s = K.of_pairs(exact, i, j)
            better = (s <= best.worst[i]) | ~best.full[i]
            best.add(i[better], s[better], ids[j[better]])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for best, rows in self.slices():
            kept = best.merge()
            if kept:
                row, score, ids = kept
                yield pa.RecordBatch.from_arrays([self.qids.take(pa.array(rows.start + row)), K.given_ids(ids, self.kind), pa.array(score)],
                                                 names=["qid", "item_id", "score"])


def _dealt(queries: DataFrame, items: DataFrame, block: int, blocks: int) -> tuple[DataFrame, tuple]:
    """Queries (side 0) and coded items (side 1), both with ``blk``, as tiles (blk, qc): the
    queries of a block are cut into chunks of about ``block`` rows, and each chunk meets all
    the block's items.  Also how ``over_tiles`` deals them."""
    sizes = queries.groupBy("blk").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("nq")).checkpoint()      # one row a block
    most = sizes.agg(F.max("nq")).first()[0] or 1
    sizes = broadcast_if_small(sizes, sizes.count() * 16)
    qt = queries.join(sizes, "blk").withColumn("qc", F.pmod(F.xxhash64("qid"), F.col("nq")).cast("int")).withColumn("side", F.lit(0)).drop("nq")
    it = items.join(sizes, "blk").withColumn("qc", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).withColumn("side", F.lit(1)).drop("nq")
    return qt.unionByName(it, allowMissingColumns=True), (blocks * most, F.col("blk") * most + F.col("qc"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("score", "item_id")
    return found.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def shortlisted(queries: DataFrame, path: str, probes: int, shortlist: int) -> DataFrame:
    """(qid, id, cell): of the probed cells' items the ``shortlist`` with the smallest
    coded distance.  Cells are dealt to blocks, and a query goes to the blocks that hold
    any of its cells: one a cell if it probes few, else as few as keep all tasks busy."""
    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    q, index = load_model(spark, path), rows_of(spark, path)
    cells, block = len(q.centroids), min(QUERY_BLOCK, max(SUB_BLOCK, K.KEPT // shortlist))
    n = queries.count()
    blocks = cells if 4 * probes <= cells else min(cells, -(-K._tasks(queries) // max(1, -(-n // block))))
    asked = probe(queries, q, probes, blocks).checkpoint()
    if n * probes <= 1000:                                      # a few cells: the others' folders are not listed into the scan
        on = [(r["first"], np.unpackbits(np.frombuffer(r["bits"], np.uint8))) for r in asked.select("first", "bits").collect()]
        index = index.where(F.col("cell").isin(sorted({int(first + c) for first, bits in on for c in np.flatnonzero(bits)})))
    blk = F.floor(((F.col("cell") + 1) * blocks - 1) / cells).cast("int").alias("blk")
    tiles, deal = _dealt(asked, index.select(blk, *CODED), block, blocks)
    kind = T.StructType([queries.schema["qid"], index.schema["id"], T.StructField("cell", T.IntegerType()), T.StructField("near", T.DoubleType())])
    part = K.over_tiles(tiles, ["blk", "qc"], ["qid", "qvec", "first", "bits"], CODED, lambda held: _Shortlist(held, q, shortlist), kind, deal)
    if blocks > 1:
        w = Window.partitionBy("qid").orderBy("near", "id")
        part = part.withColumn("r", F.row_number().over(w)).where(F.col("r") <= shortlist)
    return part.select("qid", "id", "cell")


def search(queries: DataFrame, path: str, k: int, probes: int, shortlist: int, short: DataFrame | None = None) -> DataFrame:
    """(qid, item_id, score, rank): approximate ``k`` nearest items of (qid, qvec) by
    squared distance, ties by id.  Exact within the shortlist; null vectors match nothing.
    ``short``: the rows of ``shortlisted`` for these arguments, if they are there already."""
    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    queries = queries.select("qid", "qvec").checkpoint()        # read for the shortlist and the re-rank
    item = F.struct("cell", "id")
    short = shortlisted(queries, path, probes, shortlist) if short is None else short
    short = short.select(F.col("qid").alias("lid"), item.alias("rid"), F.lit(None).cast("int").alias("value"))
    vectors = rows_of(spark, path).select(item.alias("rid"), F.col("vec").alias("rvec"))
    full = K.pair_scores(short, queries.select(F.col("qid").alias("lid"), F.col("qvec").alias("lvec")), vectors, K.SQUARED)
    return _ranked(full.where("score is not null").select(F.col("lid").alias("qid"), F.col("rid.id").alias("item_id"), "score"), k)


def search_exact(queries: DataFrame, path: str, k: int) -> DataFrame:
    """The exact ``k`` nearest: the codes' errors bound every distance, and only pairs
    whose bounds leave them a place are compared in full; no cell is passed over.  For at
    most ``FEW`` queries the codes alone are sent first, and vectors of the items that some
    query needs follow; many queries need nearly every item, and vectors come with the codes."""
    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    q, index = load_model(spark, path), rows_of(spark, path)
    asked = queries.select("qid", F.col("qvec").cast("array<double>").alias("qvec")).where("qid is not null and qvec is not null").checkpoint()
    n, block = asked.count(), min(QUERY_BLOCK, max(SUB_BLOCK, K.KEPT // k))
    blocks = max(1, -(-K._tasks(queries) // max(1, -(-n // block))))
    every = asked.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    blk = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("blk")
    found = T.StructType([queries.schema["qid"], T.StructField("item_id", index.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    exact = lambda tiles, deal: _ranked(K.over_tiles(tiles, ["blk", "qc"], ["qid", "qvec"], [*CODED, "vec"], lambda held: _Exact(held, q, k), found, deal), k)
    if n > FEW:
        items = index.select("cell", "id").join(index.select(*CODED, "vec"), ["cell", "id"])        # as below, where every item is needed
        return exact(*_dealt(every, items.select(blk, *CODED, "vec"), block, blocks))
    tiles, deal = _dealt(every, index.select(blk, *CODED), block, blocks)
    named = tiles.withColumn("own_blk", F.col("blk")).withColumn("own_qc", F.col("qc"))
    kind = T.StructType([T.StructField("blk", T.IntegerType()), T.StructField("qc", T.IntegerType()), T.StructField("cell", T.IntegerType()), index.schema["id"]])
    needed = K.over_tiles(named, ["blk", "qc"], ["qid", "qvec", "own_blk", "own_qc"], CODED,
                          lambda held: _Needed(held, q, k, held.select(["own_blk", "own_qc"]).rename_columns(["blk", "qc"])), kind, deal)
    full = needed.join(index.select(*CODED, "vec"), ["cell", "id"]).withColumn("side", F.lit(1))
    both = tiles.where("side = 0").select("blk", "qc", "side", "qid", "qvec").unionByName(full, allowMissingColumns=True)
    return exact(both, deal)
