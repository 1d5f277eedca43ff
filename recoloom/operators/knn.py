"""Exact vector retrieval without a users × items product (J-9, M-1, M-3, A-12).

Queries that probe a group (a category, or the catch-all group ``*``) are cut into
chunks of ~``query_block`` rows, and the group's items into as many segments as it
takes to keep all tasks busy, never smaller than ``item_block``.  A task holds the
queries of one (group, segment, chunk) tile and lets the tile's items stream past in
Arrow batches, keeping only the k best of each query (or counts).  Its memory is
bounded by the chunk, whatever the number of items, and what leaves it by the chunk
and k.  A final ``row_number() <= k`` merges groups and segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .sampling import broadcast_if_small

ALL = "*"
BATCH, KEPT = 4096, 1 << 21             # items scored at once; (query, item) places that a tile keeps
LIST_BYTES = 16 << 20                   # of an Arrow batch of lists of partners
ACROSS, NARROW = 1024, 1e15             # items and largest norm of a product in single precision
NO_ID = np.iinfo(np.int64).min          # a null id in sorts: first, as in Spark


def _tasks(df: DataFrame) -> int:
    return 2 * df.sparkSession.sparkContext.defaultParallelism


def _tile(queries: DataFrame, items: DataFrame, query_groups: DataFrame | None, item_block: int, query_block: int) -> tuple[DataFrame, tuple | None]:
    """Queries (side 0) and items (side 1) keyed by their tiles (g, blk, qc), and how
    ``over_tiles`` deals them, where their numbers are known."""
    # sizes decide the tiles: both inputs are written once, so that counting them
    # does not run their plans a second time
    ensure_checkpoint_dir(items.sparkSession)
    items, q = items.checkpoint(), queries.checkpoint()
    extra = [c for c in items.columns if c != "g"]
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    blocks = lambda n, block: F.greatest(F.lit(1), F.ceil(n / block)).cast("int")
    if query_groups is None:
        # one group: segment and chunk counts are two numbers, decided on the driver
        nq = max(1, -(-q.count() // query_block))
        nb = max(1, min(-(-items.count() // item_block), -(-_tasks(items) // nq)))
        size = lambda df: df.select(F.lit(0).cast("long").alias("g"), F.lit(nb).alias("nb"), F.lit(nq).alias("nq"), "*")
        it, qt = size(items), size(q)
        deal = (nb * nq, F.col("blk") * nq + F.col("qc"))
    else:
        deal = None
        qg = query_groups.select("qid", F.col("g").cast("string").alias("g"))
        # the catch-all group holds every item, for queries without a filter
        it = items.select(F.col("g").cast("string").alias("g"), *extra)
        it = it.unionByName(items.select(F.lit(ALL).alias("g"), *extra))
        n = F.count(F.lit(1))
        sizes = (it.groupBy("g").agg(blocks(n, item_block).alias("most"))
                 .join(qg.groupBy("g").agg(blocks(n, query_block).alias("nq")), "g")
                 .withColumn("number", F.monotonically_increasing_id()).checkpoint())          # one row per group
        at = sizes.agg(F.sum("nq"), F.count(F.lit(1))).first()
        sizes = sizes.withColumn("nb", F.least("most", F.lit(-(-_tasks(items) // max(1, at[0] or 0))))).drop("most")
        sizes = broadcast_if_small(sizes, at[1] * 64)
        it = it.join(sizes, "g").drop("g").withColumnRenamed("number", "g")
        qt = qg.join(sizes, "g").drop("g").withColumnRenamed("number", "g").join(q, "qid")
    it = it.select("g", own("item_id", "nb").alias("blk"), each("nq").alias("qc"), F.lit(1).alias("side"), *extra)
    qt = qt.withColumn("qc", own("qid", "nq")).select("g", each("nb").alias("blk"), "qc", F.lit(0).alias("side"), *q.columns)
    return qt.unionByName(it, allowMissingColumns=True), deal


def over_tiles(tiles: DataFrame, key: list[str], queries: list[str], items: list[str], begin: Callable, schema: T.StructType,
               deal: tuple[int, Column] | None = None) -> DataFrame:
    """Each tile of ``tiles`` (integer ``key`` columns, side, query and item columns) worked
    on as a stream: ``begin(held)`` gets its queries (side 0) as a table and returns an
    object whose ``add(batch)`` gets the items a batch at a time and whose ``rows()``
    yields the tile's record batches.  ``add`` may return batches, too.  ``deal``: so many
    tiles, and the number of a row's tile; tiles then go to tasks in turn, else by hash."""
    n = len(key) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, work = None, [], None
        for b in batches:
            cols = [np.asarray(b.column(i)) for i in range(n)]
            change = np.zeros(max(0, b.num_rows - 1), bool)
            for c in cols:
                change |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1), b.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                now, side = tuple(int(c[x]) for c in cols[:-1]), int(cols[-1][x])
                if now != tile:
                    if work is not None:
                        yield from work.rows()
                    tile, held, work = now, [], None
                part = b.slice(x, y - x)
                if side == 0:
                    held.append(part.select(queries))
                elif held or work is not None:                  # items that no query of the tile asks for are passed over
                    if work is None:
                        work, held = begin(pa.Table.from_batches(held).combine_chunks()), []
                    for at in range(0, part.num_rows, BATCH):
                        yield from work.add(part.slice(at, BATCH).select(items)) or ()
        if work is not None:
            yield from work.rows()
    cols = [*key, "side", *queries, *items]
    rows = tiles.select(*cols)
    if deal:
        most = max(2 * _tasks(tiles), int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.repartitionById(max(1, min(deal[0], most)), deal[1].cast("int"))
    else:
        rows = rows.repartition(*key)
    return rows.sortWithinPartitions(*key, "side").mapInArrow(run, schema)


def matrix(col: pa.Array, dim: int | None = None) -> np.ndarray:
    """The rows of a list column as doubles; null components are not a number."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    X = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dim = dim if dim is not None else len(X) // max(1, len(col))
    if len(X) != dim * len(col) or (np.diff(np.asarray(col.offsets)) != dim).any():
        raise ValueError(f"expected vectors of {dim} dimensions")
    return X.reshape(len(col), dim)


def sort_ids(col: pa.Array) -> np.ndarray:
    """Ids that sort as Spark sorts them; ``given_ids`` takes them back."""
    if pa.types.is_integer(col.type):
        return col.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    return np.array(["" if v is None else f"{v}" for v in col.to_pylist()], dtype=object) if pa.types.is_string(col.type) else col.to_numpy(zero_copy_only=False)


def given_ids(ids: np.ndarray, kind: pa.DataType) -> pa.Array:
    if pa.types.is_integer(kind):
        return pa.array(ids, pa.int64(), mask=ids == NO_ID).cast(kind)
    return pa.array(ids, kind)


class Best:
    """The k smallest (score, id) of each of n rows, of candidates that come in lots.  Lots
    are merged when they have grown to half the size of what is kept."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.worst = np.full(n, np.inf)                         # of a full row: its k-th score
        self.full = np.zeros(n, bool)
        self.lots, self.waiting = [], 0

    def add(self, row: np.ndarray, score: np.ndarray, *rest: np.ndarray) -> None:
        """``rest``: the ids, then what else belongs to the candidate."""
        if len(row):
            self.lots.append((row, score, *rest))
            self.waiting += len(row)
            if self.waiting > self.n * self.k // 2 or not self.full.all():
                self.trim()

    def trim(self) -> None:
        """As ``merge``, but what ties with a row's k-th score stays, and nothing is sorted
        by it; where much ties, or one row has most of the candidates, all is merged."""
        row, score, *rest = (np.concatenate(c) for c in zip(*self.lots))
        order = np.argsort(row.astype(np.uint16) if self.n <= 1 << 16 else row, kind="stable")
        row, score = row[order], score[order]
        size = np.bincount(row, minlength=self.n)
        width = max(self.k, size.max())
        if self.n * width > 4 * max(len(row), self.n * self.k):
            self.merge()
            return
        by_row = np.full((self.n, width), np.inf)
        by_row[row, np.arange(len(row)) - (np.cumsum(size) - size)[row]] = score
        kth = np.partition(by_row, self.k - 1, axis=1)[:, self.k - 1]
        keep = score <= kth[row]
        if keep.sum() > 1.5 * self.n * self.k:
            self.merge()
            return
        self.full = size >= self.k
        self.worst = np.where(self.full, kth, np.inf)
        self.lots, self.waiting = [(row[keep], score[keep], *(c[order[keep]] for c in rest))], 0

    def merge(self) -> tuple[np.ndarray, ...]:
        if not self.lots:
            return ()
        row, score, *rest = (np.concatenate(c) for c in zip(*self.lots))
        ids = rest[0] if rest[0].dtype != object else np.unique(rest[0], return_inverse=True)[1]
        order = np.lexsort((ids, score, row))
        row = row[order]
        start = np.searchsorted(row, np.arange(self.n))
        place = np.arange(len(row)) - start[row]
        keep = place < self.k
        kept = (row[keep], *(c[order][keep] for c in (score, *rest)))
        last = place[keep] == self.k - 1
        self.worst[kept[0][last]], self.full[kept[0][last]] = kept[1][last], True
        self.lots, self.waiting = [kept], 0
        return kept


def _candidates(S: np.ndarray, limit: np.ndarray, k: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the scores that can be among their row's k smallest: at most ``limit``, and
    at most the block's own k-th, each with ``slack`` for rounding."""
    mask = S <= (limit + slack)[:, None]
    many = np.flatnonzero(mask.sum(1) > 4 * k)
    if len(many) and S.shape[1] > k:
        kth = np.partition(S[many], k - 1, axis=1)[:, k - 1] + slack[many]
        mask[many] &= S[many] <= kth[:, None]
    return np.nonzero(mask)


class Screen:
    """Which inner products of the rows of ``A`` with those of a lot can be at most a limit, by
    matrix products in single precision.  What these can be off is allowed for, so no
    place is missed; callers score the picked places from the components."""

    def __init__(self, A: np.ndarray, sub: int):
        with np.errstate(over="ignore"):
            self.A, self.size = A.astype(np.float32), np.sqrt(np.einsum("ij,ij->i", A, A))
        self.S, self.mask = np.empty(sub * ACROSS, np.float32), np.empty(sub * ACROSS, bool)

    def lots(self, B: np.ndarray) -> Iterator[tuple[slice, np.ndarray, float]]:
        """The rows of ``B`` in lots: which, in single precision, and the largest norm."""
        with np.errstate(over="ignore"):                        # callers do not use lots that do not fit
            narrow, size = B.astype(np.float32), np.sqrt(np.einsum("ij,ij->i", B, B))
        for at in range(0, len(B), ACROSS):
            own = slice(at, min(len(B), at + ACROSS))
            yield own, narrow[own], size[own].max()

    def pick(self, rows: slice, lot: np.ndarray, top: float, limit: np.ndarray, slack: np.ndarray, k: int,
             counted: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, place): at most the row's ``limit`` and ``slack``; where that is infinite, at most
        the k-th of the lot.  ``counted(open, S)``: the products by which it is the k-th."""
        n, m = rows.stop - rows.start, len(lot)
        S, mask = self.S[:n * m].reshape(n, m), self.mask[:n * m]
        np.matmul(self.A[rows], lot.T, out=S)
        # a product of d terms is off by at most about d + 2 roundings of 2^-24, relative to the norms
        off = 2.0 ** -23 * (self.A.shape[1] + 4) * self.size[rows] * top + slack + 1e-30
        most, free = limit + off, np.flatnonzero(~np.isfinite(limit))
        if len(free) and m > k:
            part = S[free] if counted is None else counted(free, S[free])
            most[free] = np.partition(part, k - 1, axis=1)[:, k - 1] + 2 * off[free]
        np.less_equal(S, np.nextafter(most.astype(np.float32), np.float32(np.inf))[:, None], out=mask.reshape(n, m))
        if len(mask) % 8:
            place = np.flatnonzero(mask)
        else:                                                   # most are not: eight are passed over at a time
            some = np.flatnonzero(mask.view(np.uint64))
            a, b = np.nonzero(mask.reshape(-1, 8)[some])
            place = some[a] * 8 + b
        return (place >> 10, place & 1023) if m == 1 << 10 else np.divmod(place, m)


def parted(fits: np.ndarray) -> Iterator[tuple[slice | np.ndarray, bool]]:
    """The places that fit, and those that do not, where there are any."""
    if fits.all():
        yield slice(None), True
        return
    for some, which in ((fits, True), (~fits, False)):
        if some.any():
            yield np.flatnonzero(some), which


def of_pairs(score: Callable, i: np.ndarray, j: np.ndarray, step: int = 512) -> np.ndarray:
    """``score`` of the pairs, in portions whose vectors stay in the cache."""
    s = np.empty(len(i))
    for at in range(0, len(i), step):
        s[at:at + step] = score(i[at:at + step], j[at:at + step])
    return s


class _Nearest:
    """Tile of ``knn``: matrix products pick the candidates of a batch of items, whose scores
    are then taken from the components, so equal vectors score the same in any tile.
    Queries and items that single precision cannot hold are met in double precision."""

    def __init__(self, held: pa.Table, k: int, metric: str, sub_block: int, decimals: int | None, kind: pa.DataType, names: list[str]):
        self.qids, self.Q = held.column(0).combine_chunks(), matrix(held.column(1))
        self.k, self.l2, self.sub, self.decimals, self.kind, self.names = k, metric == "l2", sub_block, decimals, kind, names
        self.norm2 = (self.Q * self.Q).sum(1)
        order = np.argsort(~(self.norm2 < NARROW ** 2), kind="stable")              # those that do not fit are last
        self.narrow = int((self.norm2 < NARROW ** 2).sum())
        if self.narrow < len(order):
            self.qids, self.Q, self.norm2 = self.qids.take(pa.array(order)), self.Q[order], self.norm2[order]
        ends = [*range(0, self.narrow, sub_block), *range(self.narrow, len(self.Q), sub_block), len(self.Q)]
        self.slices = [slice(a, b) for a, b in zip(ends, ends[1:])]
        self.best = [Best(x.stop - x.start, k) for x in self.slices]
        self.screen = Screen(self.wide(slice(0, self.narrow)), sub_block)

    def wide(self, rows: slice) -> np.ndarray:
        Q = self.Q[rows]
        return np.hstack([-2 * Q, np.ones((len(Q), 1))]) if self.l2 else -Q

    def scores(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        if self.l2:
            apart = q - x
            s = np.einsum("ij,ij->i", apart, apart)
        else:
            s = -np.einsum("ij,ij->i", q, x)
        return s if self.decimals is None else np.round(s, self.decimals)

    def add(self, items: pa.RecordBatch) -> None:
        ids, X = sort_ids(items.column(0)), matrix(items.column(1), self.Q.shape[1])
        x2 = (X * X).sum(1)
        for own, fits in parted(x2 < NARROW ** 2):
            self.meet(ids[own], X[own], x2[own], fits)

    def meet(self, ids: np.ndarray, X: np.ndarray, x2: np.ndarray, fits: bool) -> None:
        wide = np.hstack([X, x2[:, None]]) if self.l2 else X
        extra = 0 if self.decimals is None else 2 * 10.0 ** -self.decimals
        for own, lot, size in self.screen.lots(wide):
            top = x2[own].max()
            top = top if np.isfinite(top) else np.nanmax(np.where(np.isfinite(x2[own]), x2[own], 0))
            for best, rows in zip(self.best, self.slices):
                qq = self.norm2[rows]
                limit = best.worst - qq if self.l2 else best.worst
                i, many = None, 4 * best.n * max(self.k, len(lot) // 64)
                if fits and rows.stop <= self.narrow:
                    i, j = self.screen.pick(rows, lot, size, limit, 1e-12 * (qq + top) + extra, self.k)
                if i is None or len(i) > many and len(lot) > self.k:
                    S = self.wide(rows) @ wide[own].T
                    S[np.isnan(S)] = np.inf
                    i, j = _candidates(S, limit, self.k, 1e-9 * (np.where(np.isfinite(qq), qq, 0) + top) + extra)
                j += own.start
                s = of_pairs(lambda a, b: self.scores(self.Q.take(rows.start + a, 0), X.take(b, 0)), i, j)
                s[np.isnan(s)] = np.inf
                better = (s <= best.worst[i]) | ~best.full[i]
                best.add(i[better], s[better], ids[j[better]])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for best, rows in zip(self.best, self.slices):
            kept = best.merge()
            if kept:
                row, score, ids = kept
                score = np.where(np.isinf(score), np.nan, score if self.l2 else -score)
                yield pa.RecordBatch.from_arrays([self.qids.take(pa.array(rows.start + row)), given_ids(ids, self.kind), pa.array(score)], names=self.names)


def knn(queries: DataFrame, items: DataFrame, k: int, metric: str = "l2",
        query_groups: DataFrame | None = None, item_block: int = 16384,
        query_block: int = 16384, sub_block: int = 512, decimals: int | None = None,
        once_per_query: bool = False) -> DataFrame:
    """Top-k items per query.

    Null vectors match nothing.  ``once_per_query``: items are filed under several
    groups and count once per query.  ``decimals`` rounds scores before they are compared.

    ``queries``: (qid, qvec); ``items``: (item_id, ivec[, g]); ``query_groups``:
    optional (qid, g) pre-filter rows (a query with no rows sees nothing; use
    g='*' alone for "no filter" — '*' already covers every group, so it is
    never listed together with other groups, and each item lives in one
    group, so no item reaches a query twice).  ``metric``: 'l2' (squared
    Euclidean, ascending) or 'ip' (inner product, descending).  Output
    (qid, item_id, score, rank); ties broken by item_id.

    A tile keeps at most ``KEPT`` places, so a large k has smaller chunks of queries; it
    scores ``sub_block`` queries against ``BATCH`` items at once.
    """
    item_cols = ["item_id", "ivec", *(["g"] if query_groups is not None else [])]
    tiles, deal = _tile(queries.select("qid", "qvec").where("qvec is not null"), items.select(*item_cols).where("ivec is not null"),
                        query_groups, item_block, min(query_block, max(sub_block, KEPT // k)))
    schema = T.StructType([T.StructField("qid", queries.schema["qid"].dataType), T.StructField("item_id", items.schema["item_id"].dataType),
                           T.StructField("score", T.DoubleType())])
    names = [f.name for f in schema]

    class Start:
        """The type of the ids is known with the first items."""
        def __init__(self, held):
            self.held, self.work = held, None

        def add(self, batch):
            if self.work is None:
                self.work = _Nearest(self.held, k, metric, sub_block, decimals, batch.column(0).type, names)
                self.held = None
            self.work.add(batch)

        def rows(self):
            return self.work.rows() if self.work else iter(())

    part = over_tiles(tiles, ["g", "blk", "qc"], ["qid", "qvec"], ["item_id", "ivec"], Start, schema, deal)
    if once_per_query:
        part = part.groupBy("qid", "item_id").agg(F.min("score").alias("score"))
    order_col = F.col("score") if metric == "l2" else F.col("score").desc()
    w = Window.partitionBy("qid").orderBy(order_col, F.col("item_id"))
    return (part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("bigint")))


class _Better:
    """Tile of ``count_better``: each threshold's count grows by the items above it."""

    def __init__(self, held: pa.Table, sub_block: int, names: list[str]):
        self.qids, self.Q, self.sub, self.names = held.column(0).combine_chunks(), matrix(held.column(1)), sub_block, names
        self.given = [np.asarray(v, np.float64) for v in held.column(2).to_pylist()]
        self.order = [np.argsort(t, kind="stable") for t in self.given]
        self.limits = [t[o] + 1e-12 for t, o in zip(self.given, self.order)]
        self.above = [np.zeros(len(t) + 1, np.int64) for t in self.given]       # items above so many of the thresholds

    def add(self, items: pa.RecordBatch) -> None:
        X = matrix(items.column(0), self.Q.shape[1])
        for a in range(0, len(self.Q), self.sub):
            for i, row in enumerate(self.Q[a:a + self.sub] @ X.T, a):
                self.above[i] += np.bincount(np.searchsorted(self.limits[i], row, side="left"), minlength=len(self.above[i]))

    def rows(self) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.Q), self.sub):
            at, pos, n = [], [], []
            for i in range(a, min(a + self.sub, len(self.Q))):
                at.append(np.full(len(self.order[i]), i))
                pos.append(self.order[i])
                n.append(self.above[i][::-1].cumsum()[::-1][1:])
            yield pa.RecordBatch.from_arrays([self.qids.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(pos).astype(np.int32)),
                                              pa.array(np.concatenate(n))], names=self.names)


def count_better(queries: DataFrame, items: DataFrame, item_block: int = 16384,
                 query_block: int = 8192, sub_block: int = 512) -> DataFrame:
    """For each query (qid, qvec, thresholds): how many items have an inner product
    strictly above each of its thresholds — the exact ranks of a query's true items
    over the whole catalogue without forming pairs (A-12).  A tile scores a query
    once, whatever the number of its thresholds.  Output (qid, pos, n_better)."""
    tiles, deal = _tile(queries.select("qid", "qvec", "thresholds").where("qvec is not null"),
                        items.select("item_id", "ivec").where("ivec is not null"), None, item_block, query_block)
    schema = T.StructType([T.StructField("qid", queries.schema["qid"].dataType), T.StructField("pos", T.IntegerType()),
                           T.StructField("n_better", T.LongType())])
    names = [f.name for f in schema]
    part = over_tiles(tiles, ["g", "blk", "qc"], ["qid", "qvec", "thresholds"], ["ivec"], lambda held: _Better(held, sub_block, names), schema, deal)
    return part.groupBy("qid", "pos").agg(F.sum("n_better").alias("n_better"))


COSINE, DOT, SQUARED = "cosine", "dot", "squared"


def _measure(kind: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if kind == SQUARED:
        return np.einsum("ij,ij->i", a - b, a - b)
    dot = np.einsum("ij,ij->i", a, b)
    if kind == DOT:
        return dot
    size = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
    return np.divide(dot, size, out=np.zeros(len(dot)), where=size != 0)


def pair_scores(pairs: DataFrame, left: DataFrame, right: DataFrame, kind: str, chunk: int = 32768) -> DataFrame:
    """Rows (lid, rid, value) of ``pairs`` with ``score``: the ``kind`` of measure between
    the vectors of ``left`` (lid, lvec) and ``right`` (rid, rvec), one row an id; null
    where a vector is missing or of another length.  Vectors are not sent along with each pair: the left
    ids are dealt into chunks, a chunk gets its own vectors once and of the other side
    each vector that it needs once, with the list of its partners."""
    ensure_checkpoint_dir(pairs.sparkSession)
    pairs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(LIST_BYTES))     # lists may be long
    rows = left.count()
    n = max(1, -(-rows // chunk), min(_tasks(pairs), rows // 512))
    own: Column = F.pmod(F.xxhash64("lid"), F.lit(n)).cast("int").alias("chunk")
    some = {f.name: f.dataType for f in pairs.schema}
    lists = pairs.select(own, "rid", F.struct("lid", "value").alias("one")).groupBy("chunk", "rid").agg(F.collect_list("one").alias("many"))
    tiles = (left.where("lid is not null and lvec is not null").select(own, F.lit(0).alias("side"), "lid", "lvec")
             .unionByName(lists.join(right.where("rvec is not null").select("rid", "rvec"), "rid", "left")
                          .select("chunk", F.lit(1).alias("side"), "rid", "rvec", "many"), allowMissingColumns=True))
    schema = T.StructType([T.StructField("lid", some["lid"]), T.StructField("rid", some["rid"]), T.StructField("value", some["value"]),
                           T.StructField("score", T.DoubleType())])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk_no, held, index, L = None, [], None, None
        for b in batches:
            no, side = np.asarray(b.column(0)), np.asarray(b.column(1))
            cuts = [0, *(np.flatnonzero((no[1:] != no[:-1]) | (side[1:] != side[:-1])) + 1), b.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if no[x] != chunk_no:
                    chunk_no, held, index = no[x], [], None
                part = b.slice(x, y - x)
                if side[x] == 0:
                    held.append(part.select(["lid", "lvec"]))
                    continue
                if index is None:
                    t = pa.Table.from_batches(held).combine_chunks() if held else None
                    index = pd.Index(sort_ids(t.column(0).combine_chunks())) if t is not None else pd.Index([])
                    L, held = matrix(t.column(1)) if t is not None else np.zeros((0, 0)), []
                for at in range(0, part.num_rows, 1024):
                    yield from scored(part.slice(at, 1024), index, L)

    def scored(part: pa.RecordBatch, index: pd.Index, L: np.ndarray) -> Iterator[pa.RecordBatch]:
        many, rvec = part.column("many"), part.column("rvec")
        known = np.asarray(rvec.is_valid())
        known &= pc.fill_null(pc.list_value_length(rvec), -1).to_numpy(zero_copy_only=False) == L.shape[1]
        R = np.zeros((part.num_rows, L.shape[1]))
        if known.any() and len(L):
            R[known] = matrix(rvec.filter(pa.array(known)), L.shape[1])
        row = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(many.offsets)))
        flat = many.flatten()
        lid = flat.field("lid")
        at = index.get_indexer(sort_ids(lid)) if len(index) else np.full(len(lid), -1)
        for a in range(0, len(row), 1 << 16):
            r, x = row[a:a + (1 << 16)], at[a:a + (1 << 16)]
            ok = (x >= 0) & known[r]
            s = np.zeros(len(r))
            if ok.any():
                s[ok] = _measure(kind, L[x[ok]], R[r[ok]])
            yield pa.RecordBatch.from_arrays([lid.slice(a, len(r)), part.column("rid").take(pa.array(r)), flat.field("value").slice(a, len(r)),
                                              pa.array(s, mask=~ok)], names=names)
    return (tiles.select("chunk", "side", "lid", "lvec", "rid", "rvec", "many").repartition("chunk").sortWithinPartitions("chunk", "side")
            .mapInArrow(run, schema))
