"""M-6, content part: vectors for posts that nobody has interacted with yet.

Text vectors are brought to a few dimensions by a singular value decomposition, and a
ridge regression maps those to the learned factors of the posts that have them.  Both
need the data only through Gram matrices of a fixed, small size: each task adds up its
own with one matrix product a batch, and their sum is solved on the driver.  The length
of the data never matters there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import TOWER_DIM

BATCH = 4096


def _matrix(col: pa.ListArray) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(len(col), -1)


def gram(rows: DataFrame, col: str, dim: int) -> np.ndarray:
    """Sum of x xᵀ over a column of arrays of ``dim`` numbers (nulls are passed over)."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        G = np.zeros((dim, dim))
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                X = _matrix(b.column(0).slice(at, BATCH))
                G += X.T @ X
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(G.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [pdf["i"].iloc[0]], "row": [np.sum(np.stack(pdf["row"].to_numpy()), axis=0)]})
    parts = rows.select(F.col(col).cast("array<double>").alias("x")).where("x is not null").mapInArrow(part, "i int, row array<double>")
    got = parts.groupBy("i").applyInPandas(total, "i int, row array<double>").collect()      # dim rows of dim numbers
    out = np.zeros((dim, dim))
    for r in got:
        out[r["i"]] = r["row"]
    return out


def singular_vectors(rows: DataFrame, col: str, dim: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(V, s): the right singular vectors (dim x k) and singular values of the stacked
    rows, largest first; signs are fixed by each vector's largest component."""
    value, vector = np.linalg.eigh(gram(rows, col, dim))
    order = np.argsort(-value)[:k]
    V = vector[:, order]
    return V * np.sign(V[np.abs(V).argmax(0), np.arange(V.shape[1])]), np.sqrt(np.maximum(value[order], 0))


def ridge_map(pairs: DataFrame, x: str, y: str, dim_x: int, dim_y: int, penalty: float = 1.0) -> np.ndarray:
    """W ((dim_x + 1) x dim_y) that maps (x, 1) to y with the least squared error plus
    ``penalty`` times the squared weights (not of the constant)."""
    both = pairs.select(F.concat(F.col(x).cast("array<double>"), F.array(F.lit(1.0)), F.col(y).cast("array<double>")).alias("xy"))
    G = gram(both, "xy", dim_x + 1 + dim_y)
    A, B = G[:dim_x + 1, :dim_x + 1], G[:dim_x + 1, dim_x + 1:]
    return np.linalg.solve(A + np.diag(np.r_[np.full(dim_x, penalty), 1e-9]), B)


def mapped(rows: DataFrame, col: str, W: np.ndarray, out: str, constant: bool = False) -> DataFrame:
    """``rows`` with ``out`` = x W (or (x, 1) W); null where x is null."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    at = rows.columns.index(col)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                known = np.asarray(part.column(at).is_valid())
                X = _matrix(part.column(at).filter(pa.array(known))) if known.any() else np.zeros((0, len(W) - constant))
                Y = np.hstack([X, np.ones((len(X), 1))]) @ W if constant else X @ W
                lists, k = [None] * part.num_rows, iter(Y.tolist())
                for i in np.flatnonzero(known):
                    lists[i] = next(k)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.float64()))], names=[f.name for f in schema])
    return rows.mapInArrow(kernel, schema)


def content_factors(texts: DataFrame, factors: DataFrame, id_col: str = "post_id", dim: int = 384, k: int = TOWER_DIM,
                    rank: int = TOWER_DIM, penalty: float = 1.0) -> DataFrame:
    """(id, content_vector, vector, learned) of every id of ``texts`` (id, vector) and
    ``factors`` (id, vector): the text's ``k`` components, and the learned factors where
    there are any, else those that the text suggests.  An id with neither has no row; an
    id without a text has no content_vector."""
    V, _ = singular_vectors(texts, "vector", dim, k)
    small = mapped(texts.select(id_col, F.col("vector").cast("array<double>").alias("__t")), "__t", V, "content_vector").select(id_col, "content_vector")
    known = factors.select(id_col, F.col("vector").cast("array<double>").alias("__f"))
    W = ridge_map(small.where("content_vector is not null").join(known, id_col), "content_vector", "__f", k, rank, penalty)
    both = mapped(small.join(known, id_col, "full"), "content_vector", W, "__p", constant=True)
    return both.select(id_col, "content_vector", F.coalesce("__f", "__p").alias("vector"), F.col("__f").isNotNull().alias("learned")).where("vector is not null")
