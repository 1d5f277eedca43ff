"""Text search by an inverted index behind a pluggable encoder (U-1, X-36).

An encoder turns texts into sparse rows (key, bucket, value).  Documents are dealt to
shards of bounded size; within a shard every bucket has one posting list, strongest
value first, with its largest and smallest value.  A query reads its buckets' lists in
the order of what they can still add to a score.  Once the lists not yet read can no
longer lift an unlikely document to the k-th place, the few documents left are scored
exactly and the other lists stay unread.

Each query is first answered by one shard, of as few shards as keep the queries spread.
Its k-th score there bounds the k-th score overall from below, so that the other shards
stop early, or at once where all their lists together cannot reach it.  Results equal those of scoring every pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ensure_checkpoint_dir
from .textvec import entries

Encoder = Callable[[DataFrame, str, str], DataFrame]       # (rows, key, text) -> (key, bucket, value)
Model = Callable[[list[str]], list[tuple[np.ndarray, np.ndarray]]]

SHARD_DOCS = 16384                      # documents of a shard, on average
QUERY_CHUNK = 4096                      # queries that meet a shard in one task, on average
HOME_QUERIES = 64                       # queries that are first answered by the same shard, on average
FEW = 64                                # documents that are scored exactly rather than read on for

_LOADED: dict[str, Model] = {}


def loaded(name: str, load: Callable[[], Model]) -> Model:
    """The model of that name, loaded at its first use in a Python worker."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def worker_rows(name: str, load: Callable[[], Model]) -> Encoder:
    """An encoder around a model that each Python worker loads once, under ``name``: one
    row (key, buckets, values) a text.  The model takes a batch of texts and returns
    (buckets, values) of each; null texts are not given to it and have no rows.  Zero and
    non-finite values are left out."""
    def encode(rows: DataFrame, key: str, text: str) -> DataFrame:
        kind = rows.schema[key].dataType
        arrow = to_arrow_type(kind)

        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = loaded(name, load)
            for b in batches:
                got = model(b.column(1).to_pylist())
                n = np.array([len(x) for x, _ in got], np.int64)
                buckets = np.concatenate([np.empty(0, np.int64), *[x for x, _ in got]]).astype(np.int64)
                values = np.concatenate([np.empty(0), *[v for _, v in got]]).astype(np.float64)
                keep = np.isfinite(values) & (values != 0)
                ends = np.r_[0, np.cumsum(np.bincount(np.repeat(np.arange(len(got)), n)[keep], minlength=len(got)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow), pa.ListArray.from_arrays(ends, buckets[keep]),
                                                  pa.ListArray.from_arrays(ends, values[keep])], names=[key, "buckets", "values"])
        schema = T.StructType([T.StructField(key, kind), T.StructField("buckets", T.ArrayType(T.LongType())),
                               T.StructField("values", T.ArrayType(T.DoubleType()))])
        return rows.select(key, text).where(F.col(text).isNotNull()).mapInArrow(kernel, schema)
    return encode


def worker_encoder(name: str, load: Callable[[], Model]) -> Encoder:
    """``worker_rows`` with a row (key, bucket, value) for each entry."""
    encode = worker_rows(name, load)
    return lambda rows, key, text: entries(encode(rows, key, text), key)


def letter_triples(dim: int) -> Model:
    """Hashed triples of neighbouring code points, ln(1 + count), at unit length."""
    def model(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for t in texts:
            c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            n = np.bincount((c[:-2] * 961 + c[1:-1] * 31 + c[2:]) % dim, minlength=dim) if len(c) > 2 else np.zeros(dim)
            at = np.flatnonzero(n)
            w = np.log1p(n[at])
            out.append((at, w / np.sqrt((w * w).sum()) if len(at) else w))
        return out
    return model


def build_index(vectors: DataFrame, key: str, n_docs: int, path: str, shard_docs: int = SHARD_DOCS) -> None:
    """Write posting lists to ``path``: one row per (shard, bucket) with the documents
    and values, strongest first.  ``vectors``: (key, bucket, value), or a text's entries in
    one row (key, buckets, values), which is less to shuffle.  Documents are dealt to shards
    by their key's hash and a shard is turned around in one task, so a bucket that every
    text has is many lists.  Rows with a null key cannot be found and are left out."""
    shards = max(1, -(-n_docs // shard_docs))
    whole = "buckets" in vectors.columns
    rows = vectors.where(F.col(key).isNotNull() & (F.size("buckets") > 0 if whole else F.col("value") != 0))
    kind = vectors.schema[key].dataType

    def lists(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, [(key, "ascending")])).combine_chunks()
        keys, buckets, values = (pa.concat_arrays(c.chunks) for c in t.columns[1:])
        row = np.arange(t.num_rows)
        if whole:
            row = np.repeat(row, np.diff(np.asarray(buckets.offsets)))
            buckets, values = buckets.flatten(), values.flatten()
        keep = np.asarray(values.is_valid()) & np.asarray(buckets.is_valid())
        value = values.fill_null(0.0).to_numpy(zero_copy_only=False)
        keep &= value != 0
        row, value, bucket = row[keep], value[keep], buckets.fill_null(0).to_numpy(zero_copy_only=False)[keep]
        names, bucket = np.unique(bucket, return_inverse=True)
        bucket = bucket.reshape(-1).astype(np.min_scalar_type(max(1, len(names))))
        order = np.argsort(-value, kind="stable")               # equal values stay in the order of the keys
        order = order[np.argsort(bucket[order], kind="stable")]
        ends = np.r_[0, np.cumsum(np.bincount(bucket, minlength=len(names)))].astype(np.int32)
        return pa.Table.from_arrays([pa.array(np.full(len(names), t.column(0)[0].as_py(), np.int32)), pa.array(names.astype(np.int64)),
                                     pa.ListArray.from_arrays(ends, keys.take(pa.array(row[order]))),
                                     pa.ListArray.from_arrays(ends, value[order])], names=["shard", "bucket", "docs", "values"])

    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.LongType()),
                           T.StructField("docs", T.ArrayType(kind)), T.StructField("values", T.ArrayType(T.DoubleType()))])
    dealt = rows.select(F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"), key, *(["buckets", "values"] if whole else ["bucket", "value"]))
    dealt.groupBy("shard").applyInArrow(lists, schema).write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Shard:
    """One shard's posting lists, and the same entries by document."""

    def __init__(self, buckets: np.ndarray, docs: list[np.ndarray], values: list[np.ndarray]):
        order = np.argsort(buckets)
        self.buckets = np.asarray(buckets)[order]
        size = np.array([len(docs[i]) for i in order])
        self.ids, at = np.unique(np.concatenate([docs[i] for i in order]), return_inverse=True)
        self.ends = np.cumsum(size)
        self.docs = at.reshape(-1)
        self.values = np.concatenate([values[i] for i in order])
        self.top, self.low = self.values[self.ends - size], self.values[self.ends - 1]
        by_doc = np.argsort(self.docs, kind="stable")           # within a document by bucket
        self.doc_bucket = np.repeat(np.arange(len(size)), size)[by_doc]
        self.doc_value = self.values[by_doc]
        self.doc_ends = np.cumsum(np.bincount(self.docs, minlength=len(self.ids)))
        self.starts = self.ends - size

    def search(self, buckets: np.ndarray, weights: np.ndarray, k: int, floor: float, decimals: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, postings read) of the k best documents that share a bucket with
        the query and score at least ``floor``, ties by id; scores are rounded first."""
        where = np.searchsorted(self.buckets, buckets)
        where[where == len(self.buckets)] = 0
        known = (self.buckets[where] == buckets) & (weights != 0)
        at, w = where[known], weights[known]
        edge = np.stack([w * self.top[at], w * self.low[at], np.zeros(len(w))])
        up, down = edge.max(0), edge.min(0)
        order = np.argsort(-(up - down), kind="stable")
        at, w = at[order], w[order]
        rest_up = np.r_[np.cumsum(up[order][::-1])[::-1], 0.0]  # what lists i, i + 1, ... can add
        rest_down = np.r_[np.cumsum(down[order][::-1])[::-1], 0.0]
        slack = 2.0 * 10.0 ** -decimals
        score, seen = np.zeros(len(self.ids)), np.zeros(len(self.ids), bool)
        few, read, best = max(FEW, 2 * k), 0, 0.0
        alive = None
        for i, (t, x) in enumerate(zip(at, w)):
            if best + rest_up[i] < floor - slack:
                return self.ids[:0], score[:0], read
            own = slice(self.starts[t], self.ends[t])
            score[self.docs[own]] += x * self.values[own]
            seen[self.docs[own]] = True
            read += own.stop - own.start
            got = score[seen]
            if len(got) >= k:
                floor = max(floor, np.partition(got, len(got) - k)[len(got) - k] + rest_down[i + 1])
            best = max(0.0, got.max())
            alive = score >= floor - rest_up[i + 1] - slack
            if np.count_nonzero(alive) <= few:
                break
        if alive is None:
            return self.ids[:0], score[:0], read
        left = np.flatnonzero(alive)
        full = np.zeros(len(self.buckets))
        full[at] = w
        hit = np.zeros(len(self.buckets), bool)
        hit[at] = True
        first, last = np.r_[0, self.doc_ends][left], self.doc_ends[left]
        n = last - first
        entry = np.arange(n.sum()) + np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n)
        owner = np.repeat(np.arange(len(left)), n)
        exact = np.bincount(owner, full[self.doc_bucket[entry]] * self.doc_value[entry], len(left))
        shares = np.bincount(owner, hit[self.doc_bucket[entry]], len(left)) > 0
        exact = np.round(exact, decimals)
        keep = shares & (exact >= floor - slack)
        left, exact = left[keep], exact[keep]
        pick = np.lexsort((left, -exact))[:k]
        return self.ids[left[pick]], exact[pick], read


def _visit(queries: DataFrame, index: DataFrame, chunks: int, k: int, decimals: int, qtype: T.DataType, dtype: T.DataType) -> DataFrame:
    """(qid, doc_id, score): each query's best documents of the shard it is sent to."""
    schema = T.StructType([T.StructField("qid", qtype), T.StructField("doc_id", dtype), T.StructField("score", T.DoubleType())])

    def kernel(qdf: pd.DataFrame, idf: pd.DataFrame) -> pd.DataFrame:
        q, d, s = [], [], []
        if len(qdf) and len(idf):
            shard = Shard(idf["bucket"].to_numpy(), [np.asarray(x) for x in idf["docs"]], [np.asarray(x) for x in idf["values"]])
            for qid, buckets, weights, floor in zip(qdf["qid"], qdf["buckets"], qdf["weights"], qdf["floor"]):
                ids, scores, _ = shard.search(np.asarray(buckets), np.asarray(weights), k, floor, decimals)
                q.extend([qid] * len(ids))
                d.extend(ids.tolist())
                s.extend(scores.tolist())
        return pd.DataFrame({"qid": q, "doc_id": d, "score": s})

    lists = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))) if chunks > 1 else index.withColumn("chunk", F.lit(0))
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64("qid", F.lit(1)), F.lit(chunks)).cast("int"))
    return (asked.groupBy("shard", "chunk").cogroup(lists.groupBy("shard", "chunk")).applyInPandas(kernel, schema))


def search(queries: DataFrame, index: DataFrame, k: int, key: str = "qid", decimals: int = 9,
           query_chunk: int = QUERY_CHUNK) -> DataFrame:
    """(qid, doc_id, score, rank) of the k best documents of each query, by the inner
    product of its sparse rows (key, bucket, value) with the documents', rounded to
    ``decimals``; ties by document id.  Documents that share no bucket with a query are
    no results, so a query may have fewer than k, or none.  Null keys are left out."""
    ensure_checkpoint_dir(queries.sparkSession)
    entry = F.sort_array(F.collect_list(F.struct("bucket", "value")))
    asked = (queries.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("qid")).agg(entry.alias("l"))
             .select("qid", F.col("l.bucket").alias("buckets"), F.col("l.value").alias("weights")).checkpoint())
    dtype = index.schema["docs"].dataType.elementType
    qtype = asked.schema["qid"].dataType
    n, of = asked.count(), 1 + (index.agg(F.max("shard")).first()[0] or 0)
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "doc_id")
    homes = min(of, max(1, -(-n // HOME_QUERIES)))               # few queries open few shards twice
    home = asked.withColumn("shard", F.pmod(F.xxhash64("qid"), F.lit(homes)).cast("int")).withColumn("floor", F.lit(float("-inf")))
    found = _visit(home, index.where(F.col("shard") < homes), max(1, -(-n // (homes * query_chunk))), k, decimals, qtype, dtype)
    if of > 1:
        # the k-th score of one shard holds for all; it goes with the query to every shard
        floor = found.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        everywhere = (asked.join(floor, "qid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
                      .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(of - 1)))))
        found = _visit(everywhere, index, max(1, -(-n // query_chunk)), k, decimals, qtype, dtype)
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("bigint")))
