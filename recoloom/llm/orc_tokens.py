"""Token ids in ORC files.

Files are written in ascending id order: one range of ids per file, its rows
sorted.  ORC's integer run-length encoding packs ids and lengths, small
stripes give parallel reads, and row indexes and Bloom filters on the document
id let a lookup skip stripes and row groups by metadata alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, shared_path
from .library_words import encoder

SCHEMA = "doc_id long, file_start long, n_tokens long, ids array<int>"
ORC_OPTIONS = {"compression": "none", "orc.stripe.size": str(16 << 20), "orc.row.index.stride": "1000",
               "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


def write_token_files(docs: DataFrame, path: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 2) -> None:
    """Encode every text, append ``end_id`` and write the ids to ``path``.

    Texts (not ids) are range-partitioned by document id, ties by the text's
    hash, so rows that repeat one id can still be spread; each range becomes one
    file and part numbers follow the id order.  Null texts count as empty and
    hold only the end id; null ids sort first."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before, end = encoder(vocabulary), 0, np.array([end_id], "<i4")
        for b in batches:
            got = enc.encode([t or "" for t in b.column(1).to_pylist()])
            n = np.array([len(g) + 1 for g in got], np.int64)
            flat = np.concatenate([x for g in got for x in (g, end)]) if got else np.empty(0, "<i4")
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(before + ends - n, pa.int64()), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), flat)],
                names=["doc_id", "file_start", "n_tokens", "ids"])
            before += int(n.sum())

    rows = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"),
                        F.xxhash64(docs["text"]).alias("tie"))
            .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
            .select("doc_id", "text"))
    map_batches(rows, kernel, SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts all ids of earlier
    documents.  Only the length column is read for the files' totals; that table
    has one row per file, which bounds both its window and its broadcast.  Files go
    by their part number: names have five digits at least, not always the same."""
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("file", F.col("_metadata.file_name"))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    base = totals.select("file", (F.sum("total").over(Window.orderBy(part)) - F.col("total")).alias("base"))
    return (rows.join(F.broadcast(base), "file")
            .select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of a few documents; the predicate is pushed into the ORC reader,
    which skips files, stripes and row groups by statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def id_digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows as read from the files."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(2)
            flat, offsets = np.asarray(ids.values), np.asarray(ids.offsets)
            flat = np.ascontiguousarray(flat, dtype="<i4")      # the bytes of non-negative ids are those of unsigned ones
            crc = [zlib.crc32(flat[x:y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return map_batches(rows.select("doc_id", "start", "ids"), kernel,
                       "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write all documents' ids in the file format and digest what the files hold."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_token_files(docs, path, vocabulary, end_id)
    return id_digests(read_token_files(spark, path))
