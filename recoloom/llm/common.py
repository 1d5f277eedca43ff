"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Arrow batches sent to Python workers: whichever bound is met first.
BATCH_ROWS = 2048
BATCH_BYTES = 4 << 20

FIRST_OF_LABEL = 32                     # texts of each label that go into a sample before all others


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes, so that long texts cannot
    blow up a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with bounded batches; no shuffle, one pass per input split."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(kernel, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a table to the shared folder and read it back.  Unlike
    a cached or locally checkpointed frame it survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text", max_bytes: int = 48 << 20) -> list[tuple[str, object]]:
    """At most ``rows`` labelled texts, chosen by the lowest hash of the id, as
    (text, label) pairs in that order; further cut to ``max_bytes`` of text (a text
    counts one byte more than it has).

    A text that does not fit is left out and the next ones are tried.  The first
    texts of every label come first and those above a sixteenth of ``max_bytes``
    last, so that no text or label takes the room of all others.

    ``labels`` holds the rows that may be learned from.  A document labelled
    more than once takes its largest label.  Documents without text count as
    empty.  Both bounds are parameters of the classifiers that call this.
    """
    pick = (labels.select(F.col(id_col).alias("__id"), F.col(label).alias("__y")).where("__y is not null and __id is not null")
            .groupBy("__id").agg(F.max("__y").alias("__y"))
            .orderBy(F.xxhash64("__id"), "__id").limit(rows))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows_ = (docs.select(F.col(id_col).alias("__id"), text.alias("__t"))
             .join(F.broadcast(pick), "__id")                  # at most ``rows`` (id, label) pairs
             .groupBy("__id").agg(F.min("__t").alias("__t"), F.max("__y").alias("__y"))
             .withColumn("__n", F.octet_length("__t")).withColumn("__h", F.xxhash64("__id")))
    kept = stage(rows_, "sample")
    size = kept.select("__id", "__y", "__n").orderBy("__h", "__id").collect()
    turn, met = [], Counter()
    for r in size:                                             # sizes of at most ``rows`` texts
        big = r["__n"] >= max(1, max_bytes // 16)
        met[big, r["__y"]] += 1
        turn.append((big, met[big, r["__y"]] > FIRST_OF_LABEL))
    total, ids = 0, []
    for k in sorted(range(len(size)), key=turn.__getitem__):   # stable: by hash within each turn
        if total + size[k]["__n"] + 1 <= max_bytes:
            total += size[k]["__n"] + 1
            ids.append((size[k]["__id"],))
    if not ids:
        return []
    chosen = kept.sparkSession.createDataFrame(ids, T.StructType([kept.schema["__id"]]))
    got = kept.join(F.broadcast(chosen), "__id")
    return [(r["__t"], r["__y"]) for r in got.orderBy("__h", "__id").select("__t", "__y").collect()]


def digest_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes()) & 0xFFFFFFFF


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file, found on the machine that asks (driver or executor)."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)
