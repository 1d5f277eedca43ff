"""Readers, writers and validation (SRC-1, SRC-5, SRC-7, SRC-8, SNK-1..SNK-6).

Writers are idempotent so a retried task or job never duplicates data:
file writes go to a staging folder that is renamed into place, and a keyed
store appends one folder per write, resolves keys on read and is compacted
behind a pointer.
Scratch space always lives under the session's ``spark.checkpoint.dir``
(a shared folder on a cluster), never a machine-local temp folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

CORRUPT = "_corrupt_record"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/recoloom/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


# ------------------------------------------------------------------ sources
def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = True) -> DataFrame:
    """SRC-1: header CSV with an explicit schema; malformed rows kept (PERMISSIVE)
    with their raw text in ``_corrupt_record`` instead of failing the job."""
    sch = T.StructType(list(schema.fields) + ([T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []))
    return (spark.read.schema(sch).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
            .csv(path))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """X-13: JSON-lines with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SRC-8: a missing optional table degrades to an empty frame with its schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).load(path).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def require_columns(df: DataFrame, cols, name: str = "input") -> DataFrame:
    """SRC-5: fail fast (no job) when required columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing required columns {missing}")
    return df


def require_nonempty(df: DataFrame, name: str = "input") -> DataFrame:
    """SRC-5: fail fast on empty input (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{name}: no rows")
    return df


def column_or_fallback(df: DataFrame, col: str, fallback, out: str | None = None) -> DataFrame:
    """SRC-7: use ``col`` when it exists and is not entirely null, else ``fallback``
    (a column name or literal).  The all-null probe reads at most one row."""
    fb = F.col(fallback) if isinstance(fallback, str) and fallback in df.columns else F.lit(fallback)
    use = col in df.columns and not df.where(F.col(col).isNotNull()).isEmpty()
    return df.withColumn(out or col, F.col(col) if use else fb)


# ------------------------------------------------------------------ sinks
def write_staged(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(), **options) -> int:
    """Write to ``path`` through a staging folder; the old table is moved aside,
    not deleted, until the new one is in place, so that a crash at any point
    leaves one of them whole.  Returns the number of rows written, counted by the
    write itself."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:8]
    staged, aside = f"{path.rstrip('/')}.staging-{mark}", f"{path.rstrip('/')}.old-{mark}"
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staged)
    fs, dst = _fs(spark, path)
    old = fs.exists(dst)
    if old:
        fs.rename(dst, _fs(spark, aside)[1])
    fs.rename(_fs(spark, staged)[1], dst)
    if old:
        fs.delete(_fs(spark, aside)[1], True)
    return int(seen.get["n"])


def write_splits_csv(df: DataFrame, path: str, split_col: str = "split") -> int:
    """SNK-1: one CSV folder per split in a single job, every field quoted;
    empty splits simply produce no folder."""
    return write_staged(df, path, "csv", (split_col,), header="true", quoteAll="true",
                        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def write_parquet(df: DataFrame, path: str, partition_by=()) -> int:
    """SNK-2: a Parquet table, replaced as a whole."""
    return write_staged(df, path, "parquet", partition_by)


def write_vector_table(df: DataFrame, path: str, dim: int, id_col: str = "post_id",
                       category_col: str = "category_id", vec_col: str = "embedding") -> int:
    """SNK-3: (id, category, vector) partitioned by category; every vector's
    dimension is checked in the same pass (bad rows fail the job, not skipped)."""
    checked = df.select(id_col, category_col, vec_col).withColumn(
        vec_col, F.when(F.size(vec_col) == dim, F.col(vec_col))
        .otherwise(F.raise_error(F.concat(F.lit("bad vector dimension for "), F.col(id_col).cast("string")))))
    return write_staged(checked, path, "parquet", (category_col,))


# ------------------------------------------------------------------ tables of batches
# A table that several writers add to is one Parquet dataset, partitioned by who wrote
# a batch and the batch's number; the latest row of a key is found when it is read.
# A batch that is delivered again replaces its own folder and no other.
_BATCH = ["_writer", "_batch"]


def write_batch(df: DataFrame, path: str, writer: str, batch: int) -> None:
    """SNK-4: add the rows of one batch.  ``writer`` names the load or the stream, and
    ``batch`` its batch: a replay of the same pair leaves the table unchanged."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_writer={writer}/_batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of all batches, with ``_writer`` and ``_batch``; without any batch an
    empty frame of ``schema``."""
    kinds = T.StructType([T.StructField("_writer", T.StringType()), T.StructField("_batch", T.LongType())])
    if not path_exists(spark, path):
        if schema is None:
            raise ValueError(f"{path}: nothing was written and no schema given")
        return spark.createDataFrame([], T.StructType([*schema.fields, *kinds.fields]))
    rows = spark.read.parquet(path) if schema is None else spark.read.schema(T.StructType([*schema.fields, *kinds.fields])).parquet(path)
    return rows.select(*[c for c in rows.columns if c not in _BATCH], *[F.col(f.name).cast(f.dataType) for f in kinds.fields])


def latest_rows(rows: DataFrame, keys: list[str], order: str | list[str], gone: DataFrame | None = None) -> DataFrame:
    """The row of each key that is greatest by ``order`` (nulls are smallest, so a row
    without a time yields to any other but is never lost); ties go to the later batch,
    then to the writer whose name is greater.  ``gone`` (a key column and
    ``deleted_at``) takes away the rows of a key up to that time by the first column of
    ``order``, or without one."""
    order = [order] if isinstance(order, str) else list(order)
    if gone is not None:
        key = next(c for c in gone.columns if c not in (*_BATCH, "deleted_at"))
        until = gone.groupBy(F.col(key).alias("__gone")).agg(F.max("deleted_at").alias("__until"))
        before = F.coalesce(F.col(order[0]) <= F.col("__until"), F.lit(True))
        rows = rows.join(until, (F.col(key) == F.col("__gone")) & before, "left_anti")
    rest = [c for c in rows.columns if c not in (*keys, *_BATCH)]
    mark = [F.col(c) for c in order] + [F.col(c) for c in _BATCH[::-1] if c in rows.columns]
    best = F.max_by(F.struct(*rest, F.lit(0).alias("__one")), F.struct(*mark)).alias("__r")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def read_latest(spark: SparkSession, path: str, keys: list[str], order: str | list[str],
                schema: T.StructType | None = None, deletes: str | None = None) -> DataFrame:
    """The latest row of each key of a table of batches.  To compact, write this to a
    new path as a batch of its own and have the writers go on there."""
    gone = read_batches(spark, deletes) if deletes and path_exists(spark, deletes) else None
    return latest_rows(read_batches(spark, path, schema), keys, order, gone)


def delete_keys(doomed: DataFrame, path: str, writer: str, batch: int) -> None:
    """SNK-5: (key, deleted_at) rows in a table of their own: all rows of the key up to
    that time are gone, later ones live.  Only the keys are written; null keys and
    times delete nothing."""
    write_batch(doomed.dropna(), path, writer, batch)


def lookup(rows: DataFrame, wanted: DataFrame, keys: list[str], types: list[str]) -> DataFrame:
    """SRC-6: which of the ``wanted`` keys the store holds with one of the types.  The
    types are pushed into the scan; a short list of keys is broadcast by its size and
    prunes by the join, a long one is joined on the keys."""
    return wanted.select(*keys).distinct().join(rows.where(F.col("interaction_type").isin(types)), keys, "left_semi")


def append_run_metrics(metrics: DataFrame, path: str, run_id: str, params: dict) -> None:
    """SNK-6: one row per (run, metric) with the run's parameters as a map."""
    long = metrics.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                            for c in metrics.columns])))
    pm = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]) if params else \
        F.create_map().cast("map<string,string>")
    (long.select(F.lit(run_id).alias("run_id"), "metric", "value", pm.alias("params"))
     .write.mode("append").partitionBy("run_id").parquet(path))
