"""Structured Streaming operators (ST-1..ST-7, F-4, F-8).

Each returns a started ``StreamingQuery``; sinks are idempotent per micro-batch: a
batch is a folder named by its writer and number (``sources.io.write_batch``), which a
replay replaces, and tables resolve the latest row of a key when they are read.  The
checkpoint location gives exactly-once progress across restarts.  Event-time columns
are cast from ``TIMESTAMP_NTZ`` to ``TIMESTAMP`` first, which watermarks require.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.asof import _interval_micros
from ..sources import io as IO


def start(writer, spark: SparkSession, state_partitions: int | None = None, **conf: str):
    """Start a stream with its state-store / shuffle partition count pinned to
    the cluster's parallelism (the stream clones the session conf at start and
    records the count in its checkpoint) and with further settings of its own,
    leaving the caller's session as it was."""
    n = state_partitions or spark.sparkContext.defaultParallelism
    own = {"spark.sql.shuffle.partitions": str(n), **conf}
    old = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def batches_to(path: str, writer: str, rows=lambda batch: batch):
    """A ``foreachBatch`` sink that adds ``rows(batch)`` to a table of batches."""
    return lambda batch, batch_id: IO.write_batch(rows(batch), path, writer, batch_id)


def push_features(stream: DataFrame, offline_path: str, online_path: str, keys: list[str], order: list[str],
                  checkpoint: str, writer: str = "push"):
    """ST-1 / F-8: each micro-batch is added to the offline table whole and to the
    online table reduced to its latest row of each key by ``order`` (feature time, then
    created); ``read_latest`` gives the latest of all, whoever wrote it and in whatever
    order rows arrived."""
    spark = stream.sparkSession

    def sink(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        IO.write_batch(batch, offline_path, writer, batch_id)
        IO.write_batch(IO.latest_rows(batch, keys, order), online_path, writer, batch_id)
        batch.unpersist()

    return start(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True), spark)


def seen_updates(stream: DataFrame, store_path: str, checkpoint: str, delay: str = "1 hour", writer: str = "seen"):
    """ST-2: (user, post, type, time) events, each written once.  The stream's state
    holds the events of the last ``delay`` of event time, so re-deliveries inside it are
    dropped there; what is older than the watermark is too late and dropped as well.
    State is bounded by the delay, not by the table."""
    ts = "interaction_timestamp"
    keys = ["user_id", "post_id", "interaction_type"]
    events = stream.select(*keys, F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, delay)
    once = events.dropDuplicatesWithinWatermark([*keys, ts])
    sink = batches_to(store_path, writer, lambda b: b.select(*keys, F.col(ts).cast("timestamp_ntz").alias(ts)))
    return start(once.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True), stream.sparkSession)


def jsonl_to_hourly(stream: DataFrame, out_path: str, checkpoint: str, ts: str = "ts"):
    """ST-3: JSON-lines events → Parquet partitioned by event date and hour (file
    sink: exactly-once via its commit log)."""
    out = stream.withColumn("date", F.to_date(ts)).withColumn("hour", F.hour(ts))
    return start(out.writeStream.format("parquet").partitionBy("date", "hour")
                 .option("path", out_path).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True), stream.sparkSession)


def pane_counts(stream: DataFrame, out_path: str, checkpoint: str, pane: str = "1 hour", delay: str = "1 hour",
                types=("like", "comment", "view_full"), writer: str = "panes"):
    """ST-4: conditional counts per (user, pane) with a watermark.  State holds open
    panes only; a pane that changed is written anew with its batch, and the later batch
    counts.  Windows of any length are merged from the panes when read."""
    t = F.col("interaction_type")
    agg = (stream.withColumn("ts", F.col("timestamp").cast("timestamp")).withWatermark("ts", delay)
           .groupBy(F.window("ts", pane).alias("w"), "user_id")
           .agg(F.count(F.lit(1)).alias("events"),
                *[F.count(F.when(t == x, 1)).alias(f"{x}_count") for x in types]))
    sink = batches_to(out_path, writer, lambda b: b.select(
        F.col("w.start").cast("timestamp_ntz").alias("pane_start"), "user_id", "events", *[f"{x}_count" for x in types]))
    return start(agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True), stream.sparkSession)


def read_panes(spark: SparkSession, path: str) -> DataFrame:
    """The panes as last written."""
    return IO.latest_rows(IO.read_batches(spark, path).withColumn("__n", F.col("_batch")), ["pane_start", "user_id"], "__n").drop("__n")


def merge_panes(panes: DataFrame, as_of, days=(1, 7, 30)) -> DataFrame:
    """Counts per user over several windows that end at ``as_of`` (a column), all from
    one scan of the panes and one aggregation.  Users without a pane in the longest
    window have no row."""
    counts = [c for c in panes.columns if c not in ("pane_start", "user_id")]
    age = lambda n: as_of - F.expr(f"INTERVAL {n} DAY")
    inside = panes.where((F.col("pane_start") >= age(max(days))) & (F.col("pane_start") < as_of))
    return inside.groupBy("user_id").agg(*[
        F.coalesce(F.sum(F.when(F.col("pane_start") >= age(n), F.col(c))), F.lit(0)).alias(f"{c}_{n}d") for n in days for c in counts])


def encode_vectors(df: DataFrame, dim: int) -> DataFrame:
    """The encoder slot: vectors L2-normalised in Arrow batches (a null vector is
    encoded as zeros); a wrong dimension fails the batch."""
    import numpy as np

    def encode(batches):
        for pdf in batches:
            if len(pdf):
                m = np.stack([np.zeros(dim) if v is None else np.asarray(v, np.float64) for v in pdf["embedding"]])
                if m.shape[1] != dim:
                    raise ValueError(f"expected {dim}-d vectors, got {m.shape[1]}")
                n = np.linalg.norm(m, axis=1, keepdims=True)
                pdf["embedding"] = list(m / np.where(n > 0, n, 1))
            yield pdf
    double = T.StructField("embedding", T.ArrayType(T.DoubleType()))
    return df.mapInPandas(encode, T.StructType([double if f.name == "embedding" else f for f in df.schema.fields]))


def new_post_vectors(stream: DataFrame, out_path: str, checkpoint: str, dim: int):
    """ST-5: each arriving post is encoded and appended to the category-partitioned vector table."""
    enc = encode_vectors(stream.select("post_id", "category_id", "embedding"), dim)
    return start(enc.writeStream.format("parquet").partitionBy("category_id").option("path", out_path)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True), stream.sparkSession)


def latest_vectors(stream: DataFrame, store_path: str, checkpoint: str, dim: int, writer: str = "vectors"):
    """ST-6: vector updates, latest wins: every version of a post's vector is encoded
    and added; ``read_latest`` finds the latest by the caller's order."""
    enc = encode_vectors(stream, dim)
    return start(enc.writeStream.foreachBatch(batches_to(store_path, writer)).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True), stream.sparkSession)


def drop_seen(stream: DataFrame, seen: DataFrame, out_path: str, checkpoint: str):
    """ST-7 against a table: stream-static anti join: candidate (user, post) rows that the static
    seen table does not hold."""
    fresh = stream.join(seen.select("user_id", "post_id").distinct(), ["user_id", "post_id"], "left_anti")
    return start(fresh.writeStream.format("parquet").option("path", out_path)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True), stream.sparkSession)


class Availability(StatefulProcessor):
    """Per (post, salt) the latest switch, as long as it is younger than ``keep``."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "ts_ms long, id long, available boolean")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentWatermarkInMs()
        held = self.latest.get() if self.latest.exists() else None
        last, before, asked = held, held, []
        for pdf in rows:                                        # switches first, whatever their place in the batch
            is_switch = pdf["available"].notna()
            for r in pdf[is_switch].itertuples(index=False):
                new = (int(r.ts.timestamp() * 1000), int(r.id), bool(r.available))
                if last is None or new[:2] > tuple(last)[:2]:
                    last = new
            if not is_switch.all():
                asked.append(pdf.loc[~is_switch, ["id", "user_id", "post_id"]])
        if last is not before:
            if before is not None:
                self.handle.deleteTimer(before[0] + self.keep_ms)
            self.latest.update(tuple(last))
            self.handle.registerTimer(last[0] + self.keep_ms)
        if last is None or last[2] or last[0] + self.keep_ms <= now:
            yield from asked

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.latest.clear()
        return iter(())

    def close(self) -> None:
        pass


def drop_unavailable(candidates: DataFrame, switches: DataFrame, out_path: str, checkpoint: str, keep: str = "30 days",
                     salts: int = 8, writer: str = "available"):
    """ST-7 against changing state: candidates (id, user_id, post_id, ts) whose post is
    not switched off.  ``switches`` (id, post_id, available, ts) is a stream too; the
    latest switch of a post counts (ties: greater id) from its batch on, is kept in state
    across restarts, and is forgotten when the watermark is ``keep`` beyond it, which
    makes the post available again.  Posts are cut by the candidates' users into
    ``salts`` groups, each of which sees all switches of its post, so that a hot post is
    no single group."""
    spark = candidates.sparkSession
    salt = F.pmod(F.xxhash64("user_id"), F.lit(salts)).cast("int")
    asked = candidates.select("post_id", salt.alias("salt"), F.lit(None).cast("boolean").alias("available"), "user_id", "id",
                              F.col("ts").cast("timestamp").alias("ts"))
    turned = switches.select("post_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "available",
                             F.lit(None).cast("long").alias("user_id"), "id", F.col("ts").cast("timestamp").alias("ts"))
    both = asked.unionByName(turned).withWatermark("ts", "0 seconds")
    rocks = {"spark.sql.streaming.stateStore.providerClass":
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    keep_ms = _interval_micros(keep) // 1000
    out = both.groupBy("post_id", "salt").transformWithStateInPandas(
        Availability(keep_ms), "id long, user_id long, post_id long", "Append", "EventTime")
    return start(out.writeStream.foreachBatch(batches_to(out_path, writer)).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True), spark, **rocks)
