"""X-1, rolling form: counts over trailing windows as of each event.

The count of a user's events in [t - d, t] is the running count up to t less the
running count ahead of t - d.  So each event asks twice and more: once behind its own
time, once ahead of the start of each window.  Events and questions are
range-partitioned and sorted by (user, time) together, one sweep keeps the running
counts and answers, and the answers of an event are put side by side.  A user that
owns a third of the rows, or a burst of them, is cut into as many ranges as it needs:
what crosses a border is one row of counts per partition, however long the windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .asof import _micros, _same

_BEFORE, _EVENT, _BEHIND = 0, 1, 2
DAY = 86_400_000_000


def _sweep(kinds: int):
    """Kernel over sorted (user, at, side, kind, id, time, window) rows of one partition:
    the questions with the counts of their user so far in this partition, marked where
    the user may have begun earlier; last, the partition's last user and its counts."""
    names = ["user", "id", "time", "window", "counts", "open", "tail"]

    def run(batches):
        key, held, first, types = None, np.zeros(kinds, np.int64), True, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            user, side, kind = b.column(0), np.asarray(b.column(2)), np.asarray(b.column(3))
            types = user.type
            fresh = np.ones(n, bool)
            fresh[0] = key is None or key[0] != user[0].as_py()
            if n > 1:
                fresh[1:] = ~_same(user.slice(0, n - 1), user.slice(1))
            one = np.zeros((n, kinds), np.int64)
            event = np.flatnonzero((side == _EVENT) & (kind >= 0))
            one[event, kind[event]] = 1
            total = np.cumsum(one, axis=0)
            number = np.cumsum(fresh)
            begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
            base = total[begin] - one[begin]                    # counts of earlier users in this batch
            base[number == 0] = -held
            counts = total - base
            is_open = (number == (1 if key is None else 0)) & first
            ask = side != _EVENT
            flat = pa.array(counts[ask].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(ask.sum() + 1, dtype=np.int32) * kinds), flat)
            picked = b.filter(pa.array(ask))
            yield pa.RecordBatch.from_arrays(
                [picked.column(0), picked.column(4), picked.column(5), picked.column(6), lists, pa.array(is_open[ask]),
                 pa.array(np.zeros(int(ask.sum()), bool))], names=names)
            key, held, first = (user[n - 1].as_py(),), counts[-1], bool(is_open[-1])
            id_type = b.column(4).type
        if key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]], types), pa.nulls(1, id_type), pa.array([0], pa.int64()), pa.array([0], pa.int32()),
                 pa.array([held.tolist()], pa.list_(pa.int64())), pa.array([first]), pa.array([True])], names=names)
    return run


def rolling_counts(events: DataFrame, days=(1, 7, 30), types=("like", "comment", "view_full"), user: str = "user_id", ts: str = "timestamp",
                   id_col: str = "interaction_id", type_col: str = "interaction_type", partitions: int | None = None) -> DataFrame:
    """(id, user, ts, <type>_count_<d>d...): for each event the number of its user's
    events of each type with ``ts - d days <= time <= ts``, itself and ties included.

    Events without a user or a time are in no window and get zeros; types that are not
    asked for count in none; rows that repeat id, user and time give one row."""
    from ..session import ensure_checkpoint_dir
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    kind = F.coalesce(*[F.when(F.col(type_col) == t, F.lit(i)) for i, t in enumerate(types)], F.lit(-1))
    known = F.col(user).isNotNull() & F.col(ts).isNotNull()
    rows = events.where(known).select(F.col(user).alias("user"), _micros(F.col(ts)).alias("time"), kind.alias("kind"), F.col(id_col).alias("id"))
    asks = F.array(F.struct(F.col("time").alias("at"), F.lit(_EVENT).alias("side"), F.lit(-1).alias("window")),
                   F.struct(F.col("time").alias("at"), F.lit(_BEHIND).alias("side"), F.lit(-1).alias("window")),
                   *[F.struct((F.col("time") - d * DAY).alias("at"), F.lit(_BEFORE).alias("side"), F.lit(i).alias("window"))
                     for i, d in enumerate(days)])
    order = ["user", "at", "side"]
    all_rows = rows.select("user", "kind", "id", "time", F.inline(asks)).select(*order, "kind", "id", "time", "window")
    spread = [*order, "id"]                                     # a burst at one time is cut by id
    dealt = all_rows.repartitionByRange(partitions, *spread) if partitions else all_rows.repartitionByRange(*spread)
    schema = T.StructType([all_rows.schema["user"], all_rows.schema["id"], T.StructField("time", T.LongType()),
                           T.StructField("window", T.IntegerType()), T.StructField("counts", T.ArrayType(T.LongType())),
                           T.StructField("open", T.BooleanType()), T.StructField("tail", T.BooleanType())])
    answers = (dealt.sortWithinPartitions(*spread).mapInArrow(_sweep(len(types)), schema)
               .withColumn("pid", F.spark_partition_id()).checkpoint(eager=True))
    carry, before = [], None
    for r in answers.where("tail").select("pid", "user", "open", "counts").orderBy("pid").collect():    # one row a partition
        counts = list(r["counts"])
        if before is not None:
            carry.append((r["pid"], before[0], before[1]))
            if r["open"] and before[0] == r["user"]:
                counts = [x + y for x, y in zip(counts, before[1])]
        before = (r["user"], counts)
    over = spark.createDataFrame(carry, T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("__u", schema["user"].dataType),
                                                      T.StructField("__c", T.ArrayType(T.LongType()))]))
    more = F.col("open") & (F.col("user") == F.col("__u"))
    whole = answers.where("not tail").join(F.broadcast(over), "pid", "left")                             # one row a partition
    total = F.when(F.coalesce(more, F.lit(False)), F.zip_with("counts", "__c", lambda a, b: a + b)).otherwise(F.col("counts"))
    by_event = whole.select("id", "user", "time", "window", total.alias("c")).groupBy("id", "user", "time").agg(
        *[F.max(F.when(F.col("window") == w, F.col("c"))).alias(f"w{w + 1}") for w in range(-1, len(days))])
    names = [(f"{t}_count_{d}d", i, w + 1) for w, d in enumerate(days) for i, t in enumerate(types)]
    out_ts = F.timestamp_micros("time").cast(events.schema[ts].dataType).alias(ts)
    found = by_event.select(F.col("id").alias(id_col), F.col("user").alias(user), out_ts,
                            *[(F.col("w0")[i] - F.col(f"w{w}")[i]).alias(n) for n, i, w in names])
    none = events.where(~known).select(id_col, user, ts, *[F.lit(0).cast("long").alias(n) for n, *_ in names]).distinct()
    return found.unionByName(none)
