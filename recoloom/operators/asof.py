"""Point-in-time (as-of) joins and latest-row-per-key (J-6, J-6b, W-1, F-2..F-5, F-9).

As-of join = union of entity and feature rows, range-partitioned and sorted by
(key, time): one shuffle, no row pairs.  Range bounds come from the rows
themselves, so a key that owns a third of the rows, or a burst of them in one
second, is cut into as many ranges as it needs.  Within a range the last feature
row is carried forward in Arrow batches; what must cross a range border is one
feature row per partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIDE = "__side"
_TS = "__ts"
_CR = "__created"
_FEAT = "__feat"
_ENT = "__ent"


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _interval_micros(spec: str) -> int:
    """'1 day' / '6 hours' / '30 minutes' -> microseconds (driver-side constant)."""
    n, unit = spec.split()
    unit = unit.rstrip("s").lower()
    mult = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6,
            "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}[unit]
    return int(float(n) * mult)


def _sides(entity: DataFrame, features: DataFrame, keys: list[str], entity_ts: str, feature_ts: str,
           feature_cols: list[str], created_col: str | None) -> DataFrame:
    """Entity and feature rows in one frame: keys, time, side (0: feature), created,
    feature, entity.  A feature row without a time or a key can match nothing."""
    features = features.dropna(subset=[*keys, feature_ts])
    fields = list(dict.fromkeys([*feature_cols, feature_ts]))
    created = F.col(created_col).cast("bigint") if created_col else F.lit(0).cast("bigint")
    null_feat = F.lit(None).cast(features.select(F.struct(*fields)).schema[0].dataType)
    null_ent = F.lit(None).cast(entity.select(F.struct(*entity.columns)).schema[0].dataType)
    e = entity.select(*keys, F.col(entity_ts).alias(_TS), F.lit(1).alias(_SIDE), F.lit(None).cast("bigint").alias(_CR),
                      null_feat.alias(_FEAT), F.struct(*entity.columns).alias(_ENT))
    f = features.select(*keys, F.col(feature_ts).alias(_TS), F.lit(0).alias(_SIDE), created.alias(_CR),
                        F.struct(*fields).alias(_FEAT), null_ent.alias(_ENT))
    return e.unionByName(f)


def _output(rows: DataFrame, entity: DataFrame, feature_cols: list[str], feature_ts: str, ttl: str | None, prefix: str) -> DataFrame:
    """Entity columns and the matched feature ``__m``, unless it is older than ``ttl``."""
    m = F.col("__m")
    if ttl:
        m = F.when(_micros(m[feature_ts]) >= _micros(F.col(_TS)) - F.lit(_interval_micros(ttl)), m)
    fields = list(dict.fromkeys([*feature_cols, feature_ts]))
    return rows.select(*[F.col(f"{_ENT}.{c}").alias(c) for c in entity.columns], *[m[c].alias(prefix + c) for c in fields])


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays are equal, nulls being equal to each other."""
    equal = pc.fill_null(pc.equal(a, b), False)
    return np.asarray(pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False), bool)


def _fill_forward(keys: list[str]):
    """Kernel over the sorted rows of one partition.  Emits the entity rows with
    the last feature of their key, marked open where the partition holds none yet
    for its first key, and finally the partition's last key with its last feature
    (side 2)."""
    n_keys, names = len(keys), [*keys, _TS, _SIDE, "__m", _ENT, "__open"]

    def run(batches):
        key, feat = None, None                                  # the last row's key; that key's last feature, if any
        types, first_key = None, False                          # is the last row's key the partition's first one?
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            cols = [b.column(i) for i in range(n_keys)]
            side, pool, ents = b.column(n_keys + 1), b.column(n_keys + 3), b.column(n_keys + 4)
            fresh = np.ones(n, bool)                            # a key starts here
            fresh[0] = types is None or key != tuple(c[0].as_py() for c in cols)
            if n > 1:
                same = np.ones(n - 1, bool)
                for c in cols:
                    same &= _same(c.slice(0, n - 1), c.slice(1))
                fresh[1:] = ~same
            at, number = np.arange(n), np.cumsum(fresh)         # number 0: the key goes on from the batch before
            begin = np.maximum.accumulate(np.where(fresh, at, 0))
            entity = np.asarray(side) == 1
            last = np.maximum.accumulate(np.where(entity, -1, at))
            here = last >= begin
            found = here | ((number == 0) & (feat is not None))
            in_first = number == 1 if types is None else (number == 0) & first_key
            held = feat if feat is not None else pa.nulls(1, pool.type)
            got = pa.concat_arrays([held, pool]).take(pa.array(np.where(here, last + 1, 0), mask=~found))
            out = [*cols, b.column(n_keys), side, got, ents, pa.array(in_first & ~found)]
            yield pa.RecordBatch.from_arrays(out, names=names).filter(pa.array(entity))
            if here[-1]:
                feat = pool.slice(int(last[-1]), 1)
            elif number[-1] > 0:
                feat = None
            key, first_key = tuple(c[n - 1].as_py() for c in cols), bool(in_first[-1])
            types = [a.type for a in out]
        if types is not None:
            tail = [*[pa.array([v], t) for v, t in zip(key, types)], pa.nulls(1, types[n_keys]), pa.array([2], types[n_keys + 1]),
                    feat if feat is not None else pa.nulls(1, types[n_keys + 2]), pa.nulls(1, types[n_keys + 3]), pa.array([first_key])]
            yield pa.RecordBatch.from_arrays(tail, names=names)
    return run


def point_in_time_join(entity: DataFrame, features: DataFrame, keys: list[str] | str,
                       entity_ts: str, feature_ts: str, feature_cols: list[str],
                       created_col: str | None = None, ttl: str | None = None, prefix: str = "",
                       partitions: int | None = None) -> DataFrame:
    """For each entity row, the latest feature row with the same keys and
    ``feature_ts <= entity_ts`` (ties on ``feature_ts`` → greatest ``created_col``);
    ``feature_ts >= entity_ts - ttl`` when ``ttl`` is set.  No match → nulls,
    entity row kept; so are entity rows without a time or a key, and feature rows
    without one match nothing.  Output = entity columns + ``prefix + feature_cols`` +
    ``prefix + feature_ts``.

    The filled rows are written once (reliable checkpoint): the rows that still
    lack a feature get the one carried over from earlier ranges, a table of one row
    per partition at most.
    """
    from ..session import ensure_checkpoint_dir
    spark = entity.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [keys] if isinstance(keys, str) else list(keys)
    u = _sides(entity, features, keys, entity_ts, feature_ts, feature_cols, created_col)
    order = [*keys, _TS, _SIDE, _CR]
    dealt = u.repartitionByRange(partitions, *order) if partitions else u.repartitionByRange(*order)
    kind = u.schema
    schema = T.StructType([*[kind[k] for k in keys], kind[_TS], T.StructField(_SIDE, T.IntegerType()),
                           T.StructField("__m", kind[_FEAT].dataType), T.StructField(_ENT, kind[_ENT].dataType),
                           T.StructField("__open", T.BooleanType())])
    rows = (dealt.sortWithinPartitions(*order).mapInArrow(_fill_forward(keys), schema)
            .withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True))
    tails = rows.where(F.col(_SIDE) == 2).select("__pid", "__open", F.struct(*keys).alias("k"), "__m")
    carry, before = [], None                                    # whose last feature each partition's first key brings along
    for r in tails.select("__pid", "__open", "k", F.col("__m").isNotNull().alias("has")).orderBy("__pid").collect():
        if before is not None and before[1] is not None:
            carry.append((r["__pid"], *before))
        own = r["__pid"] if r["has"] else None
        if own is None and r["__open"] and before is not None and before[0] == r["k"]:
            own = before[1]                                     # one key without a feature fills this whole partition
        before = (r["k"], own)
    over = spark.createDataFrame(carry, T.StructType([
        T.StructField("__pid", T.IntegerType()), T.StructField("__k", T.StructType([kind[k] for k in keys])),
        T.StructField("__from", T.IntegerType())]))
    over = over.join(tails.select(F.col("__pid").alias("__from"), F.col("__m").alias("__c")), "__from").drop("__from")
    fits = F.col("__open") & F.struct(*keys).eqNullSafe(F.col("__k"))
    out = (rows.where(F.col(_SIDE) == 1).join(over, "__pid", "left")       # at most one row a partition; features may be wide
           .withColumn("__m", F.when(fits & F.col("__m").isNull(), F.col("__c")).otherwise(F.col("__m"))))
    return _output(out, entity, feature_cols, feature_ts, ttl, prefix)


def latest_per_key(df: DataFrame, keys: list[str] | str, ts: str, cols: list[str],
                   created_col: str | None = None, start=None, end=None) -> DataFrame:
    """Latest row per key with ``start <= ts <= end`` (W-1 / materialize).

    One hash aggregation with ``max_by`` (partial aggregation map-side, so a hot
    key is combined before the shuffle).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if start is not None:
        df = df.where(F.col(ts) >= start)
    if end is not None:
        df = df.where(F.col(ts) <= end)
    order = F.struct(F.col(ts), F.col(created_col)) if created_col else F.col(ts)
    fields = [c for c in cols if c != ts] + [ts]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*fields), order).alias("__r"))
            .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in fields]))


def online_lookup(keys_df: DataFrame, latest: DataFrame, keys: list[str] | str) -> DataFrame:
    """Multi-key online read: every requested key, null features when unknown (F-5)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return keys_df.join(latest, keys, "left")


def materialize_incremental(spark, source: DataFrame, keys: list[str] | str, ts: str, cols: list[str],
                            online_path: str, state_path: str, end, created_col: str | None = None) -> None:
    """F-4: materialise rows with ``last_end < ts <= end`` into the online table
    (latest per key wins, ties → greatest ``created_col``), then record ``end``
    as the new high-water mark.  Both are batches numbered by the mark they start
    from, so a run that is repeated after a failure replaces what it had written."""
    from ..sources import io as IO
    keys = [keys] if isinstance(keys, str) else list(keys)
    src, start = source.where(F.col(ts) <= end), 0
    if IO.path_exists(spark, state_path):
        mark = IO.read_batches(spark, state_path).agg(F.max("end_ts").alias("t")).select("t", _micros(F.col("t")).alias("m")).first()
        src, start = src.where(F.col(ts) > F.lit(mark["t"])), mark["m"]
    extra = [created_col] if created_col else []
    IO.write_batch(src.select(*keys, *[c for c in cols if c != ts], ts, *extra), online_path, "materialize", start)
    IO.write_batch(spark.range(1).select(end.alias("end_ts")), state_path, "materialize", start)
