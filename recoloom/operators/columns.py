"""Column-level projections and cleaning (PRJ-1..PRJ-9, ORD-4, SF-1, SF-9)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_features(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """PRJ-1: keys then features in the declared order."""
    return df.select(*keys, *features)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """PRJ-5: drop every column whose name matches the regular expression."""
    rx = re.compile(pattern)
    return df.drop(*[c for c in df.columns if rx.search(c)])


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """PRJ-6: drop rows with a null in any (or the given) column."""
    return df.dropna(how="any", subset=subset)


def type_default(dt: T.DataType):
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.lit(0.0).cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    return F.lit(None).cast(dt)


def fill_defaults(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ-7: per-type defaults — 0 for numbers, '' for text, epoch for times, [] for lists."""
    cols = cols or df.columns
    return df.select(*[F.coalesce(F.col(f.name), type_default(f.dataType)).alias(f.name) if f.name in cols
                       else F.col(f.name) for f in df.schema.fields])


def align_to(df: DataFrame, schema: T.StructType, fill_missing=None) -> DataFrame:
    """PRJ-9: impose a declared column list and order; absent columns are added
    (``fill_missing`` or null, cast to the declared type), extras dropped."""
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            v = F.lit(fill_missing) if fill_missing is not None else F.lit(None)
            out.append(v.cast(f.dataType).alias(f.name))
    return df.select(*out)


def format_id(prefix: str, width: int, c: Column) -> Column:
    """SF-1: zero-padded string ids such as ``u_0001``."""
    return F.format_string(f"{prefix}%0{width}d", c)


def time_rules(ts: Column, *earliest: Column, latest: Column | None = None) -> tuple[Column, Column]:
    """SF-9: (valid, clamped) — an event must not precede any of ``earliest``;
    the clamped time is ``least(greatest(ts, earliest…), latest)``."""
    lo = F.greatest(*earliest) if len(earliest) > 1 else earliest[0]
    valid = ts >= lo
    clamped = F.greatest(ts, lo)
    if latest is not None:
        clamped = F.least(clamped, latest)
    return valid, clamped


def shuffle_rows(df: DataFrame, key_cols: list[str], seed: int = 42, partitions: int | None = None) -> DataFrame:
    """ORD-4: repeatable full shuffle — hash-partition by a seeded key hash and
    order inside partitions by it (no global sort, no rand())."""
    h = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    r = df.repartition(partitions, h) if partitions else df.repartition(h)
    return r.sortWithinPartitions(h)
