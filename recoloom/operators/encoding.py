"""Feature encoding (E-1..E-5, E-9..E-11, SF-3..SF-5, PRJ-8..PRJ-10).

Vocabularies are DataFrames (distinct values + dense index) joined back to
the data, never driver-side dicts, so they scale with cardinality.  Classes
found in the data give sparse rows; one column per class only where the caller
names the classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sampling import broadcast_if_small, dense_index_sized


def vocabulary(values: DataFrame, col: str, start: int = 1) -> DataFrame:
    """E-1: sorted distinct non-null values → index ``start, start+1, …``."""
    distinct = values.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    vocab, _ = dense_index_sized(distinct, ["value"], "index")
    return _sized(vocab.withColumn("index", F.col("index") + start))


def _sized(vocab: DataFrame) -> DataFrame:
    """A vocabulary with a broadcast hint if its values, measured, are small."""
    size = vocab.agg(F.sum(F.octet_length(F.col("value").cast("string")) + 64)).first()[0]
    return broadcast_if_small(vocab, size or 0)


def apply_vocabulary(df: DataFrame, col: str, vocab: DataFrame, out: str, default: int = 0) -> DataFrame:
    """J-8 / SF-18 / E-9: left lookup join, unknown or null → ``default``."""
    v = vocab.select(F.col("value").alias("__v"), F.col("index").alias(out))
    return (df.join(v, df[col] == v["__v"], "left").drop("__v")
            .withColumn(out, F.coalesce(F.col(out), F.lit(default).cast("bigint"))))


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """E-3: alphabetical codes 0..n-1, null → −1."""
    vocab = vocabulary(df, col, start=0)
    return apply_vocabulary(df, col, vocab, out or f"{col}_code", default=-1)


def multi_hot(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """E-4: a sparse 0/1 row per id: the sorted indices (from 0, classes in
    alphabetical order) of the classes in the list, and the number of classes.  A
    null or empty list gives an empty row.  There is no limit on classes."""
    vocab = vocabulary(df.select(F.explode(col).alias(col)), col, start=0)
    n = vocab.select(F.count(F.lit(1))).scalar()
    flat = df.select(id_col, F.explode(F.array_distinct(col)).alias("__c"))
    hot = (flat.join(vocab.select(F.col("value").alias("__c"), "index"), "__c")
           .groupBy(id_col).agg(F.sort_array(F.collect_list("index")).alias("indices")))     # one list's classes
    return (df.select(id_col).join(hot, id_col, "left")
            .select(id_col, F.coalesce("indices", F.array().cast("array<bigint>")).alias("indices"), n.alias("n_classes")))


def multi_hot_columns(df: DataFrame, col: str, classes: list[str]) -> DataFrame:
    """E-4 with one 0/1 column ``<col>_<class>`` per class that the caller names;
    the list column is dropped."""
    flags = [F.coalesce(F.array_contains(col, c), F.lit(False)).cast("int").alias(f"{col}_{c}") for c in classes]
    return df.select(*[c for c in df.columns if c != col], *flags)


def parse_string_list(c: Column) -> Column:
    """SF-3: parse a list literal like ``"['a', 'b']"``; bad input → empty array."""
    return F.coalesce(F.from_json(c, "array<string>", {"allowSingleQuotes": "true"}),
                      F.array().cast("array<string>"))


def parse_float_list(c: Column) -> Column:
    """SF-4: parse vector text ``"[0.1, 0.2]"`` into array<float>; bad input → null."""
    return F.from_json(c, "array<float>")


TIME_FORMATS = ("yyyy-MM-dd['T'][ ]HH:mm[:ss][.SSSSSS][.SSS]XXX", "yyyy-MM-dd['T'][ ]HH:mm[:ss][.SSSSSS][.SSS]XX",
                "yyyy-MM-dd['T'][ ]HH:mm[:ss][.SSSSSS][.SSS]", "yyyy-MM-dd")


def parse_timestamp(c: Column) -> Column:
    """SF-5: ISO-8601 date, or date and time (``T`` or blank, optional seconds and
    fraction, optional ``Z``, ``+hh:mm`` or ``+hhmm``), or epoch seconds; anything
    else → null.  Offsets are converted; the result is a UTC TIMESTAMP_NTZ."""
    t = F.trim(c)
    iso = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in TIME_FORMATS])
    num = F.when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?$"),
                 F.timestamp_micros((t.cast("decimal(20,6)") * 1000000).cast("bigint")))
    return F.coalesce(num, iso).cast("timestamp_ntz")


def coerce_numeric(df: DataFrame, col: str) -> DataFrame:
    """PRJ-10: booleans → 0/1; a string column → double when every value parses,
    else kept as string (decided by one aggregation before the plan is built,
    since it changes the schema); numbers stay; anything else → string."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.BooleanType):
        return df.withColumn(col, F.col(col).cast("int"))
    if isinstance(kind, T.NumericType):
        return df
    if not isinstance(kind, T.StringType):
        return df.withColumn(col, F.col(col).cast("string"))
    ok = df.select(F.count(F.col(col)) == F.count(F.col(col).try_cast("double"))).first()[0]
    return df.withColumn(col, F.col(col).try_cast("double")) if ok else df


def first_seen_vocabulary(df: DataFrame, col: str, order_col: str, start: int = 1) -> DataFrame:
    """E-2: index values by first appearance (smallest ``order_col``), ``start``
    upwards; 0 stays the out-of-vocabulary code."""
    first = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
             .agg(F.min(order_col).alias("__first")))
    vocab, _ = dense_index_sized(first, ["__first", "value"], "index")
    return _sized(vocab.select("value", (F.col("index") + start).alias("index")))
