"""E-10 / E-12: the model matrix of a configured feature list, in sparse rows.

What a feature becomes follows from its type: numbers and booleans take one slot, text
and ids one slot with their code (alphabetical over the training rows; missing or
unseen: -1), lists of text one slot per class (1 where the class is in the list), lists
of numbers and sparse vectors (size, indices, values) one slot per dimension.  Features that are not there, or of a type without a
rule, are left out and reported.

Encoders are fitted on the training rows only.  Vocabularies are tables; lists are
encoded once per distinct list.  A row is two arrays, the slots that are not zero and
their values, so neither wide embeddings nor many classes cost a column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import encoding as E

NUMBER, CODE, LABELS, EMBEDDING = "number", "code", "labels", "embedding"


@dataclass
class Block:
    feature: str
    kind: str
    first: int
    size: int
    vocabulary: DataFrame | None = None


def kind_of(t: T.DataType) -> str | None:
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return NUMBER
    if isinstance(t, T.StringType):
        return CODE
    if isinstance(t, T.ArrayType):
        return LABELS if isinstance(t.elementType, T.StringType) else EMBEDDING if isinstance(t.elementType, T.NumericType) else None
    return EMBEDDING if isinstance(t, T.StructType) and t.names == ["size", "indices", "values"] else None


def fit(train: DataFrame, features: list[str], codes: tuple[str, ...] = ()) -> list[Block]:
    """The blocks of the configured ``features`` that ``train`` has, in their order.
    ``codes`` names numeric ids that are to be coded.  One pass finds the width of every
    embedding (the largest); a vocabulary is one aggregation."""
    types = {f.name: f.dataType for f in train.schema.fields}
    kinds = {f: CODE if f in codes else kind_of(types[f]) for f in features if f in types}
    wide = {f: F.col(f"{f}.size") if isinstance(types[f], T.StructType) else F.size(f) for f, k in kinds.items() if k == EMBEDDING}
    width = train.agg(F.lit(0).alias("none"), *[F.max(n).alias(f) for f, n in wide.items()]).first().asDict()
    blocks, at = [], 0
    for f, k in kinds.items():
        if k is None:
            continue
        vocab = None
        if k in (CODE, LABELS):
            values = (train.select(f).distinct().select(F.explode(f).alias("v")) if k == LABELS
                      else train.select(F.col(f).cast("string").alias("v")))
            vocab = E.vocabulary(values, "v", start=0)
        size = 1 if k in (NUMBER, CODE) else max(width[f] or 0, 0) if k == EMBEDDING else vocab.count()
        blocks.append(Block(f, k, at, size, vocab))
        at += size
    return blocks


def report(spark: SparkSession, df: DataFrame, features: list[str], blocks: list[Block]) -> DataFrame:
    """(feature, kind, first_slot, n_slots) of every configured feature; kind is
    'missing' or 'left out' where it takes no slot."""
    have = {b.feature: b for b in blocks}
    rows = [(f, have[f].kind, have[f].first, have[f].size) if f in have else (f, "left out" if f in df.columns else "missing", None, 0)
            for f in features]
    return spark.createDataFrame(rows, "feature string, kind string, first_slot int, n_slots int")


def slot_names(spark: SparkSession, blocks: list[Block]) -> DataFrame:
    """(slot, name): ``feature``, ``feature_dim_<i>`` or ``feature_<class>``."""
    out = None
    for b in blocks:
        if b.kind == LABELS:
            part = b.vocabulary.select((F.col("index") + b.first).cast("int").alias("slot"), F.concat(F.lit(b.feature + "_"), "value").alias("name"))
        elif b.kind == EMBEDDING:
            part = spark.range(b.size).select((F.col("id") + b.first).cast("int").alias("slot"), F.concat(F.lit(b.feature + "_dim_"), "id").alias("name"))
        else:
            part = spark.range(1).select(F.lit(b.first).alias("slot"), F.lit(b.feature).alias("name"))
        out = part if out is None else out.union(part)
    return out


def _listed(df: DataFrame, b: Block) -> DataFrame:
    """``df`` with ``__<feature>``: the sorted places of a list's known classes."""
    each = df.select(F.col(b.feature).alias("__l")).where(F.size("__l") > 0).distinct()
    flat = each.select("__l", F.explode(F.array_distinct("__l")).alias("__v"))
    hot = (flat.join(b.vocabulary.select(F.col("value").alias("__v"), "index"), "__v")
           .groupBy("__l").agg(F.sort_array(F.collect_list("index")).alias(f"__{b.feature}")))          # one list's classes
    return df.join(hot, df[b.feature] == hot["__l"], "left").drop("__l")


def _entry(slot, value):
    return F.struct(slot.cast("int").alias("slot"), value.cast("double").alias("value"))


def _entry_of_dimension(first: int):
    return lambda x, i: _entry(i + first, F.coalesce(x, F.lit(0.0)))


def _shifted(first: int):
    return lambda i: (i + first).cast("int")


def _one(first: int, value):
    """One slot, empty where its value is zero, missing or no number."""
    on = F.coalesce((value != 0) & ~F.isnan(value), F.lit(False))
    none = F.array().cast
    return F.when(on, F.array(F.lit(first).cast("int"))).otherwise(none("array<int>")), F.when(on, F.array(value)).otherwise(none("array<double>"))


def _sparse(c, first: int, size: int):
    """A sparse vector's slots and values as they are; cut to the block and without zeros where there are such."""
    at, x = c["indices"].cast("array<int>"), c["values"].cast("array<double>")
    slots = F.transform(at, _shifted(first))
    kept = F.filter(F.arrays_zip(at.alias("slot"), x.alias("value")), lambda e: (e["slot"] < size) & (e["value"] != 0) & ~F.isnan(e["value"]))
    odd = (c["size"] > size) | F.exists(x, lambda v: F.coalesce((v == 0) | F.isnan(v), F.lit(True)))
    none = F.array().cast
    return (F.when(c.isNull(), none("array<int>")).when(odd, F.transform(kept["slot"], _shifted(first))).otherwise(slots),
            F.when(c.isNull(), none("array<double>")).when(odd, kept["value"]).otherwise(x))


def assemble(df: DataFrame, blocks: list[Block], attach: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """The columns of ``df`` that are no features, and ``indices`` and ``values`` of each
    row's non-zero slots in ascending order.  ``attach`` adds features that ``df`` does not
    have, and is called after the joins that look codes up, so that wide ones do not ride
    through these."""
    whole = attach(df).schema
    own, out, parts = [c for c in whole.names if c not in {b.feature for b in blocks}], df, []
    for b in blocks:
        c = F.col(b.feature)
        if b.kind == NUMBER:
            parts.append(_one(b.first, c.cast("double")))
        elif b.kind == CODE:
            out = E.apply_vocabulary(out.withColumn(f"__s_{b.feature}", c.cast("string")), f"__s_{b.feature}", b.vocabulary, f"__{b.feature}", default=-1)
            parts.append(_one(b.first, F.col(f"__{b.feature}").cast("double")))
        elif b.kind == LABELS:
            out = _listed(out, b)
            places = F.coalesce(f"__{b.feature}", F.array().cast("array<bigint>"))
            parts.append((F.transform(places, _shifted(b.first)), F.array_repeat(F.lit(1.0), F.size(places))))
        elif isinstance(whole[b.feature].dataType, T.StructType):
            parts.append(_sparse(c, b.first, b.size))
        else:
            vector = F.coalesce(F.slice(c.cast("array<double>"), 1, max(b.size, 1)), F.array().cast("array<double>"))
            full = F.filter(F.transform(vector, _entry_of_dimension(b.first)), lambda e: (e["value"] != 0) & ~F.isnan(e["value"]))
            parts.append((full["slot"], full["value"]))
    slots, values = ([p[i] for p in parts] or [F.array().cast(kind)] for i, kind in ((0, "array<int>"), (1, "array<double>")))
    return attach(out).select(*own, F.concat(*slots).alias("indices"), F.concat(*values).alias("values"))


def as_vectors(rows: DataFrame, size: int, out: str = "features") -> DataFrame:
    """Sparse rows as the trainers' vector type, for which there is no built-in function."""
    from pyspark.ml.linalg import Vectors, VectorUDT
    pack = F.udf(lambda i, v: Vectors.sparse(size, i, v), VectorUDT())
    return rows.withColumn(out, pack("indices", "values"))
