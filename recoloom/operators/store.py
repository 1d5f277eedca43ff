"""Declarative feature-store objects (F-1, F-6, F-7, F-9) over Spark DataFrames.

A ``FeatureView`` names a lazily-built source DataFrame, its join keys, event
timestamp, optional created-timestamp tie-break and TTL.  Retrieval is the
as-of join of ``operators.asof``; there is no registry server — the
``FeatureStore`` is an in-process dict of definitions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import asof


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]


@dataclass
class Source:
    """Path/loader + timestamp fields + identity-or-rename field mapping (SRC-3/SRC-4)."""
    loader: Callable[[], DataFrame]
    timestamp_field: str
    created_timestamp_column: str | None = None
    field_mapping: dict[str, str] = field(default_factory=dict)

    def load(self) -> DataFrame:
        df = self.loader()
        for a, b in self.field_mapping.items():
            df = df.withColumnRenamed(a, b)
        return df


@dataclass
class FeatureView:
    name: str
    entities: tuple[Entity, ...]
    source: Source
    features: tuple[str, ...]
    ttl: str | None = None

    @property
    def join_keys(self) -> list[str]:
        return [k for e in self.entities for k in e.join_keys]

    def validate(self) -> None:
        cols = set(self.source.load().columns)
        need = set(self.join_keys) | set(self.features) | {self.source.timestamp_field}
        missing = need - cols
        if missing:
            raise ValueError(f"view {self.name}: source lacks {sorted(missing)}")


@dataclass
class OnDemandView:
    """Row-wise features over stored + request columns (F-6): name -> Column expression."""
    name: str
    expressions: dict[str, Callable[[], Column]]


@dataclass
class OnDemandPandasView:
    """U-5 pandas variant: ``fn(pdf) -> pdf`` over Arrow batches of the joined
    frame (``mapInPandas``); ``outputs`` maps each produced column to its type."""
    name: str
    fn: Callable
    outputs: dict[str, str]


@dataclass
class FeatureService:
    """Named bundle of ``view:feature`` references (F-7)."""
    name: str
    features: tuple[str, ...]


def is_vector(t: T.DataType) -> bool:
    """A list of numbers, or a sparse vector (indices, values)."""
    if isinstance(t, T.StructType):
        return {"indices", "values"} <= set(t.names)
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.NumericType)


class FeatureStore:
    SEP = "__"

    def __init__(self, views: list[FeatureView], on_demand: list = ()):
        self.views = {v.name: v for v in views}
        self.on_demand = {v.name: v for v in on_demand}

    @staticmethod
    def _parse(refs) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for r in refs:
            view, feat = r.split(":", 1)
            out.setdefault(view, []).append(feat)
        return out

    def get_historical_features(self, entity_df: DataFrame, features, event_ts: str = "event_timestamp",
                                as_of=None) -> DataFrame:
        """Per view, an as-of join in which the entity rows ride along (J-6b, F-2).

        Output columns are ``view__feature``; entity columns (labels, request
        values) are unchanged (F-10).  ``as_of`` (a timestamp) overrides the rows'
        own event time: features as they stood then, for every row.
        """
        if isinstance(features, FeatureService):
            features = features.features
        wanted = self._parse(features)
        rows, attach = self.get_historical_rows(entity_df, features, event_ts, as_of)
        stored = [f"{vname}{self.SEP}{f}" for vname, feats in wanted.items() if vname not in self.on_demand for f in feats]
        out = attach(rows).select(*entity_df.columns, *stored)
        for vname, feats in wanted.items():
            od = self.on_demand.get(vname)
            if isinstance(od, OnDemandView):
                out = out.select("*", *[od.expressions[f]().alias(f"{vname}{self.SEP}{f}") for f in feats])
            elif isinstance(od, OnDemandPandasView):
                out = self._apply_pandas(out, od, feats)
        return out

    def get_historical_rows(self, entity_df: DataFrame, features, event_ts: str = "event_timestamp",
                            as_of=None) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """The stored features except vectors, and a function that adds the vectors to these
        rows, or to rows made from them.  Vectors do not ride through the as-of joins, which
        find the number of a view's row instead, nor need they through joins that follow."""
        out, at, late = entity_df, event_ts, []
        if as_of is not None:
            at = "__as_of"
            out = out.withColumn(at, F.lit(as_of).cast("timestamp_ntz"))
        for vname, feats in self._parse(features).items():
            if vname in self.on_demand:
                continue
            v = self.views[vname]
            before, source = out.columns, v.source.load()
            wide, row = [f for f in feats if is_vector(source.schema[f].dataType)], f"__row{len(late)}"
            narrow = [f for f in feats if f not in wide]
            if wide:
                ensure_checkpoint_dir(source.sparkSession)
                source = source.withColumn(row, F.monotonically_increasing_id()).checkpoint()
                late.append((row, source.select(F.col(row).alias("__number"), *[F.col(f).alias(f"{vname}{self.SEP}{f}") for f in wide])))
                narrow.append(row)
            got = asof.point_in_time_join(out, source, v.join_keys, at, v.source.timestamp_field, narrow,
                                          created_col=v.source.created_timestamp_column, ttl=v.ttl, prefix="__f_")
            out = got.select(*before, *[F.col(f"__f_{f}").alias(f if f == row else f"{vname}{self.SEP}{f}") for f in narrow])

        def attach(rows: DataFrame) -> DataFrame:
            for row, vectors in late:
                rows = rows.join(vectors, F.col(row) == F.col("__number"), "left").drop(row, "__number")
            return rows
        return (out.drop(at) if as_of is not None else out), attach

    def _apply_pandas(self, df: DataFrame, od: OnDemandPandasView, feats: list[str]) -> DataFrame:
        from pyspark.sql import types as T
        names = [f"{od.name}{self.SEP}{f}" for f in feats]
        schema = T.StructType(list(df.schema.fields) + [
            T.StructField(n, od.outputs[f] if isinstance(od.outputs[f], T.DataType)
                          else T.DataType.fromDDL(od.outputs[f])) for n, f in zip(names, feats)])
        fn, cols = od.fn, df.columns

        def run(batches):
            for pdf in batches:
                res = fn(pdf)
                for n, f in zip(names, feats):
                    pdf[n] = res[f].values
                yield pdf[cols + names]

        return df.mapInPandas(run, schema)

    def materialize(self, view: str, start=None, end=None) -> DataFrame:
        """Latest row per key with event time in [start, end] -> online table (F-3)."""
        v = self.views[view]
        return asof.latest_per_key(v.source.load(), v.join_keys, v.source.timestamp_field,
                                   list(v.features), v.source.created_timestamp_column, start, end)

    def get_online_features(self, keys_df: DataFrame, view: str, online: DataFrame | None = None) -> DataFrame:
        v = self.views[view]
        online = online if online is not None else self.materialize(view)
        return asof.online_lookup(keys_df, online, v.join_keys)
