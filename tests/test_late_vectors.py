"""Vectors do not ride through joins with the labelled pairs, and the rows stay the same."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoloom.functions import vectors as VX
from recoloom.operators import asof
from recoloom.operators import knn as K
from recoloom.operators import matrix as MX
from recoloom.operators.store import Entity, FeatureStore, FeatureView, Source

SPARSE = "struct<size: int, indices: array<int>, values: array<double>>"


def day(n):
    return dt.datetime(2024, 1, n)


def test_vectors_are_joined_by_row_number(spark, monkeypatch):
    source = spark.createDataFrame([(1, day(1), "a", [1.0, 2.0]), (1, day(5), "b", [3.0, 4.0]), (1, day(5), "b", [3.0, 4.0]), (2, day(9), "c", [5.0]),
                                    (3, day(1), "d", None)], "k long, t timestamp_ntz, word string, vec array<double>")
    store = FeatureStore([FeatureView("v", (Entity("k", ("k",)),), Source(lambda: source, "t"), ("word", "vec"))])
    entity = spark.createDataFrame([(1, day(2), 10), (1, day(6), 11), (1, day(6), 11), (2, day(8), 12), (3, day(2), 13), (None, day(2), 14)],
                                   "k long, event_timestamp timestamp_ntz, label int")
    seen, real = [], asof.point_in_time_join
    monkeypatch.setattr(asof, "point_in_time_join", lambda e, f, keys, at, ts, cols, **kw: seen.append(cols) or real(e, f, keys, at, ts, cols, **kw))
    got = store.get_historical_features(entity, ["v:vec", "v:word"])
    assert got.columns == ["k", "event_timestamp", "label", "v__vec", "v__word"]
    assert sorted((r.label, r.v__word, r.v__vec) for r in got.collect()) == [
        (10, "a", [1.0, 2.0]), (11, "b", [3.0, 4.0]), (11, "b", [3.0, 4.0]), (12, None, None), (13, "d", None), (14, None, None)]
    assert seen and all("vec" not in cols for cols in seen)


def test_sparse_vectors_in_the_matrix(spark):
    rows = [(1, 2.0, ["x"], (4, [0, 2], [0.5, 1.5])), (2, 0.0, None, None), (3, float("nan"), ["y"], (4, [1, 3], [0.0, 2.0])),
            (4, None, [], (6, [3, 5], [1.0, 7.0]))]
    df = spark.createDataFrame(rows, f"id long, num double, tags array<string>, emb {SPARSE}")
    blocks = MX.fit(df.where("id < 4"), ["num", "emb", "tags"])
    assert [(b.kind, b.first, b.size) for b in blocks] == [("number", 0, 1), ("embedding", 1, 4), ("labels", 5, 2)]
    want = {1: {0: 2.0, 1: 0.5, 3: 1.5, 5: 1.0}, 2: {}, 3: {4: 2.0, 6: 1.0}, 4: {4: 1.0}}
    assert {r.id: dict(zip(r.indices, r["values"])) for r in MX.assemble(df, blocks).collect()} == want
    late = df.select(F.col("id").alias("n"), "emb")
    attach = lambda r: r.join(late, F.col("id") == F.col("n"), "left").drop("n")
    assert {r.id: dict(zip(r.indices, r["values"])) for r in MX.assemble(df.drop("emb"), blocks, attach).collect()} == want


def test_sparse_dot(spark):
    rows = [((9, [1, 4], [2.0, 3.0]), (9, [0, 4, 8], [1.0, 5.0, 1.0]), 15.0), ((9, [0, 1, 2], [1.0, 1.0, 1.0]), (9, [2], [4.0]), 4.0),
            ((9, [1], [1.0]), (9, [2], [1.0]), 0.0), (None, (9, [2], [1.0]), 0.0), ((9, [], []), (9, [2], [1.0]), 0.0)]
    df = spark.createDataFrame(rows, f"a {SPARSE}, b {SPARSE}, want double")
    assert all(r.got == r.want for r in df.withColumn("got", VX.sparse_dot("a", "b")).collect())


def test_pairs_meet_vectors_in_tiles_only(spark, monkeypatch):
    from recoloom.plans import models as PM
    pairs, real = [], K.pair_scores
    monkeypatch.setattr(K, "pair_scores", lambda p, *a: pairs.append(p) or real(p, *a))
    ent = spark.createDataFrame([(1, 0, day(20), "x"), (1, 0, day(20), "x"), (1, 3, day(20), "y"), (2, 10**6, day(20), "z"), (None, 0, day(20), "n"),
                                 (2, None, day(20), "p")], "user_id long, post_id long, event_timestamp timestamp_ntz, tag string")
    posts = PM.V.posts(spark, SF_SMALL, with_text=False)
    uv = posts.where("post_id = 0").select(F.lit(1).cast("long").alias("user_id"), F.col("embedding").cast("array<double>").alias("user_vector"))
    rows = PM.pair_features(spark, SF_SMALL, ent, uv)
    got = sorted((r.tag, r.user_id, r.post_id, round(r.cosine_similarity_user_post_embedding, 6)) for r in rows.collect())
    e = {r.post_id: r.embedding for r in posts.where("post_id in (0, 3)").collect()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    cosine = dot(e[0], e[3]) / (dot(e[0], e[0]) * dot(e[3], e[3])) ** 0.5
    assert [g[0] for g in got] == ["n", "p", "x", "x", "y", "z"] and [g[3] for g in got if g[0] != "y"] == [0.0, 0.0, 1.0, 1.0, 0.0]
    assert abs(next(g[3] for g in got if g[0] == "y") - cosine) < 1e-5
    value = {f.name: f.dataType for f in pairs[0].schema["value"].dataType}
    assert pairs and not any(isinstance(t, T.ArrayType) for t in value.values())
