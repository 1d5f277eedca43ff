"""Sources, sinks and column helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoloom.operators import columns as C
from recoloom.sources import io as IO


def test_validation_helpers(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b string")
    assert IO.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError):
        IO.require_columns(df, ["a", "zz"])
    with pytest.raises(ValueError):
        IO.require_nonempty(df.where("a > 5"))
    out = IO.column_or_fallback(df, "b", "fallback").select("b").distinct().collect()
    assert [r.b for r in out] == ["fallback"]
    out = IO.column_or_fallback(df, "missing", 7, out="m").select("m").distinct().collect()
    assert [r.m for r in out] == [7]


def test_checkpoint_dir_is_never_local_on_a_cluster():
    from types import SimpleNamespace

    from recoloom.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None),
                              conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(cluster)


def test_read_or_empty(spark):
    schema = T.StructType([T.StructField("x", T.LongType())])
    df = IO.read_or_empty(spark, IO.scratch_path(spark, "nothing-here"), schema)
    assert df.count() == 0 and df.schema == schema


def test_csv_corrupt_rows_kept(spark):
    path = IO.scratch_path(spark, "bad-csv")
    spark.createDataFrame([("1", "x"), ("oops", "y")], "a string, b string").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = IO.read_csv(spark, path, schema).collect()
    assert len(rows) == 2
    assert sum(1 for r in rows if r[IO.CORRUPT] is not None) == 1


def test_batches_replay_delete_and_lookup(spark):
    path, deletes, whole = (IO.scratch_path(spark, n) for n in ("store", "store-deletes", "store-whole"))
    t, hour = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    a = spark.createDataFrame([(1, 10, "seen", t), (1, 11, "seen", t), (2, 10, "disliked", t)],
                              "user_id long, post_id long, interaction_type string, interaction_timestamp timestamp_ntz")
    keys, ts = ["user_id", "post_id", "interaction_type"], "interaction_timestamp"
    users = lambda p, **k: {r.user_id for r in IO.read_latest(spark, p, keys, ts, **k).collect()}
    assert IO.read_latest(spark, path, keys, ts, schema=a.schema).count() == 0
    IO.write_batch(a, path, "load", 0)
    b = spark.createDataFrame([(1, 10, "seen", t + hour)], a.schema)
    for _ in range(2):                                                  # a replayed batch replaces itself
        IO.write_batch(b, path, "stream", 0)                            # the number of another writer's batch
        rows = IO.read_latest(spark, path, keys, ts).collect()
        assert len(rows) == 3 and IO.read_batches(spark, path).count() == 4
        assert max(r[ts] for r in rows if r.post_id == 10 and r.user_id == 1) == t + hour
    wanted = spark.createDataFrame([(1, 10), (1, 12), (2, 10), (None, 10), (1, 10)], "user_id long, post_id long")
    hit = IO.lookup(IO.read_batches(spark, path), wanted, ["user_id", "post_id"], ["seen"]).collect()
    assert [tuple(r) for r in hit] == [(1, 10)]
    IO.delete_keys(spark.createDataFrame([(1, t + hour), (None, t), (2, None)], "user_id long, deleted_at timestamp_ntz"), deletes, "moderation", 0)
    IO.write_batch(a, path, "load", 0)                                  # an old batch again: its rows stay deleted
    assert users(path, deletes=deletes) == {2}
    IO.write_batch(IO.read_latest(spark, path, keys, ts, deletes=deletes), whole, "compacted", 0)
    assert users(whole) == {2}
    IO.write_batch(spark.createDataFrame([(1, 10, "seen", t + 2 * hour)], a.schema), whole, "stream", 1)
    IO.write_batch(b, whole, "stream", 0)                               # replays after the rewrite
    assert users(whole, deletes=deletes) == {1, 2} and IO.read_latest(spark, whole, keys, ts).count() == 2


def test_latest_orders_nulls_and_ties(spark):
    path, t = IO.scratch_path(spark, "store-nulls"), dt.datetime(2024, 1, 1)
    schema = "k long, ts timestamp_ntz, created long, v string"
    a = spark.createDataFrame([(1, None, 1, "untimed"), (2, t, 5, "later"), (3, t, 1, "x"), (5, t, 1, "batch 0")], schema)
    b = spark.createDataFrame([(2, t, 4, "earlier"), (3, None, 9, "untimed"), (4, None, None, None), (5, t, 1, "batch 1")], schema)
    IO.write_batch(a, path, "w", 0)
    IO.write_batch(b, path, "a", 1)
    want = {1: "untimed", 2: "later", 3: "x", 4: None, 5: "batch 1"}
    assert {r.k: r.v for r in IO.read_latest(spark, path, ["k"], ["ts", "created"]).collect()} == want


def test_staged_write_counts_and_replaces(spark):
    path = IO.scratch_path(spark, "staged")
    assert IO.write_parquet(spark.range(7).toDF("x"), path) == 7
    assert IO.write_parquet(spark.range(3).toDF("x"), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_vector_sink_rejects_bad_dimension(spark):
    df = spark.createDataFrame([(1, "c", [0.1, 0.2]), (2, "c", [0.1])], "post_id long, category_id string, embedding array<double>")
    with pytest.raises(Exception):
        IO.write_vector_table(df, IO.scratch_path(spark, "vec-bad"), dim=2)
    ok = df.where("post_id = 1")
    assert IO.write_vector_table(ok, IO.scratch_path(spark, "vec-ok"), dim=2) == 1


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, None, "x", None), (2, 3.0, None, [1])],
                               "id long, v double, s string, arr array<int>")
    assert C.drop_matching(df, r"^(v|s)$").columns == ["id", "arr"]
    assert C.drop_incomplete(df).count() == 0
    assert C.drop_incomplete(df, ["id"]).count() == 2
    f = C.fill_defaults(df).orderBy("id").collect()
    assert (f[0].v, f[1].s, f[0].arr) == (0.0, "", [])
    sch = T.StructType([T.StructField("s", T.StringType()), T.StructField("new", T.DoubleType()),
                        T.StructField("id", T.LongType())])
    al = C.align_to(df, sch, 0.0)
    assert al.columns == ["s", "new", "id"] and al.first().new == 0.0


def test_shuffle_rows_repeatable(spark):
    df = spark.range(200)
    a = [r.id for r in C.shuffle_rows(df, ["id"], seed=3, partitions=4).collect()]
    b = [r.id for r in C.shuffle_rows(df, ["id"], seed=3, partitions=4).collect()]
    assert a == b and sorted(a) == list(range(200)) and a != list(range(200))


def test_select_features_order(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "id long, f1 double, f2 string")
    assert C.select_features(df, ["id"], ["f2", "f1"]).columns == ["id", "f2", "f1"]
