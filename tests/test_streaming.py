"""Streaming operators: restart from the checkpoint is exactly-once, and a
replayed micro-batch leaves the sinks unchanged."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from recoloom.sources import io as IO
from recoloom.sources import views as V
from recoloom.streaming import ingest as ST


def _stage(spark, df, name):
    path = IO.scratch_path(spark, name)
    df.withColumn("day", F.to_date("feature_ts")).write.partitionBy("day").parquet(path)
    return path


def test_push_restart_is_exactly_once(spark):
    rows = V.feature_rows(spark, SF_SMALL)
    src = _stage(spark, rows, "push-restart-src")
    schema = spark.read.parquet(src).schema
    online, offline = IO.scratch_path(spark, "online-r"), IO.scratch_path(spark, "offline-r")
    ckpt = IO.scratch_path(spark, "ckpt-r")

    def run():
        s = ST.file_stream(spark, src, schema, max_files=3).drop("day")
        q = ST.push_features(s, offline, online, ["user_id"], ["feature_ts", "created"], ckpt)
        q.awaitTermination()

    run()
    first = sorted(tuple(r) for r in IO.read_latest(spark, online, ["user_id"], ["feature_ts", "created"]).select("user_id", "spend", "feature_ts").collect())
    n_off = spark.read.parquet(offline).count()
    run()                                    # restart: nothing new to read
    again = sorted(tuple(r) for r in IO.read_latest(spark, online, ["user_id"], ["feature_ts", "created"]).select("user_id", "spend", "feature_ts").collect())
    assert first == again
    assert spark.read.parquet(offline).count() == n_off == rows.count()


def test_load_and_two_streams_keep_each_others_rows(spark):
    """All of them number their batches from 0."""
    rows = V.feature_rows(spark, SF_SMALL)
    src = [_stage(spark, rows.where(F.col("created") % 2 == k), f"two-src-{k}") for k in range(2)]
    schema = spark.read.parquet(src[0]).schema
    online, offline = IO.scratch_path(spark, "online-two"), IO.scratch_path(spark, "offline-two")
    keys, order = ["user_id"], ["feature_ts", "created"]
    IO.write_batch(spark.createDataFrame([(-1, 1.0, None, 0), (-2, 2.0, None, 0)], rows.schema), online, "load", 0)
    for k in range(2):
        s = ST.file_stream(spark, src[k], schema, max_files=20).drop("day")
        ST.push_features(s, offline, online, keys, order, IO.scratch_path(spark, f"ckpt-two-{k}"), writer=f"push{k}").awaitTermination()
    got = {r.user_id: r.created for r in IO.read_latest(spark, online, keys, order).collect()}
    want = {r.user_id: r.created for r in rows.groupBy("user_id").agg(F.max_by("created", F.struct(*order)).alias("created")).collect()}
    assert got == {**want, -1: 0, -2: 0} and IO.read_batches(spark, offline).count() == rows.count()


def test_redelivered_and_late_events(spark):
    import datetime as dt
    src, store, ckpt = (IO.scratch_path(spark, n) for n in ("dups-src", "dups", "dups-ckpt"))
    day = lambda k, h=0: dt.datetime(2024, 1, 1 + k, h)
    schema = "user_id long, post_id long, interaction_type string, interaction_timestamp timestamp_ntz"
    runs = [[(1, 1, "seen", day(0)), (1, 1, "seen", day(0)), (2, 1, "seen", day(0, 5)), (None, 1, "seen", day(0, 5))],
            [(2, 1, "seen", day(0, 5)), (3, 1, "seen", day(0, 6)), (1, 1, "seen", day(5))],      # again, in time, later
            [(4, 1, "seen", day(0, 7)), (1, 1, "seen", day(0)), (4, 1, "seen", day(4, 12))]]     # too late, too late, in time
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        ST.seen_updates(ST.file_stream(spark, src, spark.read.parquet(src).schema), store, ckpt, "1 day").awaitTermination()
    got = sorted(((r.user_id, r.interaction_timestamp) for r in IO.read_batches(spark, store).collect()), key=str)
    assert got == sorted([(1, day(0)), (2, day(0, 5)), (None, day(0, 5)), (3, day(0, 6)), (1, day(5)), (4, day(4, 12))], key=str)


def test_a_post_switched_off_and_on_again(spark):
    """Between batches, after restarts; a switch is forgotten in the end."""
    import datetime as dt
    src, out, ckpt = (IO.scratch_path(spark, n) for n in ("avail-src", "avail", "avail-ckpt"))
    day = lambda k, h=0: dt.datetime(2024, 1, 1 + k, h)
    schema = "id long, user_id long, post_id long, available boolean, ts timestamp_ntz"
    ask = lambda i, post, t: (i, i, post, None, t)
    turn = lambda i, post, on, t: (i, None, post, on, t)
    runs = [([ask(1, 7, day(0)), turn(2, 7, False, day(0, 1)), ask(3, 8, day(0, 2))], [3]),      # a switch counts for its whole batch
            ([ask(4, 7, day(1)), ask(5, 8, day(1))], [5]),
            ([turn(6, 7, True, day(2)), ask(7, 7, day(2, 1)), turn(8, 8, True, day(2)), turn(9, 8, False, day(2))], [7]),
            ([ask(10, 7, day(3)), ask(11, 8, day(3))], [10]),
            ([ask(12, 9, day(20))], [12]), ([ask(13, 8, day(21))], [13])]                         # forgotten by then
    seen = set()
    for rows, new in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = ST.file_stream(spark, src, spark.read.parquet(src).schema)
        ST.drop_unavailable(stream.where("available is null"), stream.where("available is not null"), out, ckpt, keep="10 days",
                            salts=2).awaitTermination()
        now = {r.id for r in IO.read_batches(spark, out).collect()}
        assert now - seen == set(new)
        seen = now


def test_push_ties_do_not_depend_on_arrival(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1.0, t, 9), (1, 2.0, t, 5), (2, 3.0, t, 1), (2, 4.0, t + dt.timedelta(hours=1), 0)]
    for k, order in enumerate((rows, rows[::-1])):
        src = IO.scratch_path(spark, f"ties-{k}")
        for r in order:                                                # one file per row
            spark.createDataFrame([r], "user_id long, spend double, feature_ts timestamp_ntz, created long").coalesce(1).write.mode("append").parquet(src)
        online, offline = IO.scratch_path(spark, "ties-on"), IO.scratch_path(spark, "ties-off")
        s = ST.file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
        ST.push_features(s, offline, online, ["user_id"], ["feature_ts", "created"], IO.scratch_path(spark, "ckpt-ties")).awaitTermination()
        assert {r.user_id: r.spend for r in IO.read_latest(spark, online, ["user_id"], ["feature_ts", "created"]).collect()} == {1: 1.0, 2: 4.0}
