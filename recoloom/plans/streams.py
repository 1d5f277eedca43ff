"""Sink / source round trips and streaming queries (SNK-*, SRC-1, SRC-6..SRC-8, X-13, ST-*).

Every query stages data *derived from the supplied tables* under the shared
scratch folder, runs the writer or the stream to completion
(``availableNow``), and returns a batch read of what was written, so the
result can be compared with the equivalent batch SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import sampling as SM
from ..sources import io as IO
from ..sources import views as V
from ..sources.tables import read_table
from ..streaming import ingest as ST
from . import sqlviews as S
from .registry import register
from .training import SPLIT_SQL

INTERACTION_SCHEMA = T.StructType([
    T.StructField("interaction_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("post_id", T.LongType()), T.StructField("interaction_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType())])


@register("csv_roundtrip", SPLIT_SQL.replace("SELECT interaction_id, user_id, post_id,", 'SELECT interaction_id, user_id, post_id, interaction_type, "timestamp",')
          .replace("SELECT interaction_id,\n       CASE", 'SELECT interaction_id, user_id, post_id, interaction_type, "timestamp",\n       CASE'))
def csv_roundtrip(spark, d):
    """SNK-1 + SRC-1: interactions written as one CSV folder per split, read back
    with an explicit schema."""
    split = SM.chronological_split(V.interactions(spark, d), "timestamp", "interaction_id")
    path = IO.scratch_path(spark, "splits-csv")
    IO.write_splits_csv(split, path)
    back = IO.read_csv(spark, path, INTERACTION_SCHEMA)
    return back.select("interaction_id", "user_id", "post_id", "interaction_type", "timestamp", "split")


@register("jsonl_ingest", S.with_views(
    'SELECT interaction_id, user_id, post_id, interaction_type, "timestamp" FROM interactions', S.INTERACTIONS))
def jsonl_ingest(spark, d):
    """X-13: interactions staged as JSON lines and ingested with an explicit schema."""
    path = IO.scratch_path(spark, "interactions-jsonl")
    V.interactions(spark, d).write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return IO.read_jsonl(spark, path, INTERACTION_SCHEMA)


@register("write_vectors", "WITH " + S.POSTS + """
SELECT post_id, category_id, CAST(dim AS BIGINT) AS dim, round(CAST(v AS DOUBLE), 6) AS value
FROM (SELECT post_id, category_id, unnest(range(len(embedding))) AS dim, unnest(embedding) AS v FROM posts)""")
def write_vectors(spark, d):
    """SNK-3: the vector table written partitioned by category (staged swap,
    dimension-checked), read back in full."""
    path = IO.scratch_path(spark, "vectors")
    IO.write_vector_table(V.posts(spark, d, with_text=False), path, dim=64)
    return _long_vectors(spark.read.parquet(path), "embedding")


def _long_vectors(df, vec, digits=6):
    return df.select("post_id", "category_id", F.posexplode(vec).alias("dim", "v")).select(
        "post_id", "category_id", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("v").cast("double"), digits).alias("value"))


SEEN_LATEST_SQL = "WITH " + ",\n".join([S.INTERACTIONS, S.SEEN]) + """
SELECT user_id, post_id, interaction_type, max(interaction_timestamp) AS interaction_timestamp
FROM seen_store {where} GROUP BY user_id, post_id, interaction_type"""


@register("upsert_interactions", SEEN_LATEST_SQL.format(where=""))
def upsert_interactions(spark, d):
    """SNK-4: the serving store loaded with the training split, upserted with the
    later splits and compacted; read back = latest row per (user, post, type)."""
    split = SM.chronological_split(V.interactions(spark, d), "timestamp", "interaction_id")
    seen = V.SEEN_TYPE_MAP
    ss = (split.where(F.col("interaction_type").isin(list(seen)))
          .select("user_id", "post_id", V._case_map(F.col("interaction_type"), seen, None).alias("interaction_type"),
                  F.col("timestamp").alias("interaction_timestamp"), "split"))
    path, whole = IO.scratch_path(spark, "seen-store"), IO.scratch_path(spark, "seen-store-compact")
    keys, ts = ["user_id", "post_id", "interaction_type"], "interaction_timestamp"
    for batch, part in enumerate((F.col("split") == "train", F.col("split") != "train")):
        IO.write_batch(ss.where(part).drop("split"), path, "load", batch)
    IO.write_batch(IO.read_latest(spark, path, keys, ts), whole, "compacted", 0)
    return IO.read_latest(spark, whole, keys, ts)


@register("delete_users", SEEN_LATEST_SQL.format(
    where="""WHERE user_id NOT IN (
      SELECT user_id FROM seen_store
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY interaction_timestamp DESC, post_id DESC,
                                 interaction_type DESC) = 1 AND interaction_type = 'reported')"""))
def delete_users(spark, d):
    """SNK-5: users whose most recent store row is a 'reported' one are deleted
    from the store (only their keys are written)."""
    path, deletes = IO.scratch_path(spark, "seen-store"), IO.scratch_path(spark, "seen-deletes")
    store = V.seen_store(spark, d)
    keys, ts = ["user_id", "post_id", "interaction_type"], "interaction_timestamp"
    IO.write_batch(store, path, "load", 0)
    last = store.groupBy("user_id").agg(F.max_by("interaction_type", F.struct(ts, "post_id", "interaction_type")).alias("last_type"),
                                        F.max(ts).alias("deleted_at"))
    IO.delete_keys(last.where(F.col("last_type") == "reported").select("user_id", "deleted_at"), deletes, "moderation", 0)
    return IO.read_latest(spark, path, keys, ts, deletes=deletes)


@register("run_metrics", S.with_views("""
SELECT 'run-0001' AS run_id, metric, value, 'seed=42;source=interactions' AS params FROM (
  SELECT 'user_id_vocab_size' AS metric, CAST(count(DISTINCT user_id) + 2 AS DOUBLE) AS value FROM interactions
  UNION ALL SELECT 'post_id_vocab_size', CAST(count(DISTINCT post_id) + 2 AS DOUBLE) FROM interactions
  UNION ALL SELECT 'training_samples', CAST(count(*) AS DOUBLE) FROM interactions) t""", S.INTERACTIONS))
def run_metrics(spark, d):
    """SNK-6: a run's metrics (label distribution and vocabulary sizes) appended
    to a metrics table and read back."""
    from ..operators import aggregates as A
    inter = V.interactions(spark, d)
    m = A.vocab_sizes(inter, ["user_id", "post_id"]).select(
        "*", inter.select(F.count(F.lit(1))).scalar().alias("training_samples"))
    path = IO.scratch_path(spark, "run-metrics")
    IO.append_run_metrics(m, path, "run-0001", {"seed": 42, "source": "interactions"})
    params = F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return spark.read.parquet(path).select("run_id", "metric", "value", params.alias("params"))


def _stage(df, name, spark, partition_col=None):
    """Stage replay input, one folder per ``partition_col`` value.  Files are
    picked up in no particular order of events."""
    path = IO.scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)
    return path


def _await(q):
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


@register("stream_push", "WITH " + S.FEATURE_ROWS + """
SELECT user_id, spend, feature_ts, created FROM feature_rows
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY feature_ts DESC, created DESC) = 1""")
def stream_push(spark, d):
    """ST-1 / F-8 / F-4: purchase events pushed in micro-batches (5 files per
    trigger) into the offline store and the online latest-per-user table."""
    rows = V.feature_rows(spark, d).withColumn("day", F.to_date("feature_ts"))
    src = _stage(rows, "push-src", spark, "day")
    schema = spark.read.parquet(src).schema
    stream = ST.file_stream(spark, src, schema, max_files=5).drop("day")
    online, offline = IO.scratch_path(spark, "online"), IO.scratch_path(spark, "offline")
    q = ST.push_features(stream, offline, online, ["user_id"], ["feature_ts", "created"], IO.scratch_path(spark, "ckpt-push"))
    _await(q)
    return IO.read_latest(spark, online, ["user_id"], ["feature_ts", "created"]).select("user_id", "spend", "feature_ts", "created")


LATE = "post_id % 10 = 3 AND CAST(interaction_timestamp AS DATE) < (SELECT min(CAST(interaction_timestamp AS DATE)) + 3 FROM seen_store)"


@register("stream_seen", "WITH " + ",\n".join([S.INTERACTIONS, S.SEEN]) + f"""
SELECT user_id, post_id, interaction_type, max(interaction_timestamp) AS interaction_timestamp,
       count(DISTINCT interaction_timestamp) AS n
FROM seen_store WHERE NOT ({LATE}) GROUP BY user_id, post_id, interaction_type""")
def stream_seen(spark, d):
    """ST-2: seen/disliked/reported events streamed into the serving table in three
    runs over the same checkpoint, each delivering its rows twice and a day of the run
    before again; the events of a few posts in the first days come with the last run, days
    after the watermark.  Each event in time is in the table once, the late ones are not."""
    rows = V.seen_store(spark, d)
    ts = F.col("interaction_timestamp")
    first, last = rows.agg(F.min(F.to_date(ts)), F.max(F.to_date(ts))).first()
    late = (F.col("post_id") % 10 == 3) & (F.to_date(ts) < F.lit(first) + F.expr("INTERVAL 3 DAY"))
    src, store, ckpt = (IO.scratch_path(spark, n) for n in ("seen-src", "seen-stream-store", "ckpt-seen"))
    cuts = [F.date_add(F.lit(first), (last - first).days * k // 3 + (k == 3)) for k in range(4)]
    for k in range(3):
        now = rows.where(~late & (F.to_date(ts) >= cuts[k]) & (F.to_date(ts) < cuts[k + 1]))
        again = rows.where(~late & (F.to_date(ts) >= F.date_sub(cuts[k], 1)) & (F.to_date(ts) < cuts[k]))
        sent = now.union(now).union(again)
        (sent.union(rows.where(late)) if k == 2 else sent).write.mode("append").parquet(src)
        _await(ST.seen_updates(ST.file_stream(spark, src, rows.schema), store, ckpt, "1 day"))
    return (IO.read_batches(spark, store).groupBy("user_id", "post_id", "interaction_type")
            .agg(F.max(ts).alias("interaction_timestamp"), F.count("*").alias("n")))


@register("stream_jsonl_hourly", """
SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_jsonl_hourly(spark, d):
    """ST-3: JSON-lines event batches streamed into date/hour-partitioned Parquet."""
    ev = read_table(spark, d, "events")
    src = IO.scratch_path(spark, "events-jsonl")
    ev.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(src)
    stream = ST.file_stream(spark, src, ev.schema, fmt="json", max_files=2)
    out = IO.scratch_path(spark, "events-hourly")
    _await(ST.jsonl_to_hourly(stream, out, IO.scratch_path(spark, "ckpt-jsonl")))
    return spark.read.parquet(out).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))


@register("stream_window_counts", S.with_views("""
SELECT date_trunc('day', "timestamp") AS window_start, user_id, count(*) AS events,
       count(*) FILTER (WHERE interaction_type = 'like') AS like_count,
       count(*) FILTER (WHERE interaction_type = 'comment') AS comment_count,
       count(*) FILTER (WHERE interaction_type = 'view_full') AS view_full_count
FROM interactions GROUP BY 1, 2""", S.INTERACTIONS))
def stream_window_counts(spark, d):
    """ST-4: daily per-user counts, merged from the hourly panes of a stream."""
    panes = _panes(spark, d)
    day = F.date_trunc("day", "pane_start").cast("timestamp_ntz").alias("window_start")
    return panes.groupBy(day, "user_id").agg(*[F.sum(c).alias(c) for c in ("events", "like_count", "comment_count", "view_full_count")])


def _panes(spark, d):
    inter = V.interactions(spark, d).withColumn("day", F.to_date("timestamp"))
    src = _stage(inter, "inter-src", spark, "day")
    stream = ST.file_stream(spark, src, spark.read.parquet(src).schema, max_files=5).drop("day")
    out = IO.scratch_path(spark, "pane-counts")
    _await(ST.pane_counts(stream, out, IO.scratch_path(spark, "ckpt-panes"), delay="60 days"))    # files come in no order of time
    return ST.read_panes(spark, out)


@register("stream_rolling_windows", S.with_views("""
SELECT user_id, """ + ", ".join(
    f"count(*) FILTER (WHERE inside AND {t} AND age < {n}) AS {c}_{n}d" for n in (1, 7, 30)
    for c, t in (("events", "true"), ("like_count", "interaction_type = 'like'"), ("comment_count", "interaction_type = 'comment'"),
                 ("view_full_count", "interaction_type = 'view_full'"))) + """
FROM (SELECT *, true AS inside, date_diff('hour', date_trunc('hour', "timestamp"), (SELECT date_trunc('hour', max("timestamp")) FROM interactions)) / 24.0 AS age
      FROM interactions) WHERE age < 30 GROUP BY user_id""", S.INTERACTIONS))
def stream_rolling_windows(spark, d):
    """ST-4: counts of the last 1, 7 and 30 days of each user up to the end of the last
    hour seen, three windows from one stream of panes."""
    panes = _panes(spark, d)
    end = panes.agg(F.max("pane_start")).first()[0]
    return ST.merge_panes(panes, F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR"))


UNIT_SQL = """
n AS (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm FROM {src}),
u AS (SELECT post_id, category_id, unnest(range(len(embedding))) AS dim, unnest(embedding) AS v, norm FROM n)
SELECT post_id, category_id, CAST(dim AS BIGINT) AS dim, round(CAST(v AS DOUBLE) / norm, 4) AS value FROM u"""


def _encoded(df):
    return _long_vectors(df, "embedding", 4)


@register("stream_new_posts", "WITH " + S.POSTS + "," + UNIT_SQL.format(src="posts"))
def stream_new_posts(spark, d):
    """ST-5: new posts encoded on arrival and appended to the vector table."""
    posts = V.posts(spark, d, with_text=False).select("post_id", "category_id", "embedding")
    src = _stage(posts, "posts-src", spark)
    stream = ST.file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
    out = IO.scratch_path(spark, "posts-vectors")
    _await(ST.new_post_vectors(stream, out, IO.scratch_path(spark, "ckpt-posts"), dim=64))
    return _encoded(spark.read.parquet(out))


@register("stream_vector_updates", "WITH " + S.POSTS + """,
up AS (SELECT post_id, category_id, CASE WHEN post_id % 3 = 0 THEN list_reverse(embedding) ELSE embedding END AS embedding FROM posts),"""
          + UNIT_SQL.format(src="up"))
def stream_vector_updates(spark, d):
    """ST-6: vectors arrive in two versions, newest first for some posts (a third
    of them changed, the others sent again); the store serves the newer version
    whatever the order of arrival."""
    posts = V.posts(spark, d, with_text=False).select("post_id", "category_id", "embedding")
    newer = posts.withColumn("embedding", F.when(F.col("post_id") % 3 == 0, F.reverse("embedding")).otherwise(F.col("embedding")))
    both = posts.withColumn("version", F.lit(1)).unionByName(newer.withColumn("version", F.lit(2)))
    src = _stage(both.withColumn("file", (F.col("post_id") + F.col("version")) % 2), "vector-updates", spark, "file")
    stream = ST.file_stream(spark, src, spark.read.parquet(src).schema, max_files=1).drop("file")
    store = IO.scratch_path(spark, "vector-store")
    _await(ST.latest_vectors(stream, store, IO.scratch_path(spark, "ckpt-vectors"), 64))
    return _encoded(IO.read_latest(spark, store, ["post_id"], ["version"]))


@register("stream_drop_seen", "WITH " + ",\n".join([S.INTERACTIONS, S.SEEN]) + """
SELECT interaction_id, user_id, post_id FROM interactions i WHERE interaction_type IN ('like', 'bookmark')
AND NOT EXISTS (SELECT 1 FROM seen_store s WHERE s.user_id = i.user_id AND s.post_id = i.post_id)""")
def stream_drop_seen(spark, d):
    """ST-7: a stream of candidate rows anti-joined with the static seen store."""
    cand = (V.interactions(spark, d).where(F.col("interaction_type").isin("like", "bookmark"))
            .select("interaction_id", "user_id", "post_id"))
    src = _stage(cand, "candidates-src", spark)
    stream = ST.file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
    out = IO.scratch_path(spark, "candidates")
    _await(ST.drop_seen(stream, V.seen_store(spark, d), out, IO.scratch_path(spark, "ckpt-candidates")))
    return spark.read.parquet(out).select("interaction_id", "user_id", "post_id")


@register("stream_availability", "WITH " + S.INTERACTIONS + """,
days AS (SELECT min(CAST("timestamp" AS DATE)) AS lo, max(CAST("timestamp" AS DATE)) AS hi FROM interactions),
run AS (SELECT i.*, CASE WHEN CAST("timestamp" AS DATE) < lo + CAST(floor((hi - lo) / 3) AS INTEGER) THEN 0
                         WHEN CAST("timestamp" AS DATE) < lo + CAST(floor((hi - lo) * 2 / 3) AS INTEGER) THEN 1 ELSE 2 END AS k FROM interactions i, days),
mark AS (SELECT k, max("timestamp") AS top FROM run GROUP BY k),
turned AS (SELECT *, interaction_type = 'bookmark' AS available FROM run WHERE interaction_type IN ('bookmark', 'dislike')),
known AS (
  SELECT c.interaction_id, c.user_id, c.post_id, t.available, t."timestamp" AS since,
         (SELECT max(top) FROM mark WHERE mark.k < c.k) AS seen
  FROM run c LEFT JOIN turned t ON t.post_id = c.post_id AND t.k <= c.k WHERE c.interaction_type = 'like'
  QUALIFY row_number() OVER (PARTITION BY c.interaction_id ORDER BY t."timestamp" DESC NULLS LAST, t.interaction_id DESC) = 1)
SELECT interaction_id AS id, user_id, post_id FROM known
WHERE available IS NULL OR available OR coalesce(date_trunc('millisecond', since) + INTERVAL 5 DAY <= date_trunc('millisecond', seen), false)""")
def stream_availability(spark, d):
    """ST-7: likes as candidates, bookmarks and dislikes as switches that turn a post on
    and off, streamed in three runs over one checkpoint: a candidate passes by the latest
    switch of its post so far, unless that is more than five days behind the watermark."""
    inter = V.interactions(spark, d)
    rows = inter.select(F.col("interaction_id").alias("id"), "user_id", "post_id", "interaction_type", F.col("timestamp").alias("ts"))
    first, last = rows.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    cuts = [F.date_add(F.lit(first), (last - first).days * k // 3 + (k == 3)) for k in range(4)]
    src, out, ckpt = (IO.scratch_path(spark, n) for n in ("availability-src", "available", "ckpt-available"))
    for k in range(3):
        rows.where((F.to_date("ts") >= cuts[k]) & (F.to_date("ts") < cuts[k + 1])).write.mode("append").parquet(src)
        stream = ST.file_stream(spark, src, rows.schema)
        kind = F.col("interaction_type")
        _await(ST.drop_unavailable(stream.where(kind == "like"),
                                   stream.where(kind.isin("bookmark", "dislike")).withColumn("available", kind == "bookmark"),
                                   out, ckpt, keep="5 days"))
    return IO.read_batches(spark, out).select("id", "user_id", "post_id")


@register("seen_lookup", "WITH " + ",\n".join([S.INTERACTIONS, S.SEEN]) + """
SELECT DISTINCT i.user_id, i.post_id FROM interactions i JOIN seen_store s ON s.user_id = i.user_id AND s.post_id = i.post_id
WHERE i.interaction_type IN ('like', 'bookmark') AND s.interaction_type IN ('seen', 'disliked')""")
def seen_lookup(spark, d):
    """SRC-6: which of all liked or bookmarked (user, post) pairs the stored table
    holds as seen or disliked."""
    path = IO.scratch_path(spark, "seen-lookup")
    IO.write_batch(V.seen_store(spark, d), path, "load", 0)
    wanted = V.interactions(spark, d).where(F.col("interaction_type").isin("like", "bookmark"))
    return IO.lookup(IO.read_batches(spark, path), wanted, ["user_id", "post_id"], ["seen", "disliked"])


@register("optional_tables", S.with_views("""
SELECT user_id, headline_text AS display_name, about_text AS about, 0 AS n_reports FROM users""", S.USERS))
def optional_tables(spark, d):
    """SRC-7 / SRC-8 / SNK-2: users written as one Parquet table and read back; a
    missing column falls back to another, an all-null one too, and a missing table
    counts as empty."""
    path = IO.scratch_path(spark, "users")
    u = V.users(spark, d).select("user_id", "headline_text", "about_text").withColumn("about", F.lit(None).cast("string"))
    IO.write_parquet(u, path)
    back = IO.column_or_fallback(IO.column_or_fallback(spark.read.parquet(path), "display_name", "headline_text"), "about", "about_text")
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("reports", T.IntegerType())])
    reports = IO.read_or_empty(spark, IO.scratch_path(spark, "no-reports"), schema)
    return (back.join(reports, "user_id", "left")
            .select("user_id", "display_name", "about", F.coalesce("reports", F.lit(0)).alias("n_reports")))
