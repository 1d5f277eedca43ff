"""Encoding queries (§2.9 E-*, SF-3..SF-5, SF-16..SF-18, PRJ-8, PRJ-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..operators import encoding as E
from ..sources import views as V
from ..sources.tables import read_table
from . import sqlviews as S
from .registry import register
from .retrieval import UV_SQL, user_vectors


@register("vocab_encode", S.with_views("""
, v AS (SELECT category_id AS value, dense_rank() OVER (ORDER BY category_id) AS idx
        FROM (SELECT DISTINCT category_id FROM posts WHERE category_id IS NOT NULL))
SELECT i.interaction_id, i.post_id, CAST(coalesce(v.idx, 0) AS BIGINT) AS category_index
FROM interactions i LEFT JOIN posts p USING (post_id) LEFT JOIN v ON v.value = p.category_id
""", S.INTERACTIONS, S.POSTS).replace("\n, v AS", ",\nv AS"))
def vocab_encode(spark, d):
    """E-1 / E-9 / J-8: sorted vocabulary from 1, unknown → 0, applied to interactions."""
    posts = V.posts(spark, d, with_text=False).select("post_id", "category_id")
    vocab = E.vocabulary(posts, "category_id")
    inter = V.interactions(spark, d).select("interaction_id", "post_id").join(posts, "post_id", "left")
    return E.apply_vocabulary(inter, "category_id", vocab, "category_index").select(
        "interaction_id", "post_id", "category_index")


@register("category_codes", S.with_views("""
, v AS (SELECT interaction_type AS value, dense_rank() OVER (ORDER BY interaction_type) - 1 AS idx
        FROM (SELECT DISTINCT interaction_type FROM interactions))
SELECT i.interaction_id, CAST(coalesce(v.idx, -1) AS BIGINT) AS interaction_type_code
FROM interactions i LEFT JOIN v ON v.value = i.interaction_type""", S.INTERACTIONS).replace("\n, v AS", ",\nv AS"))
def category_codes(spark, d):
    """E-3: alphabetical integer codes, null → −1."""
    inter = V.interactions(spark, d).select("interaction_id", "interaction_type")
    return E.category_codes(inter, "interaction_type").select("interaction_id", "interaction_type_code")


_CLASSES = [f"cat_{i:02d}" for i in range(10)]


@register("multi_hot", S.with_views("""
c AS (SELECT user_id, unnest(onboarding_category_ids) AS value FROM users),
v AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT value FROM c))
SELECT u.user_id, coalesce(string_agg(CAST(v.idx AS VARCHAR), ',' ORDER BY v.idx), '') AS indices,
       (SELECT count(*) FROM v) AS n_classes
FROM users u LEFT JOIN c USING (user_id) LEFT JOIN v ON v.value = c.value GROUP BY u.user_id""", S.USERS).replace("\n\nc AS", ",\nc AS"))
def multi_hot(spark, d):
    """E-4: onboarding categories as sparse 0/1 rows (classes discovered from the data)."""
    u = V.users(spark, d).select("user_id", "onboarding_category_ids")
    hot = E.multi_hot(u, "onboarding_category_ids", "user_id")
    return hot.select("user_id", F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"), "n_classes")


@register("multi_hot_columns", S.with_views("SELECT user_id, " + ", ".join(
    f"CAST(list_contains(onboarding_category_ids, '{c}') AS INTEGER) AS onboarding_category_ids_{c}"
    for c in _CLASSES) + " FROM users", S.USERS))
def multi_hot_columns(spark, d):
    """E-4: one 0/1 column per onboarding category of a given list."""
    u = V.users(spark, d).select("user_id", "onboarding_category_ids")
    return E.multi_hot_columns(u, "onboarding_category_ids", _CLASSES)


@register("flatten_embedding", "WITH " + S.POSTS + "\nSELECT post_id, " + ", ".join(
    f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS embedding_dim_{i}" for i in range(64)) + " FROM posts")
def flatten_embedding(spark, d):
    """E-5 / SF-17: one column per vector dimension."""
    p = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    flat = VX.flatten(p, "embedding", 64)
    return flat.select("post_id", *[F.round(F.col(f"embedding_dim_{i}").cast("double"), 6)
                                    .alias(f"embedding_dim_{i}") for i in range(64)])


@register("zero_impute", "WITH " + ",\n".join(UV_SQL + [S.USERS]) + """
SELECT u.user_id, CAST(uv.user_vector IS NULL AS INTEGER) AS imputed,
       CAST(len(coalesce(uv.user_vector, list_transform(range(64), lambda x: 0.0))) AS BIGINT) AS dim,
       round(sqrt(list_sum(list_transform(coalesce(uv.user_vector, list_transform(range(64), lambda x: 0.0)),
                                          lambda x: x * x))), 6) AS norm
FROM users u LEFT JOIN uv USING (user_id)""")
def zero_impute(spark, d):
    """PRJ-8 / SF-16: missing or wrong-length vectors → zero vector of the modal dimension."""
    uv = user_vectors(spark, d)
    u = V.users(spark, d).select("user_id").join(uv, "user_id", "left")
    u = u.withColumn("__dim", VX.modal_dim(uv, "user_vector"))
    v = VX.zero_impute("user_vector", F.col("__dim"))
    return u.select("user_id", F.col("user_vector").isNull().cast("int").alias("imputed"),
                    F.size(v).cast("bigint").alias("dim"), F.round(VX.norm(v), 6).alias("norm"))


@register("parse_lists", S.with_views("""
SELECT user_id, CAST(len(onboarding_category_ids) AS BIGINT) AS n_items,
       array_to_string(onboarding_category_ids, ',') AS items
FROM users""", S.USERS))
def parse_lists(spark, d):
    """SF-3: users' category lists written as Python-style literals and parsed back."""
    u = V.users(spark, d).select("user_id", "onboarding_category_ids")
    text = F.concat(F.lit("['"), F.array_join("onboarding_category_ids", "', '"), F.lit("']"))
    parsed = E.parse_string_list(text)
    return u.select("user_id", F.size(parsed).cast("bigint").alias("n_items"),
                    F.array_join(parsed, ",").alias("items"))


@register("parse_vectors", "WITH " + S.POSTS + """
SELECT post_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS vsum,
       CAST(len(embedding) AS BIGINT) AS dim FROM posts""")
def parse_vectors(spark, d):
    """SF-4: embedding vectors rendered as text and parsed back into array<float>."""
    p = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ", "), F.lit("]"))
    v = E.parse_float_list(text)
    s = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return p.select("post_id", F.round(s, 4).alias("vsum"), F.size(v).cast("bigint").alias("dim"))


@register("parse_times", """
WITH t AS (
  SELECT event_id, date_trunc('second', ts) AS s, event_id % 11 AS m,
         CASE event_id % 11
           WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 1 THEN CAST(CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS VARCHAR)
           WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000+0000'
           WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
           WHEN 4 THEN 'bad-' || CAST(event_id AS VARCHAR)
           WHEN 5 THEN strftime(ts, '%Y-%m-%d')
           WHEN 6 THEN strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') || '+01:30'
           WHEN 7 THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') || '.250000-05:00'
           WHEN 8 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0000'
           WHEN 9 THEN strftime(ts, '%Y-%m-%dT%H:%M')
           ELSE strftime(ts, ' %Y-%m-%d %H:%M:%S ') END AS raw
  FROM events)
SELECT event_id, raw, CASE m WHEN 4 THEN NULL WHEN 5 THEN date_trunc('day', s) WHEN 7 THEN s + INTERVAL 250 MILLISECOND
                             WHEN 9 THEN date_trunc('minute', s) ELSE s END AS parsed FROM t""")
def parse_times(spark, d):
    """SF-5 / SF-6: mixed timestamp text (dates, ISO with and without zone,
    offset, seconds and fraction, epoch seconds, junk) → UTC timestamps or null."""
    ev = read_table(spark, d, "events").select("event_id", "ts")
    m, ts = F.col("event_id") % 11, F.col("ts")
    text = lambda t, f: F.date_format(t, f)
    day, full = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"
    raw = (F.when(m == 0, text(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(m == 1, F.unix_timestamp(F.date_trunc("second", ts).cast("timestamp")).cast("string"))
           .when(m == 2, F.concat(text(ts, full), F.lit(".000000+0000")))
           .when(m == 3, text(ts, "yyyy-MM-dd'T'HH:mm:ss"))
           .when(m == 4, F.concat(F.lit("bad-"), F.col("event_id").cast("string")))
           .when(m == 5, text(ts, day))
           .when(m == 6, F.concat(text(ts + F.expr("INTERVAL 90 MINUTE"), full), F.lit("+01:30")))
           .when(m == 7, F.concat(text(ts - F.expr("INTERVAL 5 HOUR"), full), F.lit(".250000-05:00")))
           .when(m == 8, F.concat(text(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000")))
           .when(m == 9, text(ts, "yyyy-MM-dd'T'HH:mm"))
           .otherwise(F.concat(F.lit(" "), text(ts, full), F.lit(" "))))
    return ev.select("event_id", raw.alias("raw")).select("event_id", "raw",
                                                          E.parse_timestamp(F.col("raw")).alias("parsed"))


@register("type_coercion", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def type_coercion(spark, d):
    """PRJ-10: a string column becomes numeric because every value parses."""
    ev = read_table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"))
    return E.coerce_numeric(ev, "k")


@register("type_coercion_kinds", """
SELECT event_id, CAST(value > 50 AS INTEGER) AS flag, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS kind, value FROM events""")
def type_coercion_kinds(spark, d):
    """PRJ-10: boolean → 0/1, date → string; text that is no number and numbers stay."""
    ev = read_table(spark, d, "events").select("event_id", (F.col("value") > 50).alias("flag"), F.to_date("ts").alias("day"),
                                               F.col("event_type").alias("kind"), "value")
    for c in ("flag", "day", "kind", "value"):
        ev = E.coerce_numeric(ev, c)
    return ev


@register("select_drop_rows", S.with_views("""
SELECT i.interaction_id, i.interaction_type, i.user_id FROM interactions i JOIN posts p USING (post_id)
WHERE p.description_text IS NOT NULL""", S.INTERACTIONS, S.POSTS))
def select_drop_rows(spark, d):
    """PRJ-1 / PRJ-5 / PRJ-6: chosen features in declared order, columns dropped by
    pattern, rows with a missing value dropped."""
    from ..operators import columns as C
    j = V.interactions(spark, d).join(V.posts(spark, d).select("post_id", "description_text"), "post_id")
    j = C.drop_incomplete(C.drop_matching(j, "^time"), ["description_text"])
    return C.select_features(j, ["interaction_id"], ["interaction_type", "user_id"])


@register("shuffled_rows", """SELECT o_orderkey, o_custkey FROM orders""")
def shuffled_rows(spark, d):
    """ORD-4: all orders in a repeatable shuffled order (the set is checked here,
    the order by a test)."""
    from ..operators import columns as C
    return C.shuffle_rows(read_table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], seed=42)
