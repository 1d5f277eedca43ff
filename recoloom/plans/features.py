"""Feature-pipeline queries: entity aggregates and profiles (§2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..sources import views as V
from . import sqlviews as S
from .registry import register

USER_AGG_SQL = """
, up AS (
  SELECT user_id, post_id,
         count(*) FILTER (WHERE interaction_type = 'like') AS likes,
         count(*) FILTER (WHERE interaction_type = 'comment') AS comments,
         max("timestamp") AS last_ts
  FROM {inter} GROUP BY user_id, post_id),
upc AS (SELECT up.*, p.creator_id, p.category_id FROM up LEFT JOIN {posts} p USING (post_id)),
actor AS (
  SELECT user_id, sum(likes) AS count_likes_given, sum(comments) AS count_comments_given,
         max(last_ts) AS last_interaction_timestamp,
         count(DISTINCT category_id) AS distinct_categories_interacted
  FROM upc GROUP BY user_id),
recv AS (SELECT creator_id AS user_id, sum(likes) AS num_likes_received_on_posts
         FROM upc WHERE creator_id IS NOT NULL GROUP BY creator_id),
created AS (SELECT creator_id AS user_id, count(*) AS num_posts_created FROM {posts} GROUP BY creator_id)
SELECT u.user_id,
       CAST(coalesce(c.num_posts_created, 0) AS BIGINT) AS num_posts_created,
       CAST(coalesce(a.count_likes_given, 0) AS BIGINT) AS count_likes_given,
       CAST(coalesce(a.count_comments_given, 0) AS BIGINT) AS count_comments_given,
       CAST(coalesce(a.distinct_categories_interacted, 0) AS BIGINT) AS distinct_categories_interacted,
       CAST(coalesce(r.num_likes_received_on_posts, 0) AS BIGINT) AS num_likes_received_on_posts,
       coalesce(a.last_interaction_timestamp, TIMESTAMP '1970-01-01 00:00:00') AS last_interaction_timestamp,
       coalesce(a.last_interaction_timestamp, TIMESTAMP '1970-01-01 00:00:00') AS event_timestamp
FROM {users} u LEFT JOIN actor a USING (user_id) LEFT JOIN recv r USING (user_id)
     LEFT JOIN created c USING (user_id)
"""


def _user_agg_sql(inter, posts, users, *views):
    # The body starts with ", up AS (...)" so it extends the view CTE list.
    return "WITH " + ",\n".join(views) + USER_AGG_SQL.format(inter=inter, posts=posts, users=users)


@register("user_aggregates", _user_agg_sql("interactions", "posts", "users", S.INTERACTIONS, S.POSTS, S.USERS))
def user_aggregates(spark, d):
    return A.user_aggregates(V.interactions(spark, d), V.posts(spark, d, with_text=False), V.users(spark, d))


@register("order_user_aggregates", _user_agg_sql("order_interactions", "order_posts", "order_users",
                                                 S.ORDER_INTERACTIONS, S.ORDER_POSTS, S.ORDER_USERS))
def order_user_aggregates(spark, d):
    """Same operator over the 6×-larger orders ⋈ lineitem fact (timing query)."""
    return A.user_aggregates(V.order_interactions(spark, d), V.order_posts(spark, d), V.order_users(spark, d))


POST_AGG_SQL = S.with_views("""
, counts AS (
  SELECT post_id,
         count(*) FILTER (WHERE interaction_type = 'like') AS num_likes_on_post,
         count(*) FILTER (WHERE interaction_type = 'view_full') AS num_views_on_post,
         count(*) FILTER (WHERE interaction_type = 'comment') AS num_comments_on_post
  FROM interactions GROUP BY post_id)
SELECT p.post_id,
       round(coalesce((epoch_us((SELECT max("timestamp") FROM interactions)) - epoch_us(p.creation_timestamp)) / 3.6e9, 0.0), 6)
         AS post_age_hours,
       CAST(coalesce(c.num_likes_on_post, 0) AS BIGINT) AS num_likes_on_post,
       CAST(coalesce(c.num_views_on_post, 0) AS BIGINT) AS num_views_on_post,
       CAST(coalesce(c.num_comments_on_post, 0) AS BIGINT) AS num_comments_on_post,
       p.creation_timestamp, p.creation_timestamp AS event_timestamp
FROM posts p LEFT JOIN counts c USING (post_id)
""".lstrip("\n"), S.INTERACTIONS, S.POSTS).replace("\n, counts", ",\ncounts")


@register("post_aggregates", POST_AGG_SQL)
def post_aggregates(spark, d):
    out = A.post_aggregates(V.interactions(spark, d), V.posts(spark, d, with_text=False))
    return out.withColumn("post_age_hours", F.round("post_age_hours", 6))


@register("vocab_sizes", S.with_views("""
SELECT CAST(count(DISTINCT user_id) + 2 AS BIGINT) AS user_id_vocab_size,
       CAST(count(DISTINCT post_id) + 2 AS BIGINT) AS post_id_vocab_size,
       CAST(count(DISTINCT interaction_type) + 2 AS BIGINT) AS interaction_type_vocab_size
FROM interactions""", S.INTERACTIONS))
def vocab_sizes(spark, d):
    return A.vocab_sizes(V.interactions(spark, d), ["user_id", "post_id", "interaction_type"])


@register("column_profile", S.with_views("""
SELECT (SELECT count(*) FROM posts) AS row_count, column_name, null_count FROM (
  SELECT 'post_id' AS column_name, count(*) FILTER (WHERE post_id IS NULL) AS null_count FROM posts
  UNION ALL SELECT 'creator_id', count(*) FILTER (WHERE creator_id IS NULL) FROM posts
  UNION ALL SELECT 'category_id', count(*) FILTER (WHERE category_id IS NULL) FROM posts
  UNION ALL SELECT 'media_type', count(*) FILTER (WHERE media_type IS NULL) FROM posts
  UNION ALL SELECT 'description_text', count(*) FILTER (WHERE description_text IS NULL) FROM posts
  UNION ALL SELECT 'creation_timestamp', count(*) FILTER (WHERE creation_timestamp IS NULL) FROM posts
  UNION ALL SELECT 'embedding', count(*) FILTER (WHERE embedding IS NULL) FROM posts) t""", S.POSTS))
def column_profile(spark, d):
    return A.null_profile(V.posts(spark, d))


@register("formatted_ids", S.with_views("""
SELECT interaction_id, printf('i_%07d', interaction_id) AS interaction_key, printf('u_%04d', user_id) AS user_key,
       printf('p_%05d', post_id) AS post_key FROM interactions""", S.INTERACTIONS))
def formatted_ids(spark, d):
    """SF-1: zero-padded string ids of the reference's id scheme."""
    from ..operators.columns import format_id
    i = V.interactions(spark, d)
    return i.select("interaction_id", format_id("i_", 7, F.col("interaction_id")).alias("interaction_key"),
                    format_id("u_", 4, F.col("user_id")).alias("user_key"),
                    format_id("p_", 5, F.col("post_id")).alias("post_key"))


@register("interaction_time_rules", S.with_views("""
SELECT i.interaction_id,
       i."timestamp" >= greatest(u.creation_timestamp, p.creation_timestamp) AS is_valid,
       least(greatest(i."timestamp", u.creation_timestamp, p.creation_timestamp),
             (SELECT max("timestamp") FROM interactions)) AS clamped_timestamp
FROM interactions i JOIN users u USING (user_id) JOIN posts p USING (post_id)""",
                                              S.INTERACTIONS, S.USERS, S.POSTS))
def interaction_time_rules(spark, d):
    """SF-9: an interaction must follow the user's and the post's creation;
    times are clamped into [latest creation, end of range]."""
    from ..operators.columns import time_rules
    i = V.interactions(spark, d)
    u = V.users(spark, d).select("user_id", F.col("creation_timestamp").alias("u_created"))
    p = V.posts(spark, d, with_text=False).select("post_id", F.col("creation_timestamp").alias("p_created"))
    end = i.select(F.max("timestamp")).scalar()
    valid, clamped = time_rules(F.col("timestamp"), F.col("u_created"), F.col("p_created"), latest=end)
    return i.join(u, "user_id").join(p, "post_id").select("interaction_id", valid.alias("is_valid"),
                                                          clamped.alias("clamped_timestamp"))


@register("vocab_first_seen", S.with_views("""
, v AS (SELECT interaction_type AS value, row_number() OVER (ORDER BY min("timestamp"), interaction_type) AS idx
        FROM interactions GROUP BY interaction_type)
SELECT i.interaction_id, CAST(coalesce(v.idx, 0) AS BIGINT) AS type_index
FROM interactions i LEFT JOIN v ON v.value = i.interaction_type""", S.INTERACTIONS).replace("\\n, v AS", ",\\nv AS"))
def vocab_first_seen(spark, d):
    """E-2: vocabulary in first-appearance order (by event time), OOV = 0."""
    from ..operators import encoding as E
    i = V.interactions(spark, d)
    vocab = E.first_seen_vocabulary(i, "interaction_type", "timestamp")
    return E.apply_vocabulary(i, "interaction_type", vocab, "type_index").select("interaction_id", "type_index")


@register("aligned_features", """
SELECT user_id, CAST(count_likes_given AS DOUBLE) AS count_likes_given,
       CAST(num_posts_created AS DOUBLE) AS num_posts_created, CAST(0.0 AS DOUBLE) AS embedding_norm,
       CAST(distinct_categories_interacted AS DOUBLE) AS distinct_categories_interacted
FROM (""" + _user_agg_sql("interactions", "posts", "users", S.INTERACTIONS, S.POSTS, S.USERS) + ") t")
def aligned_features(spark, d):
    """PRJ-9: a frame forced onto a declared feature schema — order imposed,
    an absent feature added as 0.0, types cast."""
    from pyspark.sql import types as T

    from ..operators.columns import align_to
    ua = A.user_aggregates(V.interactions(spark, d), V.posts(spark, d, with_text=False), V.users(spark, d))
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("count_likes_given", T.DoubleType()),
                           T.StructField("num_posts_created", T.DoubleType()),
                           T.StructField("embedding_norm", T.DoubleType()),
                           T.StructField("distinct_categories_interacted", T.DoubleType())])
    return align_to(ua, schema, fill_missing=0.0)
