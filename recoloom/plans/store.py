"""Feature-store queries: as-of retrieval, materialisation, online reads (§2.11)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import asof
from ..operators.store import Entity, FeatureService, FeatureStore, FeatureView, OnDemandView, Source
from ..sources import views as V
from . import sqlviews as S
from .registry import register

USER = Entity("user", ("user_id",))
POST = Entity("post", ("post_id",))


def text_embeddings(spark, d):
    """The users' and posts' text columns, encoded together: (kind, id, sparse vector)."""
    from ..operators import textvec as TV
    u, p = V.users(spark, d), V.posts(spark, d)
    texts = None
    for kind, rows, key, text in (("about", u, "user_id", "about_text"), ("headline", u, "user_id", "headline_text"),
                                  ("description", p, "post_id", "description_text")):
        part = rows.select(F.struct(F.lit(kind).alias("kind"), F.col(key).alias("id")).alias("key"), F.col(text).alias("text"))
        texts = part if texts is None else texts.unionByName(part)
    return TV.packed_vectors(texts, "key", "text").select("key.kind", "key.id", "vector").checkpoint()


def user_profiles(spark, d, vec):
    """F-1: what a user states, with the vectors of the two texts."""
    of = lambda k: vec.where(F.col("kind") == k).select(F.col("id").alias("user_id"), F.col("vector").alias(f"{k}_embedding"))
    return (V.users(spark, d).select("user_id", "onboarding_category_ids", F.col("creation_timestamp").alias("event_timestamp"))
            .join(of("about"), "user_id", "left").join(of("headline"), "user_id", "left"))


def post_details(spark, d, vec):
    """F-1: what a post is, with the vector of its text."""
    vec = vec.where("kind = 'description'").select(F.col("id").alias("post_id"), F.col("vector").alias("description_embedding"))
    return (V.posts(spark, d, with_text=False).select("post_id", "category_id", "media_type", "creator_id", "creation_timestamp",
                                                      F.col("creation_timestamp").alias("event_timestamp"))
            .join(vec, "post_id", "left"))


def feature_store(spark, d, spend_ttl: str | None = None) -> FeatureStore:
    """The engine's feature definitions over the canonical views (F-1)."""
    spend = FeatureView("user_spend", (USER,),
                        Source(lambda: V.feature_rows(spark, d), "feature_ts", "created"),
                        ("spend",), ttl=spend_ttl)
    post_stats = FeatureView(
        "post_stats", (POST,),
        Source(lambda: A.post_aggregates(V.interactions(spark, d), V.posts(spark, d, with_text=False)),
               "event_timestamp"),
        ("post_age_hours", "num_likes_on_post", "num_views_on_post", "num_comments_on_post"))
    user_stats = FeatureView(
        "user_stats", (USER,),
        Source(lambda: A.user_aggregates(V.interactions(spark, d), V.posts(spark, d, with_text=False),
                                         V.users(spark, d)), "event_timestamp"),
        ("count_likes_given", "count_comments_given", "distinct_categories_interacted"))
    texts = cache(lambda: text_embeddings(spark, d))            # once for both views, and only if one is read
    profile = FeatureView("user_profile_features", (USER,), Source(lambda: user_profiles(spark, d, texts()), "event_timestamp"),
                          ("onboarding_category_ids", "about_embedding", "headline_embedding"))
    details = FeatureView("post_details_features", (POST,), Source(lambda: post_details(spark, d, texts()), "event_timestamp"),
                          ("category_id", "media_type", "creator_id", "creation_timestamp", "description_embedding"))
    request = OnDemandView("request_features", {
        # stored feature + request-time value (F-6): the entity row carries val_to_add
        "spend_plus_val": lambda: F.col("user_spend__spend") + F.col("val_to_add"),
        "spend_plus_val_2": lambda: F.col("user_spend__spend") + F.col("val_to_add") * 2,
    })
    return FeatureStore([spend, post_stats, user_stats, profile, details], [request])


ASOF_SQL = S.with_views("""
SELECT e.event_id, e.user_id, e.event_ts, e.post_id, e.label, f.spend, f.feature_ts
FROM entity_rows e LEFT JOIN feature_rows f ON f.user_id = e.user_id AND f.feature_ts <= e.event_ts {ttl}
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.feature_ts DESC NULLS LAST, f.created DESC NULLS LAST) = 1
""", S.ENTITY_ROWS, S.FEATURE_ROWS)


@register("asof_features", ASOF_SQL.format(ttl=""))
def asof_features(spark, d):
    return asof.point_in_time_join(V.entity_rows(spark, d), V.feature_rows(spark, d), "user_id",
                                   "event_ts", "feature_ts", ["spend"], created_col="created")


@register("asof_features_unbucketed", ASOF_SQL.format(ttl=""))
def asof_features_unbucketed(spark, d):
    """The same join over another number of ranges — cross-check of what crosses borders."""
    return asof.point_in_time_join(V.entity_rows(spark, d), V.feature_rows(spark, d), "user_id",
                                   "event_ts", "feature_ts", ["spend"], created_col="created", partitions=37)


@register("asof_missing_keys", "WITH " + S.ENTITY_ROWS + ",\n" + S.FEATURE_ROWS + """,
e AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 5 <> 0 THEN event_ts END AS event_ts FROM entity_rows),
f AS (SELECT CASE WHEN created % 11 <> 0 THEN user_id END AS user_id, spend, created, CASE WHEN created % 3 <> 0 THEN feature_ts END AS feature_ts FROM feature_rows)
SELECT e.event_id, e.user_id, e.event_ts, f.spend, f.feature_ts FROM e LEFT JOIN f ON f.user_id = e.user_id AND f.feature_ts <= e.event_ts
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.feature_ts DESC NULLS LAST, f.created DESC NULLS LAST) = 1""")
def asof_missing_keys(spark, d):
    """J-6 where users and times are missing on both sides: such rows match nothing."""
    gap = lambda c, by, n: F.when(F.col(by) % n != 0, F.col(c)).alias(c)
    ent = V.entity_rows(spark, d).select("event_id", gap("user_id", "event_id", 7), gap("event_ts", "event_id", 5))
    feat = V.feature_rows(spark, d).select(gap("user_id", "created", 11), "spend", "created", gap("feature_ts", "created", 3))
    return asof.point_in_time_join(ent, feat, "user_id", "event_ts", "feature_ts", ["spend"], created_col="created")


@register("asof_features_ttl",
          ASOF_SQL.format(ttl="AND f.feature_ts >= e.event_ts - INTERVAL 1 DAY"))
def asof_features_ttl(spark, d):
    return asof.point_in_time_join(V.entity_rows(spark, d), V.feature_rows(spark, d), "user_id",
                                   "event_ts", "feature_ts", ["spend"], created_col="created", ttl="1 day")


_POST_STATS = """
, ps AS (
  SELECT p.post_id, p.creation_timestamp AS event_timestamp,
         count(i.post_id) FILTER (WHERE i.interaction_type = 'like') AS num_likes_on_post,
         count(i.post_id) FILTER (WHERE i.interaction_type = 'view_full') AS num_views_on_post,
         count(i.post_id) FILTER (WHERE i.interaction_type = 'comment') AS num_comments_on_post
  FROM posts p LEFT JOIN interactions i USING (post_id) GROUP BY p.post_id, p.creation_timestamp)"""

MULTI_SQL = "WITH " + ",\n".join([S.ENTITY_ROWS, S.FEATURE_ROWS, S.INTERACTIONS, S.POSTS]) + _POST_STATS + """
, us AS (
  SELECT e.event_id, f.spend FROM entity_rows e
  LEFT JOIN feature_rows f ON f.user_id = e.user_id AND f.feature_ts <= e.event_ts
  QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.feature_ts DESC NULLS LAST, f.created DESC NULLS LAST) = 1),
pj AS (
  SELECT e.event_id, s.num_likes_on_post, s.num_views_on_post FROM entity_rows e
  LEFT JOIN ps s ON s.post_id = e.post_id AND s.event_timestamp <= e.event_ts)
SELECT e.event_id, e.user_id, e.post_id, e.event_ts AS event_timestamp, e.label,
       us.spend AS user_spend__spend,
       CAST(pj.num_likes_on_post AS BIGINT) AS post_stats__num_likes_on_post,
       CAST(pj.num_views_on_post AS BIGINT) AS post_stats__num_views_on_post
FROM entity_rows e JOIN us USING (event_id) JOIN pj USING (event_id)
"""


def _entities(spark, d):
    return V.entity_rows(spark, d).withColumnRenamed("event_ts", "event_timestamp")


@register("asof_multi_view", MULTI_SQL)
def asof_multi_view(spark, d):
    fs = feature_store(spark, d)
    return fs.get_historical_features(
        _entities(spark, d),
        ["user_spend:spend", "post_stats:num_likes_on_post", "post_stats:num_views_on_post"])


ON_DEMAND_SQL = S.with_views("""
, us AS (
  SELECT e.event_id, f.spend FROM entity_rows e
  LEFT JOIN feature_rows f ON f.user_id = e.user_id AND f.feature_ts <= e.event_ts
  QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.feature_ts DESC NULLS LAST, f.created DESC NULLS LAST) = 1)
SELECT e.event_id, e.user_id, e.post_id, e.event_ts AS event_timestamp, e.label, e.post_id AS val_to_add,
       us.spend AS user_spend__spend,
       us.spend + e.post_id AS request_features__spend_plus_val,
       us.spend + e.post_id * 2 AS request_features__spend_plus_val_2
FROM entity_rows e JOIN us USING (event_id)""", S.ENTITY_ROWS, S.FEATURE_ROWS).replace("\n, us AS", ",\nus AS")


@register("asof_now", S.with_views("""
SELECT e.event_id, e.user_id, e.event_ts AS event_timestamp, f.spend AS user_spend__spend
FROM entity_rows e LEFT JOIN feature_rows f ON f.user_id = e.user_id AND f.feature_ts <= TIMESTAMP '2024-01-15 00:00:00'
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.feature_ts DESC NULLS LAST, f.created DESC NULLS LAST) = 1
""", S.ENTITY_ROWS, S.FEATURE_ROWS))
def asof_now(spark, d):
    """F-10: features as they stood at one given time, whatever the rows' own event times."""
    ent = _entities(spark, d).select("event_id", "user_id", "event_timestamp")
    return feature_store(spark, d).get_historical_features(ent, ["user_spend:spend"], as_of="2024-01-15 00:00:00")


@register("on_demand_features", ON_DEMAND_SQL)
def on_demand_features(spark, d):
    fs = feature_store(spark, d)
    ent = _entities(spark, d).withColumn("val_to_add", F.col("post_id"))
    return fs.get_historical_features(
        ent, ["user_spend:spend", "request_features:spend_plus_val", "request_features:spend_plus_val_2"])


SERVICE_SQL = "WITH " + ",\n".join([S.ENTITY_ROWS, S.INTERACTIONS, S.POSTS]) + _POST_STATS + """
SELECT e.event_id, e.post_id, e.event_ts AS event_timestamp,
       CAST(s.num_comments_on_post AS BIGINT) AS post_stats__num_comments_on_post
FROM entity_rows e LEFT JOIN ps s ON s.post_id = e.post_id AND s.event_timestamp <= e.event_ts
"""


@register("feature_service_select", SERVICE_SQL)
def feature_service_select(spark, d):
    """A named bundle with a per-view sub-selection (F-7)."""
    fs = feature_store(spark, d)
    svc = FeatureService("post_engagement_v1", ("post_stats:num_comments_on_post",))
    ent = _entities(spark, d).select("event_id", "post_id", "event_timestamp")
    return fs.get_historical_features(ent, svc)


LATEST_SQL = S.with_views("""
SELECT user_id, spend, feature_ts FROM feature_rows {where}
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY feature_ts DESC, created DESC) = 1
""", S.FEATURE_ROWS)


@register("latest_features", LATEST_SQL.format(where=""))
def latest_features(spark, d):
    return feature_store(spark, d).materialize("user_spend")


@register("materialize_range", LATEST_SQL.format(
    where="WHERE feature_ts >= TIMESTAMP '2024-01-10 00:00:00' AND feature_ts <= TIMESTAMP '2024-01-20 00:00:00'"))
def materialize_range(spark, d):
    return feature_store(spark, d).materialize(
        "user_spend", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"),
        F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


@register("online_lookup", S.with_views("""
, latest AS (SELECT user_id, spend, feature_ts FROM feature_rows
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY feature_ts DESC, created DESC) = 1)
SELECT c.c_custkey AS user_id, l.spend, l.feature_ts FROM customer c LEFT JOIN latest l ON l.user_id = c.c_custkey
""", S.FEATURE_ROWS).replace("\n, latest AS", ",\nlatest AS"))
def online_lookup(spark, d):
    keys = V.users(spark, d).select("user_id")
    return feature_store(spark, d).get_online_features(keys, "user_spend")


@register("materialize_incremental", LATEST_SQL.format(where=""))
def materialize_incremental(spark, d):
    """F-4: two incremental materialisations (to mid-range, then to the end)
    from a stored high-water mark; the online table then equals a full one."""
    from ..sources import io as IO
    online, state = IO.scratch_path(spark, "online-inc"), IO.scratch_path(spark, "online-inc-mark")
    src = V.feature_rows(spark, d)
    mid = src.select(F.percentile_approx(F.unix_micros(F.col("feature_ts").cast("timestamp")), 0.5)).first()[0]
    end = src.select(F.max("feature_ts")).first()[0]
    import datetime as _dt
    mid_ts = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=int(mid))
    for upto in (mid_ts, end):
        asof.materialize_incremental(spark, src, "user_id", "feature_ts", ["spend"], online, state,
                                     F.lit(upto).cast("timestamp_ntz"), created_col="created")
    return IO.read_latest(spark, online, ["user_id"], ["feature_ts", "created"]).select("user_id", "spend", "feature_ts")
