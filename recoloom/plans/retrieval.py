"""Vector queries: mean user vectors, pair similarities, kNN retrieval, top-K accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..operators import knn as K
from ..sources import views as V
from . import sqlviews as S
from .registry import register

from ..defaults import RETRIEVAL_POSITIVE_TYPES as RETRIEVAL_POSITIVES, TOP_K_ACCURACY_KS, TOP_N_CANDIDATES


def positive_pairs(spark, d):
    inter = V.interactions(spark, d)
    return (inter.where(F.col("interaction_type").isin(*RETRIEVAL_POSITIVES))
            .select("user_id", "post_id").distinct())


def user_vectors(spark, d):
    """X-5: mean embedding of each user's positively interacted posts."""
    emb = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    return VX.mean_vector(positive_pairs(spark, d).join(emb, "post_id"), "user_id", "embedding", "user_vector")


# DuckDB text of the same user vectors
UV_SQL = [S.INTERACTIONS, S.POSTS, """pos AS (
  SELECT DISTINCT user_id, post_id FROM interactions
  WHERE interaction_type IN ('like', 'bookmark', 'view_full'))""", """uv AS (
  SELECT user_id, list(v ORDER BY dim) AS user_vector FROM (
    SELECT user_id, dim, avg(v) AS v FROM (
      SELECT p.user_id, unnest(range(len(e.embedding))) AS dim, unnest(e.embedding) AS v
      FROM pos p JOIN posts e USING (post_id)) GROUP BY user_id, dim) GROUP BY user_id)"""]


def _uv_sql(body: str, *more: str) -> str:
    return "WITH " + ",\n".join(UV_SQL + list(more)) + "\n" + body


@register("user_mean_vector", _uv_sql("""
SELECT user_id, CAST(dim AS BIGINT) AS dim, round(v, 6) AS value
FROM (SELECT user_id, unnest(range(len(user_vector))) AS dim, unnest(user_vector) AS v FROM uv)"""))
def user_mean_vector(spark, d):
    uv = user_vectors(spark, d)
    return uv.select("user_id", F.posexplode("user_vector").alias("dim", "v")).select(
        "user_id", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value"))


PAIR_BODY = """
SELECT p.user_id, p.post_id, round({expr}, 6) AS {name}
FROM pos p JOIN uv USING (user_id) JOIN posts e USING (post_id)"""


def _pairs(spark, d, expr, name):
    uv = user_vectors(spark, d)
    emb = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    return (positive_pairs(spark, d).join(uv, "user_id").join(emb, "post_id")
            .select("user_id", "post_id", F.round(expr(F.col("user_vector"), F.col("embedding")), 6).alias(name)))


@register("cosine_pairs", _uv_sql(PAIR_BODY.format(
    expr="list_cosine_similarity(uv.user_vector, CAST(e.embedding AS DOUBLE[]))", name="cosine")))
def cosine_pairs(spark, d):
    """SF-10 / E-6 / X-9: cosine(user mean vector, post vector) for every positive pair."""
    return _pairs(spark, d, VX.cosine, "cosine")


@register("dot_pairs", _uv_sql(PAIR_BODY.format(
    expr="list_dot_product(uv.user_vector, CAST(e.embedding AS DOUBLE[]))", name="dot")))
def dot_pairs(spark, d):
    return _pairs(spark, d, VX.dot, "dot")


@register("l2_pairs", _uv_sql(PAIR_BODY.format(
    expr="sqrt(list_sum(list_transform(list_zip(uv.user_vector, CAST(e.embedding AS DOUBLE[])), "
         "lambda x: (x[1] - x[2]) * (x[1] - x[2]))))", name="l2")))
def l2_pairs(spark, d):
    return _pairs(spark, d, VX.l2, "l2")


L2SQ = ("list_sum(list_transform(list_zip(uv.user_vector, CAST(e.embedding AS DOUBLE[])), "
        "lambda x: (x[1] - x[2]) * (x[1] - x[2])))")

KNN_K = TOP_N_CANDIDATES

KNN_SQL = _uv_sql("""
SELECT user_id, post_id, round(dist, 6) AS distance, CAST(rk AS BIGINT) AS rank FROM (
  SELECT uv.user_id, e.post_id, {l2} AS dist,
         row_number() OVER (PARTITION BY uv.user_id ORDER BY {l2}, e.post_id) AS rk
  FROM uv {join}) t
WHERE rk <= {k}""".replace("{l2}", L2SQ))


def _knn_queries(spark, d):
    return user_vectors(spark, d).select(F.col("user_id").alias("qid"), F.col("user_vector").alias("qvec"))


def _knn_items(spark, d):
    return V.posts(spark, d, with_text=False).select(
        F.col("post_id").alias("item_id"), F.col("embedding").alias("ivec"), F.col("category_id").alias("g"))


def _knn_out(res):
    return res.select(F.col("qid").alias("user_id"), F.col("item_id").alias("post_id"),
                      F.round("score", 6).alias("distance"), "rank")


@register("knn_exact", KNN_SQL.replace("{join}", "CROSS JOIN posts e").replace("{k}", str(KNN_K)))
def knn_exact(spark, d):
    """M-1 / J-9: top-100 posts by squared L2 for every user vector, over all posts."""
    return _knn_out(K.knn(_knn_queries(spark, d), _knn_items(spark, d).drop("g"), KNN_K, "l2"))


def category_prefilter(spark, d):
    """FLT-3: a user's onboarding categories; an empty list means no filter ('*')."""
    u = V.users(spark, d).select("user_id", "onboarding_category_ids")
    return u.select(F.col("user_id").alias("qid"), F.explode(
        F.when(F.size("onboarding_category_ids") > 0, F.col("onboarding_category_ids"))
        .otherwise(F.array(F.lit(K.ALL)))).alias("g"))


@register("knn_category", KNN_SQL.replace("{join}", """JOIN users u USING (user_id)
  JOIN posts e ON len(u.onboarding_category_ids) = 0 OR list_contains(u.onboarding_category_ids, e.category_id)"""
                                          ).replace("WITH ", "WITH " + S.USERS + ",\n", 1).replace("{k}", str(KNN_K)))
def knn_category(spark, d):
    """M-3: top-100 within the user's preferred categories (pre-filter, then k)."""
    return _knn_out(K.knn(_knn_queries(spark, d), _knn_items(spark, d), KNN_K, "l2",
                          query_groups=category_prefilter(spark, d)))


TOPK_SQL = _uv_sql("""
, truth AS (
  SELECT p.user_id, p.post_id, list_dot_product(uv.user_vector, CAST(e.embedding AS DOUBLE[])) AS s
  FROM pos p JOIN uv USING (user_id) JOIN posts e USING (post_id)),
ranks AS (
  SELECT t.user_id, t.post_id,
         1 + count(*) FILTER (WHERE list_dot_product(uv.user_vector, CAST(e.embedding AS DOUBLE[])) > t.s + 1e-9) AS rk
  FROM truth t JOIN uv USING (user_id) CROSS JOIN posts e GROUP BY t.user_id, t.post_id)
SELECT count(*) AS n_positives,
       round(avg(CAST(rk <= 1 AS DOUBLE)), 6) AS top_1_accuracy,
       round(avg(CAST(rk <= 5 AS DOUBLE)), 6) AS top_5_accuracy,
       round(avg(CAST(rk <= 10 AS DOUBLE)), 6) AS top_10_accuracy,
       round(avg(CAST(rk <= 50 AS DOUBLE)), 6) AS top_50_accuracy,
       round(avg(CAST(rk <= 100 AS DOUBLE)), 6) AS top_100_accuracy
FROM ranks""").replace("\n\n, truth AS", ",\ntruth AS").replace("\n, truth AS", ",\ntruth AS")


THRESHOLDS = 4096                       # scores of a user's positives that one row carries


@register("topk_accuracy", TOPK_SQL)
def topk_accuracy(spark, d):
    """A-12: share of positive pairs whose post ranks within the top K of the
    user's scores over the *whole* catalogue (rank = 1 + #items scoring higher)."""
    uv = user_vectors(spark, d)
    emb = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    pos = positive_pairs(spark, d)
    scores = K.pair_scores(pos.select(F.col("user_id").alias("lid"), F.col("post_id").alias("rid"), F.lit(None).cast("int").alias("value")),
                           uv.select(F.col("user_id").alias("lid"), F.col("user_vector").alias("lvec")),
                           emb.select(F.col("post_id").alias("rid"), F.col("embedding").alias("rvec")), K.DOT)
    pairs = scores.where("score is not null").select(F.col("lid").alias("user_id"), F.col("rid").alias("post_id"), "score")
    lists = pos.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / THRESHOLDS).cast("int").alias("lists"))
    part = F.pmod(F.xxhash64("post_id"), F.col("lists")).cast("int").alias("part")
    truth = (pairs.join(lists, "user_id")                               # rows of about THRESHOLDS scores, however many a user has
             .groupBy(F.struct("user_id", part).alias("qid"))
             .agg(F.collect_list(F.col("score") + F.lit(1e-9)).alias("thresholds"))
             .withColumn("user_id", F.col("qid.user_id")).join(uv, "user_id").drop("user_id").withColumnRenamed("user_vector", "qvec"))
    items = emb.select(F.col("post_id").alias("item_id"), F.col("embedding").alias("ivec"))
    ranks = K.count_better(truth, items).select((F.col("n_better") + 1).alias("rk"))
    return ranks.agg(F.count(F.lit(1)).alias("n_positives"),
                     *[F.round(F.avg((F.col("rk") <= k).cast("double")), 6).alias(f"top_{k}_accuracy")
                       for k in TOP_K_ACCURACY_KS])


@register("mean_vector_cosine", "WITH " + ",\n".join(UV_SQL) + """,
allpairs AS (SELECT DISTINCT user_id, post_id FROM interactions)
SELECT a.user_id, a.post_id,
       round(CASE WHEN uv.user_vector IS NULL OR e.embedding IS NULL THEN 0.0
                  ELSE coalesce(list_cosine_similarity(uv.user_vector, CAST(e.embedding AS DOUBLE[])), 0.0) END, 6)
         AS cosine
FROM allpairs a LEFT JOIN uv USING (user_id) LEFT JOIN posts e USING (post_id)""")
def mean_vector_cosine(spark, d):
    """X-9: cosine(user mean vector, post vector) for every interacted pair of any
    type; 0.0 when the user has no vector (no positives) or the post is unknown."""
    uv = user_vectors(spark, d)
    emb = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    pairs = V.interactions(spark, d).select("user_id", "post_id").distinct()
    return (pairs.join(uv, "user_id", "left").join(emb, "post_id", "left")
            .select("user_id", "post_id", F.round(VX.cosine("user_vector", "embedding"), 6).alias("cosine")))
