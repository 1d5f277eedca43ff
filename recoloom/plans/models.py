"""Metrics and model queries (A-11, X-31, X-32, M-5..M-9, E-8, E-10, X-33)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..functions.hashing import md5_sql
from ..operators import knn as K
from ..operators import metrics as MT
from ..operators import sampling as SM
from ..sources import views as V
from ..sources.tables import read_table
from .registry import register
from .retrieval import L2SQ, UV_SQL, user_vectors
from . import sqlviews as S
from .training import PAIRS_CTES, _params_sql, _walk_sql


def pair_predictions(spark, d):
    """Retrieval pairs scored by (cosine(user vector, post vector) + 1) / 2."""
    pairs = SM.retrieval_pairs(V.interactions(spark, d))
    emb = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    uv = user_vectors(spark, d)
    whole = F.forall("embedding", lambda x: x.isNotNull())
    cosine = K.pair_scores(pairs.select(F.col("user_id").alias("lid"), F.col("post_id").alias("rid"), F.col("label").alias("value")),
                           uv.select(F.col("user_id").alias("lid"), F.col("user_vector").alias("lvec")),
                           emb.where(whole).select(F.col("post_id").alias("rid"), F.col("embedding").alias("rvec")), K.COSINE)
    return cosine.select(F.col("lid").alias("user_id"), F.col("rid").alias("post_id"), F.col("value").alias("label"),
                         ((F.coalesce("score", F.lit(0.0)) + 1.0) / 2.0).alias("score"))


PRED_CTES = PAIRS_CTES + [S.POSTS, """rpos AS (
  SELECT DISTINCT user_id, post_id FROM interactions
  WHERE interaction_type IN ('like', 'bookmark', 'view_full'))""", UV_SQL[3].replace("FROM pos p", "FROM rpos p"),
    """pred AS (
  SELECT pr.user_id, pr.post_id, pr.label,
         (CASE WHEN uv.user_vector IS NULL OR e.embedding IS NULL THEN 0.0
               ELSE coalesce(list_cosine_similarity(uv.user_vector, CAST(e.embedding AS DOUBLE[])), 0.0) END
          + 1.0) / 2.0 AS score
  FROM pairs pr LEFT JOIN uv USING (user_id) LEFT JOIN posts e USING (post_id))"""]

BIN_SQL = "WITH " + ",\n".join(PRED_CTES) + """,
rk AS (SELECT label, rank() OVER (ORDER BY score) AS r0, count(*) OVER (PARTITION BY score) AS ties FROM pred),
auc AS (SELECT (sum(CASE WHEN label = 1 THEN r0 + (ties - 1) / 2.0 END)
                - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
               / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS roc_auc FROM rk),
m AS (SELECT count(*) AS n,
             avg(-(label * ln(greatest(least(score, 1 - 1e-15), 1e-15))
                   + (1 - label) * ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)))) AS log_loss,
             avg(CASE WHEN (score >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy,
             count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
             count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn FROM pred),
pr AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM m)
SELECT n, round(roc_auc, 6) AS roc_auc, round(log_loss, 6) AS log_loss, round(accuracy, 6) AS accuracy,
       round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) AS f1
FROM pr, auc"""


@register("binary_metrics", BIN_SQL)
def binary_metrics(spark, d):
    """A-11 / X-31 / M-14: AUC (exact, tie-correct), log-loss, accuracy, precision, recall, F1 at 0.5."""
    m = MT.binary_metrics(pair_predictions(spark, d))
    return m.select("n", *[F.round(c, 6).alias(c) for c in
                           ("roc_auc", "log_loss", "accuracy", "precision", "recall", "f1")])


RANK_SQL = "WITH " + ",\n".join(UV_SQL) + f""",
recs AS (
  SELECT user_id, post_id, rk AS rank FROM (
    SELECT uv.user_id, e.post_id,
           row_number() OVER (PARTITION BY uv.user_id ORDER BY {L2SQ}, e.post_id) AS rk
    FROM uv CROSS JOIN posts e) t WHERE rk <= 10),
nrel AS (SELECT user_id, count(*) AS n_rel FROM pos GROUP BY user_id),
per AS (
  SELECT r.user_id, count(p.post_id) AS hits,
         sum(CASE WHEN p.post_id IS NOT NULL THEN 1.0 / log2(r.rank + 1) ELSE 0.0 END) AS dcg,
         min(CASE WHEN p.post_id IS NOT NULL THEN r.rank END) AS first_hit
  FROM recs r LEFT JOIN pos p USING (user_id, post_id) GROUP BY r.user_id)
SELECT count(*) AS n_users,
       round(avg(hits / 10.0), 6) AS precision_at_k,
       round(avg(hits / n_rel), 6) AS recall_at_k,
       round(avg(dcg / list_sum(list_transform(range(1, least(n_rel, 10) + 1), lambda i: 1.0 / log2(i + 1)))), 6)
         AS ndcg_at_k,
       round(avg(coalesce(1.0 / first_hit, 0.0)), 6) AS mrr
FROM per JOIN nrel USING (user_id)"""


@register("ranking_metrics", RANK_SQL)
def ranking_metrics(spark, d):
    """X-32: Precision@10, Recall@10, NDCG@10, MRR of kNN recommendations against positives."""
    uv = user_vectors(spark, d).select(F.col("user_id").alias("qid"), F.col("user_vector").alias("qvec"))
    items = V.posts(spark, d, with_text=False).select(F.col("post_id").alias("item_id"),
                                                      F.col("embedding").alias("ivec"))
    recs = K.knn(uv, items, 10, "l2").select(F.col("qid").alias("user_id"), F.col("item_id").alias("post_id"),
                                             "rank")
    rel = (V.interactions(spark, d).where(F.col("interaction_type").isin("like", "bookmark", "view_full"))
           .select("user_id", "post_id"))
    m = MT.ranking_metrics(recs, rel, 10)
    return m.select("n_users", *[F.round(c, 6).alias(c) for c in
                                 ("precision_at_k", "recall_at_k", "ndcg_at_k", "mrr")])


TEXT_CTES = """tok AS (SELECT {key}, unnest(string_split_regex(lower(coalesce({text}, '')), '\\W+')) AS term FROM {src}),
tf AS (SELECT {key}, """ + md5_sql("term", seed="text") + """ % 384 AS bucket, count(*) AS tf FROM tok WHERE length(term) > 0 GROUP BY 1, 2),
idf AS (SELECT bucket, ln(((SELECT count(*) FROM {src}) + 1.0) / (count(*) + 1)) AS idf FROM tf GROUP BY bucket),
w AS (SELECT {key}, bucket, tf * idf AS w FROM tf JOIN idf USING (bucket) WHERE tf * idf > 0),
vec AS (SELECT {key}, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS value FROM w)"""


# ------------------------------------------------------------------ ranking model
NUMERIC = ["user_spend__spend", "post_stats__num_likes_on_post", "post_stats__num_views_on_post",
           "post_stats__num_comments_on_post", "cosine_similarity_user_post_embedding",
           "is_post_category_in_onboarding"]
CATEGORICAL = ["media_type"]


def training_vectors(split, posts):
    """User vectors from the training split only (no look-ahead into validation)."""
    train_pos = split.where((F.col("split") == "train") & F.col("interaction_type").isin("like", "bookmark", "view_full"))
    return VX.mean_vector(train_pos.select("user_id", "post_id").distinct()
                          .join(posts.select("post_id", "embedding"), "post_id"), "user_id", "embedding", "user_vector")


def pair_features(spark, d, ent, uv, as_of=None):
    """Rows (user_id, post_id, event_timestamp, ...) with the ranker's features:
    point-in-time features of two views (J-6b), pair features (E-6, E-7), null
    policy (PRJ-7).  One function for training and serving."""
    from ..operators import rerank as R
    from .store import feature_store
    # each post row has a number, by which its vector is found: neither vector rides through joins with the pairs
    posts = V.posts(spark, d, with_text=False).withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    users = V.users(spark, d).select("user_id", "onboarding_category_ids")
    uv = uv.checkpoint()
    f = feature_store(spark, d).get_historical_features(
        ent, ["user_spend:spend", "post_stats:num_likes_on_post", "post_stats:num_views_on_post",
              "post_stats:num_comments_on_post"], as_of=as_of)
    f = (f.join(posts.select("post_id", "__row", "category_id", "media_type", "creation_timestamp"), "post_id", "left")
         .join(users, "user_id", "left"))
    rows = f.select(
        *ent.columns, "category_id", "creation_timestamp", "media_type", "__row",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in NUMERIC[:4]],
        R.in_list_flag(F.col("category_id"), F.col("onboarding_category_ids"))
        .cast("double").alias("is_post_category_in_onboarding"))
    own = [c for c in rows.columns if c not in ("user_id", "__row")]
    scored = K.pair_scores(rows.select(F.col("user_id").alias("lid"), F.col("__row").alias("rid"), F.struct(*own).alias("value")),
                           uv.select(F.col("user_id").alias("lid"), F.col("user_vector").alias("lvec")),
                           posts.where(F.forall("embedding", lambda x: x.isNotNull())).select(F.col("__row").alias("rid"), F.col("embedding").alias("rvec")),
                           K.COSINE)
    f = scored.select(F.col("lid").alias("user_id"), "value.*", F.coalesce("score", F.lit(0.0)).alias("cosine_similarity_user_post_embedding"))
    return f.select(*ent.columns, "category_id", "creation_timestamp", "media_type", *NUMERIC)


def ranking_datasets(spark, d):
    """E-12: (train, validation) ranking sets — split → positives (one row per
    interaction, N-3) ∪ sampled negatives (N-1) → features, joined once for both."""
    split, posts, both = _ranking_pairs(spark, d)
    # written once (reliable checkpoint in spark.checkpoint.dir): the estimators read
    # it many times, and a lost executor does not replay the sampling
    f = pair_features(spark, d, both, training_vectors(split, posts)).drop("category_id", "creation_timestamp").checkpoint()
    return f.where("split = 'train'"), f.where("split = 'validation'")


def _ranking_pairs(spark, d):
    """The split interactions, the posts, and the labelled pairs of both ranking sets."""
    split = SM.chronological_split(V.interactions(spark, d), "timestamp", "interaction_id")
    posts = V.posts(spark, d, with_text=False)
    both = None
    for name in ("train", "validation"):
        pos = (split.where((F.col("split") == name) & F.col("interaction_type").isin("like", "bookmark"))
               .select("user_id", "post_id", "timestamp", F.lit(1).alias("label")))
        neg = SM.ranking_negatives(pos, posts, ratio=4, seed=42)
        ent = (pos.unionByName(neg.select("user_id", "post_id", "timestamp", "label"))
               .withColumnRenamed("timestamp", "event_timestamp").withColumn("split", F.lit(name)))
        both = ent if both is None else both.unionByName(ent)
    return split, posts, both


#: The configured features (fixed values), by the names of their views here.
CONFIGURED = ["user_profile_features:about_embedding", "user_profile_features:headline_embedding",
              "user_profile_features:onboarding_category_ids", "user_stats:count_likes_given",
              "post_details_features:description_embedding", "post_details_features:category_id", "post_details_features:media_type",
              "post_details_features:creator_id", "post_stats:post_age_hours", "post_stats:num_likes_on_post"]


def configured_rows(spark, d):
    """E-12: the labelled pairs of both sets with every configured feature as of their
    time, and the two pair features: text cosine (E-6) and category flag (E-7).  Vectors,
    and the cosine of two, are added to the rows by the function that comes with them."""
    from ..operators import rerank as R
    from .store import feature_store
    _, _, both = _ranking_pairs(spark, d)
    f, vectors = feature_store(spark, d).get_historical_rows(both.checkpoint(), CONFIGURED)
    about, text = "user_profile_features__about_embedding", "post_details_features__description_embedding"
    rows = f.withColumn("is_post_category_in_onboarding", R.in_list_flag(F.col("post_details_features__category_id"),
                                                                         F.col("user_profile_features__onboarding_category_ids")).cast("int"))
    return rows, lambda r: vectors(r).withColumn("cosine_similarity_user_post_embedding", VX.sparse_dot(about, text))       # both have unit length


def configured_matrix_rows(spark, d):
    """Sparse rows over all configured features, encoders fitted on train, and the slots' blocks."""
    from ..operators import matrix as MX
    f, attach = configured_rows(spark, d)
    names = [c.replace(":", "__") for c in CONFIGURED] + ["cosine_similarity_user_post_embedding", "is_post_category_in_onboarding"]
    blocks = MX.fit(attach(f.where("split = 'train'")), names, codes=("post_details_features__creator_id",))
    return MX.assemble(f, blocks, attach), blocks


def _matrices(spark, d):
    from ..operators import models as M
    tr, va = ranking_datasets(spark, d)
    _, trm, vam = M.fit_transform(tr, va, CATEGORICAL, NUMERIC)
    return trm, vam


def _side_sql(name: str) -> str:
    """Positives and sampled negatives of one split."""
    k, n = "least(n_pos * 4, p - n_in)", name[0]
    return f"""
pos_{n} AS (SELECT user_id, post_id, "timestamp" FROM sp WHERE split = '{name}' AND interaction_type IN ('like', 'bookmark')),
pin_{n} AS (SELECT DISTINCT user_id, post_id FROM pos_{n} WHERE post_id IN (SELECT post_id FROM pidx)),
stats_{n} AS (
  SELECT s.user_id, s.n_pos, s.ts, coalesce(i.n_in, 0) AS n_in, (SELECT count(*) FROM pidx) AS p
  FROM (SELECT user_id, count(DISTINCT post_id) AS n_pos, max("timestamp") AS ts FROM pos_{n} GROUP BY user_id) s
  LEFT JOIN (SELECT user_id, count(*) AS n_in FROM pin_{n} GROUP BY user_id) i USING (user_id)),
params_{n} AS {_params_sql(f'stats_{n}', k, f'least({k} + n_in, p)')},
got_{n} AS {_walk_sql(f'params_{n}', 'pidx', f'pin_{n}')},
ent_{n} AS (SELECT '{name}' AS split, user_id, post_id, "timestamp" AS event_timestamp, 1 AS label FROM pos_{n}
  UNION ALL SELECT '{name}', g.user_id, g.post_id, s.ts, 0 FROM got_{n} g JOIN stats_{n} s USING (user_id))"""


MATRIX_SQL = "WITH " + ",\n".join([S.INTERACTIONS, S.POSTS, S.USERS, S.FEATURE_ROWS]) + """,
sp AS (SELECT *, CASE WHEN rk < floor(n * 0.7) THEN 'train' WHEN rk < floor(n * 0.7) + floor(n * 0.15) THEN 'validation'
                      ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", interaction_id) - 1 AS rk, count(*) OVER () AS n FROM interactions)),
pidx AS (SELECT post_id, row_number() OVER (ORDER BY post_id) - 1 AS idx FROM (SELECT DISTINCT post_id FROM posts)),""" + \
    _side_sql("train") + "," + _side_sql("validation") + """,
ent AS (SELECT *, row_number() OVER () AS rid FROM (SELECT * FROM ent_t UNION ALL SELECT * FROM ent_v)),
spend AS (SELECT e.rid, f.spend FROM ent e JOIN feature_rows f ON f.user_id = e.user_id AND f.feature_ts <= e.event_timestamp
          QUALIFY row_number() OVER (PARTITION BY e.rid ORDER BY f.feature_ts DESC, f.created DESC) = 1),
ps AS (SELECT p.post_id, p.creation_timestamp, count(i.post_id) FILTER (WHERE i.interaction_type = 'like') AS likes,
              count(i.post_id) FILTER (WHERE i.interaction_type = 'view_full') AS views,
              count(i.post_id) FILTER (WHERE i.interaction_type = 'comment') AS comments
       FROM posts p LEFT JOIN interactions i USING (post_id) GROUP BY p.post_id, p.creation_timestamp),
tpos AS (SELECT DISTINCT user_id, post_id FROM sp WHERE split = 'train' AND interaction_type IN ('like', 'bookmark', 'view_full')),
uv AS (SELECT user_id, list(v ORDER BY dim) AS user_vector FROM (
         SELECT user_id, dim, avg(v) AS v FROM (
           SELECT p.user_id, unnest(range(len(e.embedding))) AS dim, unnest(e.embedding) AS v FROM tpos p JOIN posts e USING (post_id))
         GROUP BY user_id, dim) GROUP BY user_id),
f AS (SELECT e.*, [coalesce(spend.spend, 0.0),
        CASE WHEN ps.creation_timestamp <= e.event_timestamp THEN CAST(ps.likes AS DOUBLE) ELSE 0.0 END,
        CASE WHEN ps.creation_timestamp <= e.event_timestamp THEN CAST(ps.views AS DOUBLE) ELSE 0.0 END,
        CASE WHEN ps.creation_timestamp <= e.event_timestamp THEN CAST(ps.comments AS DOUBLE) ELSE 0.0 END,
        CASE WHEN uv.user_vector IS NULL OR p.embedding IS NULL THEN 0.0
             ELSE coalesce(list_cosine_similarity(uv.user_vector, CAST(p.embedding AS DOUBLE[])), 0.0) END,
        CASE WHEN coalesce(list_contains(u.onboarding_category_ids, p.category_id), false) THEN 1.0 ELSE 0.0 END,
        CASE WHEN p.media_type = 'image' THEN 1.0 ELSE 0.0 END, CASE WHEN p.media_type = 'text' THEN 1.0 ELSE 0.0 END,
        CASE WHEN p.media_type = 'video' THEN 1.0 ELSE 0.0 END, CASE WHEN p.media_type IS NULL THEN 1.0 ELSE 0.0 END] AS v
      FROM ent e LEFT JOIN spend USING (rid) LEFT JOIN ps USING (post_id) LEFT JOIN posts p USING (post_id)
      LEFT JOIN users u USING (user_id) LEFT JOIN uv USING (user_id))
SELECT split, user_id, post_id, event_timestamp, label, CAST(unnest(range(10)) AS INTEGER) AS slot,
       round(CAST(unnest(v) AS DOUBLE), 6) AS value FROM f"""


@register("feature_matrix", MATRIX_SQL)
def feature_matrix(spark, d):
    """E-10..E-12 / N-3: the train-fitted encoding pipeline applied to train and
    validation; one row per slot of the assembled vector."""
    from pyspark.ml.functions import vector_to_array
    trm, vam = _matrices(spark, d)
    both = trm.unionByName(vam).select("split", "user_id", "post_id", "event_timestamp", "label",
                                       F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return both.withColumn("value", F.round("value", 6))


CONFIGURED_SQL = MATRIX_SQL[:MATRIX_SQL.index("spend AS (SELECT e.rid")] + """
t AS (SELECT 'about' || user_id AS id, about_text AS text FROM users UNION ALL SELECT 'headline' || user_id, headline_text FROM users
      UNION ALL SELECT 'description' || post_id, description_text FROM posts),
""" + TEXT_CTES.format(key="id", text="text", src="t") + """,
ps AS (SELECT p.post_id, p.creation_timestamp, count(i.post_id) FILTER (WHERE i.interaction_type = 'like') AS likes,
              coalesce((epoch_us((SELECT max("timestamp") FROM interactions)) - epoch_us(p.creation_timestamp)) / 3.6e9, 0.0) AS age
       FROM posts p LEFT JOIN interactions i USING (post_id) GROUP BY p.post_id, p.creation_timestamp),
us AS (SELECT user_id, max("timestamp") AS at, count(*) FILTER (WHERE interaction_type = 'like') AS likes FROM interactions GROUP BY user_id),
e AS (
  SELECT ent.rid, ent.split, 'about' || u.user_id AS ua, 'headline' || u.user_id AS uh, 'description' || p.post_id AS pd,
         u.onboarding_category_ids AS cats, p.category_id, p.media_type, p.creator_id,
         CASE WHEN p.post_id IS NOT NULL THEN ps.likes ELSE 0 END AS plikes, CASE WHEN p.post_id IS NOT NULL THEN ps.age ELSE 0 END AS age,
         CASE WHEN us.at <= ent.event_timestamp THEN us.likes ELSE 0 END AS ulikes
  FROM ent LEFT JOIN users u ON u.user_id = ent.user_id AND u.creation_timestamp <= ent.event_timestamp
  LEFT JOIN posts p ON p.post_id = ent.post_id AND p.creation_timestamp <= ent.event_timestamp
  LEFT JOIN ps ON ps.post_id = p.post_id LEFT JOIN us ON us.user_id = ent.user_id),
cos AS (SELECT e.rid, sum(a.value * b.value) AS value FROM e JOIN vec a ON a.id = e.ua JOIN vec b ON b.id = e.pd AND b.bucket = a.bucket GROUP BY e.rid),
code AS (
  SELECT name, v, row_number() OVER (PARTITION BY name ORDER BY v) - 1 AS c FROM (
    SELECT DISTINCT 'post_details_features__category_id' AS name, category_id AS v FROM e WHERE split = 'train' AND category_id IS NOT NULL
    UNION SELECT DISTINCT 'post_details_features__media_type', media_type FROM e WHERE split = 'train' AND media_type IS NOT NULL
    UNION SELECT DISTINCT 'post_details_features__creator_id', CAST(creator_id AS VARCHAR) FROM e WHERE split = 'train' AND creator_id IS NOT NULL)),
coded AS (
  SELECT rid, split, 'post_details_features__category_id' AS name, category_id AS v FROM e
  UNION ALL SELECT rid, split, 'post_details_features__media_type', media_type FROM e
  UNION ALL SELECT rid, split, 'post_details_features__creator_id', CAST(creator_id AS VARCHAR) FROM e),
m AS (
  SELECT split, 'user_profile_features__about_embedding_dim_' || bucket AS name, value FROM e JOIN vec ON vec.id = e.ua
  UNION ALL SELECT split, 'user_profile_features__headline_embedding_dim_' || bucket, value FROM e JOIN vec ON vec.id = e.uh
  UNION ALL SELECT split, 'post_details_features__description_embedding_dim_' || bucket, value FROM e JOIN vec ON vec.id = e.pd
  UNION ALL SELECT split, 'user_profile_features__onboarding_category_ids_' || c, 1.0 FROM (SELECT split, unnest(cats) AS c FROM e)
            WHERE c IN (SELECT unnest(cats) FROM e WHERE split = 'train')
  UNION ALL SELECT split, name, CAST(coalesce(c, -1) AS DOUBLE) FROM coded LEFT JOIN code USING (name, v)
  UNION ALL SELECT split, 'user_stats__count_likes_given', CAST(ulikes AS DOUBLE) FROM e
  UNION ALL SELECT split, 'post_stats__num_likes_on_post', CAST(plikes AS DOUBLE) FROM e
  UNION ALL SELECT split, 'post_stats__post_age_hours', CAST(age AS DOUBLE) FROM e
  UNION ALL SELECT split, 'cosine_similarity_user_post_embedding', value FROM e JOIN cos USING (rid)
  UNION ALL SELECT split, 'is_post_category_in_onboarding', 1.0 FROM e WHERE list_contains(cats, category_id))
SELECT split, name, count(*) AS n_rows, round(sum(value), 3) AS total, round(min(value), 6) AS least, round(max(value), 6) AS most
FROM m WHERE value <> 0 GROUP BY split, name"""


@register("configured_matrix", CONFIGURED_SQL)
def configured_matrix(spark, d):
    """E-10..E-12: the matrix over all configured features, summed up per slot: rows with
    a value, their sum, least and greatest."""
    from ..operators import matrix as MX
    rows, blocks = configured_matrix_rows(spark, d)
    cells = rows.select("split", F.inline(F.arrays_zip("indices", "values"))).withColumnsRenamed({"indices": "slot", "values": "value"})
    per = cells.groupBy("split", "slot").agg(F.count("*").alias("n_rows"), F.round(F.sum("value"), 3).alias("total"),
                                             F.round(F.min("value"), 6).alias("least"), F.round(F.max("value"), 6).alias("most"))
    return per.join(MX.slot_names(spark, blocks), "slot").select("split", "name", "n_rows", "total", "least", "most")


@register("train_rank")
def train_rank(spark, d):
    """M-5 + M-14: GBT with the reference hyper-parameters (validation-based
    early stopping), evaluated on train and validation."""
    from ..operators import models as M
    trm, vam = _matrices(spark, d)
    model = M.train_gbt(M.class_weights(trm), M.class_weights(vam), weight="weight")
    rows = []
    for name, df in (("train", trm), ("validation", vam)):
        m = MT.binary_metrics(M.score(model, df).select("label", "score"))
        rows.append(m.select(F.lit(name).alias("split"), "*"))
    return rows[0].unionByName(rows[1])


@register("feature_importance")
def feature_importance(spark, d):
    """X-33: importance of each assembled feature slot, sorted descending."""
    from ..operators import models as M
    trm, vam = _matrices(spark, d)
    model = M.train_gbt(M.class_weights(trm), M.class_weights(vam), weight="weight")
    return M.feature_importance(model, M.assembled_names(trm), spark)


def saved_ranker(spark, d) -> tuple[str, str]:
    """Train the ranker once and save it: paths of its encoding pipeline and trees."""
    from ..operators import models as M
    from ..sources import io as IO
    tr, va = ranking_datasets(spark, d)
    encoder, trm, vam = M.fit_transform(tr, va, CATEGORICAL, NUMERIC)
    paths = IO.scratch_path(spark, "ranker-encoder"), IO.scratch_path(spark, "ranker")
    M.save_model(encoder, paths[0])
    M.save_model(M.train_gbt(M.class_weights(trm), M.class_weights(vam), weight="weight"), paths[1])
    return paths


def trained_scores(spark, d):
    """M-9: candidates retrieved by learned (ALS) vectors, without what the user has
    seen, with their probability by the saved and reloaded ranker."""
    from pyspark.ml import PipelineModel

    from ..operators import models as M
    from ..operators import rerank as R
    from .serving import REF_TS, TOP_N
    encoder, trees = saved_ranker(spark, d)
    inter = V.interactions(spark, d)
    _, uf, pf = M.als_vectors(inter)
    pf = with_content(spark, d, pf)                             # a post without interactions is found by its text
    cand = K.knn(uf.select(F.col("user_id").alias("qid"), F.col("vector").alias("qvec")),
                 pf.select(F.col("post_id").alias("item_id"), F.col("vector").alias("ivec")), TOP_N, "ip")
    cand = cand.select(F.col("qid").alias("user_id"), F.col("item_id").alias("post_id"), F.col("rank").alias("cand_rank"))
    posts = V.posts(spark, d, with_text=False)
    cand = R.seen_filter(cand, V.seen_store(spark, d)).join(posts.select("post_id"), "post_id", "left_semi").checkpoint()
    split = SM.chronological_split(inter, "timestamp", "interaction_id")
    f = pair_features(spark, d, cand, training_vectors(split, posts), as_of=REF_TS)
    return M.score(M.load_ranker(trees), PipelineModel.load(encoder).transform(f))


@register("score_candidates")
def score_candidates(spark, d):
    """M-9: probability of every retrieved candidate by the trained, saved and reloaded GBT ranker."""
    return trained_scores(spark, d).select("user_id", "post_id", "cand_rank", F.round("score", 6).alias("score"))


@register("recommend_trained")
def recommend_trained(spark, d):
    """M-13 with trained models: learned vectors → candidates → seen filter → GBT
    probability → freshness boost → diverse top 20."""
    from ..operators import rerank as R
    from .serving import BOOST_FACTOR, BOOST_HOURS, DIVERSITY, FINAL_N, REF_TS
    s = trained_scores(spark, d)
    ref = F.lit(REF_TS).cast("timestamp_ntz")
    s = s.select("user_id", "post_id", "cand_rank", "category_id",
                 R.freshness_boost(F.col("score"), F.col("creation_timestamp"), ref, BOOST_HOURS, BOOST_FACTOR).alias("score"))
    return R.diverse_rerank(s, n=FINAL_N, factor=DIVERSITY).select(
        "user_id", "rank", "post_id", F.round("score", 6).alias("score"), "category_id")


def with_content(spark, d, factors):
    """Vectors of all posts: learned ones, else those that the text suggests."""
    from ..operators import content as CT
    from ..operators import textvec as TV
    texts = V.posts(spark, d).select("post_id", F.col("description_text").alias("text")).where("text is not null")
    dense = TV.dense_vectors(texts, "post_id", "text").checkpoint()
    return CT.content_factors(dense, factors.checkpoint()).checkpoint()


@register("content_vectors", S.with_views("""
pos AS (SELECT DISTINCT post_id FROM interactions WHERE interaction_type IN ('like', 'bookmark', 'view_full', 'comment', 'share')),
t AS (SELECT post_id FROM posts WHERE length(regexp_replace(coalesce(description_text, ''), '\\W', '', 'g')) > 0)
SELECT coalesce(t.post_id, pos.post_id) AS post_id, pos.post_id IS NOT NULL AS learned, t.post_id IS NOT NULL AS has_content,
       CAST(64 AS INTEGER) AS n_factors, CASE WHEN t.post_id IS NOT NULL THEN CAST(64 AS INTEGER) END AS n_components
FROM t FULL JOIN pos ON t.post_id = pos.post_id""", S.INTERACTIONS, S.POSTS).replace("\n\npos AS", ",\npos AS"))
def content_vectors(spark, d):
    """M-6: every post with a text or a positive interaction gets a vector of the
    configured size, joined with the components of its text."""
    from ..operators import models as M
    _, _, pf = M.als_vectors(V.interactions(spark, d))
    v = with_content(spark, d, pf)
    return v.select("post_id", "learned", F.col("content_vector").isNotNull().alias("has_content"),
                    F.size("vector").alias("n_factors"), F.nullif(F.size("content_vector"), F.lit(-1)).alias("n_components"))


@register("als_vectors")
def als_vectors(spark, d):
    """M-6/M-7/M-8: implicit-ALS user and post vectors (rank 64), one row per dimension."""
    from ..operators import models as M
    _, uf, pf = M.als_vectors(V.interactions(spark, d))
    u = uf.select(F.lit("user").alias("entity"), F.col("user_id").alias("id"), "vector")
    p = pf.select(F.lit("post").alias("entity"), F.col("post_id").alias("id"), "vector")
    return u.unionByName(p).select("entity", "id", F.posexplode("vector").alias("dim", "value"))


@register("als_check", S.with_views("""
pos AS (SELECT DISTINCT user_id, post_id FROM interactions WHERE interaction_type IN ('like', 'bookmark', 'view_full', 'comment'))
SELECT * FROM (VALUES ('users', CAST((SELECT count(DISTINCT user_id) FROM pos) AS DOUBLE)),
  ('posts', CAST((SELECT count(DISTINCT post_id) FROM pos) AS DOUBLE)), ('dim', 64.0), ('fits_better_than_chance', 1.0)) t(metric, value)""",
    S.INTERACTIONS).replace("\n\npos AS", ",\npos AS"))
def als_check(spark, d):
    """M-6: every user and post with a positive interaction gets a vector of the
    configured size, and observed pairs score above pairs of the same users with
    other posts (AUC over 0.6)."""
    from ..operators import models as M
    inter = V.interactions(spark, d)
    _, uf, pf = M.als_vectors(inter)
    pos = inter.where(F.col("interaction_type").isin(*M.CONFIDENCE)).select("user_id", "post_id").distinct()
    other = SM.random_negatives(pos, pos, pos, ratio=1).select("src_user", F.col("post_id")).withColumnRenamed("src_user", "user_id")
    pairs = pos.withColumn("label", F.lit(1)).unionByName(other.withColumn("label", F.lit(0)))
    scored = (pairs.join(uf.withColumnRenamed("vector", "u"), "user_id").join(pf.withColumnRenamed("vector", "p"), "post_id")
              .select("label", F.greatest(F.lit(0.0), F.least(F.lit(1.0), VX.dot("u", "p"))).alias("score")))
    auc = MT.binary_metrics(scored).select("roc_auc").scalar()
    rows = [("users", uf.select(F.count(F.lit(1))).scalar()), ("posts", pf.select(F.count(F.lit(1))).scalar()),
            ("dim", uf.select(F.max(F.size("vector"))).scalar()), ("fits_better_than_chance", (auc > 0.6).cast("int"))]
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value"))
                                                    for n, v in rows])))


@register("text_vectors", "WITH " + TEXT_CTES.format(key="doc_id", text="text", src="documents") + """
SELECT doc_id, CAST(bucket AS BIGINT) AS bucket, round(value, 6) AS value FROM vec""")
def text_vectors(spark, d):
    """E-8: hashed TF-IDF vectors (384 buckets) of every document's whole text."""
    from ..operators import textvec as TV
    docs = read_table(spark, d, "documents", "doc_id", "text")
    return TV.text_vectors(docs, "doc_id", "text").select("doc_id", "bucket", F.round("value", 6).alias("value"))


USER_TEXTS = {"headline": "headline_text", "about": "about_text"}


@register("user_text_vectors", "WITH " + S.USERS + """,
t AS (SELECT 'headline:' || user_id AS id, headline_text AS text FROM users
      UNION ALL SELECT 'about:' || user_id, about_text FROM users),
""" + TEXT_CTES.format(key="id", text="text", src="t") + """
SELECT id, CAST(bucket AS BIGINT) AS bucket, round(value, 6) AS value FROM vec""")
def user_text_vectors(spark, d):
    """E-8: the users' two text columns, encoded together."""
    from ..operators import textvec as TV
    u = V.users(spark, d)
    t = None
    for name, col in USER_TEXTS.items():
        part = u.select(F.concat(F.lit(name + ":"), F.col("user_id")).alias("id"), F.col(col).alias("text"))
        t = part if t is None else t.unionByName(part)
    return TV.text_vectors(t, "id", "text").select("id", "bucket", F.round("value", 6).alias("value"))


@register("text_pair_cosine", "WITH " + ",\n".join([S.INTERACTIONS, S.POSTS, S.USERS]) + """,
pr AS (SELECT DISTINCT user_id, post_id FROM interactions WHERE interaction_type = 'like'),
t AS (SELECT 'u' || user_id AS id, about_text AS text FROM users
      UNION ALL SELECT 'p' || post_id, description_text FROM posts),
""" + TEXT_CTES.format(key="id", text="text", src="t") + """
SELECT pr.user_id, pr.post_id, round(coalesce(sum(a.value * b.value), 0.0), 6) AS cosine
FROM pr LEFT JOIN vec a ON a.id = 'u' || pr.user_id LEFT JOIN vec b ON b.id = 'p' || pr.post_id AND b.bucket = a.bucket
GROUP BY pr.user_id, pr.post_id""")
def text_pair_cosine(spark, d):
    """E-6: cosine of the user's about text and the post's description text for liked pairs."""
    from ..operators import textvec as TV
    pairs = (V.interactions(spark, d).where(F.col("interaction_type") == "like").select("user_id", "post_id").distinct()
             .withColumn("pair", F.concat_ws(":", "user_id", "post_id")))
    u = V.users(spark, d).select(F.concat(F.lit("u"), F.col("user_id")).alias("id"), F.col("about_text").alias("text"))
    p = V.posts(spark, d).select(F.concat(F.lit("p"), F.col("post_id")).alias("id"), F.col("description_text").alias("text"))
    vec = TV.text_vectors(u.unionByName(p), "id", "text").checkpoint()          # read by both sides of the pairs
    left = pairs.join(vec, F.concat(F.lit("u"), F.col("user_id")) == F.col("id")).select("pair", "bucket", "value")
    right = pairs.join(vec, F.concat(F.lit("p"), F.col("post_id")) == F.col("id")).select("pair", "bucket", "value")
    return (pairs.join(TV.cosine_of_texts(left, right), "pair", "left")
            .select("user_id", "post_id", F.round(F.coalesce("cosine", F.lit(0.0)), 6).alias("cosine")))


@register("batch_infer")
def batch_infer(spark, d):
    """M-7 / SF-13: two dense ReLU layers over every post vector in batches of
    256.  Layer 1 is the class-logit layer of a multinomial model fitted on
    (embedding → category); layer 2 maps it back to 64-d with the class
    centroid matrix — both learned from the data."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import array_to_vector

    from ..operators import models as M
    from ..operators import rerank as R
    posts = V.posts(spark, d, with_text=False).select("post_id", "category_id", "embedding")
    lab = StringIndexer(inputCol="category_id", outputCol="y", stringOrderType="alphabetAsc").fit(posts)
    tr = lab.transform(posts).withColumn("x", array_to_vector("embedding"))
    lr = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", maxIter=30).fit(tr)
    w1 = lr.coefficientMatrix.toArray()
    b1 = lr.interceptVector.toArray()
    cents = {r["category_id"]: np.asarray(r["vsum"]) / r["n"]
             for r in R.category_vector_stats(posts).collect()}          # one row per class: bounded
    w2 = np.stack([cents[c] for c in lab.labels]).T                     # 64 × n_classes
    tower = M.dense_tower(posts, "embedding", [(w1, b1), (w2, np.zeros(w2.shape[0]))])
    return tower.select("post_id", F.posexplode("tower_vector").alias("dim", "value"))


def _weight(i: int, j: int) -> float:
    return ((7 * i + 3 * j) % 11 - 5) / 10.0


DENSE_SQL = "WITH " + S.POSTS + """,
h AS (SELECT post_id, list_transform(range(8), lambda i: greatest(0.0, 0.1 + list_sum(list_transform(range(64),
        lambda j: ((7 * i + 3 * j) % 11 - 5) / 10.0 * CAST(embedding[j + 1] AS DOUBLE))))) AS h FROM posts),
o AS (SELECT post_id, list_transform(range(4), lambda i: greatest(0.0, 0.1 + list_sum(list_transform(range(8),
        lambda j: ((7 * i + 3 * j) % 11 - 5) / 10.0 * h[j + 1])))) AS o FROM h)
SELECT post_id, CAST(unnest(range(4)) AS INTEGER) AS dim, round(CAST(unnest(o) AS DOUBLE), 6) AS value FROM o"""


@register("dense_infer", DENSE_SQL)
def dense_infer(spark, d):
    """SF-13 / U-6 / U-7: batched dense ReLU layers (64 → 8 → 4) with given weights over every post vector."""
    import numpy as np

    from ..operators import models as M
    layers = [(np.array([[_weight(i, j) for j in range(n)] for i in range(m)]), np.full(m, 0.1)) for n, m in ((64, 8), (8, 4))]
    posts = V.posts(spark, d, with_text=False).select("post_id", "embedding")
    out = M.dense_tower(posts, "embedding", layers).select("post_id", F.posexplode("tower_vector").alias("dim", "value"))
    return out.withColumn("value", F.round("value", 6))
