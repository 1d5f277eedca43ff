"""Queries for the documented (plan / course-notes) operators X-1..X-38."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import aggregates as A
from ..operators import features as FE
from ..operators import rolling as RO
from ..operators import knn as K
from ..sources import views as V
from ..sources.io import scratch_path
from ..sources.tables import read_table
from . import sqlviews as S
from .registry import register
from .models import TEXT_CTES
from .retrieval import L2SQ, UV_SQL, user_vectors

REF_SQL = '(SELECT max("timestamp") FROM interactions)'
TYPES = FE.INTERACTION_TYPES


def _ref(spark, d):
    return V.interactions(spark, d).select(F.max("timestamp")).scalar()


@register("window_counts", S.with_views("SELECT user_id, " + ",\n  ".join(
    f"count(*) FILTER (WHERE interaction_type = '{t}' AND \"timestamp\" >= {REF_SQL} - INTERVAL {d} DAY "
    f"AND \"timestamp\" <= {REF_SQL}) AS {t}_count_{d}d" for d in (1, 7, 30) for t in TYPES)
    + " FROM interactions GROUP BY user_id", S.INTERACTIONS))
def window_counts(spark, d):
    """X-1: per-user counts of all 7 types over trailing 1/7/30 days of the latest event."""
    return FE.window_counts(V.interactions(spark, d), _ref(spark, d))


@register("rolling_counts", S.with_views('SELECT interaction_id, user_id, "timestamp", ' + ",\n  ".join(
    f"count(*) FILTER (WHERE interaction_type = '{t}') OVER (PARTITION BY user_id ORDER BY \"timestamp\" "
    f"RANGE BETWEEN INTERVAL {d} DAY PRECEDING AND CURRENT ROW) AS {t}_count_{d}d" for d in (1, 7, 30) for t in ("like", "comment", "view_full"))
    + " FROM interactions", S.INTERACTIONS))
def rolling_counts(spark, d):
    """X-1: counts over the last 1, 7 and 30 days as of each interaction."""
    return RO.rolling_counts(V.interactions(spark, d))


@register("preferred_media", S.with_views("""
, c AS (SELECT i.user_id, p.media_type, count(*) AS n FROM interactions i JOIN posts p USING (post_id)
        GROUP BY i.user_id, p.media_type)
SELECT user_id, arg_max(media_type, (n, media_type)) AS preferred_media_type, max(n) AS n_interactions
FROM c GROUP BY user_id""", S.INTERACTIONS, S.POSTS).replace("\n, c AS", ",\nc AS"))
def preferred_media(spark, d):
    """X-2: the user's most frequent media type."""
    return FE.preferred_media(V.interactions(spark, d), V.posts(spark, d, with_text=False))


@register("category_counts", S.with_views("""
SELECT i.user_id, p.category_id, count(*) AS likes
FROM interactions i JOIN posts p USING (post_id) WHERE i.interaction_type = 'like' GROUP BY i.user_id, p.category_id""",
    S.INTERACTIONS, S.POSTS))
def category_counts(spark, d):
    """X-3: likes per user × category, in long form."""
    return FE.category_counts(V.interactions(spark, d), V.posts(spark, d, with_text=False))


@register("category_affinity", S.with_views("""
, c AS (SELECT i.user_id, p.category_id, count(*) AS n FROM interactions i JOIN posts p USING (post_id)
        WHERE i.interaction_type IN ('like', 'bookmark') GROUP BY i.user_id, p.category_id)
SELECT user_id, category_id, n, round(n / sum(n) OVER (PARTITION BY user_id), 6) AS affinity FROM c""",
    S.INTERACTIONS, S.POSTS).replace("\n, c AS", ",\nc AS"))
def category_affinity(spark, d):
    """X-4: positive share per user × category."""
    r = FE.category_affinity(V.interactions(spark, d), V.posts(spark, d, with_text=False))
    return r.select("user_id", "category_id", "n", F.round("affinity", 6).alias("affinity"))


ENG_COLS = ("num_likes_on_post", "num_views_on_post", "num_comments_on_post")


@register("engagement_norm", S.with_views("""
, c AS (
  SELECT p.post_id,
         count(i.post_id) FILTER (WHERE i.interaction_type = 'like') AS num_likes_on_post,
         count(i.post_id) FILTER (WHERE i.interaction_type = 'view_full') AS num_views_on_post,
         count(i.post_id) FILTER (WHERE i.interaction_type = 'comment') AS num_comments_on_post
  FROM posts p LEFT JOIN interactions i USING (post_id) GROUP BY p.post_id)
SELECT post_id, """ + ", ".join(
    f"round(coalesce(({c} - (SELECT min({c}) FROM c)) / nullif((SELECT max({c}) FROM c) - (SELECT min({c}) FROM c), 0), 0.0), 6) AS {c}_norm"
    for c in ENG_COLS) + " FROM c", S.INTERACTIONS, S.POSTS).replace("\n, c AS", ",\nc AS"))
def engagement_norm(spark, d):
    """X-6: min-max normalised post engagement counters."""
    pa = A.post_aggregates(V.interactions(spark, d), V.posts(spark, d, with_text=False))
    n = FE.minmax_scale(pa.select("post_id", *ENG_COLS), list(ENG_COLS))
    return n.select("post_id", *[F.round(f"{c}_norm", 6).alias(f"{c}_norm") for c in ENG_COLS])


def _pairs(spark, d):
    return V.interactions(spark, d).select("user_id", "post_id").distinct()


@register("top_category_flag", S.with_views("""
, cc AS (SELECT i.user_id, p.category_id, count(*) AS n FROM interactions i JOIN posts p USING (post_id)
         GROUP BY i.user_id, p.category_id),
top AS (SELECT user_id, category_id FROM cc
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category_id) <= 3),
pairs AS (SELECT DISTINCT user_id, post_id FROM interactions)
SELECT pr.user_id, pr.post_id, p.category_id,
       CASE WHEN t.user_id IS NOT NULL THEN 1 ELSE 0 END AS post_category_in_top
FROM pairs pr LEFT JOIN posts p USING (post_id) LEFT JOIN top t ON t.user_id = pr.user_id AND t.category_id = p.category_id
""", S.INTERACTIONS, S.POSTS).replace("\n, cc AS", ",\ncc AS"))
def top_category_flag(spark, d):
    """X-7: post category within the user's top-3 interacted categories."""
    r = FE.top_category_flag(_pairs(spark, d), V.interactions(spark, d), V.posts(spark, d, with_text=False))
    return r.select("user_id", "post_id", "category_id", "post_category_in_top")


@register("creator_seen_flag", S.with_views("""
, pairs AS (SELECT DISTINCT user_id, post_id FROM interactions)
SELECT a.user_id, a.post_id, pa.creator_id,
       CASE WHEN EXISTS (SELECT 1 FROM pairs b JOIN posts pb ON pb.post_id = b.post_id
                         WHERE b.user_id = a.user_id AND pb.creator_id = pa.creator_id AND b.post_id <> a.post_id)
            THEN 1 ELSE 0 END AS seen_other_post_of_creator
FROM pairs a LEFT JOIN posts pa USING (post_id)""", S.INTERACTIONS, S.POSTS).replace("\n, pairs AS", ",\npairs AS"))
def creator_seen_flag(spark, d):
    """X-8: user already interacted with another post of the same creator."""
    r = FE.creator_seen_flag(_pairs(spark, d), V.interactions(spark, d), V.posts(spark, d, with_text=False))
    return r.select("user_id", "post_id", "creator_id", "seen_other_post_of_creator")


@register("category_rate", S.with_views("""
SELECT i.user_id, p.category_id,
       count(*) FILTER (WHERE i.interaction_type = 'like') AS likes,
       count(*) FILTER (WHERE i.interaction_type = 'view_full') AS views,
       round(count(*) FILTER (WHERE i.interaction_type = 'like')
             / nullif(count(*) FILTER (WHERE i.interaction_type = 'view_full'), 0), 6) AS like_rate
FROM interactions i JOIN posts p USING (post_id) GROUP BY i.user_id, p.category_id""", S.INTERACTIONS, S.POSTS))
def category_rate(spark, d):
    """X-10: likes per full view, per user × category."""
    r = FE.category_rate(V.interactions(spark, d), V.posts(spark, d, with_text=False))
    return r.select("user_id", "category_id", "likes", "views", F.round("like_rate", 6).alias("like_rate"))


@register("impression_negatives", S.with_views("""
SELECT DISTINCT user_id, post_id, 0 AS label FROM interactions i WHERE interaction_type = 'view_full'
AND NOT EXISTS (SELECT 1 FROM interactions j WHERE j.user_id = i.user_id AND j.post_id = i.post_id
                AND j.interaction_type IN ('like', 'bookmark'))""", S.INTERACTIONS))
def impression_negatives(spark, d):
    """X-11: impressions (full views) without a positive interaction."""
    return FE.impression_negatives(V.interactions(spark, d))


@register("preferred_engagement", S.with_views("""
SELECT i.user_id, count(*) AS n_interactions,
       round(avg(CASE WHEN list_contains(u.onboarding_category_ids, p.category_id) THEN 1.0 ELSE 0.0 END), 6)
         AS share_in_preferred,
       round(sum(CASE WHEN list_contains(u.onboarding_category_ids, p.category_id)
                       AND i.interaction_type IN ('like', 'bookmark') THEN 1.0 ELSE 0.0 END)
             / nullif(sum(CASE WHEN i.interaction_type IN ('like', 'bookmark') THEN 1.0 ELSE 0.0 END), 0), 6)
         AS positive_share_in_preferred
FROM interactions i JOIN posts p USING (post_id) JOIN users u USING (user_id) GROUP BY i.user_id""",
    S.INTERACTIONS, S.POSTS, S.USERS))
def preferred_engagement(spark, d):
    """X-18: engagement inside the user's preferred categories (monitoring)."""
    r = FE.preferred_engagement(V.interactions(spark, d), V.posts(spark, d, with_text=False), V.users(spark, d))
    return r.select("user_id", "n_interactions", F.round("share_in_preferred", 6).alias("share_in_preferred"),
                    F.round("positive_share_in_preferred", 6).alias("positive_share_in_preferred"))


@register("days_since", S.with_views(f"""
SELECT post_id, CAST(datediff('day', creation_timestamp, {REF_SQL}) AS BIGINT) AS days_since_creation
FROM posts""", S.INTERACTIONS, S.POSTS))
def days_since(spark, d):
    """X-20: whole days between post creation and the latest event (date difference)."""
    p = V.posts(spark, d, with_text=False)
    return p.select("post_id", F.datediff(_ref(spark, d), F.col("creation_timestamp")).cast("bigint")
                    .alias("days_since_creation"))


@register("article_text", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS description_length, concat_ws(' - ', source, lang, text) AS article_text,
       printf('https://posts.example/p/%05d', doc_id) AS url
FROM documents""")
def article_text(spark, d):
    """X-21: text length, concatenated descriptive text (whole text), URL from id, of every document."""
    p = read_table(spark, d, "documents", "doc_id", "text", "source", "lang")
    return p.select("doc_id", F.length("text").cast("bigint").alias("description_length"),
                    F.concat_ws(" - ", "source", "lang", "text").alias("article_text"),
                    F.format_string("https://posts.example/p/%05d", F.col("doc_id")).alias("url"))


@register("drop_null_columns", S.with_views("""
SELECT u.user_id, u.headline_text, u.about_text FROM users u""", S.USERS))
def drop_null_columns(spark, d):
    """X-22: users with their latest spend; columns that contain nulls are dropped."""
    from .store import feature_store
    u = V.users(spark, d).select("user_id", "headline_text", "about_text")
    latest = feature_store(spark, d).materialize("user_spend")
    return FE.drop_null_columns(u.join(latest, "user_id", "left"))


@register("month_cycle", f"""
SELECT o_orderkey, CAST(month(o_orderdate) AS BIGINT) AS month,
       round(sin({2 * math.pi!r} * month(o_orderdate) / 12.0), 6) AS month_sin,
       round(cos({2 * math.pi!r} * month(o_orderdate) / 12.0), 6) AS month_cos
FROM orders""")
def month_cycle(spark, d):
    """X-23: cyclic month features of the order date."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    s, c = FE.month_cycle(F.col("o_orderdate"))
    return o.select("o_orderkey", F.month("o_orderdate").cast("bigint").alias("month"),
                    F.round(s, 6).alias("month_sin"), F.round(c, 6).alias("month_cos"))


@register("retrieval_view", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, c.c_mktsegment, c.c_nationkey, l.l_partkey, p.p_type, p.p_brand,
       o.o_orderdate, l.l_extendedprice
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN part p ON p.p_partkey = l.l_partkey""")
def retrieval_view(spark, d):
    """X-24: transactions ⋈ customers ⋈ articles with projections (dimension joins
    are left to AQE: broadcast when the dimension is small, shuffle otherwise)."""
    rd = lambda t, *c: read_table(spark, d, t, *c)
    li = rd("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    o = rd("orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = rd("customer", "c_custkey", "c_mktsegment", "c_nationkey")
    p = rd("part", "p_partkey", "p_type", "p_brand")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(p, li.l_partkey == p.p_partkey))
    return j.select("l_orderkey", "l_linenumber", "o_custkey", "c_mktsegment", "c_nationkey", "l_partkey",
                    "p_type", "p_brand", "o_orderdate", "l_extendedprice")


@register("label_distribution", """
WITH l AS (SELECT quality AS label FROM labels)
SELECT label, count(*) AS n,
       round(CAST((SELECT count(*) FROM l WHERE label = 0) AS DOUBLE)
             / nullif((SELECT count(*) FROM l WHERE label = 1), 0), 6) AS neg_pos_ratio
FROM l GROUP BY label""")
def label_distribution(spark, d):
    """X-26 / A-13: label counts of the quality labels and the neg/pos class weight."""
    lab = read_table(spark, d, "labels").select(F.col("quality").alias("label"))
    return A.label_distribution(lab)


@register("purchased_exclusion", "WITH " + ",\n".join(UV_SQL) + f""",
recs AS (
  SELECT user_id, post_id, rk FROM (
    SELECT uv.user_id, e.post_id,
           row_number() OVER (PARTITION BY uv.user_id ORDER BY {L2SQ}, e.post_id) AS rk
    FROM uv CROSS JOIN posts e) t WHERE rk <= 20),
pa AS (SELECT p.post_id, count(i.post_id) FILTER (WHERE i.interaction_type = 'like') AS likes
       FROM posts p LEFT JOIN interactions i USING (post_id) GROUP BY p.post_id)
SELECT r.user_id, r.post_id, CAST(r.rk AS BIGINT) AS cand_rank, pa.likes AS num_likes_on_post, p.category_id
FROM recs r JOIN pa USING (post_id) JOIN posts p USING (post_id)
WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.user_id = r.user_id AND i.post_id = r.post_id)""")
def purchased_exclusion(spark, d):
    """X-29: k-NN candidates, minus anything the user already interacted with,
    inner-joined with item features."""
    uv = user_vectors(spark, d).select(F.col("user_id").alias("qid"), F.col("user_vector").alias("qvec"))
    posts = V.posts(spark, d, with_text=False)
    items = posts.select(F.col("post_id").alias("item_id"), F.col("embedding").alias("ivec"))
    c = K.knn(uv, items, 20, "l2").select(F.col("qid").alias("user_id"), F.col("item_id").alias("post_id"),
                                         F.col("rank").alias("cand_rank"))
    inter = V.interactions(spark, d)
    c = c.join(inter.select("user_id", "post_id"), ["user_id", "post_id"], "left_anti")
    pa = A.post_aggregates(inter, posts).select("post_id", "num_likes_on_post")
    return c.join(pa, "post_id").join(posts.select("post_id", "category_id"), "post_id").select(
        "user_id", "post_id", "cand_rank", "num_likes_on_post", "category_id")


REPLIES_SQL = """
WITH replies AS (SELECT conv_id, turn, CASE (conv_id + turn) % 6
    WHEN 0 THEN text
    WHEN 1 THEN text || ' Probability: 0.' || lpad(CAST(conv_id % 1000 AS VARCHAR), 3, '0') || ' '
    WHEN 2 THEN 'Probability: ' || CAST(conv_id % 3 AS VARCHAR) || 'Probability: 0.5'
    WHEN 3 THEN 'Probability: high ' || text
    WHEN 4 THEN ' * food @ ' || text || ' | bad part | + a b @ x @ y | In short: ' || text || ' '
    ELSE '@ | ' || text || ' @ | ' END AS text
  FROM conversations WHERE role = 'assistant')"""


def replies(spark, d):
    """Assistant replies with the markers a model would write: valid, out of
    range, not a number, absent; item lists well and badly formed."""
    c = read_table(spark, d, "conversations").where(F.col("role") == "assistant")
    k, t, m = F.col("conv_id"), F.col("text"), (F.col("conv_id") + F.col("turn")) % 6
    text = (F.when(m == 0, t)
            .when(m == 1, F.concat(t, F.lit(" Probability: 0."), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(" ")))
            .when(m == 2, F.concat(F.lit("Probability: "), (k % 3).cast("string"), F.lit("Probability: 0.5")))
            .when(m == 3, F.concat(F.lit("Probability: high "), t))
            .when(m == 4, F.concat(F.lit(" * food @ "), t, F.lit(" | bad part | + a b @ x @ y | In short: "), t, F.lit(" ")))
            .otherwise(F.concat(F.lit("@ | "), t, F.lit(" @ | "))))
    return c.select("conv_id", "turn", text.alias("text"))


@register("parse_scores", REPLIES_SQL + """
SELECT conv_id, turn,
       CASE WHEN TRY_CAST(regexp_replace(split_part(text, 'Probability:', 2), '^\\s+|\\s+$', '', 'g') AS DOUBLE)
                 BETWEEN 0.0 AND 1.0
            THEN TRY_CAST(regexp_replace(split_part(text, 'Probability:', 2), '^\\s+|\\s+$', '', 'g') AS DOUBLE)
            ELSE 0.0 END AS probability
FROM replies""")
def parse_scores(spark, d):
    """X-34: score every assistant reply (whole text) by its ``Probability:`` value."""
    return replies(spark, d).select("conv_id", "turn", TX.parse_probability(F.col("text")).alias("probability"))


@register("parse_items", REPLIES_SQL + r""",
r AS (
  SELECT conv_id, turn, string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), ' | ') AS items
  FROM replies),
d AS (
  SELECT conv_id, turn,
         CASE WHEN len(items) > 1 THEN items[len(items)] ELSE 'No summary available.' END AS summary,
         CASE WHEN len(items) > 1 THEN items[1:len(items) - 1] ELSE items END AS descs
  FROM r),
e AS (SELECT conv_id, turn, summary, unnest(descs) AS item, generate_subscripts(descs, 1) AS pos FROM d),
h AS (SELECT *, strpos(item, ' @ ') AS atp,
             CASE WHEN strpos(item, ' @ ') > 0 THEN item[1:strpos(item, ' @ ') - 1] END AS head FROM e)
SELECT conv_id, turn, CAST(pos AS BIGINT) AS pos,
       CASE WHEN atp > 0 AND strpos(head, ' ') > 0 THEN head[1:strpos(head, ' ') - 1] ELSE '🔷' END AS emoji,
       CASE WHEN atp > 0 AND strpos(head, ' ') > 0 THEN head[strpos(head, ' ') + 1:] ELSE 'Item' END AS category,
       CASE WHEN atp > 0 AND strpos(head, ' ') > 0 THEN item[atp + 3:] ELSE item END AS description,
       summary
FROM h""")
def parse_items(spark, d):
    """X-35: split each assistant reply into ``emoji category @ description`` items plus a summary."""
    c = replies(spark, d)
    items = TX.reply_items(F.col("text"))
    r = c.select("conv_id", "turn", TX.reply_summary(items).alias("summary"),
                 F.posexplode(TX.reply_descriptions(items)).alias("p", "item"))
    return r.select("conv_id", "turn", (F.col("p") + 1).cast("bigint").alias("pos"),
                    TX.parse_item(F.col("item")).alias("it"), "summary").select(
        "conv_id", "turn", "pos", "it.emoji", "it.category", "it.description", "summary")


@register("rfm", """
SELECT o_custkey, CAST(datediff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS INTEGER) AS recency_days,
       count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary
FROM orders GROUP BY o_custkey""")
def rfm(spark, d):
    """X-38: recency / frequency / monetary per customer as of the last order date."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    ref = o.select(F.max("o_orderdate")).scalar()
    r = FE.rfm(o, ref)
    return r.select("o_custkey", "recency_days", "frequency", F.round("monetary", 2).alias("monetary"))


@register("load_checks", S.with_views("""
SELECT * FROM (VALUES
  ('rows', (SELECT count(*) FROM interactions)),
  ('null_user_id', (SELECT count(*) FROM interactions WHERE user_id IS NULL)),
  ('null_post_id', (SELECT count(*) FROM interactions WHERE post_id IS NULL)),
  ('null_timestamp', (SELECT count(*) FROM interactions WHERE "timestamp" IS NULL)),
  ('unknown_user_rows', (SELECT count(*) FROM interactions i WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = i.user_id))),
  ('unknown_post_rows', (SELECT count(*) FROM interactions i WHERE NOT EXISTS (SELECT 1 FROM posts p WHERE p.post_id = i.post_id))),
  ('duplicate_interaction_ids', (SELECT count(*) FROM (SELECT interaction_id FROM interactions GROUP BY 1 HAVING count(*) > 1)))
) t("check", value)""", S.INTERACTIONS, S.POSTS, S.USERS))
def load_checks(spark, d):
    """X-37 / SRC-5: key consistency, null and duplicate counts as one report."""
    return FE.load_checks(V.interactions(spark, d), V.users(spark, d), V.posts(spark, d, with_text=False))


@register("keywords", r"""
WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '\W+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE length(term) > 0 GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT tf.doc_id, tf.term, tf.tf * (ln(((SELECT count(*) FROM documents) + 1.0) / (df.df + 1)) + 1.0) AS score
       FROM tf JOIN df USING (term))
SELECT doc_id, CAST(rk AS BIGINT) AS rank, term, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rk FROM sc) WHERE rk <= 5""")
def keywords(spark, d):
    """X-19: top-5 TF-IDF keywords of every document's full text."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    k = FE.keywords(docs, "doc_id", "text", 5)
    return k.select("doc_id", "rank", "term", F.round("score", 6).alias("score"))


def _hard_sql():
    from ..functions.hashing import STRIDE_PRIMES, md5_sql
    h = md5_sql("user_id", "category_id", seed=42)
    primes = "[" + ", ".join(str(x) for x in STRIDE_PRIMES) + "]"
    return "WITH " + ",\n".join([S.INTERACTIONS, S.POSTS, S.USERS]) + f""",
gidx AS (SELECT category_id, post_id, row_number() OVER (PARTITION BY category_id ORDER BY post_id) - 1 AS idx
         FROM (SELECT DISTINCT category_id, post_id FROM posts)),
pc AS (SELECT category_id, count(*) AS p FROM gidx GROUP BY category_id),
pos AS (SELECT DISTINCT user_id, post_id FROM interactions WHERE interaction_type IN ('like', 'bookmark')),
nin AS (SELECT p.user_id, q.category_id, count(*) AS n_in FROM pos p JOIN posts q USING (post_id) GROUP BY 1, 2),
uc AS (SELECT DISTINCT user_id, unnest(onboarding_category_ids) AS category_id FROM users
       WHERE user_id IN (SELECT user_id FROM pos)),
par AS (SELECT uc.user_id, uc.category_id, pc.p, coalesce(nin.n_in, 0) AS n_in,
               least(3, pc.p - coalesce(nin.n_in, 0)) AS k,
               least(least(3, pc.p - coalesce(nin.n_in, 0)) + coalesce(nin.n_in, 0), pc.p) AS m,
               {h} % pc.p AS b,
               list_extract({primes}, CAST((({h}) >> 8) % {len(STRIDE_PRIMES)} + 1 AS INTEGER)) AS s
        FROM uc JOIN pc USING (category_id) LEFT JOIN nin USING (user_id, category_id)),
cand AS (SELECT user_id, category_id, k, j, (b + j * (s % p)) % p AS idx
         FROM (SELECT *, unnest(range(m)) AS j FROM par WHERE m > 0)),
ok AS (SELECT c.user_id, c.category_id, g.post_id, c.j, c.k FROM cand c JOIN gidx g USING (category_id, idx)
       WHERE NOT EXISTS (SELECT 1 FROM pos x WHERE x.user_id = c.user_id AND x.post_id = g.post_id))
SELECT user_id, category_id, post_id, 0 AS label FROM ok
QUALIFY row_number() OVER (PARTITION BY user_id, category_id ORDER BY j) <= k"""


@register("hard_negatives", _hard_sql())
def hard_negatives(spark, d):
    """X-12: per user and preferred category, up to 3 non-positive posts of that
    category by a per-(user, category) permutation walk over the category's posts."""
    from ..operators import sampling as SM
    inter = V.interactions(spark, d)
    pos = inter.where(F.col("interaction_type").isin("like", "bookmark")).select("user_id", "post_id").distinct()
    return SM.hard_negatives(pos, V.users(spark, d), V.posts(spark, d, with_text=False), per_category=3)


@register("semantic_search", "WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'q' || item_id, text FROM benchmark),\n"
          + TEXT_CTES.format(key="id", text="text", src="t") + """,
q AS (SELECT CAST(id[2:] AS BIGINT) AS item_id, bucket, value FROM vec WHERE id[1:1] = 'q'),
c AS (SELECT CAST(id[2:] AS BIGINT) AS doc_id, bucket, value FROM vec WHERE id[1:1] = 'd'),
s AS (SELECT item_id, doc_id, round(sum(q.value * c.value), 9) AS score FROM q JOIN c USING (bucket) GROUP BY 1, 2)
SELECT item_id, doc_id, round(score, 6) AS cosine, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM s) WHERE rk <= 25""")
def semantic_search(spark, d):
    """X-36: every benchmark text (a stated query set) searched against all
    documents; top-25 by cosine of text vectors fitted on both."""
    from ..operators import textvec as TV
    docs, bench = _search_texts(spark, d)
    counts = TV.counted(docs.unionByName(bench), "id", "text")
    idf = TV.idf(counts)
    part = lambda kind: TV.weighted(counts.where(F.col("id").startswith(kind)), idf)
    return _text_search(spark, d, part("d"), part("q"))


TRIPLES = 512


@register("subword_search", f"""WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'q' || item_id, text FROM benchmark),
pos AS (SELECT id, text, unnest(range(1, CAST(length(text) AS BIGINT) - 1)) AS i FROM t WHERE length(text) > 2),
n AS (SELECT id, (unicode(text[i]) * 961 + unicode(text[i + 1]) * 31 + unicode(text[i + 2])) % {TRIPLES} AS bucket, ln(1 + count(*)) AS w
      FROM pos GROUP BY 1, 2),
vec AS (SELECT id, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM n),
q AS (SELECT CAST(id[2:] AS BIGINT) AS item_id, bucket, value FROM vec WHERE id[1:1] = 'q'),
c AS (SELECT CAST(id[2:] AS BIGINT) AS doc_id, bucket, value FROM vec WHERE id[1:1] = 'd'),
s AS (SELECT item_id, doc_id, round(sum(q.value * c.value), 9) AS score FROM q JOIN c USING (bucket) GROUP BY 1, 2)
SELECT item_id, doc_id, round(score, 6) AS cosine, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM s) WHERE rk <= 25""")
def subword_search(spark, d):
    """U-1, X-36: the same search behind another encoder, a model that each Python
    worker loads once (hashed letter triples)."""
    from ..operators import textsearch as TS
    docs, bench = _search_texts(spark, d)
    encode = TS.worker_rows(f"letter triples {TRIPLES}", lambda: TS.letter_triples(TRIPLES))
    return _text_search(spark, d, encode(docs, "id", "text"), encode(bench, "id", "text"))


def _search_texts(spark, d):
    docs = read_table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    return docs, read_table(spark, d, "benchmark").select(F.concat(F.lit("q"), F.col("item_id")).alias("id"), "text")


def _text_search(spark, d, docs, queries):
    from ..operators import textsearch as TS
    from ..operators import textvec as TV
    num = F.substring("id", 2, 30).cast("bigint")
    path = scratch_path(spark, "text-index")
    n = read_table(spark, d, "documents").count()
    TS.build_index(docs.select(num.alias("doc_id"), "buckets", "values"), "doc_id", n, path)
    res = TS.search(TV.entries(queries.select(num.alias("qid"), "buckets", "values"), "qid"), TS.read_index(spark, path), 25)
    return res.select(F.col("qid").alias("item_id"), "doc_id", F.round("score", 6).alias("cosine"), "rank")


@register("dedup_embed", "WITH u AS (SELECT min(doc_id) AS doc_id, count(*) AS copies, text FROM documents GROUP BY text),\n"
          + TEXT_CTES.format(key="doc_id", text="text", src="u") + """
SELECT doc_id, copies, CAST(bucket AS BIGINT) AS bucket, round(value, 6) AS value FROM vec JOIN u USING (doc_id)""")
def dedup_embed(spark, d):
    """X-28: de-duplicate documents by exact text (keep the smallest id), then
    encode the survivors.  Copies meet by a 256-bit digest of the text and bring its
    word counts along, which are the same in all of them, so neither repeated nor missing
    ids matter.  Texts are neither shuffled nor written."""
    from ..operators import textvec as TV
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    digest = F.unhex(F.sha2(F.coalesce(F.concat(F.lit("t"), "text"), F.lit("")), 256))
    counted = TV.term_counts(docs.withColumn("h", digest), "text")
    uniq = counted.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
                                    F.any_value(F.struct("buckets", "counts")).alias("words"))
    kept = uniq.select("doc_id", "copies", "words.buckets", "words.counts").checkpoint()
    return TV.entries(TV.weighted(kept), "doc_id", "copies").withColumn("value", F.round("value", 6))
