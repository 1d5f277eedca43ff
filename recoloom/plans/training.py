"""Training-set queries: splits and sampled pairs (§2.5 W-4/W-5, §2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import STRIDE_PRIMES, md5_sql
from ..operators import sampling as SM
from ..sources import views as V
from . import sqlviews as S
from .registry import register

PRIMES_SQL = "[" + ", ".join(str(p) for p in STRIDE_PRIMES) + "]"

SPLIT_SQL = S.with_views("""
, r AS (SELECT interaction_id, user_id, post_id,
               row_number() OVER (ORDER BY "timestamp", interaction_id) - 1 AS rk,
               count(*) OVER () AS n FROM interactions)
SELECT interaction_id,
       CASE WHEN rk < floor(n * 0.7) THEN 'train'
            WHEN rk < floor(n * 0.7) + floor(n * 0.15) THEN 'validation' ELSE 'test' END AS split
FROM r""", S.INTERACTIONS).replace("\n, r AS", ",\nr AS")


def _split(spark, d):
    return SM.chronological_split(V.interactions(spark, d), "timestamp", "interaction_id")


@register("split_chronological", SPLIT_SQL)
def split_chronological(spark, d):
    return _split(spark, d).select("interaction_id", "split")


@register("split_string_ids", S.with_views("""
, s AS (SELECT interaction_id AS row_id, CASE WHEN interaction_id % 13 <> 0 THEN 'i_' || lpad(CAST(interaction_id AS VARCHAR), 7, '0') END AS id,
               CASE WHEN interaction_id % 17 <> 0 THEN date_trunc('day', "timestamp") END AS day FROM interactions),
r AS (SELECT *, row_number() OVER (ORDER BY day NULLS LAST, id NULLS LAST) - 1 AS rk, dense_rank() OVER (ORDER BY day NULLS LAST, id NULLS LAST) AS dr,
             count(*) OVER () AS n FROM s),
k AS (SELECT max(dr) FILTER (WHERE rk = floor(n * 0.7)) AS k1, max(dr) FILTER (WHERE rk = floor(n * 0.7) + floor(n * 0.15)) AS k2 FROM r)
SELECT row_id, id, CASE WHEN dr < k1 THEN 'train' WHEN dr < k2 THEN 'validation' ELSE 'test' END AS split FROM r, k""",
    S.INTERACTIONS).replace("\n, s AS", ",\ns AS"))
def split_string_ids(spark, d):
    """W-4 with text ids, some of them and some times missing, and many rows of one time."""
    i = F.col("interaction_id")
    text = F.when(i % 13 != 0, F.concat(F.lit("i_"), F.lpad(i.cast("string"), 7, "0")))
    day = F.when(i % 17 != 0, F.date_trunc("day", "timestamp").cast("timestamp_ntz"))
    rows = V.interactions(spark, d).select(i.alias("row_id"), text.alias("id"), day.alias("day"))
    return SM.chronological_split(rows, "day", "id").select("row_id", "id", "split")


SPLIT_ENT_SQL = "WITH " + ",\n".join([S.INTERACTIONS, S.POSTS, S.USERS]) + """,
r AS (SELECT interaction_id, user_id, post_id,
             row_number() OVER (ORDER BY "timestamp", interaction_id) - 1 AS rk,
             count(*) OVER () AS n FROM interactions),
sp AS (SELECT user_id, post_id,
              CASE WHEN rk < floor(n * 0.7) THEN 'train'
                   WHEN rk < floor(n * 0.7) + floor(n * 0.15) THEN 'validation' ELSE 'test' END AS split
       FROM r)
SELECT * FROM (
  SELECT DISTINCT split, 'user' AS entity, user_id AS id FROM sp
  UNION
  SELECT DISTINCT sp.split, 'user', p.creator_id FROM sp JOIN posts p USING (post_id))
WHERE id IN (SELECT user_id FROM users)
UNION ALL
SELECT DISTINCT sp.split, 'post', sp.post_id FROM sp WHERE sp.post_id IN (SELECT post_id FROM posts)
"""


@register("split_entities", SPLIT_ENT_SQL)
def split_entities(spark, d):
    return SM.split_entities(_split(spark, d), V.posts(spark, d, with_text=False), V.users(spark, d))


HASH_SPLIT_SQL = S.with_views(f"""
SELECT interaction_id,
       CASE WHEN ({md5_sql('interaction_id', seed=42)} % 1000000) / 1e6 < 0.8 THEN 'train'
            WHEN ({md5_sql('interaction_id', seed=42)} % 1000000) / 1e6 < 0.9 THEN 'validation'
            ELSE 'test' END AS split
FROM interactions""", S.INTERACTIONS)


@register("hash_split", HASH_SPLIT_SQL)
def hash_split(spark, d):
    return SM.hash_split(V.interactions(spark, d), ["interaction_id"]).select("interaction_id", "split")


def _walk_sql(params: str, pidx: str, exclude: str | None) -> str:
    """Oracle for the permutation walk: explode every candidate, then a plain window."""
    excl = (f"WHERE NOT EXISTS (SELECT 1 FROM {exclude} x WHERE x.user_id = c.user_id AND x.post_id = u.post_id)"
            if exclude else "")
    return f"""(
  SELECT user_id, post_id, j FROM (
    SELECT c.user_id, u.post_id, c.j, c.k,
           row_number() OVER (PARTITION BY c.user_id ORDER BY c.j) AS r
    FROM (SELECT user_id, k, j, (b + j * (s % p)) % p AS idx
          FROM (SELECT *, unnest(range(m)) AS j FROM {params} WHERE m > 0)) c
    JOIN {pidx} u USING (idx) {excl}) t
  WHERE r <= k)"""


def _params_sql(src: str, k: str, m: str) -> str:
    h = md5_sql("user_id", seed=42)
    return f"""(SELECT *, {h} % p AS b,
         list_extract({PRIMES_SQL}, CAST((({h}) >> 8) % {len(STRIDE_PRIMES)} + 1 AS INTEGER)) AS s
       FROM (SELECT *, {k} AS k, {m} AS m FROM {src}))"""


NEG_SQL = "WITH " + ",\n".join([S.INTERACTIONS, S.POSTS]) + f""",
pos AS (SELECT user_id, post_id, "timestamp" FROM interactions WHERE interaction_type IN ('like', 'bookmark')),
pidx AS (SELECT post_id, row_number() OVER (ORDER BY post_id) - 1 AS idx FROM (SELECT DISTINCT post_id FROM posts)),
pin AS (SELECT DISTINCT user_id, post_id FROM pos WHERE post_id IN (SELECT post_id FROM pidx)),
stats AS (
  SELECT s.user_id, s.n_pos, s.ts, coalesce(i.n_in, 0) AS n_in, (SELECT count(*) FROM pidx) AS p
  FROM (SELECT user_id, count(DISTINCT post_id) AS n_pos, max("timestamp") AS ts FROM pos GROUP BY user_id) s
  LEFT JOIN (SELECT user_id, count(*) AS n_in FROM pin GROUP BY user_id) i USING (user_id)),
params AS {_params_sql('stats', 'least(n_pos * 4, p - n_in)', 'least(least(n_pos * 4, p - n_in) + n_in, p)')},
got AS {_walk_sql('params', 'pidx', 'pin')}
SELECT g.user_id, g.post_id, 0 AS label, s.ts AS "timestamp" FROM got g JOIN stats s USING (user_id)
"""


@register("ranking_negatives", NEG_SQL)
def ranking_negatives(spark, d):
    inter = V.interactions(spark, d)
    pos = inter.where(F.col("interaction_type").isin("like", "bookmark"))
    return SM.ranking_negatives(pos, V.posts(spark, d, with_text=False), ratio=4, seed=42)


PAIRS_CTES = [S.INTERACTIONS, """uidx AS (SELECT post_id, row_number() OVER (ORDER BY post_id) - 1 AS idx
         FROM (SELECT DISTINCT post_id FROM interactions WHERE post_id IS NOT NULL))""",
              """pos AS (SELECT DISTINCT user_id, post_id FROM interactions
        WHERE interaction_type IN ('like', 'bookmark', 'view_full'))""",
              """pin AS (SELECT * FROM pos WHERE post_id IN (SELECT post_id FROM uidx))""",
              """stats AS (
  SELECT s.user_id, s.n_pos, coalesce(i.n_in, 0) AS n_in, (SELECT count(*) FROM uidx) AS p
  FROM (SELECT user_id, count(*) AS n_pos FROM pos GROUP BY user_id) s
  LEFT JOIN (SELECT user_id, count(*) AS n_in FROM pin GROUP BY user_id) i USING (user_id))""",
              "pa AS " + _params_sql('(SELECT * FROM stats WHERE p - n_in > 0)', 'least(p - n_in, n_pos * 5)',
                                     'least(least(p - n_in, n_pos * 5) + n_pos, p)'),
              "pb AS " + _params_sql('(SELECT * FROM stats WHERE p - n_in <= 0)', 'least(p, 5)', 'least(p, 5)'),
              "na AS " + _walk_sql('pa', 'uidx', 'pin'),
              "nb AS " + _walk_sql('pb', 'uidx', None),
              """pairs AS (
  SELECT user_id, post_id, 1 AS label FROM pos
  UNION ALL SELECT user_id, post_id, 0 FROM na
  UNION ALL SELECT user_id, post_id, 0 FROM nb)"""]
PAIRS_SQL = "WITH " + ",\n".join(PAIRS_CTES) + "\nSELECT user_id, post_id, label FROM pairs"


@register("retrieval_pairs", PAIRS_SQL)
def retrieval_pairs(spark, d):
    return SM.retrieval_pairs(V.interactions(spark, d))


SAMPLE_SQL = S.with_views(f"""
SELECT interaction_id, user_id, post_id FROM interactions
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {md5_sql('interaction_id', seed=7)}, interaction_id) <= 3
""", S.INTERACTIONS)


@register("sample_per_user", SAMPLE_SQL)
def sample_per_user(spark, d):
    inter = V.interactions(spark, d).select("interaction_id", "user_id", "post_id")
    return SM.sample_per_group(inter, ["user_id"], 3, ["interaction_id"], seed=7)


RANDNEG_SQL = "WITH " + ",\n".join([S.INTERACTIONS, S.POSTS, S.USERS]) + f""",
ui AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS uidx FROM (SELECT DISTINCT user_id FROM users)),
pi AS (SELECT post_id, row_number() OVER (ORDER BY post_id) - 1 AS pidx FROM (SELECT DISTINCT post_id FROM posts)),
pos AS (SELECT DISTINCT user_id AS src_user, post_id AS src_post FROM interactions
        WHERE interaction_type IN ('like', 'bookmark')),
rows AS (SELECT src_user, src_post, r,
                {md5_sql('src_user', 'src_post', 'r', seed='42u')} % (SELECT count(*) FROM ui) AS uidx,
                {md5_sql('src_user', 'src_post', 'r', seed='42p')} % (SELECT count(*) FROM pi) AS pidx
         FROM (SELECT *, unnest(range(10)) AS r FROM pos))
SELECT src_user, src_post, CAST(r AS INTEGER) AS r, ui.user_id, pi.post_id, 0 AS label
FROM rows JOIN ui USING (uidx) JOIN pi USING (pidx)
"""


@register("random_negatives", RANDNEG_SQL)
def random_negatives(spark, d):
    inter = V.interactions(spark, d)
    pos = inter.where(F.col("interaction_type").isin("like", "bookmark")).select("user_id", "post_id").distinct()
    return SM.random_negatives(pos, V.users(spark, d), V.posts(spark, d, with_text=False), ratio=10)
