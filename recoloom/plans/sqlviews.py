"""DuckDB text of the canonical views (same mapping as ``sources.views``).

The oracle queries are written independently of the Spark code: plain SQL
over the pre-registered tables, composed from these CTEs.
"""

INTERACTIONS = """interactions AS (
  SELECT event_id AS interaction_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS post_id,
         CASE event_type WHEN 'click' THEN 'like' WHEN 'purchase' THEN 'bookmark'
                         WHEN 'view' THEN 'view_full' WHEN 'signup' THEN 'comment'
                         ELSE 'dislike' END AS interaction_type,
         ts AS "timestamp"
  FROM events)"""

POSTS = """posts AS (
  SELECT e.vec_id AS post_id, e.vec_id % 100 AS creator_id,
         'cat_' || lpad(CAST(e.label AS VARCHAR), 2, '0') AS category_id,
         CASE e.vec_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'image' ELSE 'video' END AS media_type,
         d.text AS description_text,
         TIMESTAMP '2023-12-01 00:00:00' + e.vec_id * INTERVAL 1 HOUR AS creation_timestamp,
         e.embedding
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)"""

USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS headline_text, c_mktsegment || ' ' || c_name AS about_text,
         list_sort(list_distinct([
           'cat_' || lpad(CAST(c_custkey % 10 AS VARCHAR), 2, '0'),
           'cat_' || lpad(CAST(c_nationkey % 10 AS VARCHAR), 2, '0')])) AS onboarding_category_ids,
         TIMESTAMP '2023-11-01 00:00:00' + c_custkey * INTERVAL 1 MINUTE AS creation_timestamp
  FROM customer)"""

SEEN = """seen_store AS (
  SELECT user_id, post_id,
         CASE interaction_type WHEN 'view_full' THEN 'seen' WHEN 'dislike' THEN 'disliked'
                               WHEN 'comment' THEN 'reported' END AS interaction_type,
         "timestamp" AS interaction_timestamp
  FROM interactions WHERE interaction_type IN ('view_full', 'dislike', 'comment'))"""

FEATURE_ROWS = """feature_rows AS (
  SELECT user_id, value AS spend, ts AS feature_ts, event_id AS created
  FROM events WHERE event_type = 'purchase')"""

ENTITY_ROWS = """entity_rows AS (
  SELECT event_id, user_id, ts AS event_ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS post_id,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 AS INTEGER) AS label
  FROM events WHERE event_type = 'click')"""

ORDER_INTERACTIONS = """order_interactions AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS post_id,
         CASE l.l_returnflag WHEN 'N' THEN 'like' WHEN 'A' THEN 'view_full'
                             WHEN 'R' THEN 'dislike' END AS interaction_type,
         o.o_orderdate AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

ORDER_POSTS = """order_posts AS (
  SELECT p_partkey AS post_id, p_partkey % 100 AS creator_id, p_type AS category_id FROM part)"""

ORDER_USERS = """order_users AS (SELECT c_custkey AS user_id FROM customer)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body
