"""Canonical recommendation views over the supplied tables.

The reference works on users / posts / interactions tables.  The supplied
test data is a star schema plus an event stream, so these views re-express
it in the reference's data model (mapping fixed in FIXTURES.md §2).  Each
view is a lazy projection: nothing is materialised and every downstream
filter or column choice reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the view mapping (FIXTURES.md §2).
EVENT_TO_INTERACTION = {
    "click": "like",
    "purchase": "bookmark",
    "view": "view_full",
    "signup": "comment",
}
OTHER_INTERACTION = "dislike"
SEEN_TYPE_MAP = {"view_full": "seen", "dislike": "disliked", "comment": "reported"}
RETURNFLAG_TO_INTERACTION = {"N": "like", "A": "view_full", "R": "dislike"}
POST_EPOCH = "2023-12-01 00:00:00"
USER_EPOCH = "2023-11-01 00:00:00"
MEDIA_TYPES = ("text", "image", "video")


def _case_map(c: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(default)


def category_label(c: Column) -> Column:
    """Integer class -> ``cat_%02d`` string id."""
    return F.concat(F.lit("cat_"), F.lpad(c.cast("string"), 2, "0"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(interaction_id, user_id, post_id, interaction_type, timestamp)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    return ev.select(
        F.col("event_id").alias("interaction_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("post_id"),
        _case_map(F.col("event_type"), EVENT_TO_INTERACTION, OTHER_INTERACTION).alias("interaction_type"),
        F.col("ts").alias("timestamp"),
    )


def posts(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """(post_id, creator_id, category_id, media_type, [description_text], creation_timestamp, embedding)."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    cols = [
        F.col("vec_id").alias("post_id"),
        (F.col("vec_id") % 100).alias("creator_id"),
        category_label(F.col("label")).alias("category_id"),
        F.element_at(F.array(*[F.lit(m) for m in MEDIA_TYPES]),
                     (F.col("vec_id") % 3 + 1).cast("int")).alias("media_type"),
    ]
    if with_text:
        d = read_table(spark, sf_dir, "documents", "doc_id", "text")
        e = e.join(d, e.vec_id == d.doc_id, "left")
        cols.append(F.col("text").alias("description_text"))
    cols += [
        (F.lit(POST_EPOCH).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.col("vec_id").cast("int"))).alias("creation_timestamp"),
        F.col("embedding"),
    ]
    return e.select(*cols)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, headline_text, about_text, onboarding_category_ids, creation_timestamp)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("headline_text"),
        F.concat_ws(" ", "c_mktsegment", "c_name").alias("about_text"),
        F.sort_array(F.array_distinct(F.array(
            category_label(F.col("c_custkey") % 10),
            category_label(F.col("c_nationkey") % 10)))).alias("onboarding_category_ids"),
        (F.lit(USER_EPOCH).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.col("c_custkey").cast("int"))).alias("creation_timestamp"),
    )


def seen_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving copy keyed (user_id, post_id, interaction_type) with seen/disliked/reported types."""
    i = interactions(spark, sf_dir)
    return (i.where(F.col("interaction_type").isin(list(SEEN_TYPE_MAP)))
            .select("user_id", "post_id",
                    _case_map(F.col("interaction_type"), SEEN_TYPE_MAP, None).alias("interaction_type"),
                    F.col("timestamp").alias("interaction_timestamp")))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature history for as-of joins: purchase events as (user_id, value, ts, created)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return (ev.where(F.col("event_type") == "purchase")
            .select("user_id", F.col("value").alias("spend"), F.col("ts").alias("feature_ts"),
                    F.col("event_id").alias("created")))


def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity rows for as-of joins: click events as (event_id, user_id, event_ts, label)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    return (ev.where(F.col("event_type") == "click")
            .select("event_id", "user_id", F.col("ts").alias("event_ts"),
                    F.get_json_object("props", "$.k").cast("bigint").alias("post_id"),
                    (F.get_json_object("props", "$.k").cast("bigint") % 2).cast("int").alias("label")))


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger interaction fact for timing: orders ⋈ lineitem.

    user = o_custkey, post = l_partkey, creator = l_suppkey, timestamp = o_orderdate,
    type from l_returnflag.  (l_orderkey, l_linenumber) is not unique, so no key
    is claimed for these rows.
    """
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("post_id"),
                    _case_map(F.col("l_returnflag"), RETURNFLAG_TO_INTERACTION, None).alias("interaction_type"),
                    F.col("o_orderdate").alias("timestamp")))


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts for the larger fact: part rows, creator = a supplier of the part."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    return p.select(F.col("p_partkey").alias("post_id"),
                    (F.col("p_partkey") % 100).alias("creator_id"),
                    F.col("p_type").alias("category_id"))


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("user_id"))
