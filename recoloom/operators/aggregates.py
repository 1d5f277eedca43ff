"""Entity aggregates (user / post feature tables), profiles and funnels.

Design: the interaction fact is scanned once and pre-aggregated to one row
per (user, post) with map-side partial aggregation before anything is joined,
so the dimension join sees at most #distinct pairs rows, and every per-entity
metric comes out of a single conditional aggregation (no per-metric
group-by/left-join passes).
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def user_post_rollup(inter: DataFrame) -> DataFrame:
    """One row per (user_id, post_id): likes, comments, events, last timestamp."""
    t = F.col("interaction_type")
    return inter.groupBy("user_id", "post_id").agg(
        count_if(t == "like").alias("likes"),
        count_if(t == "comment").alias("comments"),
        F.count(F.lit(1)).alias("events"),
        F.max("timestamp").alias("last_ts"),
    )


def user_aggregates(inter: DataFrame, posts: DataFrame, users: DataFrame) -> DataFrame:
    """User feature table (A-1..A-5, J-1, PRJ-4, PRJ-7).

    Base = every user of ``users``; users without activity get 0 / epoch.
    ``distinct_categories_interacted`` counts categories of any interaction
    whose post exists; likes received are summed over the creator's posts.
    """
    up = user_post_rollup(inter)
    dim = posts.select("post_id", "creator_id", "category_id")
    upc = up.join(dim, "post_id", "left")
    null_ts = F.lit(None).cast("timestamp_ntz")
    # Each (user, post) row contributes to the actor and to the post's creator.
    def part(uid, likes_given, comments_given, last_ts, category, likes_received):
        return F.struct(uid.alias("uid"), likes_given.alias("likes_given"),
                        comments_given.alias("comments_given"), last_ts.alias("last_ts"),
                        category.alias("category_id"), likes_received.alias("likes_received"),
                        F.lit(0).cast("bigint").alias("posts_created"))
    zero = F.lit(0).cast("bigint")
    contrib = upc.select(F.inline(F.array(
        part(F.col("user_id"), F.col("likes"), F.col("comments"), F.col("last_ts"),
             F.col("category_id"), zero),
        part(F.col("creator_id"), zero, zero, null_ts, F.lit(None).cast("string"), F.col("likes")),
    )))
    created = posts.select(F.col("creator_id").alias("uid"), F.lit(0).cast("bigint").alias("likes_given"),
                           F.lit(0).cast("bigint").alias("comments_given"), null_ts.alias("last_ts"),
                           F.lit(None).cast("string").alias("category_id"),
                           F.lit(0).cast("bigint").alias("likes_received"),
                           F.lit(1).cast("bigint").alias("posts_created"))
    agg = (contrib.unionByName(created).where(F.col("uid").isNotNull())
           .groupBy("uid").agg(
               F.sum("posts_created").alias("num_posts_created"),
               F.sum("likes_given").alias("count_likes_given"),
               F.sum("comments_given").alias("count_comments_given"),
               F.max("last_ts").alias("last_interaction_timestamp"),
               F.count_distinct("category_id").alias("distinct_categories_interacted"),
               F.sum("likes_received").alias("num_likes_received_on_posts"))
           .withColumnRenamed("uid", "user_id"))
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    out = users.select("user_id").join(agg, "user_id", "left").select(
        "user_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in
          ("num_posts_created", "count_likes_given", "count_comments_given",
           "distinct_categories_interacted", "num_likes_received_on_posts")],
        F.coalesce("last_interaction_timestamp", epoch).alias("last_interaction_timestamp"),
    )
    return out.withColumn("event_timestamp", F.col("last_interaction_timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    """Fractional hours ``later - earlier`` (SF-7); TIMESTAMP_NTZ or TIMESTAMP inputs."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(3.6e9)


def post_aggregates(inter: DataFrame, posts: DataFrame, ref_ts: Column | None = None) -> DataFrame:
    """Post feature table (A-6, A-7, SF-7).

    ``post_age_hours`` = reference time − creation, in fractional hours, where
    the reference time defaults to the latest interaction of the whole table
    (a scalar subquery, evaluated once) and may be negative; null → 0.
    """
    t = F.col("interaction_type")
    counts = inter.groupBy("post_id").agg(
        count_if(t == "like").alias("num_likes_on_post"),
        count_if(t == "view_full").alias("num_views_on_post"),
        count_if(t == "comment").alias("num_comments_on_post"))
    ref = ref_ts if ref_ts is not None else inter.select(F.max("timestamp")).scalar()
    out = posts.select("post_id", "creation_timestamp").join(counts, "post_id", "left")
    return out.select(
        "post_id",
        F.coalesce(hours_between(ref, F.col("creation_timestamp")), F.lit(0.0)).alias("post_age_hours"),
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in
          ("num_likes_on_post", "num_views_on_post", "num_comments_on_post")],
        "creation_timestamp",
        F.col("creation_timestamp").alias("event_timestamp"),
    )


def vocab_sizes(df: DataFrame, cols: list[str], extra: int = 2) -> DataFrame:
    """Vocabulary sizes ``nunique + extra`` for several columns in one aggregation (A-10)."""
    return df.agg(*[(F.count_distinct(c) + F.lit(extra)).cast("bigint").alias(f"{c}_vocab_size")
                    for c in cols])


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and row count for every column in one pass, long form (A-13)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return wide.select(F.col("__rows").alias("row_count"),
                       F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(c).alias("null_count")) for c in cols])))


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label and the negatives/positives class weight (A-13, X-26)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))                        # one row per label
    pos, neg = (F.sum(F.when(F.col(label) == v, F.col("n")).otherwise(0)).over(every) for v in (1, 0))
    return counts.select(label, "n", F.round(F.try_divide(neg.cast("double"), pos), 6).alias("neg_pos_ratio"))
