"""Behavioural features from the project plan and the course notes (X-1..X-23, X-37, X-38).

Every feature is a conditional aggregation, a bounded window, or a join of
pre-aggregated tables; none pairs users with items.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import count_if

from .skew import ROWS_A_TASK, split_join
from ..defaults import INTERACTION_TYPES, RANKING_POSITIVE_TYPES as POSITIVE_TYPES


def window_counts(inter: DataFrame, ref_ts: Column, days=(1, 7, 30), types=INTERACTION_TYPES) -> DataFrame:
    """X-1: per user, count of each type within the trailing ``d`` days of ``ref_ts``
    (``ref - d days <= ts <= ref``), every (type, window) in one aggregation."""
    t, ts, ref = F.col("interaction_type"), F.col("timestamp"), F.col("__ref")
    aggs = []
    for d in days:
        lo = ref - F.make_dt_interval(F.lit(d))
        for ty in types:
            aggs.append(count_if((t == ty) & (ts >= lo) & (ts <= ref)).alias(f"{ty}_count_{d}d"))
    return inter.withColumn("__ref", ref_ts).groupBy("user_id").agg(*aggs)          # one read of the reference time


def preferred_media(inter: DataFrame, posts: DataFrame) -> DataFrame:
    """X-2: the media type a user interacts with most (ties → larger name)."""
    c = (inter.join(posts.select("post_id", "media_type"), "post_id")
         .groupBy("user_id", "media_type").agg(F.count(F.lit(1)).alias("n")))
    return c.groupBy("user_id").agg(F.max_by("media_type", F.struct("n", "media_type")).alias("preferred_media_type"),
                                    F.max("n").alias("n_interactions"))


def category_counts(inter: DataFrame, posts: DataFrame) -> DataFrame:
    """X-3: likes per user × category, one row per pair that occurs (no limit on categories)."""
    j = inter.where(F.col("interaction_type") == "like").join(posts.select("post_id", "category_id"), "post_id")
    return j.groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("likes"))


def category_affinity(inter: DataFrame, posts: DataFrame, positive=POSITIVE_TYPES) -> DataFrame:
    """X-4: share of a user's positive interactions that fall in each category."""
    j = (inter.where(F.col("interaction_type").isin(list(positive)))
         .join(posts.select("post_id", "category_id"), "post_id"))
    c = j.groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("affinity", F.col("n") / F.sum("n").over(Window.partitionBy("user_id")))


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """X-6: (x − min) / (max − min) per column; all bounds come from one aggregate
    row, read by one scalar subquery; constant columns → 0."""
    b = df.agg(F.struct(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).alias("b")).scalar()
    scaled = {f"{c}_norm": F.coalesce(F.try_divide(F.col(c) - F.col("__b")[f"lo_{c}"],
                                                   F.col("__b")[f"hi_{c}"] - F.col("__b")[f"lo_{c}"]), F.lit(0.0)) for c in cols}
    return df.withColumn("__b", b).withColumns(scaled).drop("__b")


def top_category_flag(pairs: DataFrame, inter: DataFrame, posts: DataFrame, n: int = 3) -> DataFrame:
    """X-7: is the post's category among the user's top-n interacted categories
    (by count, ties by category id)?  Top-n per user is a WindowGroupLimit."""
    pc = posts.select("post_id", "category_id")
    counts = inter.join(pc, "post_id").groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.col("n").desc(), F.col("category_id"))
    top = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).select(
        "user_id", "category_id", F.lit(1).alias("in_top"))
    return (pairs.join(pc, "post_id", "left").join(top, ["user_id", "category_id"], "left")
            .withColumn("post_category_in_top", F.coalesce("in_top", F.lit(0))).drop("in_top"))


def creator_seen_flag(pairs: DataFrame, inter: DataFrame, posts: DataFrame) -> DataFrame:
    """X-8: has the user interacted with *another* post of this post's creator?
    Distinct posts per (user, creator) minus the current one — no pair expansion."""
    pcr = posts.select("post_id", "creator_id")
    seen = (inter.select("user_id", "post_id").distinct().join(pcr, "post_id")
            .groupBy("user_id", "creator_id").agg(F.count(F.lit(1)).alias("n_posts")))
    mine = inter.select("user_id", "post_id").distinct().withColumn("__own", F.lit(1))
    j = (pairs.join(pcr, "post_id", "left").join(seen, ["user_id", "creator_id"], "left")
         .join(mine, ["user_id", "post_id"], "left"))
    other = F.coalesce("n_posts", F.lit(0)) - F.coalesce("__own", F.lit(0))
    return j.withColumn("seen_other_post_of_creator", (other > 0).cast("int")).drop("n_posts", "__own")


def category_rate(inter: DataFrame, posts: DataFrame) -> DataFrame:
    """X-10: likes / full views per user × category (null when no views)."""
    j = inter.join(posts.select("post_id", "category_id"), "post_id")
    t = F.col("interaction_type")
    return j.groupBy("user_id", "category_id").agg(
        count_if(t == "like").alias("likes"), count_if(t == "view_full").alias("views")).withColumn(
        "like_rate", F.try_divide(F.col("likes").cast("double"), F.col("views")))


def impression_negatives(inter: DataFrame, impression_type="view_full", positive=POSITIVE_TYPES) -> DataFrame:
    """X-11: (user, post) shown (impression) but never positively interacted with."""
    imp = inter.where(F.col("interaction_type") == impression_type).select("user_id", "post_id").distinct()
    pos = inter.where(F.col("interaction_type").isin(list(positive))).select("user_id", "post_id")
    return imp.join(pos, ["user_id", "post_id"], "left_anti").withColumn("label", F.lit(0))


def preferred_engagement(inter: DataFrame, posts: DataFrame, users: DataFrame,
                         positive=POSITIVE_TYPES) -> DataFrame:
    """X-18: per user, share of interactions (and of positives) inside the onboarding categories."""
    j = (inter.join(posts.select("post_id", "category_id"), "post_id")
         .join(users.select("user_id", "onboarding_category_ids"), "user_id"))
    inside = F.coalesce(F.array_contains("onboarding_category_ids", F.col("category_id")), F.lit(False))
    pos = F.col("interaction_type").isin(list(positive))
    return j.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_interactions"),
        F.avg(inside.cast("double")).alias("share_in_preferred"),
        F.try_divide(F.sum((inside & pos).cast("double")), F.sum(pos.cast("double"))).alias("positive_share_in_preferred"))


def month_cycle(ts: Column) -> tuple[Column, Column]:
    """X-23: (sin, cos) of 2π·month/12."""
    m = F.month(ts).cast("double")
    return F.sin(F.lit(2 * math.pi) * m / 12.0), F.cos(F.lit(2 * math.pi) * m / 12.0)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """X-22: drop every column holding at least one null (one aggregation decides the schema)."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] == 0])


def rfm(orders: DataFrame, ref_ts: Column) -> DataFrame:
    """X-38: recency (days since last order), frequency, monetary per customer."""
    return orders.groupBy("o_custkey").agg(
        F.datediff(ref_ts, F.max("o_orderdate")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("o_totalprice").alias("monetary"))


def load_checks(inter: DataFrame, users: DataFrame, posts: DataFrame) -> DataFrame:
    """X-37 / SRC-5: data checks as one report table (check, value)."""
    unknown_users = inter.select("user_id").join(users.select("user_id"), "user_id", "left_anti")
    unknown_posts = inter.select("post_id").join(posts.select("post_id"), "post_id", "left_anti")
    dup = inter.groupBy("interaction_id").count().where(F.col("count") > 1)
    stats = inter.agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("user_id").isNull()).alias("null_user_id"),
                      F.count_if(F.col("post_id").isNull()).alias("null_post_id"),
                      F.count_if(F.col("timestamp").isNull()).alias("null_timestamp"))
    checks = [("rows", stats.select("rows").scalar()),
              ("null_user_id", stats.select("null_user_id").scalar()),
              ("null_post_id", stats.select("null_post_id").scalar()),
              ("null_timestamp", stats.select("null_timestamp").scalar()),
              ("unknown_user_rows", unknown_users.select(F.count(F.lit(1))).scalar()),
              ("unknown_post_rows", unknown_posts.select(F.count(F.lit(1))).scalar()),
              ("duplicate_interaction_ids", dup.select(F.count(F.lit(1))).scalar())]
    base = inter.sparkSession.range(1)
    return base.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("bigint").alias("value"))
                                          for n, v in checks])))


def keywords(docs: DataFrame, id_col: str, text: str, k: int = 5, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """X-19: top-k TF-IDF terms per document over the whole text.
    tf = count in doc, idf = ln((N + 1) / (df + 1)) + 1; ties by term.  A term's
    document frequency is its number of rows, so it also tells which terms (stop
    words) are to be split over tasks."""
    from ..functions.text import raw_tokens
    toks = (docs.select(id_col, F.explode(raw_tokens(F.col(text))).alias("term"))
            .where(F.length("term") > 0))
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(docs.sparkSession)
    # read by both sides of the join below: counted and written once
    tf = toks.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")).checkpoint(eager=True)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).checkpoint(eager=True)
    heavy = df_.where(F.col("df") > rows_a_task).select("term", F.ceil(F.col("df") / rows_a_task).cast("int").alias("splits"))
    sc = split_join(tf, df_, "term", id_col, heavy=heavy).withColumn(
        "score", F.col("tf") * (F.log((n_docs + 1).cast("double") / (F.col("df") + 1)) + 1.0))
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("term"))
    return (sc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(id_col, F.col("rank").cast("bigint").alias("rank"), "term", "score"))
