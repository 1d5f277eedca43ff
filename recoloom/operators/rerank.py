"""Serving-side operators: seen filter, category flag, scorers, freshness boost,
ranking, category-diverse greedy re-rank, interleaving, cold start
(M-4, E-7, M-15, M-10, W-2, M-11, M-12, X-14..X-16).

All set-oriented: one call handles every user.  The greedy re-rank is
order-dependent state, so it runs as a JVM ``aggregate`` fold over each
user's (bounded, top-N) candidate array instead of a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .skew import split_join

from ..defaults import (BOOST_FACTOR_DEFAULT, BOOST_HOURS_DEFAULT, DIVERSITY_CAP_OFFSET, DIVERSITY_FACTOR_DEFAULT,
                        DIVERSITY_RECENT_WINDOW, FINAL_RECOMMENDATIONS, SEEN_FILTER_TYPES as SEEN_TYPES,
                        SMOKE_SCORE_MATCH, SMOKE_SCORE_OTHER, UNKNOWN_CATEGORY)

USERS_A_TASK = 1 << 16                  # users of one category, or of one list of categories, that meet in a task


def seen_filter(candidates: DataFrame, store: DataFrame, types=SEEN_TYPES) -> DataFrame:
    """Drop a candidate if the store has any row of the given types for
    (user_id, post_id) — a left anti join; survivors keep their columns/order keys."""
    excl = store.where(F.col("interaction_type").isin(list(types))).select("user_id", "post_id")
    return candidates.join(excl, ["user_id", "post_id"], "left_anti")


def in_list_flag(category: Column, prefs: Column) -> Column:
    """E-7 / SF-15: 1 if the category is in the list, 0 otherwise (null list → 0).
    One shared expression for training and serving."""
    return F.coalesce(F.array_contains(prefs, category), F.lit(False)).cast("int")


def smoke_score(flag: Column) -> Column:
    """M-15 reference scorer without noise: 0.8 when the category matches, else 0.3."""
    return F.when(flag == 1, F.lit(SMOKE_SCORE_MATCH)).otherwise(F.lit(SMOKE_SCORE_OTHER))


def freshness_boost(score: Column, created: Column, ref_ts: Column, hours: float = BOOST_HOURS_DEFAULT,
                    factor: float = BOOST_FACTOR_DEFAULT) -> Column:
    """M-10: ``score * factor`` iff the creation time is known and
    ``ref_ts - created <= hours`` (future posts also pass); ``ref_ts`` is a
    parameter, never the wall clock."""
    age_us = F.unix_micros(ref_ts.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))
    fresh = created.isNotNull() & (age_us <= F.lit(int(hours * 3600 * 10**6)))
    return F.when(fresh, score * F.lit(factor)).otherwise(score)


def rank_by_score(df: DataFrame, score: str = "score", tie: str = "cand_rank",
                  out: str = "rank", limit: int | None = None) -> DataFrame:
    """W-2/W-3: per-user rank by score desc, ties by the input order column."""
    w = Window.partitionBy("user_id").orderBy(F.col(score).desc(), F.col(tie))
    r = df.withColumn(out, F.row_number().over(w).cast("bigint"))
    return r.where(F.col(out) <= limit) if limit else r


def diversity_cap(n: int, factor: float) -> int:
    """Per-category cap ``max(1, int(N·(f+0.2)))`` evaluated in double."""
    return max(1, int(n * (factor + DIVERSITY_CAP_OFFSET)))


def diverse_rerank(scored: DataFrame, n: int = FINAL_RECOMMENDATIONS, factor: float = DIVERSITY_FACTOR_DEFAULT,
                   window: int = DIVERSITY_RECENT_WINDOW,
                   category: str = "category_id", score: str = "score", tie: str = "cand_rank") -> DataFrame:
    """M-11 category-diverse greedy top-N per user.

    Walk candidates by (score desc, tie asc).  While fewer than N are chosen,
    take an item iff its category has fewer than ``cap`` chosen items and it
    is not *dominant*: with ≥ ``window`` chosen, its category fills
    ``>= window·(1−f)`` of the last ``window`` chosen.  Items passed over are
    kept in order and fill the remaining slots.  Input rows per user should
    be bounded (retrieval top-N); the fold runs in the JVM.
    Output: (user_id, rank, post_id, score, category_id).
    """
    cap = diversity_cap(n, factor)
    dom = window * (1 - factor)
    items = scored.select(
        "user_id",
        F.struct(F.col(score).alias("score"), F.col(tie).alias("tie"), F.col("post_id").alias("post_id"),
                 F.coalesce(F.col(category), F.lit(UNKNOWN_CATEGORY)).alias("cat")).alias("it"))
    per_user = items.groupBy("user_id").agg(F.collect_list("it").alias("items"))
    ordered = F.array_sort("items", lambda a, b: F.when(a.score > b.score, -1)
                           .when(a.score < b.score, 1)
                           .when(a.tie < b.tie, -1).when(a.tie > b.tie, 1).otherwise(0))
    elem_t = items.schema["it"].dataType
    # state: chosen items, their categories (for native counting), passed-over items
    init = F.struct(F.array().cast(ArrayType(elem_t)).alias("chosen"),
                    F.array().cast(ArrayType(StringType())).alias("cats"),
                    F.array().cast(ArrayType(elem_t)).alias("skipped"))

    def occurrences(arr, value):
        # native array functions (no per-element lambda): |arr| - |arr without value|
        return F.size(arr) - F.size(F.array_remove(arr, value))

    def step(st, x):
        chosen, cats = st["chosen"], st["cats"]
        k = F.size(chosen)
        done = k >= F.lit(n)
        recent = F.slice(cats, F.greatest(k - F.lit(window - 1), F.lit(1)), window)
        dominant = (k >= F.lit(window)) & (occurrences(recent, x["cat"]) >= F.lit(dom))
        take = (~done) & (occurrences(cats, x["cat"]) < F.lit(cap)) & (~dominant)
        return F.struct(
            F.when(take, F.concat(chosen, F.array(x))).otherwise(chosen).alias("chosen"),
            F.when(take, F.concat(cats, F.array(x["cat"]))).otherwise(cats).alias("cats"),
            # only the first N passed-over items can ever fill the output: cap the list there
            F.when((~done) & (~take) & (F.size(st["skipped"]) < F.lit(n)),
                   F.concat(st["skipped"], F.array(x))).otherwise(st["skipped"]).alias("skipped"))

    folded = per_user.select("user_id", F.aggregate(ordered, init, step).alias("st"))
    final = folded.select("user_id", F.slice(F.concat("st.chosen", "st.skipped"), 1, n).alias("final"))
    return final.select("user_id", F.posexplode("final").alias("pos", "it")).select(
        "user_id", (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("it.post_id").alias("post_id"),
        F.col("it.score").alias("score"), F.col("it.cat").alias("category_id"))


def interleave(ranked: DataFrame, category: str = "category_id", score: str = "score",
               tie: str = "post_id") -> DataFrame:
    """X-16: round-robin across categories — order by (position within the
    user's category, then score) so each round takes the best of every category."""
    w_cat = Window.partitionBy("user_id", category).orderBy(F.col(score).desc(), F.col(tie))
    r = ranked.withColumn("__round", F.row_number().over(w_cat))
    w = Window.partitionBy("user_id").orderBy("__round", F.col(score).desc(), F.col(tie))
    return r.withColumn("rank", F.row_number().over(w).cast("bigint")).drop("__round")


def category_vector_stats(posts: DataFrame, vec: str = "embedding", category: str = "category_id") -> DataFrame:
    """Per-category vector sum and count (one row per category)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    return (posts.where(F.col(vec).isNotNull()).groupBy(category)
            .agg(Summarizer.sum(array_to_vector(vec)).alias("__s"), F.count(F.lit(1)).alias("n"))
            .select(category, vector_to_array("__s").alias("vsum"), "n"))


def cold_start_vectors(users: DataFrame, posts: DataFrame, prefs: str = "onboarding_category_ids") -> DataFrame:
    """X-14: mean vector of all posts in the user's selected categories, computed
    as Σ category sums / Σ category counts (categories are disjoint), so users
    are never paired with individual posts."""
    up = users.select("user_id", F.explode(F.array_distinct(prefs)).alias("category_id"))
    return mean_of_categories(up, posts, "user_id")


def mean_of_categories(chosen: DataFrame, posts: DataFrame, key: str) -> DataFrame:
    """(key, cold_vector) of the rows (key, category_id)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    stats = category_vector_stats(posts)
    j = chosen.join(stats, "category_id")
    agg = j.groupBy(key).agg(Summarizer.sum(array_to_vector("vsum")).alias("__s"), F.sum("n").alias("n"))
    return agg.select(key, F.transform(vector_to_array("__s"), lambda x: x / F.col("n")).alias("cold_vector"))


def popular_in_categories(users: DataFrame, posts: DataFrame, inter: DataFrame, n: int = 10,
                          prefs: str = "onboarding_category_ids") -> DataFrame:
    """X-15: cold-start fallback — each user's top-n posts of the selected
    categories by like count then recency.  Top-n is computed per category
    first (WindowGroupLimit), so the user join touches ≤ n posts per category."""
    likes = inter.where(F.col("interaction_type") == "like").groupBy("post_id").agg(
        F.count(F.lit(1)).alias("likes"))
    p = posts.select("post_id", "category_id", "creation_timestamp").join(likes, "post_id", "left").fillna(0, ["likes"])
    w = Window.partitionBy("category_id").orderBy(F.col("likes").desc(), F.col("creation_timestamp").desc(),
                                                  F.col("post_id"))
    top = p.withColumn("cat_rank", F.row_number().over(w)).where(F.col("cat_rank") <= n)
    up = users.select("user_id", F.explode(F.array_distinct(prefs)).alias("category_id"))
    # a few categories hold all users: their users are dealt over tasks, each with the category's list
    lists = top.groupBy("category_id").agg(F.collect_list(F.struct("post_id", "likes", "creation_timestamp")).alias("__top"))
    cand = split_join(up, lists, "category_id", "user_id", USERS_A_TASK).where("__top is not null").select("user_id", "category_id", F.inline("__top"))
    w2 = Window.partitionBy("user_id").orderBy(F.col("likes").desc(), F.col("creation_timestamp").desc(),
                                               F.col("post_id"))
    return (cand.withColumn("rank", F.row_number().over(w2).cast("bigint")).where(F.col("rank") <= n)
            .select("user_id", "rank", "post_id", "category_id", "likes"))
