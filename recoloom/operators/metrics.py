"""Model and ranking metrics as aggregations (A-11, A-12, X-31, X-32, M-14).

ROC-AUC is exact and tie-correct: predictions are grouped per distinct
score, and each score's positives are credited with the negatives ranked
below it plus half the tied negatives; the "negatives below" running total
is a distributed prefix sum, not a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import CLASSIFICATION_THRESHOLD
from .sampling import exclusive_prefix_sums

EPS = 1e-15


def score_histogram(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(s, pos, neg): positives and negatives per distinct score — the only pass over the predictions."""
    return pred.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum((F.col(label) == 1).cast("double")).alias("pos"),
        F.sum((F.col(label) == 0).cast("double")).alias("neg"))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score") -> Column:
    ps = exclusive_prefix_sums(score_histogram(pred, label, score), ["s"], ["neg"])
    return ps.select(F.try_divide(F.sum(F.col("pos") * (F.col("before_neg") + 0.5 * F.col("neg"))),
                                  F.sum("pos") * F.sum("neg"))).scalar()


def binary_metrics(pred: DataFrame, label: str = "label", score: str = "score",
                   threshold: float = CLASSIFICATION_THRESHOLD) -> DataFrame:
    """One row: n, roc_auc, log_loss, accuracy, precision, recall, f1 (0 when undefined).

    Everything is derived from the per-score histogram (one aggregation of the
    predictions), so the prediction plan runs once; AUC credits each score's
    positives with the negatives below it (distributed prefix sum) plus half
    the tied negatives."""
    h = exclusive_prefix_sums(score_histogram(pred, label, score), ["s"], ["neg"])
    p = F.least(F.greatest(F.col("s"), F.lit(EPS)), F.lit(1 - EPS))
    hit = (F.col("s") >= threshold).cast("double")
    base = h.agg(
        F.sum(F.col("pos") + F.col("neg")).cast("bigint").alias("n"),
        F.try_divide(F.sum(F.col("pos") * (F.col("before_neg") + 0.5 * F.col("neg"))),
                     F.sum("pos") * F.sum("neg")).alias("roc_auc"),
        (F.sum(-(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p))) / F.sum(F.col("pos") + F.col("neg")))
        .alias("log_loss"),
        (F.sum(hit * F.col("pos") + (1 - hit) * F.col("neg")) / F.sum(F.col("pos") + F.col("neg"))).alias("accuracy"),
        F.sum(hit * F.col("pos")).alias("tp"), F.sum(hit * F.col("neg")).alias("fp"),
        F.sum((1 - hit) * F.col("pos")).alias("fn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return base.select("n", "roc_auc", "log_loss", "accuracy", prec.alias("precision"), rec.alias("recall"),
                       f1.alias("f1"))


def ranking_metrics(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """X-32: mean Precision@k, Recall@k, NDCG@k and MRR over users that have
    both recommendations and relevant items.  ``recs``: (user_id, post_id, rank);
    ``relevant``: (user_id, post_id)."""
    rel = relevant.select("user_id", "post_id").distinct()
    n_rel = rel.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rel"))
    top = recs.where(F.col("rank") <= k)
    hits = top.join(rel.withColumn("hit", F.lit(1)), ["user_id", "post_id"], "left").fillna(0, ["hit"])
    per = hits.groupBy("user_id").agg(
        F.sum("hit").alias("hits"),
        F.sum(F.when(F.col("hit") == 1, 1.0 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias("dcg"),
        F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first_hit"))
    per = per.join(n_rel, "user_id")
    idcg = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_rel"), F.lit(k)).cast("int")), F.lit(0.0),
                       lambda a, i: a + 1.0 / F.log2(i + 1))
    return per.select(
        F.count(F.lit(1)).alias("n_users"),
        F.avg(F.col("hits") / k).alias("precision_at_k"),
        F.avg(F.col("hits") / F.col("n_rel")).alias("recall_at_k"),
        F.avg(F.col("dcg") / idcg).alias("ndcg_at_k"),
        F.avg(F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0))).alias("mrr"))
