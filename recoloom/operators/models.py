"""Model-facing operators on MLlib (E-10..E-12, M-5..M-9, SF-13, X-33, SNK-6).

The reference trains gradient-boosted trees and a two-tower network on single
machines; here the same roles are played by distributed MLlib estimators:
``GBTClassifier`` for ranking, implicit-feedback ``ALS`` for user/post
vectors, and ``predict_batch_udf`` for batched dense-layer inference with broadcast
weights.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import GBT_PARAMS, TOWER_BATCH_SIZE, TOWER_DIM
from .sampling import dense_index


def feature_pipeline(categorical: list[str], numeric: list[str]) -> Pipeline:
    """E-10: index + one-hot the categoricals (unknown kept), assemble with numerics."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                        outputCols=[f"{c}__ohe" for c in categorical], handleInvalid="keep")
    vec = VectorAssembler(inputCols=numeric + [f"{c}__ohe" for c in categorical],
                          outputCol="features", handleInvalid="keep")
    return Pipeline(stages=idx + ([ohe] if categorical else []) + [vec])


def fit_transform(train: DataFrame, other: DataFrame, categorical: list[str], numeric: list[str]):
    """Fit on train only and apply to both — columns align by construction (E-11)."""
    model = feature_pipeline(categorical, numeric).fit(train)
    return model, model.transform(train), model.transform(other)


def class_weights(train: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """X-26: positives weigh as the negatives outnumber them, so both classes weigh the
    same; negatives weigh 1, and so does everything where a class is missing."""
    ratio = train.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1))).scalar()
    return train.withColumn(out, F.when(F.col(label) == 1, F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(1.0)))


def train_gbt(train: DataFrame, validation: DataFrame | None = None, label: str = "label",
              seed: int = 42, weight: str | None = None, **params) -> PipelineModel:
    """M-5: GBT with the reference hyper-parameters; with a validation frame the
    rows are unioned and flagged so MLlib stops early on validation error.  ``weight``
    names a column of row weights (of both frames)."""
    p = {**GBT_PARAMS, **params, **({"weightCol": weight} if weight else {})}
    if validation is not None:
        data = (train.withColumn("__is_val", F.lit(False))
                .unionByName(validation.withColumn("__is_val", F.lit(True))))
        gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed,
                            validationIndicatorCol="__is_val", **p)
    else:
        data = train
        gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **p)
    return gbt.fit(data)


def save_model(model, path: str) -> None:
    """SNK-6: a fitted model under ``path``, replacing what was there."""
    model.write().overwrite().save(path)


def load_ranker(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


def score(model, df: DataFrame, out: str = "score") -> DataFrame:
    """M-9: probability of class 1 next to the input columns."""
    return model.transform(df).withColumn(out, F.get(vector_to_array("probability"), 1)).drop(
        "rawPrediction", "probability", "prediction")


def feature_importance(model, names: list[str], spark) -> DataFrame:
    """X-33: importances as a sorted DataFrame (one row per feature — bounded)."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def assembled_names(df: DataFrame) -> list[str]:
    """Slot names of the assembled ``features`` column (from ML attribute metadata)."""
    meta = df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in meta.values() for a in group)
    return [n for _, n in slots]


# Engine choice (not a reference value): implicit-feedback confidence per interaction type.
CONFIDENCE = {"like": 3.0, "bookmark": 4.0, "view_full": 2.0, "comment": 2.0, "share": 3.0}


def als_vectors(inter: DataFrame, rank: int = TOWER_DIM, seed: int = 42, max_iter: int = 10,
                reg: float = 0.05):
    """M-6 re-aimed: implicit ALS on confidence-weighted (user, post) pairs;
    returns (model, user_factors(user_id, vector), post_factors(post_id, vector))."""
    conf = None
    for k, v in CONFIDENCE.items():
        c = F.when(F.col("interaction_type") == k, F.lit(v))
        conf = c if conf is None else conf.when(F.col("interaction_type") == k, F.lit(v))
    ratings = (inter.select("user_id", "post_id", conf.otherwise(F.lit(0.0)).alias("c"))
               .where(F.col("c") > 0).groupBy("user_id", "post_id").agg(F.sum("c").alias("rating")))
    uid = dense_index(ratings.select("user_id").distinct(), ["user_id"], "u")      # ALS wants int ids, whatever ours are
    pid = dense_index(ratings.select("post_id").distinct(), ["post_id"], "p")
    ratings = ratings.join(uid, "user_id").join(pid, "post_id").select(
        F.col("u").cast("int").alias("user_id"), F.col("p").cast("int").alias("post_id"), "rating")
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=True, alpha=1.0, seed=seed,
              userCol="user_id", itemCol="post_id", ratingCol="rating", coldStartStrategy="drop")
    model = als.fit(ratings)
    users = model.userFactors.join(uid, F.col("id") == F.col("u")).select("user_id", F.col("features").alias("vector"))
    posts = model.itemFactors.join(pid, F.col("id") == F.col("p")).select("post_id", F.col("features").alias("vector"))
    return model, users, posts


def dense_tower(df: DataFrame, vec: str, layers: list[tuple[np.ndarray, np.ndarray]],
                out: str = "tower_vector", batch_size: int = TOWER_BATCH_SIZE) -> DataFrame:
    """SF-13 / M-7: ``relu(W·x + b)`` per layer, applied in Arrow batches of
    ``batch_size`` with the weights shipped once per worker (closure of the
    model loader); the input dimension is checked against the first layer."""
    in_dim = layers[0][0].shape[1]
    weights = [(np.asarray(w, dtype=np.float64), np.asarray(b, dtype=np.float64)) for w, b in layers]

    def make_model():
        def predict(x: np.ndarray) -> np.ndarray:
            h = x.astype(np.float64)
            if h.shape[1] != in_dim:
                raise ValueError(f"expected {in_dim}-d input, got {h.shape[1]}")
            for w, b in weights:
                h = np.maximum(h @ w.T + b, 0.0)
            return h
        return predict

    udf = predict_batch_udf(make_model, return_type=T.ArrayType(T.DoubleType()),
                            batch_size=batch_size, input_tensor_shapes=[[in_dim]])
    return df.withColumn(out, udf(F.col(vec).cast("array<double>")))
