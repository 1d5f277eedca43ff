"""Content vectors, and joins with heavy keys."""

import numpy as np
from pyspark.sql import functions as F

from recoloom.operators import content as CT
from recoloom.operators import features as FE
from recoloom.operators import skew


def frame(spark, X, name="vector"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(X)], f"post_id long, {name} array<double>").repartition(5)


def test_decomposition_and_ridge_equal_numpy(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 12)) @ np.diag(np.linspace(3, 0.1, 12))
    V, s = CT.singular_vectors(frame(spark, X), "vector", 12, 5)
    _, want, Vt = np.linalg.svd(X, full_matrices=False)
    assert np.allclose(s, want[:5]) and np.allclose(np.abs((V * Vt[:5].T).sum(0)), 1)
    Y = X @ rng.normal(size=(12, 3)) + 2
    pairs = frame(spark, X, "x").join(frame(spark, Y, "y"), "post_id")
    W = CT.ridge_map(pairs, "x", "y", 12, 3, 0.5)
    A = np.hstack([X, np.ones((300, 1))])
    assert np.allclose(W, np.linalg.solve(A.T @ A + np.diag([0.5] * 12 + [1e-9]), A.T @ Y))
    got = CT.mapped(frame(spark, X), "vector", W, "out", constant=True).collect()
    assert all(np.allclose(r.out, A[r.post_id] @ W) for r in got)


def test_posts_without_interactions_are_ranked_by_their_text(spark):
    """Texts and factors share four topics; held-out posts' vectors prefer users of their topic."""
    rng = np.random.default_rng(7)
    topic = rng.integers(4, size=400)
    texts = np.eye(4)[topic] @ rng.normal(size=(4, 30)) + rng.normal(size=(400, 30)) * 0.5
    centre = rng.normal(size=(4, 8))
    factors = centre[topic] + rng.normal(size=(400, 8)) * 0.3
    known = frame(spark, factors).where("post_id >= 100")
    rows = CT.content_factors(frame(spark, texts).union(spark.createDataFrame([(900, None)], "post_id long, vector array<double>")), known.union(
        frame(spark, factors[:1]).select(F.lit(950).alias("post_id"), "vector")), dim=30, k=6, rank=8).collect()
    by = {r.post_id: r for r in rows}
    assert len(by) == 401 and 900 not in by and by[950].learned and by[950].content_vector is None
    assert all(by[i].learned == (i >= 100) for i in range(400))
    assert np.allclose(by[150].vector, factors[150])
    scores = np.array([by[i].vector for i in range(100)]) @ centre.T
    right = scores[np.arange(100), topic[:100]]
    assert np.mean([right[i] > scores[i, t] for i in range(100) for t in range(4) if t != topic[i]]) > 0.9


def test_heavy_keys_are_spread(spark):
    rows = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 4 > 0, "the").when(F.col("id") % 8 == 0, F.lit(None))
                                    .otherwise(F.concat(F.lit("w"), F.col("id"))).alias("term"))
    facts = rows.groupBy("term").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = skew.split_join(rows, facts, "term", "id", rows_a_task=200)
        per = [r["count"] for r in out.where("term = 'the'").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per) == 3000 and len(per) >= 6 and max(per) < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain = rows.join(facts, "term", "left")
    assert sorted(map(str, out.select("id", "term", "n").collect())) == sorted(map(str, plain.select("id", "term", "n").collect()))


def test_keywords_do_not_depend_on_the_split(spark):
    docs = spark.createDataFrame([(i, f"the the of word{i % 7} word{i} " * (1 + i % 3)) for i in range(60)], "doc_id long, text string")
    a, b = (sorted(tuple(r) for r in FE.keywords(docs, "doc_id", "text", 3, n).collect()) for n in (1 << 20, 5))
    assert a == b and len(a) == 180
