"""What must not grow with the square of the tables, or carry wide columns through shuffles."""

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL
from pyspark.sql import functions as F

from recoloom.functions.hashing import md5_bigint
from recoloom.operators import textvec as TV


def plan(df):
    return df._jdf.queryExecution().toString()


def test_words_are_counted_without_a_shuffle(spark):
    texts = ["The cat, the CAT\n sat_1", "", None, "Kİx été Σ 9", "a" * 70 + " b " * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = TV.text_vectors(df, "id", "text", 97)
    assert "Exchange" not in plan(got)                          # before: words, counts and norms were each shuffled by key
    words = (df.select("id", F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\W+", -1)).alias("w")).where("w <> ''")
             .groupBy("id", (md5_bigint("w", seed="text") % 97).alias("b")).agg(F.count("*").alias("tf")).collect())
    n = {b: len({r.id for r in words if r.b == b}) for b in {r.b for r in words}}
    w = {(r.id, r.b): r.tf * np.log(6 / (n[r.b] + 1)) for r in words}
    size = {i: np.sqrt(sum(v * v for (k, _), v in w.items() if k == i)) for i in {k for k, _ in w}}
    want = {k: v / size[k[0]] for k, v in w.items() if v > 0}
    have = {(r.id, r.bucket): r.value for r in got.collect()}
    assert have.keys() == want.keys() and all(abs(have[k] - want[k]) < 1e-12 for k in want)


def test_copies_meet_without_their_texts(spark):
    from recoloom.plans import QUERIES
    got = QUERIES["dedup_embed"](spark, SF_SMALL)
    assert "Exchange" not in plan(got) and got.columns == ["doc_id", "copies", "bucket", "value"]


def test_a_query_meets_the_codes_once(spark):
    """Before: one row with the vector for each query and probed cell."""
    from recoloom.operators import vector_index as VI
    rng = np.random.default_rng(5)
    q = VI.Quantizer(rng.normal(size=(40, 6)), [rng.normal(size=(8, 3)), rng.normal(size=(8, 3))])
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(30, 6)))], "qid long, qvec array<double>")
    assert VI.probe(queries, q, 36).count() == 30
    got = VI.probe(queries, q, 9, 4).collect()
    assert len(got) <= 120
    for i in range(30):
        cells = sorted(r.first + c for r in got if r.qid == i for c in np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8))))
        vec = next(r.qvec for r in got if r.qid == i)
        assert cells == sorted(np.argsort(((q.centroids - np.array(vec)) ** 2).sum(1))[:9])


def test_many_equal_items_tie_by_id(spark):
    from recoloom.operators import knn as K
    items = spark.createDataFrame([(i, [0.1, 0.7, 0.3]) for i in range(900)] + [(1000, [0.1, 0.7, 0.31])], "item_id long, ivec array<float>").repartition(7)
    queries = spark.createDataFrame([(i, [0.01 * i, 0.5, 0.2]) for i in range(40)], "qid long, qvec array<double>")
    got = K.knn(queries.where("qid > 20"), items, 5, item_block=50, query_block=7).orderBy("qid", "rank").collect()
    assert [r.item_id for r in got] == [0, 1, 2, 3, 4] * 19 and len({(r.qid, r.score) for r in got}) == 19


def test_pair_scores_send_a_vector_once_a_chunk(spark):
    from recoloom.functions import vectors as VX
    from recoloom.operators import knn as K
    rng = np.random.default_rng(4)
    left = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=5)]) for i in range(1, 30)] + [(30, None)], "lid long, lvec array<double>")
    right = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=5)]) for i in range(20)] + [(20, None), (21, [1.0, 2.0]), (22, [0.0] * 5)], "rid long, rvec array<float>")
    pairs = spark.range(900).select((F.col("id") % 32).alias("lid"), F.when(F.col("id") % 41 != 0, F.col("id") % 24).alias("rid"), F.col("id").alias("value"))
    got = K.pair_scores(pairs, left, right, K.COSINE, chunk=4).select("value", F.coalesce("score", F.lit(0.0)).alias("s"))
    want = pairs.join(left, "lid", "left").join(right, "rid", "left").select("value", VX.cosine("lvec", "rvec").alias("s"))
    have, need = ({r.value: r.s for r in x.collect()} for x in (got, want))
    assert have.keys() == need.keys() and max(abs(have[v] - need[v]) for v in have) < 1e-9


def test_users_of_one_selection_share_its_search(spark, monkeypatch):
    """Before: a query for each user without a personal vector."""
    from recoloom.operators import knn as K
    from recoloom.plans import serving
    from recoloom.sources import views as V
    asked, real = [], K.knn
    monkeypatch.setattr(K, "knn", lambda queries, *a, **b: asked.append(queries.count()) or real(queries, *a, **b))
    rows = serving.candidates(spark, SF_SMALL)
    selections = V.users(spark, SF_SMALL).select("onboarding_category_ids").distinct().count()
    users = V.users(spark, SF_SMALL).count()
    assert sum(asked) <= serving.user_vectors(spark, SF_SMALL).count() + selections
    assert rows.select("user_id").distinct().count() == users and rows.groupBy("user_id", "cand_rank").count().where("count > 1").count() == 0


def test_a_crowded_category_is_dealt_over_tasks(spark, monkeypatch):
    """Before: all users of a category met in one task."""
    from recoloom.operators import rerank as R
    users = spark.range(200).select(F.col("id").alias("user_id"), F.array(F.lit("a"), F.lit("b")).alias("onboarding_category_ids"))
    posts = spark.range(40).select(F.col("id").alias("post_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("category_id"),
                                   F.timestamp_seconds(F.col("id")).alias("creation_timestamp"))
    inter = spark.createDataFrame([(1, 3, "like"), (2, 3, "like"), (3, 7, "like")], "user_id long, post_id long, interaction_type string")
    monkeypatch.setattr(R, "USERS_A_TASK", 16, raising=False)
    got = R.popular_in_categories(users, posts, inter, 4)
    assert "__s" in plan(got)
    want = [(u, i + 1, p) for u in range(200) for i, p in enumerate([3, 7, 39, 38])]
    assert sorted((r.user_id, r.rank, r.post_id) for r in got.collect()) == want


def test_a_tile_holds_no_more_for_more_items():
    """The most that a tile of ``knn`` keeps is set by its queries and k, not by what streams past."""
    from recoloom.operators import knn as K
    rng = np.random.default_rng(3)
    lists = lambda X: pa.ListArray.from_arrays(np.arange(0, X.size + 1, X.shape[1], dtype=np.int32), X.ravel())
    most = {}
    for n in (2_000, 40_000):
        tile = K._Nearest(pa.table({"q": np.arange(60), "v": lists(rng.normal(size=(60, 8)))}), 10, "ip", 16, None, pa.int64(), ["qid", "item_id", "score"])
        most[n] = 0
        for a in range(0, n, 500):
            tile.add(pa.RecordBatch.from_arrays([pa.array(np.arange(a, a + 500)), lists(rng.normal(size=(500, 8)))], names=["i", "v"]))
            most[n] = max(most[n], sum(len(lot[0]) for best in tile.best for lot in best.lots))
        assert sum(b.num_rows for b in tile.rows()) == 600
    assert max(most.values()) <= 3 * 600
