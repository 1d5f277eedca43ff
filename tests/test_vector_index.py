"""The stored vector index against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_ORACLE

from recoloom.operators import knn as K
from recoloom.operators import vector_index as VI
from recoloom.plans import QUERIES
from recoloom.sources import io as IO


def clustered(n, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(25, dim)) * 3
    return base[rng.integers(25, size=n)] + rng.normal(size=(n, dim)) * 0.4


def frames(spark, X, Q):
    return (spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(X)], "id long, vec array<float>"),
            spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(Q)], "qid long, qvec array<double>"))


def brute(X, Q, k):
    X = X.astype(np.float32).astype(float)
    D = ((Q[:, None, :] - X[None]) ** 2).sum(2)
    return [list(np.lexsort((np.arange(len(X)), d))[:k]) for d in D]


def ranked(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.qid, {})[r["rank"]] = r.item_id
    return [[out[q][i] for i in sorted(out[q])] for q in sorted(out)]


def test_codes_decode_near_and_errors_hold():
    X = clustered(3000)
    q = VI.Quantizer(C := VI.kmeans(X, 20), [VI.kmeans((X - C[VI.nearest(X, C)])[:, a:a + 3], 256) for a in range(0, 24, 3)])
    cell, codes, error = q.encode(X)
    assert codes.dtype == np.uint8 and codes.shape == (3000, 8)
    assert np.allclose(np.sqrt(((X - q.decode(cell, codes)) ** 2).sum(1)), error)
    assert error.mean() < 0.3 * np.sqrt((X * X).sum(1)).mean()
    for j, (c, b) in enumerate(zip(q.cuts(), q.books)):         # each code is the nearest entry
        rest = (X - C[cell])[:50, c]
        assert (((rest[:, None] - b[None]) ** 2).sum(2).argmin(1) == codes[:50, j]).all()


def test_searches_and_replays(spark):
    X, Q = clustered(4000), clustered(60, seed=9)
    items, queries = frames(spark, X[:3000], Q)
    path = IO.scratch_path(spark, "index")
    VI.build(items.union(spark.createDataFrame([(9999, None)], items.schema)), path, cells=40, subspaces=8)
    assert ranked(VI.search_exact(queries, path, 10)) == brute(X[:3000], Q, 10)
    found = ranked(VI.search(queries, path, 10, probes=8, shortlist=40))
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, brute(X[:3000], Q, 10))]) >= 0.95
    assert VI.shortlisted(queries, path, 8, 40).count() == 60 * 40                   # of 60 x 3000 pairs
    q, more = VI.load_model(spark, path), frames(spark, X, Q)[0].where("id >= 3000")
    for _ in range(2):                                                              # a batch twice: no row twice
        VI.add(more, path, q, "stream", 0)
        assert ranked(VI.search_exact(queries, path, 10)) == brute(X, Q, 10)
    plan = VI.rows_of(spark, path).where("cell in (3, 4)").select("id", "codes")._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan and "vec" not in plan.split("ReadSchema")[1]
    none = VI.search(queries.limit(0), path, 10, 8, 40)
    assert none.count() == 0
    with pytest.raises(Exception, match="dimensions"):
        VI.add(spark.createDataFrame([(1, [1.0, 2.0])], "id long, vec array<double>"), path, q, "bad", 0)


def test_tiny_and_equal_vectors(spark):
    items = spark.createDataFrame([(i, [1.0, 0.0, 0.0]) for i in range(30)] + [(40, [0.0, 1.0, 0.0])], "id long, vec array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, None)], "qid long, qvec array<double>")
    path = IO.scratch_path(spark, "index-tiny")
    VI.build(items, path)
    assert ranked(VI.search_exact(queries, path, 5)) == [[0, 1, 2, 3, 4]]
    assert ranked(VI.search(queries, path, 5, 99, 99)) == [[0, 1, 2, 3, 4]]


def test_recall_of_the_registered_search(spark):
    exact = QUERIES["knn_exact"](spark, SF_ORACLE).select("user_id", "post_id")
    approx = QUERIES["knn_ivf"](spark, SF_ORACLE).select("user_id", "post_id")
    recall = exact.join(approx, ["user_id", "post_id"]).count() / exact.count()
    assert recall >= 0.95 and approx.count() == approx.distinct().count()


@pytest.mark.parametrize("few", [0, 512])
def test_many_queries_meet_codes_and_vectors_in_one_pass(spark, monkeypatch, few):
    """Before: two passes over all pairs, of which the first, by codes, found nearly every item needed."""
    X, Q = clustered(2000), clustered(90, seed=5)
    items, queries = frames(spark, X, Q)
    path = IO.scratch_path(spark, f"index-many-{few}")
    VI.build(items.union(spark.createDataFrame([(None, [0.0] * 24)], items.schema)), path, cells=20, subspaces=6)
    passes, real = [], VI.K.over_tiles
    monkeypatch.setattr(VI.K, "over_tiles", lambda *a, **b: passes.append(1) or real(*a, **b))
    monkeypatch.setattr(VI, "FEW", few)
    monkeypatch.setattr(VI, "QUERY_BLOCK", 40)
    assert ranked(VI.search_exact(queries, path, 10)) == brute(X, Q, 10)
    assert len(passes) == (1 if few == 0 else 2)


def test_the_recall_makes_its_shortlist_once(spark, monkeypatch):
    """Before: one to be counted, and another to be re-ranked."""
    from recoloom.plans import serving
    lists, real, users, made = [], VI.shortlisted, [], serving._vectors_of_users
    monkeypatch.setattr(VI, "shortlisted", lambda *a: lists.append(1) or real(*a))
    monkeypatch.setattr(serving, "_vectors_of_users", lambda *a: users.append(made(*a)) or users[-1])
    got = QUERIES["knn_ivf_recall"](spark, SF_ORACLE).first()
    assert tuple(got) == (True, True) and len(lists) == len(users) == 1


def batch(ids, X):
    return pa.record_batch({"i": pa.array(ids), "v": pa.ListArray.from_arrays(pa.array(np.arange(0, X.size + 1, X.shape[1], dtype=np.int32)), pa.array(X.ravel()))})


@pytest.mark.parametrize("shift,scale", [(0, 1), (1e6, 1), (0, 1e-25), (0, 1e20), (3, 1e-3)])
def test_single_precision_misses_no_neighbour(shift, scale):
    """Scores come from the components whatever the size of the vectors; ties go to the smaller id."""
    rng = np.random.default_rng(8)
    X, Q = (rng.normal(size=(n, 6)) * scale + shift for n in (3000, 40))
    X[1500:] = X[:1500]
    ids = rng.permutation(3000)
    tile = K._Nearest(pa.Table.from_batches([batch(np.arange(40), Q)]), 7, "l2", 16, None, pa.int64(), ["qid", "item_id", "score"])
    for a in range(0, 3000, 1100):
        tile.add(batch(ids[a:a + 1100], X[a:a + 1100]))
    got = pa.Table.from_batches(tile.rows()).to_pandas().sort_values(["qid", "score", "item_id"])
    D = np.array([K._measure(K.SQUARED, np.repeat(q[None], 3000, 0), X) for q in Q])
    assert [list(g.item_id) for _, g in got.groupby("qid")] == [list(ids[np.lexsort((ids, d))[:7]]) for d in D]


def test_vectors_with_nulls_beside_others():
    """Queries and items that hold no number are met apart and spoil no other's search; such a query finds nothing."""
    rng = np.random.default_rng(2)
    X, Q = rng.normal(size=(2500, 5)), rng.normal(size=(30, 5))
    X[7, 2], X[2400, 0], Q[11, 3] = np.nan, np.inf, np.nan
    tile = K._Nearest(pa.Table.from_batches([batch(np.arange(30), Q)]), 4, "l2", 8, None, pa.int64(), ["qid", "item_id", "score"])
    tile.add(batch(np.arange(2500), X))
    got = pa.Table.from_batches(tile.rows()).to_pandas().sort_values(["qid", "score", "item_id"])
    D = np.nan_to_num(((Q[:, None] - X[None]) ** 2).sum(2), nan=np.inf)
    assert [list(g.item_id) for _, g in got.groupby("qid")] == [list(np.argsort(d, kind="stable")[:4]) for i, d in enumerate(D) if i != 11]


def test_a_shortlist_holds_the_nearest_codes_of_the_cells_asked():
    X, Q = clustered(3000), clustered(50, seed=4)
    q = VI.Quantizer(C := VI.kmeans(X, 30), [VI.kmeans((X - C[VI.nearest(X, C)])[:, a:a + 4], 16) for a in range(0, 24, 4)])
    cell, codes, error = q.encode(X)
    asked = np.random.default_rng(1).random((50, len(C))) < 0.7
    held = pa.table({"qid": np.arange(50), "qvec": batch(np.arange(50), Q).column("v"), "first": pa.array(np.zeros(50, np.int32)),
                     "bits": pa.array([b.tobytes() for b in np.packbits(asked, axis=1)])})
    tile = VI._Shortlist(held, q, 9)
    for a in range(0, 3000, 1300):
        own = slice(a, a + 1300)
        tile.add(pa.record_batch({"id": pa.array(np.arange(3000)[own]), "codes": pa.array([c.tobytes() for c in codes[own]]), "norm2": pa.array((X[own] ** 2).sum(1)),
                                  "error": pa.array(error[own]), "cell": pa.array(cell[own].astype(np.int32))}))
    got = pa.Table.from_batches(tile.rows()).to_pandas()
    D = (Q * Q).sum(1)[:, None] + (X * X).sum(1) - 2 * Q @ q.decode(cell, codes).T
    D[~asked[:, cell]] = np.inf
    for i, g in got.groupby("qid"):
        assert len(g) == 9 and np.allclose(np.sort(g.near), np.sort(D[i])[:9]) and (g.cell.to_numpy() == cell[g.id.to_numpy()]).all()
