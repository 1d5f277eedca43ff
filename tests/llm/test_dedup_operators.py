"""SimHash and vector near-duplicates against all pairs."""

import numpy as np
import pytest
from cases import TEXTS, components, documents, fingerprint

from recoloom.llm import components as cc
from recoloom.llm import neardup_vectors, simhash
from recoloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_groups(ids, fps):
    linked = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4]
    root = components(len(fps), linked)
    least = {}
    for i, r in enumerate(root):
        if ids[i] is not None:
            least[r] = min(least.get(r, ids[i]), ids[i])
    return [least.get(r) for r in root]


def test_fingerprints_equal_the_definition():
    for t in TEXTS[:18]:
        assert simhash.fingerprint(t or "") == fingerprint(t)


def test_op5_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fps = [fingerprint(r.text) for r in docs]
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(docs, fps, brute_groups([r.doc_id for r in docs], fps))}
    assert {tuple(r) for r in QUERIES["op5_simhash"](spark, SF).collect()} == want


def test_simhash_hostile_rows(spark):
    docs = documents(spark)
    rows = docs.collect()
    fps = [simhash.fingerprint(r.text or "") for r in rows]
    want = sorted(((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_groups([r.doc_id for r in rows], fps))), key=str)
    assert sorted((tuple(r) for r in simhash.groups(docs).collect()), key=str) == want
    assert simhash.groups(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({w[2] for w in want}, key=str)
    assert simhash.keep_one(docs.limit(0)).count() == 0
    renamed = docs.withColumnsRenamed({"fp": "FP", "row": "Row", "ids": "fp_"})
    kept = simhash.keep_one(renamed)
    assert kept.columns == renamed.columns and kept.count() == len({w[2] for w in want})


@pytest.mark.parametrize("crowd,tile", [(8, 4096), (2, 3), (10_000, 4096)])
def test_links_connect_what_all_pairs_connect(spark, crowd, tile):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(x) for x in base}
    for x in base:
        for _ in range(25):
            y = int(x)
            for b in rng.choice(64, rng.integers(1, 7), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, crowd, tile).collect()
    at = {f: i for i, f in enumerate(signed)}
    pairs = [(at[r.u], at[r.v]) for r in got]
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 4 for a, b in pairs)
    want = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4]
    assert components(len(fps), pairs) == components(len(fps), want)


def test_segments_lose_no_pair():
    for bits in range(0, 9):
        parts = simhash.segments(bits)
        assert sum(w for _, w, _ in parts) == 64 and sum(r + 1 for *_, r in parts) == bits + 1


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    got = {r.id: r.component for r in cc.components(spark.createDataFrame(edges + [(None, 3)], "u long, v long")).collect()}
    root = components(1100, edges)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: root[x] for x in touched}
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_vectors(ids, vectors, cosine=0.9):
    fine = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links, pairs = [0] * len(ids), []
    for a in range(len(ids)):
        for b in range(a):
            if fine[a] and fine[b] and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a], float), np.array(vectors[b], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    pairs.append((a, b))
    root = components(len(ids), pairs)
    return sorted((ids[i], links[i], ids[root[i]], ids[i] == ids[root[i]]) for i in range(len(ids)))


def hostile_vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = [[float(x) for x in base[rng.integers(12)] + rng.normal(0, 0.3, 16) * rng.random()] for _ in range(150)]
    rows += rows[:20] + [[2 * x for x in v] for v in rows[:10]]
    return rows + [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, None], [], [1.0], [2.0], [-1.0],
                   [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]]


def test_vectors_of_any_scale(spark):
    """Squares of the components would overflow, or vanish."""
    base = [[1.0, 2.0, 3.0, -1.0], [1.0, 2.0, 3.1, -1.0], [3.0, -2.0, 0.0, 1.0]]
    rows = [[x * s for x in v] for s in (1e200, 1e-200, 1e300, 1e-300, 1.0) for v in base]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in neardup_vectors.near_duplicates(df).collect())
    assert got == [(i, 4 if i % 3 == 2 else 9, 2 if i % 3 == 2 else 0, i in (0, 2)) for i in range(15)]


@pytest.mark.parametrize("tile_bytes", [8 << 20, 2048])
def test_vectors_equal_all_pairs(spark, monkeypatch, tile_bytes):
    monkeypatch.setattr(neardup_vectors, "TILE_BYTES", tile_bytes)
    rows = hostile_vectors()
    df = spark.createDataFrame([(i, v, i, "x") for i, v in enumerate(rows)], "vec_id long, embedding array<double>, node long, links string")
    got = sorted(tuple(r) for r in neardup_vectors.near_duplicates(df).collect())
    assert got == brute_vectors(list(range(len(rows))), rows)


def test_vectors_null_and_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.01]), (None, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in neardup_vectors.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, False)], key=str)
    assert neardup_vectors.near_duplicates(df.limit(0)).count() == 0


def test_op4_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = sorted(tuple(r) for r in QUERIES["op4_vectors"](spark, SF).collect())
    X = np.array([r.embedding for r in rows], float)
    X /= np.linalg.norm(X, axis=1)[:, None]
    S = X @ X.T >= 0.9
    root = components(len(rows), [(a, b) for a, b in np.argwhere(S) if a != b])
    ids = [r.vec_id for r in rows]
    assert got == sorted((ids[i], int(S[i].sum()) - 1, ids[root[i]], ids[i] == ids[root[i]]) for i in range(len(ids)))
