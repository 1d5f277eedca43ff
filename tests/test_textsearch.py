"""Text search by posting lists against scoring every pair."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recoloom.operators import textsearch as TS
from recoloom.operators import textvec as TV
from recoloom.sources.io import scratch_path


def plain(queries, docs, k, decimals=9):
    """{query: [(doc, score), ...]} over every pair that shares a bucket."""
    out = {}
    for q, own in queries.items():
        scored = []
        for d, has in docs.items():
            both = own.keys() & has.keys()
            if both:
                scored.append((d, round(sum(own[b] * has[b] for b in both), decimals)))
        out[q] = sorted(scored, key=lambda x: (-x[1], x[0]))[:k]
    return out


def frame(spark, rows, key):
    return spark.createDataFrame([(i, b, float(v)) for i, r in rows.items() for b, v in r.items()], f"{key} long, bucket long, value double")


def run(spark, queries, docs, k, shard_docs, **more):
    path = scratch_path(spark, "index")
    TS.build_index(frame(spark, docs, "doc_id"), "doc_id", len(docs), path, shard_docs)
    got = TS.search(frame(spark, queries, "qid"), TS.read_index(spark, path), k, **more).collect()
    out = {q: [] for q in queries}
    for r in sorted(got, key=lambda r: r["rank"]):
        out[r["qid"]].append((r["doc_id"], r["score"]))
    return out


def rows(seed, n, dim, most, signed=False):
    rng = np.random.default_rng(seed)
    out = {}
    for i in range(n):
        at = rng.choice(dim, rng.integers(0, most), replace=False)
        v = rng.integers(1, 5, len(at)) / 4 * (rng.choice([-1, 1], len(at)) if signed else 1)
        out[i] = {int(b): float(x) for b, x in zip(at, v)}
    return out


@pytest.mark.parametrize("signed", [False, True])
@pytest.mark.parametrize("shard_docs,query_chunk", [(1000, 1000), (40, 7)])
def test_equals_scoring_every_pair(spark, signed, shard_docs, query_chunk):
    docs, queries = rows(1, 300, 60, 12, signed), rows(2, 40, 70, 6, signed)     # many ties, texts without rows
    assert run(spark, queries, docs, 5, shard_docs, query_chunk=query_chunk) == plain(queries, docs, 5)


def test_nothing_to_find(spark):
    docs, queries = {1: {5: 1.0}}, {1: {6: 1.0}, 2: {5: 0.5}}
    assert run(spark, queries, docs, 3, 10) == {1: [], 2: [(1, 0.5)]}
    assert run(spark, queries, {}, 3, 10) == {1: [], 2: []}
    assert run(spark, {}, docs, 3, 10) == {}


def test_null_keys_match_nothing(spark):
    docs = spark.createDataFrame([(None, 1, 1.0), (3, 1, 0.5)], "doc_id long, bucket long, value double")
    queries = spark.createDataFrame([(None, 1, 1.0), (8, 1, 1.0)], "qid long, bucket long, value double")
    path = scratch_path(spark, "index")
    TS.build_index(docs, "doc_id", 2, path)
    assert [tuple(r) for r in TS.search(queries, TS.read_index(spark, path), 4).collect()] == [(8, 3, 0.5, 1)]


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", 1, 1.0), ("a", 1, 1.0), ("c", 2, 1.0)], "doc_id string, bucket long, value double")
    queries = spark.createDataFrame([("x", 1, 1.0)], "qid string, bucket long, value double")
    path = scratch_path(spark, "index")
    TS.build_index(docs, "doc_id", 3, path)
    assert [(r["doc_id"], r["rank"]) for r in TS.search(queries, TS.read_index(spark, path), 4).collect()] == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_texts_in_one_row_give_the_same_index(spark, kind):
    """Rows (key, buckets, values) and rows (key, bucket, value): the same lists, strongest
    first and ties by key; repeated keys, null keys, zero and missing values."""
    docs = [(1, [3, 5], [1.0, -0.5]), (2, [3], [1.0]), (2, [3, 7], [0.25, 2.0]), (None, [3], [9.0]), (4, [], []), (5, [3, 5], [0.0, None]), (10, [3], [1.0])]
    whole = spark.createDataFrame(docs, "id long, buckets array<int>, values array<double>").withColumn("id", F.col("id").cast(kind))
    lists = []
    for v in (whole, TV.entries(whole, "id")):
        path = scratch_path(spark, "index")
        TS.build_index(v, "id", len(docs), path)
        lists.append(sorted((r["bucket"], [int(i) for i in r["docs"]], r["values"]) for r in TS.read_index(spark, path).collect()))
    ties = [1, 2, 10, 2] if kind == "long" else [1, 10, 2, 2]
    assert lists[0] == lists[1] == [(3, ties, [1.0, 1.0, 1.0, 0.25]), (5, [1], [-0.5]), (7, [2], [2.0])]


def test_few_queries_open_few_shards_twice(spark, monkeypatch):
    """The first answers come from one shard for each ``HOME_QUERIES`` queries, whatever the index."""
    read, visit = [], TS._visit
    monkeypatch.setattr(TS, "_visit", lambda q, index, *a: read.append(index.select("shard").distinct().count()) or visit(q, index, *a))
    docs, queries = rows(4, 400, 60, 12), rows(5, 30, 60, 6)
    assert run(spark, queries, docs, 5, 20) == plain(queries, docs, 5)
    assert read == [1, 20]


def test_a_word_is_hashed_once_a_batch(monkeypatch):
    """As the digest of each word of each text says, with fewer hashes than words, also
    when no more words can be remembered."""
    hashed, bucket = [], TV._bucket
    monkeypatch.setattr(TV, "_bucket", lambda w, dim: hashed.append(w) or bucket(w, dim))
    monkeypatch.setattr(TV, "KNOWN_WORDS", 2)
    monkeypatch.setattr(TV, "_BUCKETS", {})
    texts = ["The cat, the É9_a cat", None, "", "-- ", "K\u212a \u0130x the\x00dog", *["the bird sat"] * 50]
    ends, buckets, counts = TV.bucket_counts(texts, 13)
    for i, t in enumerate(texts):
        want = Counter(int(hashlib.md5(f"{w}|text".encode()).hexdigest()[:15], 16) % 13 for w in re.findall("[a-z0-9_]+", (t or "").lower()))
        assert list(zip(buckets[ends[i]:ends[i + 1]].tolist(), counts[ends[i]:ends[i + 1]].tolist())) == sorted(want.items())
    assert len(hashed) == len(set(hashed))


def shard_of(docs):
    lists = {}
    for d, r in docs.items():
        for b, v in r.items():
            lists.setdefault(b, []).append((-v, d))
    order = sorted(lists)
    return TS.Shard(np.array(order), [np.array([d for _, d in sorted(lists[b])]) for b in order],
                    [np.array([-v for v, _ in sorted(lists[b])]) for b in order])


def test_weak_lists_stay_unread():
    """A rare strong bucket decides; the list that all documents are on adds too little to be read."""
    docs = {i: {0: 0.01, **({1: 1.0} if i < 30 else {})} for i in range(5000)}
    shard = shard_of(docs)
    ids, scores, read = shard.search(np.array([0, 1]), np.array([1.0, 1.0]), 10, float("-inf"), 9)
    assert ids.tolist() == list(range(10)) and set(scores.tolist()) == {1.01}
    assert read == 30
    ids, _, read = shard.search(np.array([0]), np.array([1.0]), 10, 0.5, 9)      # out of reach by its bounds alone
    assert len(ids) == 0 and read == 0


def test_a_heavy_bucket_is_many_lists(spark):
    """A bucket of every text never meets in one group."""
    docs = {i: {0: 1.0, i % 7 + 1: 0.5} for i in range(400)}
    path = scratch_path(spark, "index")
    TS.build_index(frame(spark, docs, "doc_id"), "doc_id", len(docs), path, 20)
    size = TS.read_index(spark, path).where("bucket = 0").select(F.size("docs").alias("n")).toPandas()["n"]
    assert size.sum() == 400 and len(size) == 20 and size.max() < 60


def test_encoders_can_be_exchanged(spark):
    """One search, three encoders: hashed words, letter triples, a model made up here."""
    texts = spark.createDataFrame([(1, "the cat sat"), (2, "a dog ran far"), (3, None), (4, ""), (5, "cats sit")], "id long, text string")

    def vowels():
        return lambda batch: [(np.arange(5), np.array([t.count(c) for c in "aeiou"], float)) for t in batch]

    for encode, best in ((TV.text_vectors, None), (TS.worker_encoder("triples", lambda: TS.letter_triples(97)), 1),
                         (TS.worker_encoder("vowels", vowels), 2)):
        vec = encode(texts, "id", "text")
        assert vec.columns == ["id", "bucket", "value"] and set(r["id"] for r in vec.collect()) <= {1, 2, 5}
        path = scratch_path(spark, "index")
        TS.build_index(vec, "id", 5, path)
        got = TS.search(vec.where("id = 1"), TS.read_index(spark, path), 2, key="id").collect()
        assert best is None or got[0]["doc_id"] == best


def test_a_model_is_loaded_once_a_worker():
    calls = []
    load = lambda: calls.append(1) or (lambda batch: [])
    assert TS.loaded("counted", load) is TS.loaded("counted", load) and len(calls) == 1
