"""Classifiers: held-out quality, and defined results on hostile tables."""

import numpy as np
import pytest
from cases import TEXTS, documents, fold

from recoloom.llm import langid, mil_quality, toxicity
from recoloom.llm.common import labelled_sample
from recoloom.llm.queries import QUERIES
from recoloom.llm.subword import Grams, WordScores, fit_platt

SF, SF_LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def held_out(spark, name, sf, label, folds, rest):
    rows = QUERIES[name](spark, sf)
    assert rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    got = rows.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label), "doc_id").collect()
    for r in got:
        assert r.held_out == (fold(r.doc_id, folds) == rest) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    return np.array([r[label] for r in held]), np.array([r.score for r in held]), np.array([r.predicted for r in held])


def test_quality_held_out(spark):
    y, p, k = held_out(spark, "op1_quality", SF_LARGE, "quality", 5, 0)
    assert auc(y, p) > 0.99 and (k == y).mean() > 0.98 and (k == (p >= 0.3)).all()


def test_toxicity_held_out(spark):
    y, p, k = held_out(spark, "op3_toxicity", SF_LARGE, "toxic", 3, 1)
    assert auc(y, p) > 0.94 and (k == y).mean() > 0.94 and (k == (p >= 0.7)).all()


def test_language_held_out(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_langid"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.98


def labels(spark, values):
    return spark.createDataFrame(values, "doc_id long, quality int, toxic int, text string, score double")


@pytest.mark.parametrize("values", [[], [(3, 1, 1, "t", 0.5)], [(i, None, None, None, None) for i in range(5)],
                                    [(i, i % 2, i % 2, None, None) for i in range(20)] + [(3, 0, 0, None, None), (None, 1, 1, None, None), (999, 1, 1, None, None)]])
def test_hostile_rows(spark, values):
    docs = documents(spark)
    for fn in (mil_quality.classify, toxicity.classify):
        rows = fn(docs, labels(spark, values)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert all(r.held_out is False for r in rows if r.doc_id is None)
        same = {r.score for r in rows if r.doc_id in (0, 1, 2)}               # empty, null, blanks only
        assert len(same) == 1
        assert fn(docs.limit(0), labels(spark, values)).count() == 0


def test_language_hostile_rows(spark):
    docs = documents(spark)
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count()
    unknown = {0, 1, 2, 15 if not any(c.isalpha() for c in TEXTS[15]) else 0, 17}
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in unknown), r
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.rejected)
    nothing = langid.identify(docs.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(0)
    good = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(n))
    bad = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 3)).upper() + "!!" for _ in range(n))     # noqa: E731
    sample = []
    for i in range(300):
        sample.append((good(300), 1) if i % 2 else (good(128) + " " + bad(64) + " " + good(108), 0))
    model = mil_quality.train(sample, epochs=15)
    score = lambda t: mil_quality.score_texts(model, [t.encode()])[0]
    assert score(good(1000)) > 0.7 and score(good(640) + " " + bad(64) + " " + good(296)) < 0.5
    X, owner = mil_quality.encode([(good(64) + " " + bad(64)).encode()])
    assert len(X) == 2 and list(owner) == [0, 0]
    assert model.passages(X)[1][1] > model.passages(X)[1][0]                  # it attends to the bad one


def test_long_texts_are_scored_like_their_parts(monkeypatch):
    rng = np.random.default_rng(1)
    text = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(20 * 64)).encode()
    model = mil_quality.train([("ab cd ef " * 20, 1), ("AB!! CD!! " * 20, 0)] * 10, epochs=3)
    whole = mil_quality.score_texts(model, [text])[0]
    monkeypatch.setattr(mil_quality, "TEXT_BYTES", 64 * 7)                    # each stretch is one passage
    assert abs(mil_quality.score_texts(model, [text])[0] - whole) < 0.02


def test_word_scores_do_not_depend_on_the_table(spark):
    rng = np.random.default_rng(3)
    grams = Grams(10, 2, 4)
    C = rng.normal(size=(1 << 10, 2)).astype(np.float32)
    lists = [["a", "bc", "x" * 100, "é"], [], ["bc", "longer", "x" * 100]]
    free, tight = WordScores(grams, C), WordScores(grams, C, limit=2, longest=3)
    for _ in range(3):
        a, b = free(lists), tight(lists)
        assert np.allclose(a[0], b[0]) and (a[1] == b[1]).all()
    flat, offsets = grams(["bc"])
    assert np.allclose(free([["bc"]])[0][0], C[flat].sum(0)) and offsets[1] == 6      # <b bc c> <bc bc> <bc>


def test_a_toxic_passage_in_a_long_clean_text(spark):
    """A passage counts alike in texts of any length."""
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    from recoloom.llm.common import crc_fold
    model = toxicity.train(labelled_sample(docs, labels.where(crc_fold("doc_id", 3) != 1), "toxic", 6000))
    table = WordScores(model.grams, model.contributions)
    p = lambda texts: 1 / (1 + np.exp(-(model.slope * toxicity.bag_scores(model, table, texts) + model.offset)))
    held = docs.join(labels.where(crc_fold("doc_id", 3) == 1), "doc_id").where(F.length("text") > 600).orderBy("doc_id")
    toxic = [r.text for r in held.where("toxic = 1").collect()]
    toxic = [t for t, s in zip(toxic, p(toxic)) if s > 0.9][:10]
    clean = [r.text for r in held.where("toxic = 0").collect()]
    clean = " ".join(t for t, s in zip(clean, p(clean)) if s < 0.3).split()
    for n in (1000, 4000, 16_000, 40_000):
        around = [" ".join(clean[:n // 2]) + "\n" + t + "\n" + " ".join(clean[n // 2:n]) for t in toxic]
        assert (p(around) >= 0.7).mean() >= 0.9
        assert p([" ".join(clean[:n])])[0] < 0.7


def test_misspellings_share_vectors():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghijk"), 6))
    clean = [word() for _ in range(400)]
    text = lambda slur: " ".join([*rng.choice(clean, 60), *slur])
    sample = [(text(["wretch", "wretch"] if i % 2 else []), i % 2) for i in range(400)]
    model = toxicity.train(sample)
    table = WordScores(model.grams, model.contributions)
    s = lambda t: toxicity.bag_scores(model, table, [t])[0]
    plain, unseen = np.mean([s(text([])) for _ in range(20)]), np.mean([s(text(["wrettch", "wr3tch"])) for _ in range(20)])
    assert s(text(["wretch", "wretch"])) > unseen > plain + 0.5


def test_sample_is_bounded_and_steady(spark):
    docs = documents(spark)
    lab = labels(spark, [(i, i % 2, 0, None, None) for i in range(20)])
    a, b = labelled_sample(docs, lab, "quality", 7), labelled_sample(docs.repartition(5), lab, "quality", 7)
    assert a == b and len(a) == 7
    assert len(labelled_sample(docs, lab, "quality", 20, max_bytes=1)) == 1


def test_platt_without_two_classes():
    assert fit_platt(np.array([1.0, 2.0]), np.array([1, 1])) == (1.0, 0.0)
