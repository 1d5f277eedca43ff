"""Scores of the three classifiers against plain restatements, text by text."""

import math

import numpy as np
import pytest
from cases import TEXTS

from recoloom.llm import langid, mil_quality, toxicity
from recoloom.llm.common import labelled_sample
from recoloom.llm.subword import MIX, PRIME, WordScores

SF = "/root/testdata/sf0.01"
EXTRA = ["word " * 700, "a\n\n b \n" * 50, "One two THREE! 44 five-six. " * 30, "é" * 90 + " x " * 200]


def sample_texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()
    return [t or "" for t in TEXTS[:18]] + EXTRA + [r.text or "" for r in rows]


def grams(model, word):
    """Buckets of a word's n-grams over its marked bytes."""
    raw = b"<" + word.encode() + b">"
    low, high, bits = model.grams.low, model.grams.high, model.grams.bits
    parts = [raw[i:i + n] for n in range(low, high + 1) for i in range(len(raw) - n + 1)] or [raw]
    out, wrap = [], (1 << 64) - 1
    for p in parts:
        h = 0
        for b in p:
            h = (h * int(PRIME) + b + 1) & wrap
        out.append((((h + len(p)) * int(MIX)) & wrap) >> (64 - bits))
    return out


def trained(spark, module, label, folds=None):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = docs.select("doc_id", "lang") if label == "lang" else spark.read.parquet(f"{SF}/labels.parquet")
    return module.train(labelled_sample(docs, labels, label, 300))


def test_toxicity(spark):
    m = trained(spark, toxicity, "toxic")
    C = m.contributions[:, 0].astype(float)
    texts = sample_texts(spark)
    got = toxicity.bag_scores(m, WordScores(m.grams, m.contributions), texts)
    for text, value in zip(texts, got):
        words = [grams(m, w) for w in text.lower().split()]
        starts = range(0, max(1, len(words) - toxicity.STRIDE), toxicity.STRIDE)
        p = []
        for s in starts:
            bag = [g for w in words[s:s + toxicity.WINDOW] for g in w]
            p.append(1 / (1 + math.exp(-((C[bag].sum() / len(bag) if bag else 0.0) + m.bias))))
        k = toxicity.STRETCH
        runs = [p[i:i + k] for i in range(max(1, len(p) - k + 1))]
        share = max((sum(r) + toxicity.PRIOR_WINDOWS * toxicity.PRIOR_SHARE) / (len(r) + toxicity.PRIOR_WINDOWS) for r in runs)
        assert math.isclose(value, math.log(share / (1 - share)), abs_tol=2e-3)


def test_language(spark):
    m = trained(spark, langid, "lang")
    texts = [t for t in sample_texts(spark) if len(t) < langid_piece()]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in langid.predict(rows, m).collect():
        bag = [g for w in langid.words(texts[r.doc_id]) for g in grams(m, w)]
        if not bag:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        z = (m.contributions[bag].astype(float).sum(0) / len(bag) + m.bias) / m.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert math.isclose(r.score, p.max(), abs_tol=1e-4) and math.isclose(p[m.langs.index(r.lang_pred)], p.max(), abs_tol=1e-4)


def langid_piece():
    from recoloom.llm.wordsplit import PIECE_CHARS
    return PIECE_CHARS


def passage_features(text):
    """Features of each passage of PASSAGE_WORDS words, byte by byte."""
    cls = mil_quality.byte_classes()
    data = text + b"\n"
    words, at = [], 0
    while at < len(data):
        if cls[data[at]] > 1:
            end = at
            while cls[data[end]] > 1:
                end += 1
            words.append((at, end))
            at = end
        else:
            at += 1
    out = []
    for k in range(0, len(words), mil_quality.PASSAGE_WORDS):
        own = words[k:k + mil_quality.PASSAGE_WORDS]
        stop = words[k + mil_quality.PASSAGE_WORDS][0] if k + mil_quality.PASSAGE_WORDS < len(words) else len(data)
        hist = np.zeros((mil_quality.CLASSES, mil_quality.CLASSES))
        for i in range(own[0][0], stop):
            hist[cls[data[i]], cls[data[i + 1]] if i + 1 < len(data) else cls[data[i]]] += 1
        spelt, size = [data[a:b] for a, b in own], np.array([b - a for a, b in own], float)
        n = len(own)
        shapes = [math.log1p(n) / 4, n < 20, size.mean() / 10, math.sqrt(max((size ** 2).mean() - size.mean() ** 2, 0)) / 10,
                  (n - len(set(spelt))) / n, sum(x == y for x, y in zip(spelt, spelt[1:])) / n, (size <= 1).mean(), (size > 20).mean(),
                  np.mean([cls[data[a]] == 3 for a, _ in own]), 1.0]
        out.append(np.r_[np.sqrt(hist.ravel() / (stop - own[0][0])), shapes])
    return np.array(out) if out else np.zeros((1, mil_quality.FEATURES))


def test_quality(spark):
    m = trained(spark, mil_quality, "quality")
    P = {k: v.astype(float) for k, v in m.P.items()}
    texts = [t.encode() for t in sample_texts(spark) if len(t) < 100_000]
    got = mil_quality.score_texts(m, texts)
    for text, value in zip(texts, got):
        H, e = [], []
        for x in passage_features(text):
            h = np.tanh(((x - m.mean) / m.scale) @ P["A"] + P["a"])
            H.append(h)
            e.append((np.tanh(h @ P["V"]) / (1 + np.exp(-(h @ P["U"])))) @ P["w"])
        a = np.exp(np.array(e) - max(e))
        z = (np.array(H) * (a / a.sum())[:, None]).sum(0)
        want = 1 / (1 + math.exp(-(m.slope * (z @ P["c"] + P["b"][0]) + m.offset)))
        assert math.isclose(value, want, abs_tol=2e-3), (text[:80], value, want)
