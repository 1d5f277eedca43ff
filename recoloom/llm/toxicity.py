"""Toxicity: averaged subword embeddings under a linear softmax.

A text is scored in overlapping windows of words, each by the average of its
subword embeddings.  The text's score is the share of windows that the softmax finds
toxic in its densest stretch of ``STRETCH`` windows: a toxic passage counts alike in
a text of any length, and one chance hit does not condemn a text.  The model is trained jointly (embeddings and
softmax) in numpy: windows of clean texts are clean; of a toxic text the windows
that the model finds worst are taken as toxic, starting from all its windows.  The
worst words of toxic windows are also shown misspelt, so that unseen spellings
share their n-gram vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, labelled_sample, map_batches
from .subword import Grams, SubwordSoftmax, WordScores, fit_platt, gather_ragged, sigmoid
from .wordsplit import pieces

WINDOW, STRIDE = 16, 8
SAMPLE_ROWS = 6000                      # labelled texts that the classifier is fitted on
STRETCH = 32                            # windows (about 260 words) over which the share is taken
WORST_SHARE, WORST_MOST = 0.25, 12      # windows of a toxic text that are taken as toxic
PRIOR_WINDOWS, PRIOR_SHARE = 2.0, 0.02  # smooths the share of toxic windows of short texts
BITS, DIM, LOW, HIGH = 17, 16, 3, 7      # n-grams are over UTF-8 bytes


@dataclass
class Model:
    contributions: np.ndarray           # (buckets, 1): toxic minus clean
    bias: float
    slope: float
    offset: float
    grams: Grams


def words(text: str) -> list[str]:
    return text.lower().split()


def window_bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in the concatenated words) and owner of the windows of
    texts with ``sizes`` words; a text without words has one empty window."""
    n = np.maximum(1, -(-(sizes - STRIDE) // STRIDE))
    owner = np.repeat(np.arange(len(sizes)), n)
    base = np.cumsum(sizes) - sizes
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    start = base[owner] + k * STRIDE
    return start, np.minimum(start + WINDOW, (base + sizes)[owner]), owner


def window_scores(sums: np.ndarray, counts: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    s, c = np.r_[0.0, np.cumsum(sums, dtype=np.float64)], np.r_[0.0, np.cumsum(counts, dtype=np.float64)]
    return (s[end] - s[start]) / np.maximum(c[end] - c[start], 1.0)


def share_scores(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Log odds of the smoothed share of toxic windows in the densest stretch of
    STRETCH windows (all windows, if fewer) of each of ``n`` owners; owners ascend."""
    at = np.arange(len(p))
    stop = np.searchsorted(owner, owner, side="right")
    end = np.minimum(at + STRETCH, stop)
    whole = (end - at == STRETCH) | (at == np.searchsorted(owner, owner))
    total = np.r_[0.0, np.cumsum(p, dtype=np.float64)]
    share = (total[end] - total[at] + PRIOR_WINDOWS * PRIOR_SHARE) / (end - at + PRIOR_WINDOWS)
    best = np.zeros(n)
    np.maximum.at(best, owner[whole], share[whole])
    best = np.clip(best, 1e-6, 1 - 1e-6)
    return np.log(best) - np.log1p(-best)


def misspell(word: str, rng: np.random.Generator) -> str:
    i = int(rng.integers(len(word)))
    kind = int(rng.integers(4))
    letter = "abcdefghijklmnopqrstuvwxyz0134*@$"[int(rng.integers(33))]
    if kind == 0:
        return word[:i] + letter + word[i + 1:]
    if kind == 1:
        return word[:i] + word[i] + word[i:]
    if kind == 2 and len(word) > 3:
        return word[:i] + word[i + 1:]
    return word[:i] + word[i:i + 2][::-1] + word[i + 2:]


def train(sample: list[tuple[str, int]], epochs: int = 8, seed: int = 11) -> Model:
    """Fit on (text, 0/1) pairs.  Without both classes every text scores the base rate."""
    grams = Grams(BITS, LOW, HIGH)
    number: dict[str, int] = {}
    doc, labels = [], []
    for text, v in sample:                                      # word numbers at once: no lists of words are held
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words(text)), np.int32)
        if len(ids):
            doc.append(ids)
            labels.append(int(v))
    y = np.array(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros((1 << BITS, 1), np.float32), 0.0, 0.0, float(np.log((base + 1e-3) / (1 - base + 1e-3))), grams)
    vocabulary = list(number)
    del number
    flat, offsets = grams.all(vocabulary)
    rng = np.random.default_rng(seed)
    held = rng.random(len(y)) < 0.25                            # calibration slice
    if y[held].sum() == 0 or y[~held].sum() == 0:
        held[:] = False
    tokens, sizes = np.concatenate(doc), np.array([len(d) for d in doc], np.int64)
    del doc
    start, end, owner = window_bounds(sizes)
    model = SubwordSoftmax(BITS, DIM, 2, seed, adaptive=True)
    first = np.searchsorted(owner, np.arange(len(y)))
    counts = np.diff(offsets).astype(np.float32)

    def scores() -> tuple[np.ndarray, np.ndarray]:
        C = model.contributions()
        C = C[:, 1] - C[:, 0]
        s = np.concatenate([np.add.reduceat(C[flat[offsets[k]:offsets[min(k + 8192, len(counts))]]],
                                            offsets[k:min(k + 8192, len(counts))] - offsets[k])
                            for k in range(0, len(counts), 8192)])
        return window_scores(s[tokens], counts[tokens], start, end), s / counts

    fit_pos, fit_neg = np.flatnonzero(~held & (y == 1)), np.flatnonzero(~held & (y == 0))
    is_pos, is_neg, windows = ~held & (y == 1), ~held & (y == 0), np.bincount(owner)
    pos_windows, neg_windows = np.flatnonzero(np.isin(owner, fit_pos)), np.flatnonzero(np.isin(owner, fit_neg))
    for epoch in range(epochs):
        value, per_word = scores()
        if epoch < 2:
            pos = rng.permutation(pos_windows)[:8 * len(fit_pos)]
            neg = rng.permutation(neg_windows)[:2 * len(pos)]
        else:
            order = np.lexsort((-value, owner))                 # each text's windows, worst first
            rank = np.arange(len(order)) - first[owner[order]]
            per_text = np.minimum(np.ceil(WORST_SHARE * windows), WORST_MOST)
            worst = order[rank < per_text[owner[order]]]
            pos = worst[is_pos[owner[worst]]]
            top = order[rank == 0]
            neg = np.r_[rng.permutation(top[is_neg[owner[top]]])[:len(pos) // 2], rng.permutation(neg_windows)[:4 * len(pos)]]
        pick = np.r_[pos, neg]
        label = np.r_[np.ones(len(pos), np.int64), np.zeros(len(neg), np.int64)]
        order = rng.permutation(len(pick))
        for at in range(0, len(order), 64):
            bags, lab = pick[order[at:at + 64]], label[order[at:at + 64]]
            parts, size = [], []
            for w, v in zip(bags, lab):
                ids = tokens[start[w]:end[w]]
                other = np.empty(0, np.int32)
                if epoch >= 2 and rng.random() < 0.5:           # a few words: those around the worst, or any
                    size_ = int(rng.integers(1, 7))
                    k = int(np.argmax(per_word[ids])) if v else int(rng.integers(len(ids)))
                    at_ = max(0, k - int(rng.integers(size_)))
                    ids = ids[at_:at_ + size_]
                if v and epoch >= 3 and rng.random() < 0.4:     # the worst word misspelt
                    k = int(np.argmax(per_word[ids]))
                    other, _ = grams([misspell(vocabulary[ids[k]], rng)])
                    ids = np.delete(ids, k)
                own = gather_ragged(flat, offsets, ids)[0] if len(ids) else other[:0]
                bag = np.r_[own, other]
                parts.append(bag)
                size.append(len(bag))
            model.step(np.concatenate(parts), np.array(size), lab, 0.15)
    value, _ = scores()
    bias = float(model.b[1] - model.b[0])
    best = share_scores(sigmoid(value + bias), owner, len(y))
    slope, offset = fit_platt(best[held] if held.any() else best, y[held] if held.any() else y)
    C = model.contributions()
    return Model((C[:, 1:2] - C[:, 0:1]).astype(np.float32), bias, slope, offset, grams)


def bag_scores(model: Model, table: WordScores, texts: list[str]) -> np.ndarray:
    """Each text's share score; long texts pass in pieces, which bounds memory, and
    the densest piece counts.  A text without words has one window of raw score 0."""
    parts: list[list[str]] = []
    owner: list[int] = []
    for i, t in enumerate(texts):
        for p in pieces(t):
            parts.append(words(p))
            owner.append(i)
    sums, counts = table(parts)
    start, end, own = window_bounds(np.array([len(x) for x in parts], np.int64))
    value = window_scores(sums[:, 0], counts, start, end)
    by_piece = share_scores(sigmoid(value + model.bias), own, len(parts))
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, np.array(owner, np.int64), by_piece)
    return best


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every text.  Null counts as empty; a text
    without words has one empty window."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # fixed size: one number per hash bucket

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = WordScores(m.grams, m.contributions)
        for b in batches:
            value = bag_scores(m, table, [t or "" for t in b.column(1).to_pylist()])
            p = sigmoid(m.slope * value + m.offset)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")), kernel,
                       "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted): learns from at most ``sample_rows``
    labelled rows whose crc32(doc_id) mod 3 is not 1, scores every document."""
    model = train(labelled_sample(docs, labels.where(crc_fold("doc_id", 3) != 1), "toxic", sample_rows))
    return score(docs, model).select("doc_id", F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                                     "score", "predicted")
