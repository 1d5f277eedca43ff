"""Language identification: averaged hashed subword embeddings, linear softmax.

Trained by plain stochastic gradient descent in numpy; the softmax is calibrated
by a temperature on a slice kept out of training, and a rejection threshold is
set there so that accepted predictions reach a target accuracy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, labelled_sample, map_batches
from .subword import Grams, SubwordSoftmax, WordScores, gather_ragged
from .wordsplit import pieces

SAMPLE_ROWS = 3000                      # labelled texts that the classifier is fitted on
BITS, DIM, LOW, HIGH = 15, 16, 1, 4
BAG_WORDS = 60                          # words of one training bag
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    langs: list[str]
    contributions: np.ndarray           # (buckets, languages)
    bias: np.ndarray
    temperature: float
    reject_below: float
    grams: Grams


def words(text: str) -> list[str]:
    """Runs of letters; signs that are no letters (fractions, say) are left out."""
    found = _WORDS.findall(text.lower())
    if text.isascii():
        return found
    return [w for w in found if w[0].isalpha() or any(map(str.isalpha, w))]


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def train(sample: list[tuple[str, str]], epochs: int = 6, lr: float = 0.5, target: float = 0.99,
          seed: int = 5) -> Model:
    """Fit on (text, language) pairs.  Without any text with letters the model
    knows no language and every prediction is ``und``."""
    grams = Grams(BITS, LOW, HIGH)
    rng = np.random.default_rng(seed)
    langs = sorted({v for _, v in sample})
    code = {v: i for i, v in enumerate(langs)}
    number: dict[str, int] = {}
    bags: list[np.ndarray] = []
    y: list[int] = []
    for t, v in sample:
        ws = words(t)
        if not ws:
            continue
        for size in (BAG_WORDS, int(rng.integers(3, 13))):      # a long and a short stretch of each text
            at = int(rng.integers(max(1, len(ws) - size + 1)))
            bags.append(np.array([number.setdefault(w, len(number)) for w in ws[at:at + size]]))
            y.append(code[v])
    if not bags:
        return Model([], np.zeros((1 << BITS, 1), np.float32), np.zeros(1), 1.0, 0.0, grams)
    flat, offsets = grams.all(list(number))
    label = np.array(y)
    held = (np.arange(len(bags)) // 2) % 5 == 4
    model = SubwordSoftmax(BITS, DIM, max(2, len(langs)), seed)
    fit = np.flatnonzero(~held)
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for order in np.array_split(rng.permutation(fit), max(1, len(fit) // 16)):
            if not len(order):
                continue
            buckets, _ = gather_ragged(flat, offsets, np.concatenate([bags[i] for i in order]))
            size = np.array([(offsets[bags[i] + 1] - offsets[bags[i]]).sum() for i in order])
            model.step(buckets, size, label[order], lr * max(0.05, 1 - done / steps))
            done += len(order)
    C = model.contributions()[:, :len(langs)]
    check = np.flatnonzero(held) if held.any() else np.arange(len(bags))
    Z = np.array([C[gather_ragged(flat, offsets, bags[i])[0]].mean(0) for i in check]) + model.b[:len(langs)]
    grid = np.geomspace(0.1, 10, 41)
    loss = [-np.log(softmax(Z / t)[np.arange(len(check)), label[check]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(Z / temperature)
    best, right = p.max(1), p.argmax(1) == label[check]
    order = np.argsort(-best, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= target)
    reject = float(best[order][good[-1]]) if len(good) else 1.0
    return Model(langs, C.astype(np.float32), model.b[:len(langs)].astype(np.float64), temperature, reject, grams)


def logits(model: Model, table: WordScores, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed class scores and n-gram counts of each text (count 0: no letter)."""
    lists = [words(t) for t in texts]
    sums, counts = table(lists)
    ends = np.cumsum([len(x) for x in lists])
    s = np.vstack([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
    c = np.r_[0.0, np.cumsum(counts, dtype=np.float64)]
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    return s[ends] - s[starts], c[ends] - c[starts]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every text: ``und`` with score 0
    where the text is null or has no letter, or nothing was learned;
    ``rejected`` marks predictions below the calibrated threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # fixed size: buckets x languages

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = WordScores(m.grams, m.contributions)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows: list[str] = []
            owner: list[int] = []
            for i, t in enumerate(texts):
                for p in pieces(t):
                    rows.append(p)
                    owner.append(i)
            s, c = logits(m, table, rows)
            S, N = np.zeros((len(texts), s.shape[1])), np.zeros(len(texts))
            np.add.at(S, owner, s)
            np.add.at(N, owner, c)
            known = (N > 0) & bool(m.langs)
            lang, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            if known.any():
                p = softmax((S[known] / N[known][:, None] + m.bias) / m.temperature)
                lang[known] = np.array(m.langs, dtype=object)[p.argmax(1)]
                score[known] = p.max(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64()),
                 pa.array(~known | (score < m.reject_below))], names=["doc_id", "lang_pred", "score", "rejected"])
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")), kernel,
                       "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learns from at most ``sample_rows`` documents with a language whose
    crc32(doc_id) mod 5 is not 0, predicts every document."""
    known = docs.where(crc_fold("doc_id", 5) != 0).select("doc_id", "lang")
    model = train(labelled_sample(docs, known, "lang", sample_rows))
    return predict(docs, model).select("doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                                       "lang_pred", "score", "rejected")
