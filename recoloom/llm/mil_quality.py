"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 64 words.  Every passage is encoded from its
form (character-class pairs, word shape and repetition) by a learned layer; a
gated attention learned from the documents' labels weighs the passages, and the
weighted passage representation is scored.  Only document labels are known; which
passages matter is learned.  Training runs in numpy on a bounded sample; scoring
covers every passage of every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, labelled_sample, map_batches
from .subword import fit_platt, sigmoid

PASSAGE_WORDS = 64
SAMPLE_ROWS = 5000                      # labelled texts that the classifier is fitted on
HIDDEN, ATTENTION = 32, 16
TEXT_BYTES = 1 << 19                    # texts are encoded in groups or stretches of about this size

CLASSES = 12
SHAPES = 10
FEATURES = CLASSES * CLASSES + SHAPES


def byte_classes() -> np.ndarray:
    """Blank, line end, lower, upper, digit, full stop or comma, mark, quote or
    bracket, symbol, bar, other sign, byte of a non-ASCII character."""
    lut = np.full(256, 10, np.uint8)
    for k, chars in ((0, b" \t\x0b\x0c\r"), (1, b"\n"), (2, bytes(range(97, 123))), (3, bytes(range(65, 91))),
                     (4, b"0123456789"), (5, b".,"), (6, b"!?;:"), (7, b"\"'()[]{}"), (8, b"#*$%&<>"), (9, b"|")):
        lut[list(chars)] = k
    lut[128:] = 11
    return lut


LUT = byte_classes()
PRIME = np.uint64(0x100000001B3)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> np.ndarray:
    """PRIME ** i modulo 2 ** 64 for i < n, kept by the worker."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), PRIME, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS["p"] = np.cumprod(p, dtype=np.uint64)
    return have


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, owner) of the passages of all texts, in order.  A text without
    words has one passage whose features are all zero."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.empty(0, np.uint8)
    cls = LUT[data]
    blank = cls <= 1
    begin = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    end = np.flatnonzero(blank & ~np.r_[True, blank[:-1]])
    text_end = np.cumsum(sizes)
    owner = np.searchsorted(text_end, begin, side="right")
    words = np.bincount(owner, minlength=len(texts))
    rank = np.arange(len(begin)) - np.repeat(np.cumsum(words) - words, words)
    head = np.flatnonzero(rank % PASSAGE_WORDS == 0)            # first word of each passage
    full_owner = owner[head]
    count = len(head)
    X = np.zeros((count, FEATURES), np.float32)
    if count:
        passage = np.repeat(np.arange(count), np.diff(np.r_[head, len(begin)]))
        start = begin[head]
        stop = np.r_[start[1:], len(data)]
        stop = np.minimum(stop, text_end[full_owner])
        span = stop - start
        at = np.repeat(start - (np.cumsum(span) - span), span) + np.arange(span.sum())
        of = np.repeat(np.arange(count), span)
        nxt = np.r_[cls[1:], cls[-1:]]
        nxt[text_end - 1] = cls[text_end - 1]                   # a text ends with its line; its neighbour has no part in it
        pair = of * (CLASSES * CLASSES) + cls[at].astype(np.int64) * CLASSES + nxt[at]
        hist = np.bincount(pair, minlength=count * CLASSES * CLASSES).reshape(count, -1)
        X[:, :CLASSES * CLASSES] = np.sqrt(hist / span[:, None])
        with np.errstate(over="ignore"):
            p = powers(int(min((end - begin).max(), 1 << 22)) + 1)
            inside = np.repeat(begin, end - begin)
            place = np.flatnonzero(~blank)
            h = np.add.reduceat((data[place].astype(np.uint64) + np.uint64(1)) * p[np.minimum(place - inside, len(p) - 1)],
                                np.cumsum(end - begin) - (end - begin))
            key = h * np.uint64(0x9E3779B97F4A7C15) + passage.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        stutter = np.r_[False, h[1:] == h[:-1]] & np.r_[False, passage[1:] == passage[:-1]]
        n = np.bincount(passage, minlength=count).astype(np.float32)
        length = (end - begin).astype(np.float32)
        mean = np.bincount(passage, length, count) / n
        shapes = (np.log1p(n) / 4, (n < 20), mean / 10, np.sqrt(np.maximum(np.bincount(passage, length ** 2, count) / n - mean ** 2, 0)) / 10,
                  np.bincount(passage, again, count) / n, np.bincount(passage, stutter, count) / n,
                  np.bincount(passage, length <= 1, count) / n, np.bincount(passage, length > 20, count) / n,
                  np.bincount(passage, (cls[begin] == 3), count) / n, np.ones(count))
        for k, v in enumerate(shapes):
            X[:, CLASSES * CLASSES + k] = v
    missing = np.flatnonzero(words == 0)
    X = np.vstack([X, np.zeros((len(missing), FEATURES), np.float32)])
    who = np.r_[full_owner, missing]
    order = np.argsort(who, kind="stable")
    return X[order], who[order]


def stretches(text: bytes) -> list[bytes]:
    """A long text in stretches, cut at a line end or blank where there is one."""
    out, at = [], 0
    while len(text) - at > TEXT_BYTES:
        cut = max(text.rfind(b"\n", at, at + TEXT_BYTES), text.rfind(b" ", at, at + TEXT_BYTES))
        cut = cut + 1 if cut > at else at + TEXT_BYTES
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


@dataclass
class Model:
    """Encoder A, a; gates V, U and attention w; scorer c, b; input scale; calibration."""
    P: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    slope: float
    offset: float

    def passages(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Representation and unnormalised attention of each passage."""
        P = self.P
        H = np.tanh(((X - self.mean) / self.scale) @ P["A"] + P["a"])
        return H, (np.tanh(H @ P["V"]) * sigmoid(H @ P["U"])) @ P["w"]

    def bags(self, X: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(weighted representation, attention mass as log) of bags 0..n-1, none empty."""
        H, e = self.passages(X)
        first = np.searchsorted(owner, np.arange(n))
        top = np.maximum.reduceat(e, first)
        a = np.exp(e - top[owner])
        total = np.add.reduceat(a, first)
        Z = np.add.reduceat(H * a[:, None], first, axis=0) / total[:, None]
        return Z, top + np.log(total)

    def probability(self, Z: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (Z @ self.P["c"] + self.P["b"][0]) + self.offset)


def train(sample: list[tuple[str, int]], epochs: int = 30, seed: int = 3) -> Model:
    """Fit on (text, 0/1) pairs.  Without both classes every text scores the base rate."""
    rng = np.random.default_rng(seed)
    y = np.array([int(v) for _, v in sample], np.float64)
    shape = {"A": (FEATURES, HIDDEN), "a": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION),
             "w": (ATTENTION,), "c": (HIDDEN,), "b": (1,)}
    P = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s) for k, s in shape.items()}
    if not len(y) or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.5
        return Model(P, np.zeros(FEATURES), np.ones(FEATURES), 0.0, float(np.log((base + 1e-3) / (1 - base + 1e-3))))
    parts = [np.concatenate([encode([x])[0] for x in stretches(t.encode("utf-8", "surrogatepass"))]) for t, _ in sample]
    sizes = np.array([len(p) for p in parts])
    X = np.concatenate(parts).astype(np.float64)
    ends = np.cumsum(sizes)
    model = Model(P, X.mean(0), X.std(0) + 0.02, 1.0, 0.0)
    X = (X - model.mean) / model.scale
    held = rng.random(len(y)) < 0.2
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    fit = np.flatnonzero(~held)
    m1, m2, t = {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    rate = y[fit].mean()
    for epoch in range(epochs):
        for bags in np.array_split(rng.permutation(fit), max(1, len(fit) // 32)):
            own = np.repeat(np.arange(len(bags)), sizes[bags])
            rows = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in bags])
            x = X[rows]
            first = np.searchsorted(own, np.arange(len(bags)))
            H = np.tanh(x @ P["A"] + P["a"])
            v, u = np.tanh(H @ P["V"]), sigmoid(H @ P["U"])
            e = (v * u) @ P["w"]
            a = np.exp(e - np.maximum.reduceat(e, first)[own])
            a /= np.add.reduceat(a, first)[own]
            Z = np.add.reduceat(H * a[:, None], first, axis=0)
            p = sigmoid(Z @ P["c"] + P["b"][0])
            weight = np.where(y[bags] > 0, 0.5 / rate, 0.5 / (1 - rate))
            d = (p - y[bags]) * weight / len(bags)
            dZ = d[:, None] * P["c"]
            da = (H * dZ[own]).sum(1)
            de = a * (da - np.add.reduceat(a * da, first)[own])
            dv, du = de[:, None] * u * P["w"] * (1 - v * v), de[:, None] * v * P["w"] * u * (1 - u)
            dH = (a[:, None] * dZ[own] + dv @ P["V"].T + du @ P["U"].T) * (1 - H * H)
            grad = {"A": x.T @ dH, "a": dH.sum(0), "V": H.T @ dv, "U": H.T @ du, "w": (v * u).T @ de, "c": Z.T @ d,
                    "b": np.array([d.sum()])}
            t += 1
            lr = 0.004 * (1 - epoch / epochs) + 0.0002
            for k, g in grad.items():
                g = g + 1e-4 * P[k]
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                P[k] -= lr * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)
    check = np.flatnonzero(held) if held.any() else fit
    Z = np.array([model.bags(X[ends[i] - sizes[i]:ends[i]] * model.scale + model.mean, np.zeros(sizes[i], int), 1)[0][0] for i in check])
    model.slope, model.offset = fit_platt(Z @ P["c"] + P["b"][0], y[check])
    return model


def score_texts(model: Model, texts: list[bytes]) -> np.ndarray:
    parts, owner = [], []
    for i, t in enumerate(texts):
        for s in stretches(t):
            parts.append(s)
            owner.append(i)
    Z, mass = [], []
    group, size = [], 0
    for k, s in enumerate(parts):                               # encode in groups of bounded bytes
        group.append(s)
        size += len(s)
        if size >= TEXT_BYTES or k == len(parts) - 1:
            X, own = encode(group)
            z, m = model.bags(X, own, len(group))
            Z.append(z)
            mass.append(m)
            group, size = [], 0
    if not Z:
        return np.empty(0)
    z, m, own = np.concatenate(Z), np.concatenate(mass), np.array(owner)
    first = np.searchsorted(own, np.arange(len(texts)))
    a = np.exp(m - np.maximum.reduceat(m, first)[own])          # stretches of one text share one attention
    z = np.add.reduceat(z * a[:, None], first, axis=0) / np.add.reduceat(a, first)[:, None]
    return model.probability(z)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every text; null counts as empty, and an empty
    text is one passage without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # a few thousand numbers, whatever the corpus

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = score_texts(shared.value, [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")), kernel,
                       "doc_id long, score double, predicted int")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most ``sample_rows`` labelled rows whose crc32(doc_id) mod 5 is not 0."""
    return train(labelled_sample(docs, labels.where(crc_fold("doc_id", 5) != 0), "quality", sample_rows))


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return score(docs, fit(docs, labels, sample_rows)).select(
        "doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all their columns."""
    text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = score_texts(shared.value, [(t or "").encode("utf-8", "surrogatepass") for t in b.column(text).to_pylist()])
            yield b.filter(pa.array(p >= threshold))
    return map_batches(docs, kernel, docs.schema)
