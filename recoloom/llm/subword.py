"""Bags of hashed character n-grams under a linear softmax, in numpy.

A word is the bag of its n-grams between boundary marks; every n-gram hashes
to a row of one embedding table; a text is the average of its n-grams' rows and
a linear softmax scores it.  Table and softmax are trained together by
stochastic gradient descent.  As the model is linear after the average, a word
can be reduced to its summed class scores and its n-gram count, and a text is
scored from its words.
"""

from __future__ import annotations

import numpy as np

PRIME, MIX = np.uint64(1099511628211), np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Bucket numbers of the byte n-grams of words, lengths ``low`` to ``high``."""

    def __init__(self, bits: int, low: int, high: int):
        self.bits, self.low, self.high = bits, low, high

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat buckets, offsets): word ``i`` owns buckets offsets[i]:offsets[i + 1].
        Every word has at least one n-gram: itself with its marks, if shorter."""
        raw = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
        owner = np.repeat(np.arange(len(raw)), lens)
        room = np.repeat(np.cumsum(lens), lens) - np.arange(len(data))      # bytes from here to the word's end
        first = np.cumsum(lens) - lens
        h = np.zeros(len(data), np.uint64)
        who, bucket = [], []
        with np.errstate(over="ignore"):
            for n in range(1, min(self.high, len(data)) + 1):
                h[:len(data) - n + 1] = h[:len(data) - n + 1] * PRIME + data[n - 1:]
                if n < self.low:
                    short = first[lens == n]
                    at = short
                else:
                    at = np.flatnonzero(room >= n)
                who.append(owner[at])
                bucket.append((((h[at] + np.uint64(n)) * MIX) >> np.uint64(64 - self.bits)).astype(np.int32))
        who_, bucket_ = np.concatenate(who), np.concatenate(bucket)
        order = np.argsort(who_, kind="stable")
        return bucket_[order], np.r_[0, np.cumsum(np.bincount(who_, minlength=len(raw)))]

    def all(self, words: list[str], part: int = 8192) -> tuple[np.ndarray, np.ndarray]:
        """The same for many words, a part at a time, which bounds the working arrays."""
        got = [self(words[k:k + part]) for k in range(0, len(words), part)]
        sizes = np.concatenate([np.diff(o) for _, o in got])
        return np.concatenate([f for f, _ in got]), np.r_[0, np.cumsum(sizes)]


def gather_ragged(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated entries of ``rows`` and the length of each."""
    size = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[rows] - (ends - size), size)
    return flat[at], size


class SubwordSoftmax:
    """Embedding table and softmax.  ``adaptive`` scales steps by the gradients' history."""

    def __init__(self, bits: int, dim: int, classes: int, seed: int = 7, adaptive: bool = False):
        rng = np.random.default_rng(seed)
        self.E = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
        self.W = np.zeros((classes, dim), np.float32)
        self.W += rng.normal(0, 0.1, self.W.shape).astype(np.float32)
        self.b = np.zeros(classes, np.float32)
        self.adaptive = adaptive
        self.gE, self.gW, self.gb = np.zeros(1 << bits, np.float32), np.zeros_like(self.W), np.zeros_like(self.b)

    def step(self, buckets: np.ndarray, sizes: np.ndarray, y: np.ndarray, lr: float, weight: np.ndarray | None = None) -> None:
        """One step on bags given as concatenated buckets; bags are not empty."""
        starts = np.cumsum(sizes) - sizes
        H = np.add.reduceat(self.E[buckets], starts, axis=0) / sizes[:, None].astype(np.float32)
        Z = H @ self.W.T + self.b
        P = np.exp(Z - Z.max(1, keepdims=True))
        P /= P.sum(1, keepdims=True)
        P[np.arange(len(y)), y] -= 1
        if weight is not None:
            P *= weight[:, None].astype(np.float32)
        dW, db = P.T @ H, P.sum(0)
        dH = (P @ self.W) / sizes[:, None].astype(np.float32)
        bag = np.repeat(np.arange(len(y)), sizes)
        order = np.argsort(buckets, kind="stable")
        own = buckets[order]
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rows, dE = own[cut], np.add.reduceat(dH[bag[order]], cut, axis=0)
        if self.adaptive:
            self.gE[rows] += (dE * dE).mean(1)
            self.gW += dW * dW
            self.gb += db * db
            self.E[rows] -= lr * dE / np.sqrt(self.gE[rows] + 1e-10)[:, None]
            self.W -= lr * dW / np.sqrt(self.gW + 1e-8)
            self.b -= lr * db / np.sqrt(self.gb + 1e-8)
        else:
            self.E[rows] -= lr * dE
            self.W -= lr * dW
            self.b -= lr * db

    def contributions(self) -> np.ndarray:
        """Class scores of each bucket, before averaging."""
        return self.E @ self.W.T


class WordScores:
    """A worker's bounded table of words: summed class scores and n-gram counts."""

    def __init__(self, grams: Grams, contributions: np.ndarray, limit: int = 200_000, longest: int = 48):
        self.grams, self.C, self.limit, self.longest = grams, contributions, limit, longest
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.sums = np.zeros((1024, self.C.shape[1]), np.float32)
        self.counts = np.zeros(1024, np.float32)

    def __call__(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores and n-gram counts of every word of all lists, in order."""
        seen: set[str] = set()
        seen.update(*lists)
        new = list(seen.difference(self.rows))
        if len(self.rows) + len(new) > self.limit and self.rows:
            self._reset()
            new = list(seen)
        if new:
            a, b = len(self.rows), len(self.rows) + len(new)
            if b > len(self.counts):
                size = max(b, 2 * len(self.counts))
                self.sums = np.vstack([self.sums, np.zeros((size - len(self.counts), self.sums.shape[1]), np.float32)])
                self.counts = np.r_[self.counts, np.zeros(size - len(self.counts), np.float32)]
            for x in range(0, len(new), 8192):                  # bounds the n-gram arrays
                part = new[x:x + 8192]
                flat, offsets = self.grams(part)
                self.sums[a + x:a + x + len(part)] = np.add.reduceat(self.C[flat], offsets[:-1], axis=0)
                self.counts[a + x:a + x + len(part)] = np.diff(offsets)
            self.rows.update(zip(new, range(a, b)))
        get = self.rows.__getitem__
        at = np.concatenate([np.fromiter(map(get, ws), np.int64, len(ws)) for ws in lists]) if lists else np.empty(0, np.int64)
        sums, counts = self.sums[at], self.counts[at]
        if any(len(w) > self.longest for w in new):             # long words are not worth keeping
            for w in new:
                if len(w) > self.longest:
                    del self.rows[w]
            if len(self.rows) != b:                             # row numbers must stay dense
                keep = np.fromiter(self.rows.values(), np.int64, len(self.rows))
                self.sums, self.counts = self.sums[keep], self.counts[keep]
                self.rows = dict(zip(self.rows, range(len(keep))))
                if not len(keep):
                    self._reset()
        return sums, counts


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_platt(score: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and offset of a logistic map from score to probability (Newton's
    method with a small ridge); the identity where one class is absent."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    centre, scale = float(score.mean()), float(score.std()) or 1.0
    X = np.c_[(score - centre) / scale, np.ones(len(score))]
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(X @ w)
        g = X.T @ (p - y) + 1e-3 * w * [1, 0]
        H = (X * (p * (1 - p))[:, None]).T @ X + np.diag([1e-3, 1e-6])
        d = np.linalg.solve(H, g)
        w -= np.clip(d, -2, 2)
        if np.abs(d).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * centre / scale)
