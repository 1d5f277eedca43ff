"""Spelling variants grouped by k-d trees over letter counts.

A word is a point: how often it holds each letter.  A replaced letter moves a point
by one up in one letter and one down in another, an inserted one by one up, so words
one edit apart are at an L1 distance of at most two.  For each pair of lengths
(L, L) and (L, L + 1) the near points are range-searched: boxes that need more than
one step up or one step down are pruned, and the words in the boxes left are
verified letter by letter.

The search is dealt out by the trees' top levels.  They are built per length from a
bounded sample and only decide where points go: a point lives in one leaf, a query
visits every leaf within its steps, so any tree gives the same pairs, each once.
Leaves of any size are cut into tiles of bounded points and queries; a tile builds
the lower levels over its points and lets the queries stream through.  A task returns
one row per word it met, with the number of near words and the best of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
TIMES = 10                              # a form is at least so many times as frequent
DROP = 31                               # one in so many (document, run) pairs loses a letter

DIMS = 26 + 64                          # a-z and U+00C0 to U+00FF
LEAF_WORDS, SAMPLE_A_LEAF = 32_768, 64  # size aimed at for a leaf, sampled words for each
MOST_LEAVES = 4096                      # leaves beyond are larger and cut into more tiles
TREE_LENGTH = 64                        # longer words (rare) have one leaf a length
TILE_POINTS, TILE_QUERIES, TILE_BYTES = 65_536, 1 << 19, 32 << 20
BUCKET = 4                              # points at which a tile's tree stops splitting
WAVE = 4096                             # queries that walk a tree together


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the distinct words of all texts and how often each occurs.

    A null text has no words, a null id counts as no digits; rows that repeat an id
    each count."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    run = F.regexp_extract_all(text, F.lit(f"(?<![{LETTERS}])[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).alias("id"), F.explode(run).alias("run"))
    low = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % DROP == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
    return (hashed.select(F.coalesce(word, F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT))


def codes(batch: list[str], length: int) -> np.ndarray:
    """Words of one length as letter numbers, a row each."""
    c = np.frombuffer("".join(batch).encode("latin-1"), np.uint8).reshape(len(batch), length)
    return np.where(c < 0xC0, c - 97, c - (0xC0 - 26)).astype(np.uint8)


def counts(code: np.ndarray) -> np.ndarray:
    """Letter-count vectors of rows of letter numbers."""
    n, length = code.shape
    kind = np.uint8 if length < 255 else np.int32
    if n * DIMS * 8 <= TILE_BYTES:
        flat = np.bincount((np.arange(n)[:, None] * DIMS + code).ravel(), minlength=n * DIMS)
        return flat.reshape(n, DIMS).astype(kind)
    step = max(1, TILE_BYTES // (DIMS * 8))
    return np.concatenate([counts(code[i:i + step]) for i in range(0, n, step)])


def packed(count: np.ndarray) -> np.ndarray:
    """Three words a point, two Gray-coded bits a letter: points that differ by k
    steps differ in at most k bits."""
    gray = np.array([0, 1, 3, 2], np.uint64)[count & 3]
    gray = np.concatenate([gray, np.zeros((len(gray), 96 - DIMS), np.uint64)], axis=1).reshape(len(gray), 3, 32)
    return (gray << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(2, dtype=np.uint64)


class Tree:
    """A k-d tree over count vectors: at an inner node, points with at most ``cut`` of
    letter ``dim`` go left.  Leaves are numbered; ``order`` lists points leaf by leaf."""

    def __init__(self, points: np.ndarray, leaf_size: int):
        dim, cut, left, right, leaf, order, bounds = [], [], [], [], [], [], [0]
        todo = [(np.arange(len(points)), -1, False)]
        while todo:
            own, parent, is_right = todo.pop()
            here = len(dim)
            if parent >= 0:
                (right if is_right else left)[parent] = here
            d, at = self._split(points, own) if len(own) > leaf_size else (-1, 0)
            dim.append(d)
            cut.append(at)
            left.append(-1)
            right.append(-1)
            if d < 0:
                leaf.append(len(bounds) - 1)
                order.append(own)
                bounds.append(bounds[-1] + len(own))
                continue
            leaf.append(-1)
            low = points[own, d] <= at
            todo += [(own[~low], here, True), (own[low], here, False)]
        self.dim, self.cut, self.leaf = np.array(dim, np.int16), np.array(cut, np.int32), np.array(leaf, np.int32)
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.order, self.bounds = np.concatenate(order), np.array(bounds)

    @staticmethod
    def _split(points: np.ndarray, own: np.ndarray) -> tuple[int, int]:
        """The letter and count that part the points most evenly; (-1, 0) if they are all equal."""
        seen = points[own] if len(own) <= 4096 else points[own[:: -(-len(own) // 4096)]]
        best, choice = 0, (-1, 0)
        low, high = seen.min(0), seen.max(0)
        for at in range(int(low.min()), int(high.max())):
            below = (seen <= at).sum(0)
            even = np.minimum(below, len(seen) - below)
            if even.max() > best:
                best, choice = int(even.max()), (int(even.argmax()), at)
            if at > 8 and best:                                 # long words: further counts only if none parts yet
                break
        if best == 0 and len(seen) < len(own):                  # the thinned points are equal, the others may not be
            full = points[own]
            low, high = full.min(0), full.max(0)
            if (low < high).any():
                d = int((low < high).argmax())
                return d, int(low[d])
        return choice

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.zeros(len(points), np.int32)
        inner = np.flatnonzero(self.dim[node] >= 0)
        while len(inner):
            at = node[inner]
            low = points[inner, self.dim[at]] <= self.cut[at]
            node[inner] = np.where(low, self.left[at], self.right[at])
            inner = inner[self.dim[node[inner]] >= 0]
        return self.leaf[node]

    def reach(self, points: np.ndarray, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) for every leaf whose box a point can reach by at most one step
        up and, if ``down``, one step down."""
        q = np.arange(len(points), dtype=np.int32)
        node = np.zeros(len(q), np.int32)
        up_at, down_at = np.full(len(q), -1, np.int16), np.full(len(q), -1 if down else -2, np.int16)
        out_q, out_leaf = [], []
        while len(q):
            dim = self.dim[node]
            done = dim < 0
            if done.any():
                out_q.append(q[done])
                out_leaf.append(self.leaf[node[done]])
                go = ~done
                q, node, up_at, down_at, dim = q[go], node[go], up_at[go], down_at[go], dim[go]
            cut = self.cut[node]
            c = points[q, dim].astype(np.int32) + (up_at == dim) - (down_at == dim)
            low = c <= cut
            over = np.flatnonzero((c == cut) & (up_at == -1))          # one step up crosses the cut
            under = np.flatnonzero((c == cut + 1) & (down_at == -1))   # one step down does
            q, node, up_at, down_at = (
                np.concatenate([q, q[over], q[under]]),
                np.concatenate([np.where(low, self.left[node], self.right[node]), self.right[node[over]], self.left[node[under]]]),
                np.concatenate([up_at, dim[over], up_at[under]]), np.concatenate([down_at, down_at[over], dim[under]]))
        return (np.concatenate(out_q), np.concatenate(out_leaf)) if out_q else (q, node)


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows (of equal length) that differ in exactly one letter."""
    return (a != b).sum(1) == 1


def inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows of ``long`` that are those of ``short`` and one letter more."""
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= short.shape[1]


class Best:
    """Of each of a list of words: how many near words were met, and which of them is
    most frequent (ties: smallest)."""

    def __init__(self, size: int):
        self.near = np.zeros(size, np.int64)
        self.n = np.zeros(size, np.int64)
        self.word = np.full(size, "", object)

    def add(self, at: np.ndarray, n: np.ndarray, word: np.ndarray) -> None:
        if not len(at):
            return
        np.add.at(self.near, at, 1)
        rank = np.unique(word, return_inverse=True)[1]
        order = np.lexsort((rank, -n, at))
        first = order[np.concatenate([[True], at[order][1:] != at[order][:-1]])]
        at, n, word = at[first], n[first], word[first]
        better = (n > self.n[at]) | ((n == self.n[at]) & (word < self.word[at]))
        self.n[at[better]], self.word[at[better]] = n[better], word[better]

    def rows(self, word: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(self.near)
        return pa.RecordBatch.from_arrays(
            [pa.array(word[some].tolist(), pa.string()), pa.array(self.near[some]), pa.array(self.n[some]),
             pa.array(self.word[some].tolist(), pa.string())], names=["word", "n_near", "best_n", "best"])


class Tile:
    """The points of one tile and their tree."""

    def __init__(self, length: int, word: list[str], n: np.ndarray):
        self.length, self.word, self.n = length, np.array(word, object), n
        self.code = codes(word, length)
        count = counts(self.code)
        self.tree = Tree(count, BUCKET)
        self.bits = packed(count)
        self.best = Best(len(word))

    def search(self, word: list[str], n: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        """Queries of this length, or of one letter less, against the points.  A pair
        of one length and leaf is met from both ends and taken from the smaller word."""
        text, best = np.array(word, object), Best(len(word))
        same = len(word[0]) == self.length
        step = max(1, min(WAVE, TILE_BYTES // (4 * self.length + 1)))
        for at in range(0, len(word), step):
            code = codes(word[at:at + step], len(word[0]))
            count = counts(code)
            bits = packed(count)
            q, leaf = self.tree.reach(count, down=same)
            first, size = self.tree.bounds[leaf], np.diff(self.tree.bounds)[leaf]
            for lo in range(0, len(q), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                for i, j in self._candidates(q[part], first[part], size[part]):
                    close = np.bitwise_count(bits[i] ^ self.bits[j]).sum(1) <= (2 if same else 1)
                    i, j = i[close], j[close]
                    ok = replaced(code[i], self.code[j]) if same else inserted(code[i], self.code[j])
                    i, j = i[ok], j[ok]
                    if same:
                        once = ~home[at + i] | (text[at + i] < self.word[j]).astype(bool)
                        i, j = i[once], j[once]
                    best.add(at + i, self.n[j], self.word[j])
                    self.best.add(j, n[at + i], text[at + i])
        return best.rows(text)

    def _candidates(self, q: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, point) pairs of bounded number: points of a leaf beyond BUCKET are
        equal and can be many."""
        most = max(1024, TILE_BYTES // (16 * self.length))
        skip = np.zeros(len(q), np.int64)
        while len(q):
            room = np.cumsum(size - skip)
            take = np.clip(most - (room - (size - skip)), 0, size - skip)
            row = np.repeat(np.arange(len(q)), take)
            place = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
            yield q[row], self.tree.order[(first + skip)[row] + place]
            skip = skip + take
            left = skip < size
            q, first, size, skip = q[left], first[left], size[left], skip[left]


def trees(vocabulary: DataFrame) -> dict[int, Tree]:
    """The top levels per length, from a sample of SAMPLE_A_LEAF words a leaf (at most
    MOST_LEAVES leaves in all).  Lengths that fit into one leaf have no tree."""
    length = F.length("word")
    # rows: lengths up to TREE_LENGTH
    large = {r["l"]: r["c"] for r in vocabulary.where(length <= TREE_LENGTH).groupBy(length.alias("l")).agg(F.count("*").alias("c"))
             .where(F.col("c") > LEAF_WORDS).collect()}
    if not large:
        return {}
    size = max(LEAF_WORDS, -(-sum(large.values()) // MOST_LEAVES))
    share = min(1.0, SAMPLE_A_LEAF / size)
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample: dict[int, list[str]] = {}
    for r in vocabulary.where(length.isin(list(large)) & drawn).select("word").collect():
        sample.setdefault(len(r["word"]), []).append(r["word"])
    return {l: Tree(counts(codes(sorted(w), l)), max(1, len(w) * size // large[l])) for l, w in sample.items()}


_POINT, _HOME, _GUEST = 0, 1, 2


def deal(vocabulary: DataFrame, top: dict[int, Tree]) -> DataFrame:
    """(length, leaf, side, word, n): each word as a point of its leaf, and as a query
    of every leaf within its steps, of its own length from its own leaf on and of the
    next length.  Sides: 0 point, 1 query of its own leaf, 2 query of another leaf."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            word, n = np.array(b.column(0).to_pylist(), object), np.asarray(b.column(1))
            lengths = np.fromiter(map(len, word), np.int64, len(word))
            for l in np.unique(lengths):
                own = np.flatnonzero(lengths == l)
                step = max(1, TILE_BYTES // (int(l) + 8 * DIMS))
                for at in range(0, len(own), step):
                    rows = own[at:at + step]
                    count = counts(codes(word[rows].tolist(), int(l))) if int(l) in top or int(l) + 1 in top else None
                    every, zero = np.arange(len(rows)), np.zeros(len(rows), np.int32)
                    home = top[l].home(count) if l in top else zero
                    q, leaf = top[l].reach(count, True) if l in top else (every, zero)
                    ahead = leaf >= home[q]
                    q, leaf = q[ahead], leaf[ahead]
                    up, up_leaf = top[l + 1].reach(count, False) if l + 1 in top else (every, zero)
                    who = np.concatenate([every, q, up])
                    m = [len(every), len(q), len(up)]
                    out = (np.repeat([l, l, l + 1], m), np.concatenate([home, leaf, up_leaf]),
                           np.concatenate([np.full(m[0], _POINT), np.where(leaf == home[q], _HOME, _GUEST), np.full(m[2], _GUEST)]))
                    for x in range(0, len(who), 8192):
                        w = rows[who[x:x + 8192]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(o[x:x + 8192], pa.int32()) for o in out] + [pa.array(word[w].tolist(), pa.string()), pa.array(n[w])],
                            names=["length", "leaf", "side", "word", "n"])
    return map_batches(vocabulary.select("word", "n"), kernel, "length int, leaf int, side int, word string, n long")


def near(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best), partial: near words found in one tile."""
    dealt = deal(vocabulary, trees(vocabulary))
    leaf = ["length", "leaf"]
    size = dealt.groupBy(*leaf).agg(F.count_if(F.col("side") == _POINT).alias("points"), F.count_if(F.col("side") > _POINT).alias("queries"))
    cut = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    point_bytes = F.greatest(cut("points", TILE_POINTS), F.ceil(F.col("points") * (F.col("length") + 5 * DIMS) / (4 * TILE_BYTES)).cast("int"))
    size = size.where("points > 0 and queries > 0").select(*leaf, point_bytes.alias("ps"), cut("queries", TILE_QUERIES).alias("qs"))
    own = lambda k: F.pmod(F.xxhash64("word"), F.col(k)).cast("int")
    place = F.when(F.col("side") == _POINT, F.transform(F.sequence(F.lit(0), F.col("qs") - 1), lambda q: F.struct(own("ps").alias("p"), q.alias("q"))))
    place = place.otherwise(F.transform(F.sequence(F.lit(0), F.col("ps") - 1), lambda p: F.struct(p.alias("p"), own("qs").alias("q"))))
    tile = [*leaf, "p", "q"]
    tiles = (dealt.join(size, leaf).select(*leaf, "side", "word", "n", F.inline(place))
             .select(*tile, "side", F.length("word").alias("l"), "word", "n").repartition(*tile).sortWithinPartitions(*tile, "side", "l"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, points = None, [], None
        for batch in batches:
            k = np.stack([np.asarray(batch.column(i)) for i in range(4)] + [np.asarray(batch.column(4)) > _POINT,
                                                                            np.asarray(batch.column(5))], axis=1).astype(np.int64)
            edges = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1 if len(k) else []
            for x, y in zip([0, *edges], [*edges, len(k)]):
                if x == y:
                    continue
                if tuple(k[x][:4]) != key:
                    if points is not None:
                        yield points.best.rows(points.word)
                    key, held, points = tuple(k[x][:4]), [], None
                rows = batch.slice(x, y - x)
                if not k[x][4]:
                    held.append(rows)
                    continue
                if points is None:
                    if not held:
                        continue
                    points = Tile(int(key[0]), [w for h in held for w in h.column(6).to_pylist()],
                                  np.concatenate([np.asarray(h.column(7)) for h in held]))
                    held = []
                yield points.search(rows.column(6).to_pylist(), np.asarray(rows.column(7)), np.asarray(rows.column(4)) == _HOME)
        if points is not None:
            yield points.best.rows(points.word)
    return map_batches(tiles, kernel, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to, from (word, form) rows.  A form
    is TIMES as frequent as its word, so chains are short; each round doubles the steps."""
    up = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        inner = up.join(up.select(F.col("root").alias("word")).distinct(), "word", "left_semi")     # forms that have one themselves
        inner = stage(inner.select(F.col("word").alias("root"), F.col("root").alias("next")), "spelling-inner")
        if inner.isEmpty():
            return up
        up = stage(up.join(inner, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of all texts."""
    vocabulary = stage(words(docs), "spelling-words")
    none = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                             F.lit(None).cast("string").alias("best"))
    met = near(vocabulary).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    choice = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))).alias("b")
    seen = none.union(met).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), choice)
    far = -F.col("b.m") >= TIMES * F.col("n")
    known = stage(seen.select("word", "n", "n_near", F.when(far, F.col("b.w")).alias("form"), F.when(far, -F.col("b.m")).alias("form_n")),
                  "spelling-forms")
    last = roots(known.where("form is not null"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
