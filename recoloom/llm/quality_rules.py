"""Quality rules under weak supervision.

Each rule votes good or junk, or abstains.  Expectation-maximisation over the
votes of all documents estimates how often each rule is right on good and on junk
documents (``label_model``); a document is kept by its posterior probability of
being good, not by passing every rule.  Only counts per vote pattern reach the
driver: at most 3 ** rules rows, whatever the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, stage

WINDOW = 8                              # words of a repeat window
BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_cased",
            "n_marks", "n_stutter")
RELIABLE, DOUBTFUL = 100.0, 0.2         # prior of a rule: blames about 1 in 100 good documents; share of rules that may blame any
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x2545F4914F6CDD1D)


def repeat_cover(ids: np.ndarray) -> int:
    """How many words lie in a window of WINDOW words that occurs more than once.
    Exact: windows are numbered by doubling, pairs of numbered halves."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    code, span = ids.astype(np.int64), 1
    while span < WINDOW:
        code = np.unique(code[:-span] * (int(code.max()) + 1) + code[span:], return_inverse=True)[1]
        span *= 2
    seen = np.bincount(code)[code] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(seen), 1)
    np.add.at(edge, np.flatnonzero(seen) + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(texts: list[str]) -> np.ndarray:
    """MEASURES of each text, one row per text."""
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    lists = [t.encode("utf-8", "surrogatepass").split() for t in texts]         # bytes: ASCII blanks only
    seen: set[bytes] = set()
    seen.update(*lists)
    number = dict(zip(seen, range(len(seen)))).__getitem__
    sizes = np.array([len(ws) for ws in lists], np.int64)
    ids = np.concatenate([np.fromiter(map(number, ws), np.int64, len(ws)) for ws in lists]) if lists else sizes
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    # texts in which two windows hash alike; only those are counted exactly
    suspects = np.empty(0, np.int64)
    if len(ids) >= WINDOW:
        with np.errstate(over="ignore"):
            mixed = (ids.astype(np.uint64) + np.uint64(1)) * MIX
            h = np.zeros(len(ids) - WINDOW + 1, np.uint64)
            for k in range(WINDOW):
                h = h * STEP + mixed[k:k + len(h)]
            whole = owner[:len(h)] == owner[WINDOW - 1:]
            h = (h ^ (h >> np.uint64(29))) + owner[:len(h)].astype(np.uint64) * MIX
        order = np.argsort(h[whole], kind="stable")
        s = h[whole][order]
        suspects = np.unique(owner[:len(h)][whole][order][1:][s[1:] == s[:-1]])
    repeats = {int(d): repeat_cover(ids[ends[d] - sizes[d]:ends[d]]) for d in suspects}
    stutter = np.bincount(owner[1:][(ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])], minlength=len(texts)) if len(ids) else 0
    for i, t in enumerate(texts):
        lines = Counter(x for x in t.split("\n") if x.strip(BLANKS))
        raw = t.encode("utf-8", "surrogatepass")
        upper, lower = len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, LOWER))
        out[i, :9] = (sizes[i], len(t) - sum(map(t.count, BLANKS)), sum(map(t.count, SYMBOLS)),
                      sum(lines.values()) - len(lines), repeats.get(i, 0),
                      sum(lines.values()), upper, upper + lower, sum(map(t.count, "!?")))
    out[:, 9] = stutter
    return out


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, MEASURES...) of every whole text; null text has no words."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = measure([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(m[:, k]) for k in range(len(MEASURES))]],
                                             names=["doc_id", *MEASURES])
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")), kernel,
                       "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def rules() -> dict[str, tuple[Column, Column]]:
    """name -> (votes junk, votes good); neither: the rule abstains."""
    c = F.col
    return {
        "length": (c("n_words") < 20, c("n_words") >= 40),
        "repeats": (100 * c("n_repeat_words") > 30 * c("n_words"), 100 * c("n_repeat_words") <= 10 * c("n_words")),
        "symbols": (100 * c("n_symbols") > 25 * c("n_words"), 100 * c("n_symbols") <= 8 * c("n_words")),
        "lines": ((100 * c("n_dup_lines") > 40 * c("n_lines")) & (c("n_dup_lines") >= 3), 100 * c("n_dup_lines") <= 20 * c("n_lines")),
        "shouting": (100 * c("n_upper") > 50 * c("n_cased"), (100 * c("n_upper") <= 15 * c("n_cased")) & (c("n_cased") > 0)),
        "marks": (100 * c("n_marks") > 40 * c("n_words"), 100 * c("n_marks") <= 15 * c("n_words")),
        "stutter": (100 * c("n_stutter") > 20 * c("n_words"), 100 * c("n_stutter") <= 8 * c("n_words")),
        "word_length": ((c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 25 * c("n_words")),
                        c("word_chars").between(3 * c("n_words"), 15 * c("n_words"))),
    }


def trust(rate: np.ndarray) -> float:
    """Log prior of the rules' rates of junk votes on good documents: a rule is a reliable
    one, Beta(1, RELIABLE), or, with probability DOUBTFUL, any.  However often a rule
    fires, distrusting it costs a fixed sum at most, which few documents outweigh."""
    return float(np.log((1 - DOUBTFUL) * RELIABLE * (1 - rate) ** (RELIABLE - 1) + DOUBTFUL).sum())


def surprise(x: float, n: float) -> float:
    """Log likelihood of x of n at their own rate."""
    return x * np.log(x / n) + (n - x) * np.log1p(-x / n)


def fit_classes(votes: np.ndarray, counts: np.ndarray, rate: np.ndarray, share: np.ndarray,
                rounds: int = 500) -> dict[str, np.ndarray]:
    """EM from ``rate`` (classes x rules, row 0 the good class) and the classes' shares.
    A rule blames a junk class as often as the good one, or more often where that
    pays by the Bayesian information criterion, never more seldom."""
    plus, minus = (votes > 0).astype(float), (votes < 0).astype(float)
    junk, price = len(rate) - 1, np.log(max(counts.sum(), 1.0)) / 2
    last, own = -np.inf, 0
    for _ in range(rounds):
        odds = np.log(share) + plus @ np.log1p(-rate).T + minus @ np.log(rate).T
        top = odds.max(1, keepdims=True)
        belong = np.exp(odds - top)
        total = belong.sum(1, keepdims=True)
        belong /= total
        fits = float(counts @ (top + np.log(total))[:, 0]) - price * own
        if abs(fits - last) < 1e-9 * abs(fits):
            break
        last = fits
        mass = (counts[:, None] * belong).T
        share = (mass.sum(1) + 0.5) / (counts.sum() + 0.5 * (junk + 1))
        blamed, voted = mass @ minus + 0.5, mass @ (plus + minus) + 1.0
        rate, own = blamed / voted, 0
        for j in range(votes.shape[1]):
            pool, x, n = [0], blamed[0, j], voted[0, j]
            for c in 1 + np.argsort(rate[1:, j], kind="stable"):
                cx, cn = blamed[c, j], voted[c, j]
                if cx / cn > x / n and surprise(cx, cn) + surprise(x, n) - surprise(x + cx, n + cn) > price:
                    own += 1
                else:
                    pool, x, n = [*pool, c], x + cx, n + cn
            rate[pool, j] = x / n
    return {"junk_vote": rate, "share": share, "good": belong[:, 0], "fits": fits + trust(rate[0])}


def label_model(votes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """One good class and a few junk classes that all rules share, by EM over vote
    patterns (rows of -1, 0, 1) and how many documents have each.

    ``junk_vote[c, j]`` is how often rule ``j``, where it votes, votes junk on class
    ``c`` (0: good).  Nothing is assumed of a single rule but that it blames no kind
    of junk more seldom than good documents.  That makes a rule that mostly fires
    alone identifiable: one that is merely wrong fires as often on the junk that
    other rules find, one with a kind of junk of its own leaves that alone and needs
    a class.  How many junk classes there are is chosen by the Bayesian information
    criterion and a weak prior of the rules (``trust``); with no evidence for any (few documents, or no junk that rules agree
    or disagree on) every document is good.  Returns these, the classes' shares, and
    each pattern's posterior of being good."""
    counts = counts.astype(np.float64)
    r, price = votes.shape[1], np.log(max(counts.sum(), 1.0)) / 2
    rate = ((counts @ (votes < 0) + 0.5) / (counts @ (votes != 0) + 1.0))[None]
    best = top = fit_classes(votes, counts, rate, np.ones(1))
    most, at = top["fits"], 0
    for junk in range(1, r + 1):
        found = []
        for j in range(r):                                      # one more class, started at what rule j blames
            new = top["junk_vote"][0].copy()
            new[j] = 0.9
            found.append(fit_classes(votes, counts, np.vstack([top["junk_vote"], new]), np.r_[0.95 * top["share"], 0.05]))
        top = max(found, key=lambda f: f["fits"])
        worth = top["fits"] - price * junk
        if worth > most:
            best, most, at = top, worth, junk
        elif junk > at + 1:
            break
    return best


def pattern_of() -> Column:
    """The votes of all rules as one number in base 3."""
    votes = [F.when(bad, 0).when(good, 2).otherwise(1) for bad, good in rules().values()]
    return sum((v * 3 ** k for k, v in enumerate(votes)), F.lit(0)).cast("int")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def posteriors(patterns: DataFrame, column: str) -> DataFrame:
    """(column, quality_probability) of every vote pattern that occurs: at most 3 ** rules rows."""
    counted = patterns.groupBy(column).count().orderBy(column).collect()
    seen = np.array([r[column] for r in counted], np.int64)
    fitted = label_model(seen[:, None] // 3 ** np.arange(len(rules())) % 3 - 1, np.array([r["count"] for r in counted]))
    return patterns.sparkSession.createDataFrame([(int(p), float(q)) for p, q in zip(seen, fitted["good"])],
                                                 f"{column} int, quality_probability double")


def judge(docs: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """(doc_id, MEASURES..., base_failed, quality_probability, kept) of every row.

    base_failed: under 20 words, or over 30 % of the words in repeated windows.
    Kept: not base_failed and a posterior of at least ``keep_from``.  An empty
    corpus gives no rows; repeated rows count as often as they occur."""
    seen = stage(measures(docs).withColumn("pattern", pattern_of()), "rules")
    return (seen.join(F.broadcast(posteriors(seen, "pattern")), "pattern").withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= keep_from)).drop("pattern"))


def accepted(docs: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all their columns.  Texts are
    measured once; the votes ride along with the rows."""
    own = docs.schema.fields
    text = docs.columns.index("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = measure([t or "" for t in b.column(text).to_pylist()])
            row = pa.StructArray.from_arrays(b.columns, [f"c{k}" for k in range(len(own))])
            yield pa.RecordBatch.from_arrays([row, *[pa.array(m[:, k]) for k in range(len(MEASURES))]],
                                             names=["row", *MEASURES])
    packed = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(own)])
    schema = T.StructType([T.StructField("row", packed), *[T.StructField(m, T.LongType()) for m in MEASURES]])
    seen = stage(map_batches(docs, kernel, schema).select("row", pattern_of().alias("pattern"),
                                                          base_failed().alias("failed")), "rules-docs")
    return (seen.where("not failed").join(F.broadcast(posteriors(seen, "pattern")), "pattern")
            .where(F.col("quality_probability") >= keep_from)
            .select(*[F.col(f"row.c{k}").alias(f.name) for k, f in enumerate(own)]))
