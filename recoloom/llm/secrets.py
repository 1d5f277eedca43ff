"""Secrets in texts: three patterns, and two character Markov models.

The patterns (a password or token assigned, an access key, a long hex run) give the
base spans.  They also label samples: the values they find are random strings; runs
with the shape of an identifier (no digits but a few at the end) are ordinary ones;
other runs are not learned from.  From the distinct strings of both classes two
first-order character models are learned; a run whose log-likelihood ratio, with the
prior odds of a secret, favours the random model is a span of kind ``random``.

Everything is DataFrame functions.  Finding and scoring are one narrow pass over the
texts; learning is an aggregation to distinct strings and then to at most 67 x 66
counts of character pairs, the only table that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base spans.  A run of hex digits or of access-key
#: characters is maximal, so asking for its least length in the pattern drops the
#: same matches as a check afterwards would; an assignment is checked afterwards.
QUOTE = "[\"']?"
WORD = ("(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])")
ASSIGN = WORD + QUOTE + r"\x20*[:=]\x20*" + QUOTE + "([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "(?<![0-9a-f])[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ["assign", "access", "hex", "random"]

#: Runs of so many characters and more are judged.
LEAST_RUN = 16
#: Runs that are learned from as ordinary.
ORDINARY = "(?<![A-Za-z0-9+/_-])[A-Za-z_/+-]{7,}[0-9]{0,4}(?![A-Za-z0-9+/_-])"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN = f"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_RUN},}}"
STATES = len(ALPHABET) + 1              # and the state ahead of the first character
PRIOR = 1e-4                            # share of secrets among runs
SMOOTH = 0.5                            # added to each count of a character pair
ANY_ALPHABET = 0.5                      # share of random strings drawn from the whole alphabet

BLOCK = 512                             # elements summed in one fold


def every(pattern: str) -> Callable[[Column], Column]:
    return lambda text: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def running_sum(lengths: Column) -> Column:
    """Sum of an array's elements up to and with each element.  Folds run inside
    blocks and over the blocks' sums, so the work stays near-linear."""
    def fold(values: Column, first: Column) -> Column:
        start = F.struct(first.alias("sum"), F.array().cast("array<bigint>").alias("list"))
        step = lambda acc, v: F.struct((acc["sum"] + v).alias("sum"),
                                       F.concat(acc["list"], F.array(acc["sum"] + v)).alias("list"))
        return F.aggregate(values, start, step, lambda acc: acc["list"])
    zero = F.lit(0).cast("bigint")
    firsts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(firsts, lambda i: F.slice(lengths, i, BLOCK))
    totals = fold(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, v: s + v)), zero)
    return F.flatten(F.zip_with(blocks, totals, lambda b, t: fold(b, t - F.aggregate(b, zero, lambda s, v: s + v))))


def located(rows: DataFrame, patterns: dict[str, str], keep: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``rows`` (with a column ``text``, which is dropped) and for each named pattern an
    array<struct<start, stop, value>> of its matches, leftmost and without overlap, in
    code points.  The gaps between matches give the places, so no position is searched
    for; texts without an accepted match are split by none.  ``keep`` names the
    patterns whose matches must be accepted.  Each step is a projection of its own, as
    an array that a lambda uses must be computed before it."""
    own = [c for c in rows.columns if c != "text"]
    t = F.col("text")
    found = rows.select("*", *[every(p)(t).alias(f"m_{k}") for k, p in patterns.items()])

    def lengths(k: str) -> Column:
        m = F.col(f"m_{k}")
        gaps = F.slice(F.split(t, patterns[k], -1), F.lit(1), F.size(m))
        sums = F.zip_with(gaps, m, lambda g, v: (F.length(g) + F.length(v)).cast("bigint"))
        some = F.exists(m, keep[k]) if k in keep else F.size(m) > 0
        return F.when(some, sums).otherwise(F.array().cast("array<bigint>"))
    measured = found.select(*own, *[f"m_{k}" for k in patterns], *[lengths(k).alias(f"l_{k}") for k in patterns])

    def spans(k: str) -> Column:
        s = F.zip_with(running_sum(F.col(f"l_{k}")), f"m_{k}", lambda e, v: F.struct(
            (e - F.length(v)).alias("start"), e.alias("stop"), v.alias("value")))
        s = F.filter(s, lambda x: x["stop"].isNotNull())        # no place was computed: none is accepted
        return F.filter(s, lambda x: keep[k](x["value"])) if k in keep else s
    return measured.select(*own, *[spans(k).alias(k) for k in patterns])


def assigned(match: Column) -> Column:
    """The value of an assignment."""
    return F.regexp_extract(match, ASSIGN, 1)


def long_value(match: Column) -> Column:
    return F.length(assigned(match)) >= LEAST_VALUE


def samples(texts: DataFrame) -> DataFrame:
    """(run, secret) of the distinct labelled strings of ``texts`` (one column,
    ``text``): values of base spans are secrets, runs shaped like an identifier are
    not, unless they are such a value elsewhere."""
    t = F.col("text")
    values = F.concat(F.transform(F.filter(every(ASSIGN)(t), long_value), assigned), every(ACCESS)(t), every(HEX)(t))
    labelled = F.concat(F.transform(values, lambda v: F.struct(v.alias("run"), F.lit(1).alias("secret"))),
                        F.transform(every(ORDINARY)(t), lambda v: F.struct(v.alias("run"), F.lit(0).alias("secret"))))
    return texts.select(F.inline(labelled)).groupBy("run").agg(F.max("secret").alias("secret"))


def pair_counts(strings: DataFrame) -> DataFrame:
    """(secret, before, after, n): how often a character follows another, by their
    places in the alphabet (0: the start); other characters are passed over."""
    place = lambda c: F.instr(F.lit(ALPHABET), c)
    chars = F.filter(F.transform(F.split("run", ""), place), lambda i: i > 0)
    path = F.concat(F.array(F.lit(0)), chars)
    steps = strings.select("secret", path.alias("path")).select(
        "secret", F.inline(F.zip_with(F.slice("path", 1, F.size("path") - 1), F.slice("path", 2, F.size("path")),
                                      lambda a, b: F.struct(a.alias("before"), b.alias("after")))))
    return steps.groupBy("secret", "before", "after").agg(F.count("*").alias("n"))


def log_ratios(counts: list) -> list[float]:
    """log P(after | before, random) - log P(after | before, ordinary) for each pair
    of places, as a flat table; rows of ``counts`` are (secret, before, after, n)."""
    wide = len(ALPHABET)
    n = {(s, a, b): k for s, a, b, k in counts}

    def chance(s: int, a: int, b: int, total: float) -> float:
        return (n.get((s, a, b), 0) + SMOOTH) / (total + SMOOTH * wide)
    out = []
    for a in range(STATES):
        total = [sum(n.get((s, a, b), 0) for b in range(1, STATES)) for s in (0, 1)]
        for b in range(STATES):
            random = (1 - ANY_ALPHABET) * chance(1, a, b, total[1]) + ANY_ALPHABET / wide
            out.append(math.log(random) - math.log(chance(0, a, b, total[0])) if b else 0.0)
    return out


def fit(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Learn from all texts.  At most 67 x 66 counts a class come to the driver."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return log_ratios([tuple(r) for r in pair_counts(samples(texts)).collect()])


def number_list(values: list[float]) -> Column:
    """The values as an array literal that the planner folds into one constant."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def log_odds(run: Column, table: Column) -> Column:
    """Log odds that a run is random, from the table of log ratios and the prior."""
    places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.struct(F.lit(math.log(PRIOR / (1 - PRIOR))).alias("sum"), F.lit(0).alias("at"))
    step = lambda acc, i: F.struct((acc["sum"] + F.element_at(table, acc["at"] * STATES + i + 1)).alias("sum"),
                                   i.alias("at"))
    return F.aggregate(places, start, step, lambda acc: acc["sum"])


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans), one row per row of ``docs``: spans are (start, kind, stop),
    by start and then kind (a place in ``KINDS``), in code points, ends exclusive.

    Base spans may overlap those of another kind.  A run that is itself a base span
    or the value of one is not given again as random.  A null text counts as empty
    and has no spans; ids are passed through, null and repeated ones too."""
    base = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = number_list(ratios)
    spans = located(rows, {**base, "run": RUN}, {"assign": long_value})
    code = lambda start, stop: start * F.lit(1 << 32) + stop
    held = F.concat(F.transform("assign", lambda s: code(s["stop"] - F.length(assigned(s["value"])), s["stop"])),
                    *[F.transform(k, lambda s: code(s["start"], s["stop"])) for k in ("access", "hex")])
    random = F.array_except(F.transform(F.filter("run", lambda s: log_odds(s["value"], table) > 0),
                                        lambda s: code(s["start"], s["stop"])), held)
    as_span = lambda k: lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["stop"].alias("stop"))
    added = F.transform(random, lambda c: F.struct(F.shiftright(c, 32).alias("start"), F.lit(3).alias("kind"),
                                                   c.bitwiseAND(F.lit((1 << 32) - 1)).alias("stop")))
    return spans.select("doc_id", F.sort_array(F.concat(*[F.transform(k, as_span(i)) for i, k in enumerate(base)], added))
                        .alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of every text, learned from the same texts."""
    found = scan(docs, fit(docs))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
