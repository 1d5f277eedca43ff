"""Splits and training-pair sampling (W-4, W-5, FLT-5, N-1..N-4, X-11, X-12, X-25, X-27).

Negative sampling never forms the users × posts product.  Posts get a dense
index 0..P-1; each user walks its own pseudo-random permutation of that
index, ``idx_j = (b_u + j * s_u) mod P`` with a per-user offset ``b_u`` and a
per-user stride ``s_u`` that is a prime larger than P (hence coprime with P,
so the walk visits every post once).  Taking the first ``k_u + n_u``
candidates (n_u = the user's positives) guarantees ``k_u`` non-positives, so
the sample is *exactly* "the first k_u non-positive posts of the user's
permutation": a uniform-looking sample without replacement, deterministic in
the seed, with O(k_u + n_u) work per user.  Long walks are cut in chunks so a
hot user is spread over many tasks, and the final "first k_u survivors" is a
prefix count over chunks plus a rank inside each (bounded) chunk.

The chronological split needs only two rank boundaries; they are found by
distributed selection over timestamp histograms (``keys_at_ranks``), so the
interaction fact is never globally sorted.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import (RANKING_NEGATIVE_RATIO, RETRIEVAL_NEGATIVES_PER_POSITIVE, RETRIEVAL_POSITIVE_TYPES,
                        SPLIT_RATIOS)
from ..functions.hashing import STRIDE_PRIMES, md5_bigint

MID_BITS = 33


def _partition_offsets(spark, totals: DataFrame, cols: dict[str, str]) -> tuple[DataFrame, dict]:
    """Exclusive running totals over partition ids.  ``totals`` has one row per
    partition (its size is the partition count, not the data), so — exactly as
    ``RDD.zipWithIndex`` does — the totals are brought to the driver, summed
    there, and returned as a small table to broadcast (plus the grand totals)."""
    rows = sorted(totals.collect(), key=lambda r: r["__pid"])
    types = {c: totals.schema[c].dataType.simpleString() for c in cols}
    run = {c: (0.0 if types[c] in ("double", "float") else 0) for c in cols}
    out = []
    for r in rows:
        out.append([int(r["__pid"])] + [run[c] for c in cols])
        for c in cols:
            run[c] += r[c] or 0
    schema = "__pid long, " + ", ".join(f"{o} {types[c]}" for c, o in cols.items())
    return spark.createDataFrame(out, schema), run


def broadcast_if_small(df: DataFrame, nbytes: int) -> DataFrame:
    """Broadcast hint behind a size check: ``nbytes`` is measured (checkpointed
    frames carry no statistics, so AQE cannot size them itself); above the
    session's broadcast threshold, as Spark itself parses it, the frame is left
    to a shuffle join."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if 0 <= nbytes <= limit else df


def dense_index_sized(df: DataFrame, order_cols: list[str], name: str = "idx") -> tuple[DataFrame, int]:
    """``dense_index`` plus the row count (known on the driver from the
    per-partition totals, so no extra job)."""
    spark = df.sparkSession
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    srt = (df.orderBy(*order_cols)
           .withColumn("__mid", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    pid = F.shiftright("__mid", MID_BITS)
    counts = srt.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    offsets, totals = _partition_offsets(spark, counts, {"__n": "__off"})
    out = (srt.join(F.broadcast(offsets), pid == F.col("__pid"))
           .withColumn(name, F.col("__off") + F.col("__mid").bitwiseAND(F.lit((1 << MID_BITS) - 1)))
           .drop("__mid", "__pid", "__off"))
    return out, int(totals["__n"])


def dense_index(df: DataFrame, order_cols: list[str], name: str = "idx") -> DataFrame:
    """Attach a 0-based dense rank over a total order, without a single-partition window.

    Global sort (range partitioning) → ``monotonically_increasing_id`` encodes
    (partition, position) → per-partition counts (one row per partition) →
    offsets → index.  The sorted frame is checkpointed first so counting and
    numbering see the same partitioning even if tasks are retried.
    """
    return dense_index_sized(df, order_cols, name)[0]


EPOCH = datetime(1970, 1, 1)


def _time(us: int) -> Column:
    return F.lit(EPOCH + timedelta(microseconds=us)).cast("timestamp_ntz")


def _key_before(ts: str, id_col: str, key) -> Column:
    """(ts, id) < key in (ts, id) order, nulls last in both; ``key`` None = +infinity."""
    if key is None:
        return F.lit(True)
    kt, ki = key
    smaller = F.col(id_col).isNotNull() if ki is None else F.coalesce(F.col(id_col) < F.lit(ki), F.lit(False))
    if kt is None:
        return F.col(ts).isNotNull() | smaller
    return F.coalesce((F.col(ts) < F.lit(kt)) | ((F.col(ts) == F.lit(kt)) & smaller), F.lit(False))


def _keys_by_splitters(df: DataFrame, col: str, ks: list[int], fan: int = 64, few: int = 4096) -> dict:
    """k -> the value with 0-based rank ``k`` among the non-null values of a column of
    any ordered type.  A band of values is cut at a hash-chosen sample of its distinct
    values and narrowed to the part that holds the rank, until it is one value or a few
    rows; each pass brings ``fan`` numbers to the driver."""
    out = {}
    for k in ks:
        band, below = F.col(col).isNotNull(), 0
        while True:
            rows = df.where(band).select(F.col(col).alias("v"))
            st = rows.agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).first()
            if st["a"] == st["b"] or st["n"] <= few:
                out[k] = st["a"] if st["a"] == st["b"] else rows.orderBy("v").limit(k - below + 1).collect()[k - below]["v"]
                break
            cuts = sorted(r["v"] for r in rows.distinct().orderBy(F.xxhash64("v")).limit(fan).collect())
            cell = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("v")))      # v in (cut before, cut]
            counts = {r["cell"]: r["n"] for r in rows.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
            for i in range(len(cuts) + 1):
                if below + counts.get(i, 0) > k:
                    band = band & (F.col(col) > F.lit(cuts[i - 1]) if i else F.lit(True)) & (F.col(col) <= F.lit(cuts[i]) if i < len(cuts) else F.lit(True))
                    break
                below += counts.get(i, 0)
    return out


def _values_at_ranks(df: DataFrame, value: Column, within, ks: list[int], lo: int, hi: int, buckets: int) -> dict[int, tuple[int, int]]:
    """k -> (value, rows below it) of the rows with 0-based ranks ``ks`` by an
    integer column: bands of values are cut into ``buckets`` and narrowed, all
    ranks at once, until each band is one value.  ``within(lo, hi)`` is the
    predicate of a half-open band, in a form that the scan can push down."""
    bands = {k: (lo, hi + 1, 0) for k in ks}
    while open_ := sorted({b for b in bands.values() if b[1] - b[0] > 1}):
        case, width = None, {}
        for i, (x, y, _) in enumerate(open_):
            width[i] = -(-(y - x) // buckets)
            inside = within(x, y)
            cell = F.struct(F.lit(i).alias("i"), F.floor((value - F.lit(x)) / F.lit(width[i])).alias("c"))
            case = F.when(inside, cell) if case is None else case.when(inside, cell)
        any_band = reduce(lambda p, q: p | q, [within(x, y) for x, y, _ in open_])
        counts = df.where(any_band).groupBy(case.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()   # <= ranks x buckets rows
        hist: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r["cell"]["i"], r["cell"]["c"])):
            hist.setdefault(r["cell"]["i"], []).append((int(r["cell"]["c"]), r["n"]))
        for k, band in bands.items():
            if band in open_:
                i, at = open_.index(band), band[2]
                for c, n in hist[i]:
                    if at + n > k:
                        x = band[0] + c * width[i]
                        bands[k] = (x, min(x + width[i], band[1]), at)
                        break
                    at += n
    return {k: (x, below) for k, (x, _, below) in bands.items()}


def keys_at_ranks(df: DataFrame, ts: str, id_col: str, ks: list[int], buckets: int = 4096) -> dict[int, tuple | None]:
    """k -> the (ts, id) key of the row with 0-based rank ``k`` in (ts, id) order with
    nulls last in both, None past the end: distributed selection, no sort of the data.

    Bands of timestamps are histogrammed and narrowed for all ranks in the same
    passes (band predicates compare the column with timestamp literals, so they
    reach the scan); rows of one timestamp are then selected by id: integers the same
    way, ids of any other ordered type by sampled splitters.
    Passes <= log_buckets(time range in us) + log_buckets(id range).
    """
    integers = isinstance(df.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    us, i = F.unix_micros(F.col(ts).cast("timestamp")), F.col(id_col).cast("bigint") if integers else F.lit(0)
    st = df.agg(F.count(ts).alias("n"), F.count(F.lit(1)).alias("all"), F.min(us).alias("a"), F.max(us).alias("b")).first()
    timed = [k for k in ks if k < st["n"]]
    by_time: dict = {}
    if timed:
        inside = lambda x, y: (F.col(ts) >= _time(x)) & (F.col(ts) < _time(y))
        by_time = _values_at_ranks(df, us, inside, timed, st["a"], st["b"], buckets)
    groups: dict = {}
    for k in ks:
        if k in by_time:
            groups.setdefault(by_time[k][0], []).append((k, by_time[k][1]))
        elif k < st["all"]:
            groups.setdefault(None, []).append((k, st["n"]))
    out: dict[int, tuple | None] = {k: None for k in ks}
    for t, members in groups.items():
        same = df.where(F.col(ts).isNull() if t is None else F.col(ts) == _time(t))
        r = same.agg(F.min(i).alias("a"), F.max(i).alias("b"), F.count(id_col).alias("n")).first()
        ranks = [k - below for k, below in members if k - below < r["n"]]                   # beyond: rows without an id
        if integers:
            found = {k: v for k, (v, _) in _values_at_ranks(same, i, lambda x, y: (i >= x) & (i < y), ranks, r["a"], r["b"], buckets).items()}
        else:
            found = _keys_by_splitters(same, id_col, ranks)
        for k, below in members:
            out[k] = (None if t is None else EPOCH + timedelta(microseconds=t), found.get(k - below))
    return out


def key_at_rank(df: DataFrame, ts: str, id_col: str, k: int, buckets: int = 4096):
    return keys_at_ranks(df, ts, id_col, [k], buckets)[k]


def chronological_split(df: DataFrame, ts: str, id_col: str, train: float = SPLIT_RATIOS[0],
                        validation: float = SPLIT_RATIOS[1]) -> DataFrame:
    """Label rows train / validation / test by global time order (W-4).

    ``n_train = floor(n·train)``, ``n_val = floor(n·validation)``, test = rest;
    rows without a time come last, ties in time are broken by ``id_col`` (of any
    ordered type; rows without an id last, and rows equal in both stay together, in
    the later part).  The two boundary keys are found together by distributed selection
    (``keys_at_ranks``); labelling is then a per-row comparison — the data itself
    is never sorted or shuffled.
    """
    n = df.select(F.count(F.lit(1))).first()[0]
    k1 = math.floor(n * train)
    k2 = k1 + math.floor(n * validation)
    at = keys_at_ranks(df, ts, id_col, [k1, k2])
    return df.withColumn("split", F.when(_key_before(ts, id_col, at[k1]), "train")
                         .when(_key_before(ts, id_col, at[k2]), "validation").otherwise("test"))


def split_entities(inter_split: DataFrame, posts: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Entities of each split (FLT-5, J-4, SET-1, SET-2): users = rows of the
    users table that acted in the split or created one of its posts; posts =
    rows of the posts table interacted with in the split.  Long form
    (split, entity, id); an entity may belong to several splits."""
    actors = inter_split.select("split", F.col("user_id").alias("id"))
    touched = inter_split.select("split", "post_id").distinct()
    creators = (touched.join(posts.select("post_id", "creator_id"), "post_id")
                .select("split", F.col("creator_id").alias("id")))
    us = actors.unionByName(creators).distinct()
    if users is not None:
        us = us.join(users.select(F.col("user_id").alias("id")), "id", "left_semi")
    us = us.withColumn("entity", F.lit("user"))
    ps = (touched.join(posts.select("post_id"), "post_id", "left_semi")
          .select("split", F.col("post_id").alias("id")).withColumn("entity", F.lit("post")))
    return us.unionByName(ps).select("split", "entity", "id")


def hash_split(df: DataFrame, key_cols: list[str], fractions=(0.8, 0.1, 0.1),
               names=("train", "validation", "test"), seed: int = 42) -> DataFrame:
    """Repeatable random split by a hash of the key (X-27): no shuffle at all."""
    u = (md5_bigint(*key_cols, seed=seed) % F.lit(1_000_000)).cast("double") / F.lit(1e6)
    bounds, acc = [], 0.0
    for f in fractions[:-1]:
        acc = round(acc + f, 9)
        bounds.append(acc)
    expr = None
    for b, nm in zip(bounds, names):
        expr = F.when(u < b, nm) if expr is None else expr.when(u < b, nm)
    return df.withColumn("split", expr.otherwise(names[-1]))


def _permutation_sample(params: DataFrame, universe_idx: DataFrame, exclude: DataFrame | None,
                        chunk: int, group: str | None = None) -> DataFrame:
    """Core walk.  ``params``: (user_id, [group], k, m, b, s, P) per walk;
    ``universe_idx``: (post_id, [group], idx); ``exclude``: (user_id, post_id)
    pairs to skip or None.  Returns (user_id, [group], post_id, j) — the first k
    admissible candidates of each walk.
    """
    walk = ["user_id"] + ([group] if group else [])
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(params.sparkSession)
    starts = (params.where(F.col("m") > 0)
              .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1,
                                                F.lit(chunk).cast("bigint"))).alias("c0"))
              .repartition(*walk, "c0"))          # spread a hot user's chunks over tasks
    cand = starts.select(
        *walk, "k", "c0",
        F.explode(F.sequence(F.col("c0"), F.least(F.col("c0") + chunk, F.col("m")) - 1)).alias("j"),
        "b", "s", "P")
    cand = cand.select(*walk, "k", "c0", "j",
                       ((F.col("b") + F.col("j") * (F.col("s") % F.col("P"))) % F.col("P")).alias("idx"))
    cand = cand.join(universe_idx, ([group] if group else []) + ["idx"])
    if exclude is not None:
        cand = cand.join(exclude, ["user_id", "post_id"], "left_anti")
    # each chunk (at most ``chunk`` candidates) becomes one row, written once: how
    # many survive in the chunks before it decides what each chunk may give
    chunks = (cand.groupBy(*walk, "c0").agg(F.first("k").alias("k"), F.sort_array(F.collect_list(F.struct("j", "post_id"))).alias("got"))
              .checkpoint(eager=True))
    n_c = F.size("got").cast("bigint")
    before = chunks.select(*walk, "c0", (F.sum(n_c).over(Window.partitionBy(*walk).orderBy("c0")) - n_c).alias("before"))
    left = F.greatest(F.col("k") - F.col("before"), F.lit(0)).cast("int")
    return (chunks.join(before, [*walk, "c0"]).where(F.col("before") < F.col("k"))
            .select(*walk, F.inline(F.slice("got", F.lit(1), left)))
            .select(*walk, "post_id", "j"))


def _walk_params(users: DataFrame, P: Column, seed: int, key: tuple = ("user_id",)) -> DataFrame:
    h = md5_bigint(*key, seed=seed)
    primes = F.array(*[F.lit(p).cast("bigint") for p in STRIDE_PRIMES])
    return users.select("*", (h % P).alias("b"),
                        F.element_at(primes, (F.shiftright(h, 8) % len(STRIDE_PRIMES) + 1).cast("int")).alias("s"),
                        P.alias("P"))


def ranking_negatives(positives: DataFrame, posts: DataFrame, ratio: int = RANKING_NEGATIVE_RATIO, seed: int = 42,
                      chunk: int = 4096) -> DataFrame:
    """N-1: per user with ≥1 positive, ``min(ratio·n_pos, n_avail)`` posts sampled
    without replacement from all posts minus the user's positives; label 0;
    timestamp = the user's latest positive timestamp.  Users with no
    remaining post are skipped."""
    pidx, n_posts = dense_index_sized(posts.select("post_id").distinct(), ["post_id"])
    pidx = broadcast_if_small(pidx, n_posts * 24)
    P = F.lit(n_posts).cast("bigint")
    pos = positives.select("user_id", "post_id", "timestamp")
    pos_set = pos.select("user_id", "post_id").distinct()
    in_universe = pos_set.join(pidx.select("post_id"), "post_id", "left_semi")
    stats = (pos.groupBy("user_id").agg(F.count_distinct("post_id").alias("n_pos"),
                                        F.max("timestamp").alias("timestamp"))
             .join(in_universe.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_in")), "user_id", "left")
             .fillna(0, ["n_in"]))
    k = F.least(F.col("n_pos") * ratio, P - F.col("n_in"))
    params = _walk_params(stats.select("user_id", "timestamp", k.alias("k"),
                                       F.least(k + F.col("n_in"), P).alias("m")), P, seed)
    got = _permutation_sample(params.drop("timestamp"), pidx, in_universe, chunk)
    return (got.join(stats.select("user_id", "timestamp"), "user_id")
            .select("user_id", "post_id", F.lit(0).alias("label"), "timestamp"))


def retrieval_pairs(inter: DataFrame, universe: DataFrame | None = None,
                    positive_types=RETRIEVAL_POSITIVE_TYPES,
                    per_positive: int = RETRIEVAL_NEGATIVES_PER_POSITIVE,
                    seed: int = 42, chunk: int = 4096) -> DataFrame:
    """N-2: distinct positive (user, post) pairs labelled 1, plus per user
    ``min(n_avail, 5·n_pos)`` negatives from the post universe (default: posts
    seen in interactions); a user whose positives cover the universe gets
    ``min(P, 5)`` posts sampled from the whole universe instead."""
    if universe is None:
        universe = inter.select("post_id").where(F.col("post_id").isNotNull()).distinct()
    uidx, n_posts = dense_index_sized(universe.select("post_id").distinct(), ["post_id"])
    uidx = broadcast_if_small(uidx, n_posts * 24)
    P = F.lit(n_posts).cast("bigint")
    pos = (inter.where(F.col("interaction_type").isin(list(positive_types)))
           .select("user_id", "post_id").distinct())
    pos_in = pos.join(uidx.select("post_id"), "post_id", "left_semi")
    stats = (pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos"))
             .join(pos_in.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_in")), "user_id", "left")
             .fillna(0, ["n_in"]))
    avail = P - F.col("n_in")
    k = F.least(avail, F.col("n_pos") * per_positive)
    normal = stats.where(avail > 0).select("user_id", k.alias("k"), F.least(k + F.col("n_pos"), P).alias("m"))
    fallback = stats.where(avail <= 0).select("user_id", F.least(P, F.lit(per_positive)).alias("k"))
    fallback = fallback.select("user_id", "k", F.col("k").alias("m"))
    # one walk for both kinds of user: fallback users (positives cover the whole
    # universe) sample from everything, so their positives are not excluded
    exclude = pos_in.join(fallback.select("user_id"), "user_id", "left_anti")
    walks = _walk_params(normal.unionByName(fallback), P, seed)
    negs = _permutation_sample(walks, uidx, exclude, chunk).select("user_id", "post_id", F.lit(0).alias("label"))
    return pos.select("user_id", "post_id", F.lit(1).alias("label")).unionByName(negs)


def sample_per_group(df: DataFrame, group: list[str], n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """W-5: n rows per group without replacement, hash-ordered (deterministic).
    ``row_number() <= n`` plans a partial+final WindowGroupLimit, so each task
    keeps at most n rows per group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(md5_bigint(*key_cols, seed=seed), *key_cols)
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def random_negatives(pos: DataFrame, users: DataFrame, posts: DataFrame, ratio: int = 10,
                     seed: int = 42) -> DataFrame:
    """X-25: negatives with replacement, user and post drawn independently:
    ``ratio`` rows per positive, each picking a user index and a post index by hash
    and looking both up in dense-numbered id tables (two equi-joins, no product)."""
    uidx, nu = dense_index_sized(users.select("user_id").distinct(), ["user_id"], "uidx")
    pidx, npo = dense_index_sized(posts.select("post_id").distinct(), ["post_id"], "pidx")
    uidx, pidx = broadcast_if_small(uidx, nu * 24), broadcast_if_small(pidx, npo * 24)
    rows = pos.select(F.col("user_id").alias("src_user"), F.col("post_id").alias("src_post"),
                      F.explode(F.sequence(F.lit(0), F.lit(ratio - 1))).alias("r"))
    rows = rows.select("src_user", "src_post", "r",
                       (md5_bigint("src_user", "src_post", "r", seed=f"{seed}u") % nu).alias("uidx"),
                       (md5_bigint("src_user", "src_post", "r", seed=f"{seed}p") % npo).alias("pidx"))
    return (rows.join(uidx, "uidx").join(pidx, "pidx")
            .select("src_user", "src_post", "r", "user_id", "post_id", F.lit(0).alias("label")))


def exclusive_prefix_sums(df: DataFrame, order_cols: list[str], value_cols: list[str],
                          prefix: str = "before_") -> DataFrame:
    """Global running totals in ``order_cols`` order, distributed.

    Sort (range partitions) → checkpoint → per-partition running sums in one
    Arrow pass (``mapInPandas`` keeps the partitioning, no shuffle) →
    per-partition totals (one row per partition) → offsets added back.
    """
    import pandas as pd
    from pyspark.sql import types as T

    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    srt = df.orderBy(*order_cols).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    fields = list(srt.schema.fields) + [T.StructField(prefix + c, T.DoubleType()) for c in value_cols]
    schema = T.StructType(fields)

    def local(batches):
        run = {c: 0.0 for c in value_cols}
        for pdf in batches:
            out = pdf.copy()
            for c in value_cols:
                v = pd.to_numeric(pdf[c]).astype("float64").fillna(0.0)
                cs = v.cumsum() + run[c]
                out[prefix + c] = cs - v
                if len(v):
                    run[c] = float(cs.iloc[-1])
            yield out

    loc = srt.mapInPandas(local, schema)
    totals = srt.groupBy("__pid").agg(*[F.sum(F.col(c).cast("double")).alias("__t_" + c) for c in value_cols])
    offs, _ = _partition_offsets(df.sparkSession, totals, {"__t_" + c: "__o_" + c for c in value_cols})
    res = loc.join(F.broadcast(offs), "__pid")
    for c in value_cols:
        res = res.withColumn(prefix + c, F.col(prefix + c) + F.coalesce(F.col("__o_" + c), F.lit(0.0)))
    return res.drop("__pid", *["__o_" + c for c in value_cols])


def hard_negatives(positives: DataFrame, users: DataFrame, posts: DataFrame, per_category: int = 3,
                   prefs: str = "onboarding_category_ids", seed: int = 42, chunk: int = 4096) -> DataFrame:
    """X-12: negatives biased to the user's preferred categories — for every
    (user with positives, preferred category), ``min(per_category, n_avail)``
    non-positive posts of that category, drawn by a permutation walk over the
    category's own dense post index (so a hot category is never paired
    wholesale with its users)."""
    gidx = dense_index(posts.select("category_id", "post_id").distinct(), ["category_id", "post_id"], "gi")
    first = gidx.groupBy("category_id").agg(F.min("gi").alias("g0"), F.count(F.lit(1)).alias("P"))
    uidx = gidx.join(first, "category_id").select("category_id", "post_id", (F.col("gi") - F.col("g0")).alias("idx"))
    pos = positives.select("user_id", "post_id").distinct()
    pos_cat = pos.join(posts.select("post_id", "category_id"), "post_id")
    n_in = pos_cat.groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("n_in"))
    active = pos.select("user_id").distinct()
    uc = (users.join(active, "user_id", "left_semi")
          .select("user_id", F.explode(F.array_distinct(prefs)).alias("category_id"))
          .join(first.select("category_id", "P"), "category_id")
          .join(n_in, ["user_id", "category_id"], "left").fillna(0, ["n_in"]))
    k = F.least(F.lit(per_category).cast("bigint"), F.col("P") - F.col("n_in"))
    params = uc.select("user_id", "category_id", "P", k.alias("k"), F.least(k + F.col("n_in"), F.col("P")).alias("m"))
    h = md5_bigint("user_id", "category_id", seed=seed)
    primes = F.array(*[F.lit(p).cast("bigint") for p in STRIDE_PRIMES])
    params = params.select("*", (h % F.col("P")).alias("b"),
                           F.element_at(primes, (F.shiftright(h, 8) % len(STRIDE_PRIMES) + 1).cast("int")).alias("s"))
    got = _permutation_sample(params, uidx, pos, chunk, group="category_id")
    return got.select("user_id", "category_id", "post_id", F.lit(0).alias("label"))
