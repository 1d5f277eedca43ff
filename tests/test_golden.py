"""Layer 1: golden mini-fixtures (FIXTURES.md §3-§5)."""

import datetime as dt

from pyspark.sql import functions as F

from recoloom.operators import asof, encoding as E, rerank as R
from recoloom.operators.store import Entity, FeatureStore, FeatureView, OnDemandView, Source


def test_seen_filter_cases(spark):
    store = spark.createDataFrame(
        [("user_filter_test_1", "post_101", "seen"), ("user_filter_test_1", "post_102", "disliked"),
         ("user_filter_test_1", "post_103", "seen"), ("user_filter_test_2", "post_201", "reported"),
         ("user1", "post_A", "seen"), ("user1", "post_C", "disliked")],
        "user_id string, post_id string, interaction_type string")
    cands = [f"post_{i}" for i in (100, 101, 102, 103, 104, 105, 201, 202)]
    rows = [(u, p, i) for u in ("user_filter_test_1", "user_filter_test_2", "user_with_no_interactions")
            for i, p in enumerate(cands)]
    rows += [("user1", p, i) for i, p in enumerate(["post_A", "post_B", "post_C", "post_D"])]
    c = spark.createDataFrame(rows, "user_id string, post_id string, cand_rank int")
    out = R.seen_filter(c, store).orderBy("user_id", "cand_rank").collect()
    got = {}
    for r in out:
        got.setdefault(r.user_id, []).append(r.post_id)
    assert got["user_filter_test_1"] == ["post_100", "post_104", "post_105", "post_201", "post_202"]
    assert got["user_filter_test_2"] == ["post_100", "post_101", "post_102", "post_103", "post_104", "post_105",
                                         "post_202"]
    assert got["user_with_no_interactions"] == cands
    assert got["user1"] == ["post_B", "post_D"]
    empty = spark.createDataFrame([], "user_id string, post_id string, cand_rank int")
    assert R.seen_filter(empty, store).count() == 0


def _rerank(spark, rows, n, f):
    df = spark.createDataFrame(rows, "user_id string, post_id string, score double, category_id string, cand_rank int")
    return [r.post_id for r in R.diverse_rerank(df, n=n, factor=f).orderBy("rank").collect()]


def test_rerank_caps_and_dominance(spark):
    rows = [("u", f"x{i}", 1 - i / 100, "A" if i < 12 else ("B" if i < 15 else "C"), i) for i in range(18)]
    assert _rerank(spark, rows, 10, 0.3) == ["x0", "x1", "x2", "x3", "x4", "x12", "x13", "x14", "x15", "x16"]


def test_rerank_reference_smoke_input(spark):
    # 42 posts A..L then M_i, N_i, O_i; exact decimal scores with input-position ties
    names = [chr(ord("A") + i) for i in range(12)] + [f"{c}{i}" for i in range(10) for c in "MNO"]
    base = [.95, .92, .90, .88, .85, .82, .80, .78, .75, .72, .70, .68]
    scores = base + [round(s - .01 * i, 2) for i in range(10) for s in (.65, .64, .63)]
    now = dt.datetime(2024, 1, 1)

    def age(i):
        if i < 10:
            return dt.timedelta(hours=2 * i + 1)
        if i < 21:
            return dt.timedelta(days=i - 9)
        return dt.timedelta(days=30 + (i - 21))
    rows = [("u", p, s, f"cat_{i % 3 + 1}", now - age(i), i) for i, (p, s) in enumerate(zip(names, scores))]
    df = spark.createDataFrame(rows, "user_id string, post_id string, base double, category_id string, "
                                     "creation_timestamp timestamp_ntz, cand_rank int")
    ref = F.lit(now).cast("timestamp_ntz")
    boosted = df.withColumn("score", F.round(R.freshness_boost(F.col("base"), F.col("creation_timestamp"),
                                                               ref, 48.0, 1.2), 9))
    got = [r.post_id for r in R.diverse_rerank(boosted, n=20, factor=0.3).orderBy("rank").collect()]
    assert got == ["A", "B", "C", "D", "E", "F", "G", "H", "I", "J", "K", "L", "M0", "N0", "M1", "O0", "N1", "M2",
                   "O1", "N2"]


def test_rerank_edges(spark):
    one_cat = [("u", f"p{i}", 1 - i / 10, "A", i) for i in range(6)]
    assert _rerank(spark, one_cat, 4, 0.2) == ["p0", "p1", "p2", "p3"]          # cap 1, then fill from skipped
    assert _rerank(spark, one_cat, 1, 0.2) == ["p0"]
    assert _rerank(spark, one_cat[:2], 5, 0.2) == ["p0", "p1"]                  # fewer candidates than N
    missing = spark.createDataFrame([("u", "p0", 0.5, None, 0)],
                                    "user_id string, post_id string, score double, category_id string, cand_rank int")
    out = R.diverse_rerank(missing, n=3).collect()
    assert out[0].category_id == R.UNKNOWN_CATEGORY
    empty = spark.createDataFrame([], "user_id string, post_id string, score double, category_id string, cand_rank int")
    assert R.diverse_rerank(empty).count() == 0


def test_diversity_cap_in_double():
    assert R.diversity_cap(20, 0.3) == 10
    assert R.diversity_cap(20, 0.2) == 8
    assert R.diversity_cap(1, 0.2) == 1


def test_request_time_features(spark):
    feats = spark.createDataFrame([(1001, dt.datetime(2021, 4, 12, 10, 59, 42), 1, 1.0)],
                                  "driver_id long, event_timestamp timestamp_ntz, created long, conv_rate double")
    view = FeatureView("driver_hourly_stats", (Entity("driver", ("driver_id",)),),
                       Source(lambda: feats, "event_timestamp", "created"), ("conv_rate",))
    od = OnDemandView("transformed_conv_rate", {
        "conv_rate_plus_val1": lambda: F.col("driver_hourly_stats__conv_rate") + F.col("val_to_add"),
        "conv_rate_plus_val2": lambda: F.col("driver_hourly_stats__conv_rate") + F.col("val_to_add_2")})
    fs = FeatureStore([view], [od])
    ent = spark.createDataFrame([(1001, dt.datetime(2021, 4, 12, 11, 0), 1000, 2000)],
                                "driver_id long, event_timestamp timestamp_ntz, val_to_add long, val_to_add_2 long")
    r = fs.get_historical_features(ent, ["driver_hourly_stats:conv_rate", "transformed_conv_rate:conv_rate_plus_val1",
                                         "transformed_conv_rate:conv_rate_plus_val2"]).first()
    assert r["transformed_conv_rate__conv_rate_plus_val1"] == 1001.0
    assert r["transformed_conv_rate__conv_rate_plus_val2"] == 2001.0


def test_asof_ttl_cases(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    feats = spark.createDataFrame([(1, t, 7.0, 1)], "k long, fts timestamp_ntz, v double, created long")
    probes = [t, t - dt.timedelta(minutes=1), t + dt.timedelta(days=1),
              t + dt.timedelta(days=1, minutes=1)]
    ent = spark.createDataFrame([(i, 1, p) for i, p in enumerate(probes)], "id long, k long, ets timestamp_ntz")
    out = asof.point_in_time_join(ent, feats, "k", "ets", "fts", ["v"], "created", ttl="1 day")
    assert [r.v for r in out.orderBy("id").collect()] == [7.0, None, 7.0, None]


def test_asof_tie_on_created(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    feats = spark.createDataFrame([(1, t, 1.0, 5), (1, t, 2.0, 9), (1, t, 3.0, 7)],
                                  "k long, fts timestamp_ntz, v double, created long")
    ent = spark.createDataFrame([(1, t + dt.timedelta(hours=1))], "k long, ets timestamp_ntz")
    assert asof.point_in_time_join(ent, feats, "k", "ets", "fts", ["v"], "created").first().v == 2.0


def test_category_flag_and_smoke_scorer(spark):
    df = spark.createDataFrame([(["10", "20", "30"], c) for c in ("10", "99", "20", "40")],
                               "prefs array<string>, cat string")
    flag = R.in_list_flag(F.col("cat"), F.col("prefs"))
    rows = df.select(flag.alias("f"), R.smoke_score(flag).alias("s")).collect()
    assert [r.f for r in rows] == [1, 0, 1, 0]
    assert [r.s for r in rows] == [0.8, 0.3, 0.8, 0.3]
    nul = spark.createDataFrame([(None, "10")], "prefs array<string>, cat string")
    assert nul.select(R.in_list_flag(F.col("cat"), F.col("prefs"))).first()[0] == 0


def test_list_literal(spark):
    df = spark.createDataFrame([("['cat_01', 'cat_05']",), ("not a list",), (None,)], "s string")
    got = [r[0] for r in df.select(E.parse_string_list(F.col("s"))).collect()]
    assert got == [["cat_01", "cat_05"], [], []]


def test_vocabulary(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "v string")
    vocab = E.vocabulary(df, "v")
    out = E.apply_vocabulary(df, "v", vocab, "idx").collect()
    assert {r.v: r.idx for r in out} == {"a": 1, "b": 2, "c": 3, None: 0}


def test_creation_time_parsing(spark):
    df = spark.createDataFrame([("2024-05-01T10:00:00Z",), ("1714557600",), ("bad",),
                                ("2024-05-01 12:00:00.000000+0200",)], "s string")
    got = [r[0] for r in df.select(E.parse_timestamp(F.col("s"))).collect()]
    want = dt.datetime(2024, 5, 1, 10, 0)
    assert got == [want, want, None, want]


def test_split_sizes(spark):
    from recoloom.operators import sampling as SM
    df = spark.range(10000).select(F.col("id"), (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
                                                 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                      F.col("id") % 977)).alias("ts"))
    out = SM.chronological_split(df.repartition(7), "ts", "id")
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 7000, "validation": 1500, "test": 1500}


def test_request_time_features_pandas_variant(spark):
    from recoloom.operators.store import OnDemandPandasView
    feats = spark.createDataFrame([(1001, dt.datetime(2021, 4, 12, 10, 59, 42), 1, 1.0)],
                                  "driver_id long, event_timestamp timestamp_ntz, created long, conv_rate double")
    view = FeatureView("driver_hourly_stats", (Entity("driver", ("driver_id",)),),
                       Source(lambda: feats, "event_timestamp", "created"), ("conv_rate",))

    def plus(pdf):
        import pandas as pd
        return pd.DataFrame({"conv_rate_plus_val1": pdf["driver_hourly_stats__conv_rate"] + pdf["val_to_add"],
                             "conv_rate_plus_val2": pdf["driver_hourly_stats__conv_rate"] + pdf["val_to_add_2"]})
    od = OnDemandPandasView("transformed_conv_rate", plus,
                            {"conv_rate_plus_val1": "double", "conv_rate_plus_val2": "double"})
    fs = FeatureStore([view], [od])
    ent = spark.createDataFrame([(1001, dt.datetime(2021, 4, 12, 11, 0), 1000, 2000)],
                                "driver_id long, event_timestamp timestamp_ntz, val_to_add long, val_to_add_2 long")
    r = fs.get_historical_features(ent, ["driver_hourly_stats:conv_rate", "transformed_conv_rate:conv_rate_plus_val1",
                                         "transformed_conv_rate:conv_rate_plus_val2"]).first()
    assert (r["transformed_conv_rate__conv_rate_plus_val1"], r["transformed_conv_rate__conv_rate_plus_val2"]) == \
        (1001.0, 2001.0)


def test_rerank_without_metadata_is_plain_score_order(spark):
    rows = [("u", f"p{i}", 1 - i / 50, None, i) for i in range(30)]
    assert _rerank(spark, rows, 20, 0.3) == [f"p{i}" for i in range(20)]


def test_asof_hot_key_is_cut_into_ranges(spark):
    """A key that holds most rows, most of them in one burst, spans many ranges;
    results equal the plain window."""
    import random
    rnd = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    minute = lambda: 777 if rnd.random() < 0.6 else rnd.randint(0, 20000)
    feats = [(k, t0 + dt.timedelta(minutes=minute()), float(i), i)
             for i in range(600) for k in ([1] if i % 3 else [rnd.randint(2, 9)])]
    ents = [(i, k, t0 + dt.timedelta(minutes=minute()))
            for i in range(500) for k in ([1] if i % 2 else [rnd.randint(2, 9), None][:1 + (i % 50 == 0)])]
    ents += [(1000, 77, t0), (1001, None, t0)]
    feats += [(None, t0, -1.0, 0), (1, None, -2.0, 0), (None, None, -3.0, 0)]
    ents += [(1002, 1, None), (1003, None, None)]
    fd = spark.createDataFrame(feats, "k long, fts timestamp_ntz, v double, created long")
    ed = spark.createDataFrame(ents, "id long, k long, ets timestamp_ntz")
    for ttl in (None, "2 days"):
        want = []
        for i, k, at in ents:
            fit = [f for f in feats if k is not None and at is not None and f[0] == k and f[1] is not None and f[1] <= at]
            last = max(fit, key=lambda f: (f[1], f[3]), default=None)
            if last is not None and ttl and last[1] < at - dt.timedelta(days=2):
                last = None
            want.append((i, k, last and last[2], last and last[1]))
        want.sort(key=str)
        for parts in (1, 7, 60):
            got = asof.point_in_time_join(ed, fd, "k", "ets", "fts", ["v"], "created", ttl, partitions=parts)
            assert sorted(((r.id, r.k, r.v, r.fts) for r in got.collect()), key=str) == want, (ttl, parts)
    assert len(want) == len(ents)
    assert asof.point_in_time_join(ed.limit(0), fd, "k", "ets", "fts", ["v"], "created").count() == 0
    assert asof.point_in_time_join(ed, fd.limit(0), "k", "ets", "fts", ["v"], "created").count() == len(ents)
