"""The configured matrix against plain rows."""

from recoloom.operators import matrix as MX
from recoloom.operators import models as M


def frame(spark):
    rows = [(1, 2.5, True, "b", ["x", "y"], [1.0, 0.0, 2.0], 7, {"k": 1}), (2, None, False, "a", ["y", "y"], [0.0, 3.0], 9, {}),
            (3, 0.0, None, None, [], None, None, None), (4, -1.0, True, "b", None, [], 7, None)]
    return spark.createDataFrame(rows, "id long, num double, flag boolean, word string, tags array<string>, emb array<double>, owner long, odd map<string,int>")


def test_rows_slots_and_report(spark):
    train, names = frame(spark), ["num", "flag", "word", "tags", "emb", "owner", "odd", "gone"]
    blocks = MX.fit(train, names, codes=("owner",))
    slots = {r.slot: r.name for r in MX.slot_names(spark, blocks).collect()}
    assert [slots[i] for i in range(len(slots))] == ["num", "flag", "word", "tags_x", "tags_y", "emb_dim_0", "emb_dim_1", "emb_dim_2", "owner"]
    other = spark.createDataFrame([(9, 1.0, False, "new", ["y", "new"], [1.0, 2.0, 3.0, 4.0], 8, None)], train.schema)
    got = {r.id: dict(zip(r.indices, r["values"])) for r in MX.assemble(train.union(other), blocks).collect()}
    assert got == {1: {0: 2.5, 1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 1.0, 7: 2.0}, 2: {4: 1.0, 6: 3.0, 8: 1.0},
                   3: {2: -1.0, 8: -1.0}, 4: {0: -1.0, 1: 1.0, 2: 1.0}, 9: {0: 1.0, 2: -1.0, 4: 1.0, 5: 1.0, 6: 2.0, 7: 3.0, 8: -1.0}}
    rep = {r.feature: (r.kind, r.first_slot, r.n_slots) for r in MX.report(spark, train, names, blocks).collect()}
    assert rep["odd"] == ("left out", None, 0) and rep["gone"] == ("missing", None, 0) and rep["emb"] == ("embedding", 5, 3)
    vectors = MX.as_vectors(MX.assemble(train, blocks), 9).orderBy("id").collect()
    assert vectors[0].features.toArray().tolist() == [2.5, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 2.0, 0.0]
    assert MX.assemble(train.limit(0), MX.fit(train.limit(0), names)).count() == 0


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    assert sorted((r.label, r.weight) for r in M.class_weights(df).collect()) == [(0, 1.0), (0, 1.0), (0, 1.0), (1, 3.0)]
    assert [r.weight for r in M.class_weights(df.where("label = 1")).collect()] == [1.0]
