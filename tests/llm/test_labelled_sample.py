"""The classifiers' sample beside very long labelled texts."""

from pyspark.sql import functions as F

from recoloom.llm.common import labelled_sample


def sample(spark, texts, quality, max_bytes):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(quality)), "doc_id long, quality int")
    return labelled_sample(docs, labels, "quality", len(texts), max_bytes=max_bytes)


def by_hash(spark, n):
    return [r["id"] for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]


def test_a_very_long_text_does_not_end_the_sample(spark):
    first = by_hash(spark, 200)[0]
    texts = ["x" * 5000 if i == first else f"text {i}" for i in range(200)]
    got = sample(spark, texts, [i % 2 for i in range(200)], 4000)
    assert len(got) == 199 and {y for _, y in got} == {0, 1} and sum(len(t) for t, _ in got) <= 4000


def test_a_long_text_that_fits_comes_last(spark):
    first = by_hash(spark, 200)[0]
    texts = ["x" * 3900 if i == first else f"text {i}" for i in range(200)]
    got = sample(spark, texts, [i % 2 for i in range(200)], 4000)
    assert len(got) == 199
    assert len(sample(spark, ["x" * 300] * 20, [1] * 20, 4000)) == 13              # all long: as many as fit


def test_a_rare_label_is_kept(spark):
    last = by_hash(spark, 200)[-1]
    got = sample(spark, ["y" * 50] * 200, [int(i == last) for i in range(200)], 2040)
    assert len(got) == 40 and sum(y for _, y in got) == 1
