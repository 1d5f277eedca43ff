"""The pipeline against its stages' definitions on small tables."""

import corpus_pipeline
import numpy as np
import public_tokenizers
from cases import components, documents, fingerprint, rule_counts
from tokenizers import Tokenizer

from recoloom.llm import mil_quality
from recoloom.llm.common import table

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf):
    out = []
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf)
        out.append(docs)
    return out


def test_stages_keep_what_they_should(spark):
    docs = table(spark, SF, "documents")
    first, second, third, packed = stages(spark, docs, SF)
    for df in (first, second, third):
        assert df.columns == docs.columns
    score = {r.doc_id: r.predicted for r in mil_quality.classify(docs, table(spark, SF, "labels")).collect()}
    a = {r.doc_id: r.text for r in first.collect()}
    assert set(a) == {i for i, p in score.items() if p}
    b = {r.doc_id: r.text for r in second.collect()}
    for i, t in a.items():
        n, *_, repeat = rule_counts(t)
        if n < 20 or 100 * repeat > 30 * n:
            assert i not in b
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    clean = [i for i, t in a.items() if labels.get(i) == 1 and rule_counts(t)[0] >= 40 and rule_counts(t)[4] == 0]
    assert np.mean([i in b for i in clean]) > 0.97
    ids = sorted(b)
    fps = [fingerprint(b[i]) for i in ids]
    root = components(len(ids), [(x, y) for x in range(len(ids)) for y in range(x) if bin(fps[x] ^ fps[y]).count("1") <= 4])
    c = {r.doc_id for r in third.collect()}
    assert c == {ids[r] for r in root}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packed.collect()
    total = {i: len(tok.encode(b[i], add_special_tokens=False).ids) + 1 for i in c}
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == total


def test_run_equals_the_stages(spark):
    docs = table(spark, SF, "documents")
    whole, last = ({tuple(r) for r in df.select("doc_id", "doc_tokens").collect()}
                   for df in (corpus_pipeline.run(spark, SF), stages(spark, docs, SF)[-1]))
    assert whole == last


def test_hostile_rows(spark):
    docs = documents(spark)
    *kept, packed = stages(spark, docs, SF)
    assert all(df.columns == docs.columns for df in kept)
    packed.collect()
    assert all(df.count() == 0 for df in stages(spark, docs.limit(0), SF))
