"""BPE, ORC token files and packing against the tokenizers library."""

import hashlib
import os

import shutil
import numpy as np
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
import public_tokenizers  # noqa: E402
from cases import LONG, TEXTS, crc, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from recoloom.llm import bpe, orc_tokens, packing  # noqa: E402
from recoloom.llm.common import shared_path  # noqa: E402
from recoloom.llm.library_words import LibraryEncoder  # noqa: E402
from recoloom.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def wanted(name, texts):
    return [e.ids for e in library(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("make,name", [(bpe.BpeCodec, LOWER), (LibraryEncoder, LOWER), (LibraryEncoder, BYTE)])
def test_ids_equal_the_library(make, name):
    got = make(name).encode([t or "" for t in TEXTS])
    assert [g.tolist() for g in got] == wanted(name, TEXTS)


def test_table_that_is_always_full_changes_nothing():
    c = bpe.BpeCodec(LOWER)
    c.encode.limit = 10
    for _ in range(2):
        assert [g.tolist() for g in c.encode([t or "" for t in TEXTS])] == wanted(LOWER, TEXTS)


def test_long_words_merge_like_the_library():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("thein aorsé"), n)).replace(" ", "") for n in (1, 2, 3, 50, 400, 3000)] + ["a" * 999, "ab" * 500]
    c = bpe.BpeCodec(LOWER)
    assert [g.tolist() for g in c.encode(words)] == wanted(LOWER, words)


def test_bpe_digests_and_decode(spark):
    docs = documents(spark)
    ref = library(LOWER)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode_digests(docs).collect()}
    want = set()
    for r in docs.collect():
        ids = ref.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want
    encoded = bpe.encode(docs)
    texts = {r.doc_id: r.text for r in bpe.decode(encoded).collect()}
    assert all(texts[i] == ref.decode(ids, skip_special_tokens=False) for i, ids in enumerate(wanted(LOWER, TEXTS)))
    assert encoded.count() == docs.count()
    assert bpe.encode_decode_digests(docs.limit(0)).count() == 0


def test_op2_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r.ids_sha256 for r in QUERIES["op2_bpe"](spark, SF).collect()}
    ids = wanted(LOWER, [r.text for r in docs])
    assert got == {r.doc_id: hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for r, x in zip(docs, ids)}


def test_op6_whole_table(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    ids = [x + [2] for x in wanted(LOWER, [r.text for r in docs])]
    starts = np.cumsum([0, *map(len, ids)])
    got = {tuple(r) for r in QUERIES["op6_orc_tokens"](spark, SF).collect()}
    assert got == {(r.doc_id, int(s), len(x), crc(x)) for r, s, x in zip(docs, starts, ids)}


def test_orc_files_hostile_rows_and_lookup(spark):
    docs = documents(spark)
    path = shared_path(spark, "test-tokens")
    orc_tokens.write_token_files(docs, path)
    rows = orc_tokens.read_token_files(spark, path).collect()
    assert len(rows) == docs.count()
    order = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in order:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        at += r.n_tokens
    want = wanted(LOWER, TEXTS)
    found = orc_tokens.lookup(spark, path, [7, 9])
    assert {r.doc_id: list(r.ids) for r in found.collect()} == {i: want[i] + [2] for i in (7, 9)}
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    empty = orc_tokens.round_trip(docs.limit(0))
    assert empty.count() == 0


def check_packed(docs, rows):
    """docs: id -> ids with the end id (distinct ids only)."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(docs[i])
            assert p.ids_crc32 == crc(docs[i][p.start:p.start + p.length])
            at += p.length
        assert at == len(docs[i])
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0 and at == pieces[0].window


def test_orc_files_go_by_number(spark, monkeypatch):
    """Beyond 99,999 files names are longer and sort differently as text."""
    path = shared_path(spark, "test-many")
    local = path.removeprefix("file:")
    for part in (99_999, 100_000, 100_001):
        orc_tokens.write_token_files(documents(spark, [f"text {part}"]).selectExpr(f"doc_id + {part} as doc_id", "text").repartition(1), f"{path}-{part}")
        name = next(f for f in sorted(os.listdir(f"{local}-{part}")) if f.endswith(".orc"))
        os.makedirs(local, exist_ok=True)
        shutil.copy(f"{local}-{part}/{name}", f"{local}/part-{part}-{name[11:]}")
    rows = sorted(orc_tokens.read_token_files(spark, path).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [99_999, 100_000, 100_001]
    assert [r.start for r in rows] == [0, rows[0].n_tokens, rows[0].n_tokens + rows[1].n_tokens]


def test_op10_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {r.doc_id: x + [0] for r, x in zip(docs, wanted(BYTE, [r.text for r in docs]))}
    rows = QUERIES["op10_packing"](spark, SF).collect()
    check_packed(ids, rows)
    steps = {}
    for r in rows:
        steps[r.step_group] = steps.get(r.step_group, 0) + r.length
    assert max(steps.values()) <= 2 * packing.STEP_TOKENS


def test_packing_hostile_rows(spark):
    docs = documents(spark).dropDuplicates(["doc_id"]).where("doc_id is not null").repartition(3)
    check_packed({i: x + [0] for i, x in enumerate(wanted(BYTE, TEXTS))}, packing.pack(docs, pool_tokens=3000).collect())
    twice = documents(spark, ["a", "b"])
    rows = packing.pack(twice.union(twice).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert sum(r.length for r in rows) == 8 and all(r.doc_id is None for r in rows)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_never_pads_long_and_short():
    docs = [(i, np.arange(n, dtype="<i4")) for i, n in enumerate([5000, 1, 1, 127, 128, 129, 700, 1024, 1023, 3])]
    cols = [c for c in packing.pack_stream(iter(docs), packing.TIERS, 4000, 2048, 0)]
    windows = {s: w for c in cols for s, w in zip(c[5], c[7])}
    total = {}
    for c in cols:
        for s, n in zip(c[5], c[2]):
            total[s] = total.get(s, 0) + n
    assert total == windows and sum(total.values()) == sum(len(x) for _, x in docs)
    assert len(LONG) > 900_000
