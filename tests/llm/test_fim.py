"""Fill-in-middle against a plain version that lists the units."""

import hashlib
import re

import numpy as np
import pytest
from cases import TEXTS, documents

from recoloom.llm import fim
from recoloom.llm.queries import QUERIES


def plain(doc_id, text, rules=fim.Rules()):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"{rules.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rules.rate:
        return doc_id, len(units), "plain", None, None, t
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < rules.spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


HOSTILE = ["\n", "\n\n\n", "a\n", "a", "a\nb", "\r\n \x85x\n", "é\n日本\n😀", "<P>", "x<S>y\nz", "<M", "<\n<\nP>\nS>\nM>",
           "a<P\n>b\n", "1234567\n" * 9, "12345678\n" * 9, "\x8a\x0b" * 20, "\n" * 100, "x" * 4000, ("é" * 7 + "\n") * 300]


def test_swar_words_find_what_bytes_hold():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 8, 9, 64, 1000):
        data = rng.choice(np.array([9, 10, 11, 0x8A, 0, 255, 0xC3, 0x80], np.uint8), size)
        ends = fim.Ranks(fim.equal_bytes(fim.words_of(data), 10))
        at = np.arange(size + 1)
        want = np.concatenate([[0], np.cumsum(data == 10)])
        assert (ends.rank(at) == want).all()
        assert (ends.select(np.arange(want[-1])) == np.flatnonzero(data == 10)).all()
        points = fim.Ranks(fim.point_bytes(fim.words_of(data)))
        assert (points.rank(at)[1:] == np.cumsum((data & 0xC0) != 0x80)).all()


@pytest.mark.parametrize("rules", [fim.Rules(), fim.Rules(seed=3, rate=40, spm=10)])
def test_hostile_rows_equal_the_plain_version(spark, rules):
    docs = documents(spark, TEXTS + HOSTILE)
    out = fim.transform(docs, rules)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted((plain(r.doc_id, r.text, rules) for r in docs.collect()), key=str)
    back = out.select("doc_id", "output", fim.restored(out["form"], out["output"]).alias("text")).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    assert fim.transform(docs.limit(0), rules).count() == 0
    assert {"plain", "psm", "spm"} == {g[2] for g in got}


def test_op12_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        p = plain(r.doc_id, r.text)
        want.append((*p[:5], digest(p[5]), digest(r.text or "")))
    assert sorted(tuple(r) for r in QUERIES["op12_fim"](spark, sf).collect()) == sorted(want)
