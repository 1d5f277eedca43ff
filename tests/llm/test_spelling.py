"""Spelling variants against all pairs of words."""

import collections
import re
import zlib

import numpy as np
import pytest
from cases import TEXTS, documents

from recoloom.llm import spelling
from recoloom.llm.queries import QUERIES

A2Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(A2Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain_near(vocabulary):
    """One edit apart: equal after one deletion in the longer, or in both at one place."""
    out = {w: set() for w in vocabulary}
    gaps = collections.defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            gaps[i, w[:i] + w[i + 1:]].add(w)
            short = w[:i] + w[i + 1:]
            if short in out:
                out[w].add(short)
                out[short].add(w)
    for group in gaps.values():
        for w in group:
            out[w] |= group - {w}
    return out


def plain(rows):
    n = plain_words(rows)
    near = plain_near(n)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n), key=str)


HOSTILE = ["example " * 300 + "exmaple " * 2 + "exampel exampel exampl exampl examples " * 3, "Straße ÉCOLEÉCOLE école÷école×école " * 3,
           "abcdefg abcdefh bbcdefg abcdefgh aabcdefg zabcdefg abcdef abdefg " * 2, "aaaaaaa aaaaaaaa aaaaaaaaa " * 40,
           ("q" * 70 + " ") * 3 + ("q" * 69 + "x ") * 2 + ("q" * 71 + " ") * 50, ("ab" * 3000 + " ") * 2 + ("ab" * 2999 + "b ") * 25,
           " ".join("".join(np.random.default_rng(i).permutation(list("lettersx"))) for i in range(200)) + " lettersx" * 2]


def small(monkeypatch, leaf, points, queries):
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "TILE_POINTS", points)
    monkeypatch.setattr(spelling, "TILE_QUERIES", queries)


@pytest.mark.parametrize("leaf,points,queries", [(32_768, 65_536, 1 << 19), (5, 7, 11)])
def test_hostile_rows_equal_the_plain_version(spark, monkeypatch, leaf, points, queries):
    small(monkeypatch, leaf, points, queries)
    docs = documents(spark, TEXTS + HOSTILE)
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in spelling.variants(docs).collect()), key=str) == want
    assert any(w[1] for w in want) and len(want) > 20
    assert spelling.variants(docs.limit(0)).count() == 0


def test_trees_reach_every_near_word():
    rng = np.random.default_rng(8)
    vocabulary = sorted({"".join(rng.choice(list("abcdeé"), 8)) for _ in range(1500)})
    count = spelling.counts(spelling.codes(vocabulary, 8))
    for size in (1, 4, 200, 5000):
        tree = spelling.Tree(count, size)
        home = tree.home(count)
        assert sorted(tree.order) == list(range(len(vocabulary)))
        place = np.empty(len(vocabulary), int)
        place[tree.order] = np.repeat(np.arange(len(tree.bounds) - 1), np.diff(tree.bounds))
        assert (place == home).all()
        reached = set(zip(*[x.tolist() for x in tree.reach(count, True)]))
        up = count.astype(int)
        diff = up[:, None, :] - up[None]
        for i, j in np.argwhere((np.maximum(diff, 0).sum(2) <= 1) & (np.maximum(-diff, 0).sum(2) <= 1)):
            assert (i, home[j]) in reached


def test_chains_lead_to_the_last_word(spark):
    chain = [(str(i), str(i + 1)) for i in range(19)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain + [("x", "7"), ("y", "19")], "word string, form string")).collect()}
    assert got == {**{str(i): "19" for i in range(19)}, "x": "19", "y": "19"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op13_whole_table(spark, monkeypatch, sf):
    if sf == "sf0.01":
        small(monkeypatch, 300, 200, 2000)
    want = plain([(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()])
    assert sorted((tuple(r) for r in QUERIES["op13_spelling"](spark, f"/root/testdata/{sf}").collect()), key=str) == want
