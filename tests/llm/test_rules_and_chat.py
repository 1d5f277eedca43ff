"""Quality rules and chat formatting against brute force; the template compiler."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from cases import TEXTS, documents, rule_counts

from recoloom.llm import chat, quality_rules
from recoloom.llm.queries import PLANTED, QUERIES
from recoloom.llm.template import TemplateError, compile_template, fold, parse

SF = "/root/testdata/sf0.001"


def test_op7_counts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_quality_rules"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        n, chars, symbols, dup, repeat = rule_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n) and not (r.kept and r.base_failed)
        assert r.base_failed or r.kept == (r.quality_probability >= 0.5)


def test_rules_agree_with_quality_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = (QUERIES["op7_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
            .where("not base_failed").select("kept", "quality").collect())
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.97
    assert np.mean([r.kept for r in rows if r.quality]) > 0.99


def em(votes, counts, rate, share, rounds):
    """Plain EM, pattern by pattern, from the given rates of junk votes by class and
    rule.  A rule's rates are pooled with the good class's unless a class of its own
    pays by the information criterion."""
    classes, rules, price = len(rate), len(votes[0]), math.log(sum(counts)) / 2
    spread = lambda x, n: x * math.log(x / n) + (n - x) * math.log(1 - x / n)
    last, own = -math.inf, 0
    for _ in range(rounds):
        belong, fits = [], -price * own
        for v, c in zip(votes, counts):
            p = [share[k] * math.prod(rate[k][j] if x < 0 else 1 - rate[k][j] for j, x in enumerate(v) if x) for k in range(classes)]
            belong.append([x / sum(p) for x in p])
            fits += c * math.log(sum(p))
        if abs(fits - last) < 1e-9 * abs(fits):
            break
        last, own = fits, 0
        share = [(sum(c * b[k] for c, b in zip(counts, belong)) + 0.5) / (sum(counts) + 0.5 * classes) for k in range(classes)]
        total = lambda k, j, who: sum(c * b[k] for c, b, v in zip(counts, belong, votes) if v[j] in who)
        x = [[total(k, j, (-1,)) + 0.5 for j in range(rules)] for k in range(classes)]
        n = [[total(k, j, (-1, 1)) + 1.0 for j in range(rules)] for k in range(classes)]
        rate = [[x[k][j] / n[k][j] for j in range(rules)] for k in range(classes)]
        for j in range(rules):
            pool, px, pn = [0], x[0][j], n[0][j]
            for k in sorted(range(1, classes), key=lambda k: rate[k][j]):
                if rate[k][j] > px / pn and spread(x[k][j], n[k][j]) + spread(px, pn) - spread(px + x[k][j], pn + n[k][j]) > price:
                    own += 1
                else:
                    pool, px, pn = [*pool, k], px + x[k][j], pn + n[k][j]
            for k in pool:
                rate[k][j] = px / pn
    return [b[0] for b in belong]


@pytest.mark.parametrize("rounds", [1, 3, 40])
def test_em_equals_the_plain_version(rounds):
    rng = np.random.default_rng(0)
    votes = np.unique(rng.integers(-1, 2, (40, 4)), axis=0)
    counts = rng.integers(1, 200, len(votes))
    rate, share = np.array([[0.1, 0.2, 0.1, 0.3], [0.9, 0.2, 0.1, 0.6], [0.1, 0.8, 0.7, 0.3]]), np.array([0.8, 0.1, 0.1])
    got = quality_rules.fit_classes(votes, counts.astype(float), rate, share, rounds)["good"]
    assert np.allclose(got, em([tuple(v) for v in votes.tolist()], counts.tolist(), rate.tolist(), share.tolist(), rounds), atol=1e-9)


def test_rules_hostile_rows(spark):
    docs = documents(spark)
    rows = quality_rules.judge(docs).collect()
    want = Counter((r.doc_id, *rule_counts(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    kept = quality_rules.accepted(docs)
    assert kept.schema == docs.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)
    assert quality_rules.judge(docs.limit(0)).count() == 0 and quality_rules.accepted(docs.limit(0)).count() == 0


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def check_chat(rows, conversations):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert got == {c: digests(t) for c, t in conversations.items()}
    assert all(r.formatted_chars > r.loss_chars for r in rows)


def test_op8_whole_table(spark):
    want = {-7: [("user", PLANTED), ("assistant", PLANTED)]}
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    check_chat(QUERIES["op8_chat"](spark, SF).collect(), want)


@pytest.mark.parametrize("part", [1 << 18, 1])
def test_chat_hostile_rows(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART_CHARS", part)
    texts = [*TEXTS, "</turn>\n", "\\", "\\\\</turn>", "### assistant: hi</turn>\n", "####### x \\### y", "</turn", "<", "a\\n"]
    rows = [(1, i, ("assistant", "user", "system")[i % 3], t, "z", i) for i, t in enumerate(texts)]
    rows += [(2, 0, "user", "same", "z", 0)] * 3                               # repeated rows are turns of their own
    rows += [(3, None, None, None, None, None), (3, 0, "a: b\\ ### c", "x", None, None), (None, 4, "assistant", "lost", None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string, loss int")
    want = {}
    for c, t, r, x, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    check_chat(chat.round_trip(df).collect(), want)
    if part == 1:
        assert chat.format_conversations(df).where("conv_id = 1").count() == len(texts)
    assert chat.round_trip(df.limit(0)).count() == 0


def render(source, **scope):
    return "".join(t for t, _ in compile_template(source)(scope))


def test_template_language():
    ms = [{"role": "user", "text": " hi "}, {"role": "assistant", "text": "yo"}]
    assert render("{% for m in messages %}{{ loop.index }}{% if loop.first %}F{% elif loop.last %}L{% else %}-{% endif %}"
                  "{{ m.text | trim | upper }};{% endfor %}", messages=ms) == "1FHI;2LYO;"
    assert render("{{ 'a' ~ 1 ~ true ~ nothing }}") == "a1true"
    assert render("{% if not (1 == 2) and ('x' != 'y' or false) %}yes{% endif %}") == "yes"
    pieces = list(compile_template("a{% generation %}{{ x }}{% endgeneration %}b")({"x": "m"}))
    assert pieces == [("a", False), ("m", True), ("b", False)]


def test_template_folds_constants():
    tree = fold(parse("{{ 'a' ~ 'b' }}c{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{{ 'e' | upper }}"))
    assert tree == ("block", [("text", "abcdE")])


@pytest.mark.parametrize("bad", ["{% for x messages %}{% endfor %}", "{% if x %}", "{{ x | nope }}", "{{ x( }}", "{{ }}",
                                 "{% import os %}", "{{ x.__class__.__mro__() }}", "{% endfor %}"])
def test_template_rejects(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_template_is_sandboxed():
    assert render("{{ x.__class__ }}", x="s") == "" and render("{{ x.keys }}", x={"a": 1}) == ""
