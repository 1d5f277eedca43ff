"""The label model of the quality rules on votes drawn from known accuracies."""

import numpy as np
import pytest

from recoloom.llm import quality_rules

N = 20_000
RULES = 8


def posterior(spark, votes):
    """Posterior by rule (of a document that this rule alone blames), and of each row of ``votes``."""
    codes = ((votes + 1) * 3 ** np.arange(RULES)).sum(1)
    patterns = spark.createDataFrame([(int(c),) for c in codes], "pattern int")
    by_code = {r["pattern"]: r["quality_probability"] for r in quality_rules.posteriors(patterns, "pattern").collect()}
    full = int((2 * 3 ** np.arange(RULES)).sum())
    return {j: by_code.get(full - 2 * 3 ** j) for j in range(RULES)}, np.array([by_code[int(c)] for c in codes])


def draw(last, own=0.0, n=N, seed=1):
    """Votes on 85 % good documents and two kinds of junk, caught by rules 0-3 and 4-6;
    rule 7 fires on a share ``last`` of all, or on junk of its own, a share ``own``."""
    rng = np.random.default_rng(seed)
    kind = rng.choice(4, n, p=[0.85 - own, 0.08, 0.07, own])
    rate = np.full((4, RULES), 0.02)
    rate[1, :4], rate[2, 4:7], rate[:, 7] = 0.8, 0.8, last
    rate[3, 7] = 0.95
    return np.where(rng.random((n, RULES)) < rate[kind], -1, 1), kind


@pytest.mark.parametrize("fires", [0.05, 0.3, 0.7])
def test_an_unreliable_rule_is_discounted(spark, fires):
    votes, kind = draw(fires)
    single, p = posterior(spark, votes)
    assert single[7] > 0.9
    assert np.mean((p >= 0.5) == (kind == 0)) > 0.98


def test_a_good_document_with_one_wrong_junk_vote_is_kept(spark):
    votes, kind = draw(0.02)
    single, p = posterior(spark, votes)
    assert all(x > 0.5 for x in single.values())
    wrong = (kind == 0) & ((votes < 0).sum(1) == 1)
    assert wrong.sum() > 1000 and (p[wrong] >= 0.5).all()


def test_a_rule_with_junk_of_its_own_is_believed(spark):
    votes, kind = draw(0.001, own=0.07)
    single, p = posterior(spark, votes)
    assert single[7] < 0.1 and all(single[j] > 0.5 for j in range(7))
    assert np.mean((p >= 0.5) == (kind == 0)) > 0.98


@pytest.mark.parametrize("seed", range(4))
def test_a_thousand_rows_are_enough(seed):
    """The same three answers on small tables; the prior outweighs no such evidence."""
    def judged(last, own):
        votes, kind = draw(last, own, 1000, seed)
        rows, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
        good = quality_rules.label_model(rows, counts)["good"]
        alone = (rows[:, 7] < 0) & ((rows < 0).sum(1) == 1)
        return good[alone], np.mean((good[at.reshape(-1)] >= 0.5) == (kind == 0))

    for fires in (0.05, 0.3, 0.7):
        alone, right = judged(fires, 0.0)
        assert (alone > 0.9).all() and right > 0.97
    alone, right = judged(0.001, 0.07)
    assert (alone < 0.3).all() and right > 0.97


def test_distrust_costs_a_fixed_sum_at_most():
    assert quality_rules.trust(np.array([0.0])) - quality_rules.trust(np.array([1.0])) < 6.1
    assert abs(quality_rules.trust(np.array([0.3])) - quality_rules.trust(np.array([0.9]))) < 1e-6
