"""The draws of the splitting tree at any population size."""

import math

import numpy as np

from corpusmill.llm import mixing


def test_inversion_is_the_distribution():
    """Against exact probabilities on small populations: cumulative sums fall where they should."""
    for n, rest, take in ((5, 7, 4), (40, 3, 20), (1, 30, 6), (12, 12, 12), (9, 2, 11)):
        low, high = max(0, take - rest), min(n, take)
        p = [math.comb(n, x) * math.comb(rest, take - x) / math.comb(n + rest, take) for x in range(low, high + 1)]
        edge = np.cumsum(p)
        for x, (a, b) in enumerate(zip([0.0, *edge[:-1]], edge), start=low):
            assert mixing._inverted(n, rest, take, (a + b) / 2) == x


def test_large_populations_keep_sums_and_moments():
    rng = np.random.default_rng(3)
    have = np.array([4_000_000_000, 1_000_000, 2_500_000_000, 0, 7], np.int64)
    take = 2_000_000_000
    draws = np.array([mixing._hypergeometric(have, take, rng) for _ in range(60)])
    assert (draws.sum(axis=1) == take).all() and (draws <= have).all() and (draws >= 0).all()
    whole = have.sum()
    for i in (0, 1, 2):
        mean, share = take * have[i] / whole, have[i] / whole
        sd = math.sqrt(take * share * (1 - share) * (whole - take) / (whole - 1))
        assert abs(draws[:, i].mean() - mean) < 5 * sd / math.sqrt(60)
        assert 0.6 * sd < draws[:, i].std() < 1.5 * sd


def test_sampler_and_inversion_agree(monkeypatch):
    have = np.array([300, 500, 200], np.int64)
    one = np.array([mixing._hypergeometric(have, 400, np.random.default_rng(k)) for k in range(800)])
    monkeypatch.setattr(mixing, "_SAMPLER_LIMIT", 1)
    two = np.array([mixing._hypergeometric(have, 400, np.random.default_rng(k)) for k in range(800)])
    assert (two.sum(axis=1) == 400).all()
    assert np.abs(one.mean(axis=0) - two.mean(axis=0)).max() < 1.5 and np.abs(one.std(axis=0) - two.std(axis=0)).max() < 1.2
