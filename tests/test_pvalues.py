import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lociframe.functions import pvalues as P


def series(t, dof):
    """Two-sided p by the finite trigonometric series for whole degrees of freedom."""
    a = math.atan(abs(t) / math.sqrt(dof))
    c, s = math.cos(a), math.sin(a)
    if dof % 2 == 0:
        total = sum(math.exp(math.lgamma(j + 0.5) - math.lgamma(j + 1)) / math.sqrt(math.pi) * c ** (2 * j) for j in range(dof // 2))
        return 1 - s * total
    total = sum(
        math.sqrt(math.pi) / 2 * math.exp(math.lgamma(j + 1) - math.lgamma(j + 1.5)) * c ** (2 * j + 1) for j in range((dof - 1) // 2)
    )
    return 1 - 2 / math.pi * (a + s * total)


@pytest.mark.parametrize("dof", [1, 2, 3, 7, 30, 31, 118, 475])
def test_t_matches_series(dof):
    t = np.array([0.0, 1e-3, 0.2, -0.9, 1.7, 2.5, -4.0, 9.0])
    got = P.t_two_sided(t, np.full(t.shape, float(dof)))
    assert np.allclose(got, [series(v, dof) for v in t], rtol=0, atol=1e-11)


@pytest.mark.parametrize("dof", [9_999, 10_001, 366_000])
def test_t_at_large_dof(dof):
    t = np.array([0.01, 0.5, 1.0, 2.0, 5.0, 14.0])
    got = P.t_two_sided(t, np.full(t.shape, float(dof)))
    # the density integrated by small steps, out to where nothing is left
    for value, p in zip(t, got):
        x = np.linspace(value, value + 12, 2_000_001)
        density = np.exp(-(dof + 1) / 2 * np.log1p(x * x / dof))
        whole = np.exp(P._log_beta_half(np.array([dof / 2])))[0] * math.sqrt(dof)
        step = x[1] - x[0]
        simpson = step / 3 * (density[0] + density[-1] + 4 * density[1:-1:2].sum() + 2 * density[2:-1:2].sum())
        assert p == pytest.approx(2 * simpson / whole, rel=1e-9)
    assert np.exp(P._log_beta_half(np.array([dof / 2])))[0] == pytest.approx(math.exp(math.lgamma(dof / 2) + math.lgamma(0.5) - math.lgamma(dof / 2 + 0.5)), rel=1e-8)


def test_t_edges():
    got = P.t_two_sided(np.array([np.nan, 1.0, np.inf, 100.0]), np.array([5.0, 0.0, 5.0, 4e5]))
    assert np.isnan(got[:2]).all() and got[2] == 0 and got[3] == 0


def brute_hwe(het, a, b):
    n, rare = het + a + b, het + 2 * min(a, b)
    if n == 0:
        return float("nan")

    def log_p(h):
        hom_rare = (rare - h) // 2
        f = math.lgamma
        return (
            h * math.log(2) + f(n + 1) - f(hom_rare + 1) - f(h + 1) - f(n - h - hom_rare + 1) + f(rare + 1) + f(2 * n - rare + 1) - f(2 * n + 1)
        )

    probs = {h: math.exp(log_p(h)) for h in range(rare % 2, rare + 1, 2)}
    return min(1.0, sum(p for p in probs.values() if p <= probs[het] * (1 + 1e-9)))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 120), st.integers(0, 120), st.integers(0, 120))
def test_hwe_matches_enumeration(het, a, b):
    got, want = P.hwe_exact(het, a, b), brute_hwe(het, a, b)
    assert (math.isnan(got) and math.isnan(want)) or got == pytest.approx(want, rel=1e-7)


def test_hwe_published_values():
    # Monomorphic sites are always in equilibrium; the last is a biobank-sized site.
    assert P.hwe_exact(0, 100, 0) == 1.0
    assert P.hwe_exact(0, 50, 50) < 1e-20
    assert 0 < P.hwe_exact(243_200, 122_000, 122_200) <= 1


def summed_hwe(het, a, b):
    """All tables by the ratios of neighbours."""
    n, rare = het + a + b, het + 2 * min(a, b)
    common = 2 * n - rare
    h = np.arange(rare % 2, rare + 1, 2, dtype=float)
    steps = np.log((rare - h[:-1]) * (common - h[:-1])) - np.log((h[:-1] + 2) * (h[:-1] + 1))
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    prob = np.exp(weight - weight.max())
    return min(1.0, prob[prob <= prob[(het - rare % 2) // 2] * (1 + 1e-9)].sum() / prob.sum())


def test_hwe_of_a_large_cohort():
    counts = [(243_200, 122_000, 122_209), (243_704, 121_852, 121_853), (240_000, 125_000, 122_409), (1_200, 486_209, 0), (1_190, 486_209, 10), (90_000, 392_000, 5_409),
              (0, 487_409, 0), (0, 487_408, 1), (1, 487_408, 0), (0, 243_704, 243_705), (487_409, 0, 0), (3, 487_400, 6)]
    got = P.hwe_exact(*np.array(counts).T)
    for value, row in zip(got, counts):
        assert value == pytest.approx(summed_hwe(*row), rel=1e-6, abs=1e-300), row


def test_columns(spark):
    df = spark.createDataFrame([(1.5, 20.0), (None, 20.0), (2.0, None)], "t double, dof double")
    got = [r[0] for r in df.select(P.t_p_value("t", "dof")).collect()]
    assert got[0] == pytest.approx(series(1.5, 20)) and got[1] is None and got[2] is None
    df = spark.createDataFrame([(5, 10, 2), (0, 0, 0), (None, 1, 1)], "a long, b long, c long")
    got = [r[0] for r in df.select(P.hwe_p_value("a", "b", "c")).collect()]
    assert got[0] == pytest.approx(brute_hwe(5, 10, 2)) and got[1] is None and got[2] is None
