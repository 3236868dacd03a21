"""Vectorised p-values: Student t and the Hardy-Weinberg exact test.

Spark has neither the incomplete beta function nor the error function, so these two run as Arrow
UDFs. Each call handles one Arrow batch of independent rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_TERMS = 10_000  # far more than any dof needs


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), on converging elements only."""
    tiny = 1e-300
    out = np.empty_like(x)
    live = np.arange(x.size)
    c = np.ones_like(x)
    d = 1.0 / np.where(np.abs(1 - (a + b) * x / (a + 1)) < tiny, tiny, 1 - (a + b) * x / (a + 1))
    h = d.copy()
    m = 0
    while live.size:
        m += 1
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        done = np.abs(step - 1) < 3e-16
        if m >= MOST_TERMS and not done.all():
            raise ArithmeticError(f"{(~done).sum()} p-values have not converged after {m} terms")
        if done.any():
            out[live[done]] = h[done]
            keep = ~done
            live, a, b, x, c, d, h = (v[keep] for v in (live, a, b, x, c, d, h))
    return out


def _log_beta_half(a: np.ndarray) -> np.ndarray:
    """log B(a, 1/2) without a difference of large logarithms.

    Gamma(a) / Gamma(a + 1/2) is taken from its asymptotic series at a + 20 and brought back by the recurrence.
    """
    back = sum(np.log1p(0.5 / (a + j)) for j in range(20))
    z = a + 20
    z2 = z * z
    series = (1 - (1 - (0.3 - 17 / (74.6666666666666666 * z2)) / z2) / (24 * z2)) / (8 * z)
    return back - 0.5 * np.log(z) + series + 0.5 * math.log(math.pi)


def _t_beta(t2: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """P(|T| > t) = I_x(dof/2, 1/2) with x = dof / (dof + t^2)."""
    a, b = dof / 2, np.full_like(dof, 0.5)
    x, y = dof / (dof + t2), t2 / (dof + t2)
    log_x = -np.log1p(t2 / dof)
    log_y = np.log(np.where(y > 0, y, 1.0))
    front = np.where(y > 0, np.exp(a * log_x + b * log_y - _log_beta_half(a)), 0.0)
    direct = x < (a + 1) / (a + b + 2)
    out = np.empty_like(t2)
    out[direct] = front[direct] * _beta_fraction(a[direct], b[direct], x[direct]) / a[direct]
    rest = ~direct
    out[rest] = 1 - front[rest] * _beta_fraction(b[rest], a[rest], y[rest]) / b[rest]
    return out


def t_two_sided(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Two-sided Student t p-value; NaN where t is NaN or dof is not positive."""
    t, dof = np.asarray(t, dtype=float), np.asarray(dof, dtype=float)
    out = np.full(t.shape, np.nan)
    ok = ~np.isnan(t) & (dof > 0)
    infinite = ok & np.isinf(t)
    out[infinite] = 0.0
    with np.errstate(all="ignore"):
        part = ok & ~infinite
        if part.any():
            out[part] = np.clip(_t_beta(t[part] ** 2, dof[part]), 0.0, 1.0)
    return out


def _log_factorial_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log(a! / b!) with an error in proportion to |a - b| only.

    Both are raised by 16, where Stirling's series is exact enough, and brought back factor by factor.
    """
    d = a - b
    back = sum(np.log1p(d / (b + i)) for i in range(1, 17))
    x, y = a + 16, b + 16
    rest = lambda z: (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z * z)) / (z * z)) / (z * z)) / z
    log = np.log1p(d / y)
    return d * np.log(x) + (y * log - d) + 0.5 * log + rest(x) - rest(y) - back


def _log_weight_ratio(h: np.ndarray, k: np.ndarray, rare: np.ndarray, common: np.ndarray) -> np.ndarray:
    """log of the probability of ``h`` heterozygotes over that of ``k``."""
    homozygotes = _log_factorial_ratio((rare - h) / 2, (rare - k) / 2) + _log_factorial_ratio((common - h) / 2, (common - k) / 2)
    return (h - k) * math.log(2) - _log_factorial_ratio(h, k) - homozygotes


def _outward_sum(h: np.ndarray, upward: np.ndarray, rare: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Probabilities from ``h`` on in one direction, relative to that of ``h``, added while they change the sum.

    Each comes from its neighbour. The direction leads away from the mode, so they fall ever faster.
    """
    total, term, live = np.ones_like(h), np.ones_like(h), np.arange(h.size)
    while live.size:
        up = (rare - h) * (common - h) / ((h + 2) * (h + 1))
        down = h * (h - 1) / ((rare - h + 2) * (common - h + 2))
        term = term * np.where(upward, up, down)
        h = h + np.where(upward, 2, -2)
        total[live] += term
        keep = term > 1e-20 * total[live]
        if not keep.all():
            live, h, upward, term, rare, common = (v[keep] for v in (live, h, upward, term, rare, common))
    return total


def hwe_exact(het: np.ndarray, hom1: np.ndarray, hom2: np.ndarray) -> np.ndarray:
    """Hardy-Weinberg exact tests: total probability of the tables no more likely than the observed.

    Probabilities fall on both sides of the mode. So the tables asked for are all from the observed one
    outward, and on the other side all from the first that is no more likely, found by bisection. The
    steps for many variants at once grow with the spread of the distribution, not with the cohort. NaN
    without calls.
    """
    shape = np.shape(het)
    het, hom1, hom2 = np.atleast_1d(*(np.asarray(v, dtype=float) for v in (het, hom1, hom2)))
    out = np.full(het.shape, np.nan)
    called = het + hom1 + hom2 > 0  # False for NaN
    het, hom1, hom2 = het[called], hom1[called], hom2[called]
    n = het + hom1 + hom2
    rare = het + 2 * np.minimum(hom1, hom2)
    common = 2 * n - rare
    mode = np.ceil(np.maximum((rare * common - 2) / (2 * n + 3), 0))  # the first whose successor is no more likely
    mode = np.minimum(mode + (rare - mode) % 2, rare)
    above = het >= mode

    # the other side, counted in steps from the mode
    edge, step = np.where(above, mode - 2, mode), np.where(above, -2, 2)
    steps = np.where(above, mode // 2, (rare - mode) // 2 + 1)
    low, high = np.zeros_like(steps), steps.copy()
    while (low < high).any():
        middle = (low + high) // 2
        at = np.where(low < high, edge + step * middle, het)
        less = _log_weight_ratio(at, het, rare, common) <= 1e-9
        low, high = np.where((low < high) & ~less, middle + 1, low), np.where((low < high) & less, middle, high)
    some = low < steps
    first = np.where(some, edge + step * low, rare)  # the last table, if there is none: nothing follows it

    whole = lambda v: np.concatenate([v, v, v, v])
    yes, no = np.ones(het.size, bool), np.zeros(het.size, bool)
    sums = _outward_sum(np.concatenate([mode, mode, het, first]), np.concatenate([yes, no, above, ~(above & some)]), whole(rare), whole(common))
    up, down, own, other = sums.reshape(4, -1)
    tail = own + np.where(some, np.exp(_log_weight_ratio(first, het, rare, common)) * other, 0.0)
    out[called] = np.minimum(1.0, np.exp(_log_weight_ratio(het, mode, rare, common)) * tail / (up + down - 1))
    return out.reshape(shape)[()]


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided Student t p-value as a column; NULL where undefined."""
    p = t_two_sided(t.to_numpy(dtype=float), dof.to_numpy(dtype=float))
    return pd.Series(p).where(~np.isnan(p), None)


@F.pandas_udf(T.DoubleType())
def hwe_p_value(het: pd.Series, hom_ref: pd.Series, hom_alt: pd.Series) -> pd.Series:
    """Hardy-Weinberg exact p-value as a column; NULL where there are no calls."""
    p = hwe_exact(*(c.to_numpy(dtype=float) for c in (het, hom_ref, hom_alt)))
    return pd.Series(p).where(~np.isnan(p), None)
