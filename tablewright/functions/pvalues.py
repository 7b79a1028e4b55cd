"""p-values of the drift tests. Each is evaluated on one row per feature."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SERIES_TERMS = 100
_LAMBDA_FLOOR = 0.2


def kolmogorov_sf(lam: Column) -> Column:
    """Upper tail of the Kolmogorov limit law, 2·Σ(−1)^(j−1)·exp(−2j²λ²), clipped to [0, 1]."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    return F.when(lam < _LAMBDA_FLOOR, F.lit(1.0)).when(lam >= _LAMBDA_FLOOR, clipped)


def ks_limit_p(statistic: Column, n: Column, m: Column, corrected: bool = False) -> Column:
    """Large-sample p-value of the two-sample statistic, if wanted with Stephens' finite-size correction."""
    n, m = n.cast("double"), m.cast("double")
    root = F.sqrt(n * m / F.nullif(n + m, F.lit(0.0)))
    factor = root + 0.12 + 0.11 / F.nullif(root, F.lit(0.0)) if corrected else root
    return kolmogorov_sf(statistic * factor)


def ks_exact_p(statistic: Column, n: Column, m: Column) -> Column:
    """Exact p-value of the two-sample statistic, at any size; its time grows with the product of the sample sizes."""
    return _ks_exact_udf()(statistic, n, m)


def chi2_sf(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-squared law."""
    return _chi2_udf()(statistic, dof)


def _ks_exact_udf():
    @F.pandas_udf("double")
    def exact(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if pd.isna(d) or min(a, b) < 1 else ks_exit_probability(d, int(a), int(b))
                for d, a, b in zip(statistic, n, m)
            ],
            dtype="float64",
        )

    return exact


def _chi2_udf():
    @F.pandas_udf("double")
    def tail(statistic: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if pd.isna(x) or pd.isna(k) else gamma_upper_ratio(float(k) / 2, float(x) / 2)
                for x, k in zip(statistic, dof)
            ],
            dtype="float64",
        )

    return tail


def ks_exit_probability(statistic: float, n: int, m: int) -> float:
    """Chance that a random merge of n and m tie-free values reaches a gap of ``statistic``.

    Under the null every order of the merged values is equally likely, so merging is drawing
    without replacement: a walk over (i, j) that takes from the first sample with chance
    (n-i)/(n+m-i-j). The p-value is the mass that leaves the band |i/n - j/m| < statistic.
    Distances are kept as the integers |i*m - j*n|, so the band edge is exact.
    """
    edge = round(statistic * n * m)
    if edge <= 0:
        return 1.0
    total = n + m
    mass = np.zeros(n + 2)
    mass[0] = 1.0
    left = 0.0
    low, high = 0, 0  # taken-from-first counts i that may carry mass
    for taken in range(total):
        i = np.arange(low, high + 1)
        here = mass[low : high + 1]
        first = here * (n - i) / (total - taken)
        second = here - first
        # From the first sample i moves up by one, from the second it stays.
        mass[low : high + 2] = 0.0
        mass[low : high + 1] = second
        mass[low + 1 : high + 2] += first
        high = min(high + 1, n)
        i = np.arange(low, high + 1)
        outside = np.abs(i * m - (taken + 1 - i) * n) >= edge
        left += float(mass[low : high + 1][outside].sum())
        mass[low : high + 1][outside] = 0.0
        inside = np.flatnonzero(~outside)
        if inside.size == 0:
            break
        low, high = low + int(inside[0]), low + int(inside[-1])
    return min(1.0, left)


def gamma_upper_ratio(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: power series for small x, continued fraction else."""
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    steps = 200 + int(20 * math.sqrt(a))
    if x < a + 1:
        term = total = 1.0 / a
        for k in range(1, steps):
            term *= x / (a + k)
            total += term
            if term < total * 1e-16:
                break
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    fraction = d
    for k in range(1, steps):
        numerator = k * (a - k)
        b += 2.0
        d = 1.0 / (_away_from_zero(numerator * d + b, tiny))
        c = _away_from_zero(b + numerator / c, tiny)
        fraction *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return front * fraction


def _away_from_zero(value: float, tiny: float) -> float:
    return value if abs(value) > tiny else tiny
