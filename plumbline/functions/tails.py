"""Tail probabilities of the test statistics; applied to one row per column, never to data."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def kolmogorov_tail(distance: float, n: float, m: float) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov tail, with Stephens' finite-size correction."""
    root = math.sqrt(n * m / (n + m))
    lam = (root + 0.12 + 0.11 / root) * distance
    if lam < 1.18:
        if lam < 0.05:
            return 1.0
        # the theta-function twin of the series converges at once for small arguments
        base = math.pi**2 / (8 * lam * lam)
        low = sum(math.exp(-((2 * k - 1) ** 2) * base) for k in range(1, 8))
        return min(1.0, max(0.0, 1.0 - math.sqrt(2 * math.pi) / lam * low))
    series = sum((-1) ** (k - 1) * math.exp(-2 * (k * lam) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * series))


def kolmogorov_exact_tail(distance: float, n: int, m: int) -> float:
    """The share of all orders of n and m values whose distance is as large, by counting lattice paths.

    A path goes a step right for a value of one side and up for one of the other; it stays inside while the two distribution functions are
    nearer than the distance.  Each diagonal holds, for its points, the share of the paths there that never left.
    """
    bound = round(distance * n * m)  # distances are multiples of 1 / (n m)
    inside = np.zeros(n + 1)
    inside[0] = 1.0
    right = np.arange(n + 1)
    for steps in range(1, n + m + 1):
        up = steps - right
        before = np.concatenate([[0.0], inside[:-1]])
        share = (before * right + inside * np.maximum(up, 0)) / steps
        inside = np.where((up >= 0) & (up <= m) & (np.abs(right * m - up * n) < bound), share, 0.0)
    return min(1.0, max(0.0, 1.0 - float(inside[n])))


def normal_two_sided_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_square_tail(statistic: float, dof: float) -> float | None:
    """Regularised upper incomplete gamma function at (dof/2, statistic/2)."""
    if math.isinf(statistic):
        return 0.0
    if dof <= 0 or statistic <= 0:
        return 1.0
    a, x = dof / 2, statistic / 2
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        step = a
        while abs(term) > abs(total) * 1e-16:
            step += 1
            term *= x / step
            total += term
        return max(0.0, 1 - scale * total)
    # Lentz's evaluation of the continued fraction
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    fraction = d
    for i in range(1, 5_000_000):
        numerator = -i * (i - a)
        b += 2
        d = 1 / (numerator * d + b or tiny)
        c = b + numerator / c or tiny
        change = c * d
        fraction *= change
        if abs(change - 1) < 1e-15:
            return min(1.0, scale * fraction)
    return None  # it did not converge: no value rather than a wrong one


def _over_series(function):
    def apply(*series: pd.Series) -> pd.Series:
        rows = zip(*series)
        return pd.Series(
            [None if any(pd.isna(v) for v in row) else function(*row) for row in rows], dtype="float64"
        )

    return apply


@F.pandas_udf(DoubleType())
def kolmogorov_p(distance: pd.Series, n: pd.Series, m: pd.Series, exact_pairs: pd.Series) -> pd.Series:
    def tail(d: float, n: float, m: float, most: float) -> float | None:
        if pd.isna(d) or n <= 0 or m <= 0:
            return None
        if n * m <= most:
            return kolmogorov_exact_tail(d, int(n), int(m))
        return kolmogorov_tail(d, n, m)

    return pd.Series([tail(*row) for row in zip(distance, n, m, exact_pairs, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _over_series(normal_two_sided_tail)(z)


@F.pandas_udf(DoubleType())
def chi_square_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _over_series(chi_square_tail)(statistic, dof)
