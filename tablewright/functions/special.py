"""Tail probabilities for rows that are already aggregated."""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# the helper below travels with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b), by its continued fraction in log space."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x) - math.log(a)
    )
    tiny = 1e-300
    ratio, c, d = 1.0, 1.0, 0.0
    for i in range(0, 2000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / ((1.0 + term * d) or tiny)
        c = (1.0 + term / c) or tiny
        ratio *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return math.exp(log_front) * (ratio - 1.0) if log_front > -745 else 0.0


def correlation_p(r: float | None, n: int | None) -> float | None:
    """Two-sided p-value of a correlation over ``n`` pairs (t with n - 2 degrees of freedom)."""
    if r is None or n is None or math.isnan(r) or n < 3:
        return None
    return incomplete_beta((n - 2) / 2.0, 0.5, max(0.0, 1.0 - r * r))


@F.pandas_udf(DoubleType())
def _correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(
        [correlation_p(None if pd.isna(a) else float(a), None if pd.isna(b) else int(b)) for a, b in zip(r, n)],
        dtype="float64",
    )


def correlation_p_value(r: Column, n: Column) -> Column:
    """Column form of :func:`correlation_p`, for aggregated rows (one per pair of features)."""
    return _correlation_p(r, n)


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def normal_score_sums():
    """A function of columns (first position, end, rows): sums of the normal scores of these positions and of their squares.

    The score of a position is the normal quantile of the median of its order statistic.
    """

    @F.pandas_udf("s double, q double")
    def sums(start: pd.Series, end: pd.Series, rows: pd.Series) -> pd.DataFrame:
        inverse, out = NormalDist().inv_cdf, []
        for a, b, n in zip(start, end, rows):
            top = 0.5 ** (1.0 / n)
            scores = [inverse(1.0 - top if i == 0 else top if i == n - 1 else (i + 1 - 0.3175) / (n + 0.365)) for i in range(a, b)]
            out.append((math.fsum(scores), math.fsum(z * z for z in scores)))
        return pd.DataFrame(out, columns=["s", "q"])

    return sums
