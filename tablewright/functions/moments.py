"""Moment statistics as aggregate expressions that never fail on short or constant input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import safe_ratio

#: Relative error that the mean of equal values may have: 64 times the distance of neighbouring doubles at 1.
ROUNDING = 64 * 2.0**-52


def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted skewness G1; null below three values or for a constant."""
    n = F.count(c).cast("double")
    factor = F.when(n > 2, F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    return F.skewness(c) * factor


def adjusted_kurtosis(c: Column) -> Column:
    """Bias-adjusted excess kurtosis G2; null below four values or for a constant."""
    n = F.count(c).cast("double")
    factor = F.when(n > 3, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)))
    return factor * ((n + 1) * F.kurtosis(c) + 6)


def jarque_bera(c: Column) -> Column:
    """Jarque-Bera statistic from the biased moments."""
    return F.count(c) / 6.0 * (F.pow(F.skewness(c), 2) + F.pow(F.kurtosis(c), 2) / 4.0)


def jarque_bera_p(statistic: Column) -> Column:
    """Tail of the chi-square distribution with two degrees of freedom."""
    return F.exp(-statistic / 2.0)


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over complete pairs; null where one side is constant.

    Equal values may leave the rounding error of their mean as a spread; that counts as constant.
    """
    noise = F.sqrt(F.regr_count(y, x).cast("double")) * F.lit(ROUNDING)
    sx, sy = F.sqrt(F.regr_sxx(y, x)), F.sqrt(F.regr_syy(y, x))
    varies = (sx > noise * F.abs(F.regr_avgx(y, x))) & (sy > noise * F.abs(F.regr_avgy(y, x)))
    return F.when(varies, safe_ratio(F.regr_sxy(y, x), sx * sy))


def rmse(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def mae(error: Column) -> Column:
    return F.avg(F.abs(error))


def r2(actual: Column, predicted: Column) -> Column:
    """Coefficient of determination against the mean of the same rows."""
    error = actual - predicted
    return 1.0 - safe_ratio(F.sum(error * error), F.count(actual) * F.var_pop(actual))
