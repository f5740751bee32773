"""Linear models solved on the driver from co-moments (a matrix of features by features).

All penalties and all folds share one scan: a training set is the merge of the other folds'
summaries, and the held-out squared error follows from the fold's own summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col
from .comoments import CoMoments, comoments


@dataclass
class LinearModel:
    features: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0

    @classmethod
    def of(cls, features: Sequence[str], solution: tuple[np.ndarray, float]) -> "LinearModel":
        weights, intercept = solution
        return cls(list(features), [float(w) for w in weights], float(intercept))

    def prediction(self) -> Column:
        """The fitted value as an expression: scoring is a projection, without a join or a UDF."""
        out = F.lit(self.intercept)
        for c, w in zip(self.features, self.weights):
            out = out + F.lit(w) * col(c)
        return out

    def coefficients(self, df: DataFrame) -> DataFrame:
        """``(feature, coefficient, abs_coefficient)``, largest first."""
        rows = list(zip(self.features, self.weights))
        table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
        return table.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient"), "feature")


def _parts(m: CoMoments) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    return m.cross[:-1, :-1], m.cross[:-1, -1], m.mean[:-1], m.mean[-1]


def _with_intercept(w: np.ndarray, m: CoMoments) -> tuple[np.ndarray, float]:
    return w, float(m.mean[-1] - w @ m.mean[:-1])


def solve_ols(m: CoMoments) -> tuple[np.ndarray, float]:
    """Least squares; the smallest solution where columns depend on each other."""
    xx, xy, _, _ = _parts(m)
    scale = np.sqrt(np.diag(xx))
    scale[scale == 0] = 1.0
    w = np.linalg.lstsq(xx / np.outer(scale, scale), xy / scale, rcond=1e-10)[0] / scale
    return _with_intercept(w, m)


def solve_ridge(m: CoMoments, alpha: float) -> tuple[np.ndarray, float]:
    """Squared error plus ``alpha`` times the squared weights; the intercept is free."""
    xx, xy, _, _ = _parts(m)
    return _with_intercept(np.linalg.solve(xx + alpha * np.eye(len(xy)), xy), m)


def solve_elastic_net(
    m: CoMoments, alpha: float, l1_ratio: float = 1.0, sweeps: int = 10_000, tolerance: float = 1e-12
) -> tuple[np.ndarray, float]:
    """Mean squared error / 2 plus ``alpha`` times the mixed penalty, one weight at a time."""
    xx, xy, _, _ = _parts(m)
    xx, xy = xx / m.n, xy / m.n
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    w = np.zeros(len(xy))
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if xx[j, j] == 0.0:
                continue
            rest = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (xx[j, j] + l2)
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= tolerance * max(1.0, float(np.abs(w).max())):
            break
    return _with_intercept(w, m)


def held_out_mse(solution: tuple[np.ndarray, float], fold: CoMoments) -> float:
    """Mean squared error of a model on rows known by their co-moments only."""
    w, intercept = solution
    xx, xy, x_mean, y_mean = _parts(fold)
    bias = y_mean - intercept - w @ x_mean
    spread = fold.cross[-1, -1] - 2.0 * w @ xy + w @ xx @ w
    return float(max(spread, 0.0) / fold.n + bias * bias)


#: The compared linear models, name -> (kind, alpha, share of the absolute penalty).
LINEAR_MODELS = {
    "Linear Regression": ("ols", 0.0, 0.0),
    "Ridge": ("ridge", 10.0, 0.0),
    "Lasso": ("net", 0.0005, 1.0),
    "ElasticNet": ("net", 0.0005, 0.9),
}


def solve(spec: tuple[str, float, float], m: CoMoments) -> tuple[np.ndarray, float]:
    kind, alpha, l1_ratio = spec
    if kind == "ols":
        return solve_ols(m)
    return solve_ridge(m, alpha) if kind == "ridge" else solve_elastic_net(m, alpha, l1_ratio)


def fit_linear(df: DataFrame, features: Sequence[str], label: str, spec: tuple[str, float, float] = ("ols", 0.0, 0.0)) -> LinearModel:
    found = comoments(df, [*features, label])
    if () not in found:
        raise ValueError("no complete row to fit on")
    return LinearModel.of(features, solve(spec, found[()]))


def cv_linear(df: DataFrame, features: Sequence[str], label: str, fold: str, models: dict | None = None) -> DataFrame:
    """``(model, fold, rmse)`` of every model and fold, from one scan of the table."""
    models = models or LINEAR_MODELS
    folds = {k[0]: m for k, m in comoments(df, [*features, label], by=[fold]).items()}
    rows = []
    for name, spec in models.items():
        for f, held in folds.items():
            others = [m for g, m in folds.items() if g != f]
            if others:
                rows.append((name, int(f), held_out_mse(solve(spec, others[0].merged(*others[1:])), held) ** 0.5))
    return df.sparkSession.createDataFrame(rows, "model string, fold int, rmse double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """``(model, cv_rmse, cv_std)``: mean and population deviation over the folds."""
    return scores.groupBy("model").agg(F.avg("rmse").alias("cv_rmse"), F.stddev_pop("rmse").alias("cv_std"))
