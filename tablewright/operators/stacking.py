"""Stacked ensemble: a ridge model over out-of-fold predictions of other models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import rmse
from ..functions.scalar import col
from ..storage import stage
from .catalog import complete_rows
from .comoments import CoMoments, comoments
from .linear import LINEAR_MODELS, LinearModel, fit_linear, held_out_mse, solve
from . import trees
from .histograms import BINS, Boosting, Rows, boost, predictions
from .trees import PARALLEL_FITS, TreeSpec, boosting, fit_trees, fits_at_once, out_of_fold, predict

RIDGE = ("ridge", 10.0, 0.0)


def _fit_all(rows: DataFrame, features: Sequence[str], label: str, specs: Mapping[str, TreeSpec | tuple]) -> dict:
    return {
        name: fit_trees(rows, features, label, s) if isinstance(s, TreeSpec) else fit_linear(rows, features, label, s)
        for name, s in specs.items()
    }


def _predict_all(fitted: Mapping, rows: DataFrame) -> DataFrame:
    for name, model in fitted.items():
        rows = rows.withColumn(name, model.prediction()) if isinstance(model, LinearModel) else predict(model, rows, name)
    return rows


@dataclass
class Stack:
    """Base models on all rows and the meta-model on their out-of-fold predictions."""

    members: dict[str, PipelineModel | LinearModel]
    meta: LinearModel

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        scored = _predict_all(self.members, df).withColumn(name, self.meta.prediction())
        return scored.drop(*self.members)


def out_of_fold_predictions(
    df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, specs: Mapping[str, TreeSpec | tuple], fits: int = PARALLEL_FITS
) -> DataFrame:
    """Rows with one column per member, each value from a model that has not seen the row."""
    return out_of_fold(
        df, fold, folds, lambda rest, held: _predict_all(_fit_all(rest, features, label, specs), held), fits
    )


def fit_stack(
    df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, specs: Mapping[str, TreeSpec | tuple], fits: int | None = None
) -> Stack:
    rows = complete_rows(df, [*features, label])
    blind = out_of_fold_predictions(rows, features, label, fold, folds, specs, fits or fits_at_once(rows, specs.values()))
    meta = fit_linear(blind, list(specs), label, RIDGE)
    return Stack(_fit_all(rows, features, label, specs), meta)


#: Linear members of a stack, by their penalties.
LINEAR_MEMBERS = {"ols": LINEAR_MODELS["Linear Regression"], "ridge": LINEAR_MODELS["Ridge"], "strong": ("ridge", 1000.0, 0.0)}


def stack_linear(parts: Mapping[int, CoMoments], members: Mapping[str, tuple], meta: tuple = RIDGE) -> tuple:
    """Weights and intercept of a stack of linear members, from the co-moments of its folds.

    Predictions for a fold by members that have not seen it are linear in the features, so their co-moments with the label follow
    from those of the fold, and so does the meta-model: nothing is fitted on rows, and no row is read again. As the members and the meta-model are
    linear, the whole stack is one linear model.
    """
    blind = []
    for fold, own in parts.items():
        rest = [m for f, m in parts.items() if f != fold]
        if rest:
            seen = rest[0].merged(*rest[1:])
            fitted = [solve(spec, seen) for spec in members.values()]
            # A row for each member, then the label as it is.
            turn = np.vstack([*[np.append(w, 0.0) for w, _ in fitted], np.append(np.zeros(len(own.mean) - 1), 1.0)])
            shift = np.array([*[b for _, b in fitted], 0.0])
            blind.append(CoMoments(own.n, turn @ own.mean + shift, turn @ own.cross @ turn.T))
    weights, intercept = solve(meta, blind[0].merged(*blind[1:]))
    everything = list(parts.values())
    final = [solve(spec, everything[0].merged(*everything[1:])) for spec in members.values()]
    return sum(v * w for v, (w, _) in zip(weights, final)), float(intercept + sum(v * b for v, (_, b) in zip(weights, final)))


def fit_stack_linear(df: DataFrame, features: Sequence[str], label: str, fold: str, members: Mapping[str, tuple] | None = None) -> LinearModel:
    """One scan, whatever the number of members and folds."""
    parts = {k[0]: m for k, m in comoments(df, [*features, label], by=[fold]).items()}
    return LinearModel.of(features, stack_linear(parts, members or LINEAR_MEMBERS))


def cv_stack_linear(
    df: DataFrame, features: Sequence[str], label: str, outer: str, inner: str, members: Mapping[str, tuple] | None = None
) -> DataFrame:
    """``(model, fold, rmse)``: the whole stack is fitted again without each outer fold, all from one scan."""
    cells = comoments(df, [*features, label], by=[outer, inner])
    out = []
    for f in sorted({o for o, _ in cells}):
        parts = {}
        for (o, i), m in cells.items():
            if o != f:
                parts[i] = parts[i].merged(m) if i in parts else m
        held = [m for (o, _), m in cells.items() if o == f]
        if len(parts) > 1:
            mse = held_out_mse(stack_linear(parts, members or LINEAR_MEMBERS), held[0].merged(*held[1:]))
            out.append(("Stacking linear", int(f), mse**0.5))
    return df.sparkSession.createDataFrame(out, "model string, fold int, rmse double")


def cv_stack_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    outer: str,
    outer_folds: int,
    inner: str,
    inner_folds: int,
    boosters: Mapping[str, Boosting],
    linear: Mapping[str, tuple] | None = None,
    bins: int = BINS,
) -> DataFrame:
    """``(model, fold, rmse)`` of a ridge over linear members and boosters of any length.

    All boosters of all outer and inner folds grow side by side in the same scans. One scan more scores the rows by all of
    them, and one gives the co-moments of members and label for every outer fold, from which meta-models and held-out errors follow.
    """
    linear = {"ridge": LINEAR_MODELS["Ridge"]} if linear is None else linear
    rows = complete_rows(df, [*features, label])
    inside = [None, *range(inner_folds)]
    jobs = {
        f"{n}\t{f}\t{g}": (b, Rows(((outer, f),) if g is None else ((outer, f), (inner, g)))) for n, b in boosters.items() for f in range(outer_folds) for g in inside
    }
    models = boost(rows, features, label, key, jobs, [outer, inner], bins)
    place = {k: i + 1 for i, k in enumerate(models)}
    cells = comoments(rows, [*features, label], by=[outer, inner])
    columns = [col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    said = predictions(list(models.values())).alias("p")
    scored = stage(rows.select(*columns, col(label).cast("double").alias("y"), col(outer).alias("o"), col(inner).alias("i"), said), "scored")

    def members(f: int) -> Column:
        """What members say of a row that is not in outer fold ``f``, blind to its inner fold; of one that is, fitted on all the others."""
        values = []
        for spec in linear.values():
            fitted = {g: LinearModel.of([f"x{i}" for i in range(len(features))], solve(spec, _rest(cells, f, g))) for g in inside}
            values.append(_chosen({g: m.prediction() for g, m in fitted.items()}, f))
        for n in boosters:
            values.append(_chosen({g: F.element_at("p", place[f"{n}\t{f}\t{g}"]) for g in inside}, f))
        held = (F.col("o") == f).cast("int")
        return F.struct(F.lit(f).alias("f"), held.alias("held"), *[v.alias(f"m{i}") for i, v in enumerate(values)], F.col("y"))

    long = scored.select(F.inline(F.array(*[members(f) for f in range(outer_folds)])))
    names = [f"m{i}" for i in range(len(linear) + len(boosters))]
    found = comoments(long, [*names, "y"], by=["f", "held"])
    out = [("Stacking", f, held_out_mse(solve(RIDGE, found[f, 0]), found[f, 1]) ** 0.5) for f in range(outer_folds) if (f, 0) in found and (f, 1) in found]
    return df.sparkSession.createDataFrame(out, "model string, fold int, rmse double")


def _rest(cells: Mapping[tuple, CoMoments], f: int, g: int | None) -> CoMoments:
    parts = [m for (o, i), m in cells.items() if o != f and i != g]
    return parts[0].merged(*parts[1:])


def _chosen(by_fold: Mapping, f: int) -> Column:
    blind = F.coalesce(*[F.when(F.col("i") == g, v) for g, v in by_fold.items() if g is not None])
    return F.when(F.col("o") == f, by_fold[None]).otherwise(blind)


def cv_stack(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    outer: str,
    outer_folds: int,
    inner: str,
    inner_folds: int,
    specs: Mapping[str, TreeSpec | tuple],
) -> DataFrame:
    """``(model, fold, rmse)``: the whole stack is fitted again without each outer fold. Boosters of many rows grow side by side, as in ``cv_trees``."""
    rows = complete_rows(df, [*features, label])
    boosters = {n: boosting(s) for n, s in specs.items() if isinstance(s, TreeSpec) and s.kind == "boost"}
    linear = {n: s for n, s in specs.items() if not isinstance(s, TreeSpec)}
    if boosters and len(boosters) + len(linear) == len(specs) and rows.count() > trees.MLLIB_ROWS:
        scores = cv_stack_boosted(rows, features, label, outer, outer, outer_folds, inner, inner_folds, boosters, linear, trees.MAX_BINS)
        return scores.withColumn("fold", F.col("fold").cast(rows.schema[outer].dataType))
    fits = fits_at_once(rows, specs.values(), PARALLEL_FITS**2)  # some of the inner folds in each of some outer ones
    within = min(fits, PARALLEL_FITS)
    scored = out_of_fold(
        rows,
        outer,
        outer_folds,
        lambda rest, held: fit_stack(rest, features, label, inner, inner_folds, specs, within).transform(held),
        fits // within,
    )
    scores = scored.groupBy(outer).agg(rmse(col(label) - F.col("prediction")).alias("rmse"))
    return scores.select(F.lit("Stacking").alias("model"), col(outer).alias("fold"), "rmse")
