"""Domain outliers: flag, remove, and measure how far they move a model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import mae, r2, rmse
from ..functions.scalar import col
from .catalog import complete_rows
from .features import keep_where_not
from .linear import LinearModel, solve_ols
from .comoments import comoments
from .shaping import flag_where


@dataclass(frozen=True)
class SizePriceRule:
    """Large but cheap: ``size > above`` and ``price < below``."""

    size: str
    price: str
    above: float
    below: float


#: The default rule of the house table.
HOUSE_RULE = SizePriceRule("GrLivArea", "SalePrice", 4000.0, 300000.0)


def flag_outliers(df: DataFrame, rule: SizePriceRule, name: str = "is_outlier") -> DataFrame:
    """Add a 0/1 flag; all 0 where the rule's columns are absent."""
    if rule.size not in df.columns or rule.price not in df.columns:
        return df.withColumn(name, F.lit(0))
    return flag_where(df, name, (col(rule.size) > rule.above) & (col(rule.price) < rule.below))


def remove_outliers(df: DataFrame, name: str = "is_outlier") -> DataFrame:
    return keep_where_not(df, col(name) == 1)


SENSITIVITY_SCHEMA = "scenario string, n_rows bigint, mae double, rmse double, r2 double, outlier_count bigint"


def outlier_sensitivity(
    df: DataFrame, flag: str, features: Sequence[str], target: str, validation: str
) -> DataFrame:
    """The same least squares fit with and without flagged rows, scored on the held-out rows.

    One scan gives the co-moments per (validation, flag), from which both fits follow; one
    more scores both on the held-out rows, each by sums over its own rows.
    """
    features = [c for c in features if c in df.columns]
    spark = df.sparkSession
    if len(features) < 2:
        return spark.createDataFrame([], SENSITIVITY_SCHEMA)
    rows = complete_rows(df.select(*features, target, flag, validation), [*features, target])
    groups = comoments(rows, [*features, target], by=[validation, flag])
    held_in = {f: m for (v, f), m in groups.items() if v == 0}
    sums, scenarios = [], []
    for i, (scenario, flags) in enumerate((("with_outliers", (0, 1)), ("without_outliers", (0,)))):
        parts = [held_in[f] for f in flags if f in held_in]
        if not parts:
            return spark.createDataFrame([], SENSITIVITY_SCHEMA)
        fitted = parts[0].merged(*parts[1:])
        model = LinearModel.of(features, solve_ols(fitted))
        kept = col(flag).isin(list(flags))
        held = kept & (col(validation) == 1)
        predicted = F.when(held, model.prediction())
        actual = F.when(held, col(target))
        scores = {
            "n_rows": F.count_if(kept),
            "mae": mae(actual - predicted),
            "rmse": rmse(actual - predicted),
            "r2": r2(actual, predicted),
            "outlier_count": F.sum(F.when(kept, col(flag)).otherwise(0)),
        }
        sums += [value.alias(f"{name}{i}") for name, value in scores.items()]
        scenarios.append(F.struct(F.lit(scenario).alias("scenario"), *[F.col(f"{name}{i}").alias(name) for name in scores]))
    return rows.agg(*sums).select(F.inline(F.array(*scenarios)))
