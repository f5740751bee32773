"""Scores, residual tables and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import mae, r2, rmse
from ..functions.scalar import col
from .catalog import complete_rows
from .shaping import labelled, renamed, to_long, union_all


def regression_metrics(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """``(mae, rmse, r2)`` in one scan; R2 against the mean of these rows."""
    return df.agg(
        mae(actual - predicted).alias("mae"), rmse(actual - predicted).alias("rmse"), r2(actual, predicted).alias("r2")
    )


def residual_table(df: DataFrame, key: str, actual: str, predicted: Column, carry: Sequence[str] = ()) -> DataFrame:
    """``(key, actual, predicted, residual, abs_residual, carried...)`` per row."""
    rows = df.select(col(key), col(actual).alias("actual"), predicted.alias("predicted"), *[col(c) for c in carry])
    residual = F.col("actual") - F.col("predicted")
    return rows.withColumns({"residual": residual, "abs_residual": F.abs(residual)})


def residual_summary(residuals: DataFrame) -> DataFrame:
    """``(metric, value)``: mean, mean absolute value and sample deviation of the residual."""
    summary = residuals.agg(
        F.avg("residual").alias("Mean Residual"),
        F.avg("abs_residual").alias("Mean Absolute Residual"),
        F.stddev_samp("residual").alias("Residual Std"),
    )
    return to_long(summary, summary.columns)


def attach_by_key(rows: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Look original columns up again for derived rows."""
    return rows.join(source.select(col(key), *[col(c) for c in columns]), key)


def cv_rmse(predictions: DataFrame, actual: str, predicted: str, fold: str = "fold") -> DataFrame:
    """``(fold, rmse)`` of held-out predictions."""
    return predictions.groupBy(fold).agg(rmse(col(actual) - col(predicted)).alias("rmse"))


#: Result column names as the three result files spell them.
RESULT_NAMES = {
    "Model": "model",
    "CV RMSE Mean": "cv_rmse",
    "CV RMSE": "cv_rmse",
    "CV RMSE Std": "cv_std",
    "CV Std": "cv_std",
}


def leaderboard(groups: dict[str, DataFrame]) -> DataFrame:
    """``(model, cv_rmse, cv_std, group)`` of all result tables, best first; a missing deviation is null."""
    frames = []
    for group, df in groups.items():
        frame = renamed(df, {k: v for k, v in RESULT_NAMES.items() if k in df.columns})
        if "cv_std" not in frame.columns:
            frame = labelled(frame, cv_std=None)
        frames.append(labelled(frame, group=group))
    table = union_all(frames).select("model", "cv_rmse", "cv_std", "group")
    return table.orderBy(F.asc_nulls_last("cv_rmse"), "model")


def stability(board: DataFrame) -> DataFrame:
    """Only the models whose deviation is known."""
    return complete_rows(board, ["cv_std"])


def plain_text(c: Column) -> Column:
    """A value as text; a number without an exponent, down to 18 decimals and below 10^20."""
    text = c.cast("string")
    digits = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    shown = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(text.rlike(r"^-?[0-9.]+E-?[0-9]+$") & ~shown.rlike(r"^-?0\.0$"), shown).otherwise(text)


def best_model(board: DataFrame) -> DataFrame:
    """``(field, value)`` of the first row, as text."""
    first = board.orderBy(F.asc_nulls_last("cv_rmse"), "model").limit(1)
    parts = [p for c in first.columns for p in (F.lit(c), plain_text(col(c)))]
    return first.select(F.stack(F.lit(len(first.columns)), *parts).alias("field", "value"))
