"""Statistics of a measure per segment, and box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clean_number, col
from ..storage import pin_small, stage
from .bins import label_frame
from .frequency import positions, quantile_of_positions, value_counts

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def segment_stats(df: DataFrame, by: str, target: str) -> DataFrame:
    """``(by, count, median, q1, q3, mean, std, iqr)``, rows with a null key left out.

    ``count`` counts rows, also those without a target. Sums combine before the shuffle, and
    quantiles come from value counts, where a hot segment is spread over ranges.
    """
    counts = value_counts(df, [target], [by])
    placed = positions(counts, [by])
    measured = clean_number(col(target))
    quantile = placed.groupBy(by).agg(*[quantile_of_positions(p).alias(k) for k, p in QUARTILES.items()])
    plain = (
        df.filter(col(by).isNotNull())
        .groupBy(col(by))
        .agg(F.count(F.lit(1)).alias("count"), F.avg(measured).alias("mean"), F.stddev_samp(measured).alias("std"))
    )
    return plain.join(quantile, by, "left").select(
        by, "count", "median", "q1", "q3", "mean", "std", (F.col("q3") - F.col("q1")).alias("iqr")
    )


def segments_by_median(df: DataFrame, by: str, target: str) -> DataFrame:
    """``(by, count, median, mean, std)``, highest median first."""
    stats = segment_stats(df, by, target).select(by, "count", "median", "mean", "std")
    return stats.orderBy(F.desc_nulls_last("median"), by)


def median_order(df: DataFrame, by: str, target: str) -> DataFrame:
    """``(by, median)`` in the order a box plot shows its groups."""
    placed = positions(value_counts(df, [target], [by]), [by])
    return placed.groupBy(by).agg(quantile_of_positions(0.5).alias("median")).orderBy(F.desc("median"), by)


def group_mean(df: DataFrame, by: str, measure: str, name: str = "mean") -> DataFrame:
    """``(by, mean)``, smallest first."""
    means = df.filter(col(by).isNotNull()).groupBy(by).agg(F.avg(clean_number(col(measure))).alias(name))
    return means.orderBy(F.asc_nulls_last(name), by)


def residual_by(df: DataFrame, by: str, labels: Sequence[str] | None = None) -> DataFrame:
    """``(by, count, mean_residual, mae)``, largest error first.

    With ``labels`` every label gets a row, in label order, also without data.
    """
    stats = (
        df.filter(col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(clean_number(col("residual"))).alias("mean_residual"),
            F.avg(clean_number(col("abs_residual"))).alias("mae"),
        )
    )
    if labels is None:
        return stats.orderBy(F.desc_nulls_last("mae"), by)
    joined = label_frame(df, labels, by).join(stats, by, "left").orderBy("position")
    return joined.select(by, F.coalesce("count", F.lit(0)).alias("count"), "mean_residual", "mae")


def box_stats(df: DataFrame, by: str, target: str, reach: float = 1.5) -> DataFrame:
    """``(by, n, q1, median, q3, lower_fence, upper_fence, whisker_low, whisker_high, n_outliers)``.

    Whiskers end at the last value inside the fences, outliers are counted beyond them, both
    from the positioned value counts, which are written once and read twice.
    """
    placed = stage(positions(value_counts(df, [target], [by]), [by]), "positions")
    quarters = pin_small(_fences(placed, by, reach))
    inside = F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return (
        placed.join(quarters, by)
        .groupBy(by, "rows", "q1", "median", "q3", "lower_fence", "upper_fence")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("n_outliers"),
        )
        .withColumnRenamed("rows", "n")
    )


def _fences(placed: DataFrame, by: str, reach: float) -> DataFrame:
    quarters = placed.groupBy(by).agg(
        F.max("total").alias("rows"), *[quantile_of_positions(p).alias(k) for k, p in QUARTILES.items()]
    )
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    return quarters.withColumns({"lower_fence": F.col("q1") - spread, "upper_fence": F.col("q3") + spread})


def box_outliers(df: DataFrame, by: str, target: str, reach: float = 1.5) -> DataFrame:
    """The rows beyond the fences of their own segment."""
    placed = positions(value_counts(df, [target], [by]), [by])
    fences = pin_small(_fences(placed, by, reach).select(by, "lower_fence", "upper_fence"))
    value = clean_number(col(target))
    beyond = (value < F.col("lower_fence")) | (value > F.col("upper_fence"))
    return df.join(fences, by).filter(beyond).select(*[col(c) for c in df.columns])
