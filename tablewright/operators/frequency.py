"""Exact order statistics from distributed value counts.

``percentile``, ``median`` and ``mode`` of Spark hold every distinct value of a group in
one task. Here a column is first reduced to counts of its distinct values. These are cut
into value ranges of about equal weight, so that no task holds more than one range of one
group, whatever share of the rows that group has. The running count over the ranges then
gives the exact position of every value. Quantiles, medians, modes, ranks and bins all
derive from that one table.

The cut points only balance the work; results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_number, col

INF = float("inf")


def range_count(df: DataFrame) -> int:
    """Ranges per column: a few per shuffle partition."""
    return max(16, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> dict[str, list[float]]:
    """Approximate quantiles per column; about ``16 * ranges`` numbers each reach the driver.

    Sketches merge in as many tasks as there are ranges to 16. Each of these needs the fewer points the more there are
    of them, so neither the sketch of a task nor the work of merging grows with the table.
    """
    ranges = ranges or range_count(df)
    slots = max(16, ranges // 16)
    points = max(16, 16 * ranges // slots)
    probs = [i / points for i in range(1, points)]
    sketches = (
        df.groupBy((F.spark_partition_id() % slots).alias("slot"))
        .agg(*[F.percentile_approx(col(c).cast("double"), probs, 4 * points).alias(f"q{i}") for i, c in enumerate(columns)])
        .collect()
    )
    out = {}
    for i, c in enumerate(columns):
        points = sorted(p for row in sketches for p in (row[f"q{i}"] or []) if p == p and abs(p) != INF)
        step = max(1, len(points) // ranges)
        out[c] = sorted(set(points[::step]))
    return out


def with_ranges(df: DataFrame, columns: Sequence[str], cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Add ``<column>__range``, the number of the value range each value falls in."""
    splits = [[-INF, *(cuts[c] or [0.0]), INF] for c in columns]  # a column without values still needs a cut
    return Bucketizer(
        splitsArray=splits,
        inputCols=list(columns),
        outputCols=[f"{c}__range" for c in columns],
        handleInvalid="keep",
    ).transform(df)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), nulls: bool = False) -> DataFrame:
    """``(keep..., feature, value, rng)``: one row per row and column, NaN taken as null."""
    aliases = [f"v{i}" for i in range(len(columns))]
    narrow = df.select(
        *[col(k) for k in keep],
        *[clean_number(col(c)).alias(a) for c, a in zip(columns, aliases)],
    )
    cuts = cut_points(narrow, aliases)
    ranged = with_ranges(narrow, aliases, cuts)
    parts = [p for a, c in zip(aliases, columns) for p in (F.lit(c), F.col(a), F.col(f"{a}__range").cast("int"))]
    out = ranged.select(*[col(k) for k in keep], F.stack(F.lit(len(columns)), *parts).alias("feature", "value", "rng"))
    return out if nulls else out.filter(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), nulls: bool = False) -> DataFrame:
    """``(by..., feature, rng, value, n)`` for numeric columns; groups with a null key are left out."""
    for key in by:
        df = df.filter(col(key).isNotNull())
    return counts_of(long_form(df, columns, by, nulls), by)


def counts_of(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return long.groupBy(*[col(k) for k in by], "feature", "rng", "value").agg(F.count(F.lit(1)).alias("n"))


def positions(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``before`` (rows with a smaller value in the group) and ``total`` (rows of the group)."""
    group = [*by, "feature"]
    per_range = counts.groupBy(*group, "rng").agg(F.sum("n").alias("range_rows"))
    ordered = Window.partitionBy(*group).orderBy("rng")
    offsets = per_range.select(
        *group,
        "rng",
        (F.sum("range_rows").over(ordered) - F.col("range_rows")).alias("offset"),
        F.sum("range_rows").over(Window.partitionBy(*group)).alias("total"),
    )
    inside = Window.partitionBy(*group, "rng").orderBy("value")
    return (
        counts.withColumn("upto", F.sum("n").over(inside))
        .join(offsets, [*group, "rng"])
        .select(*group, "rng", "value", "n", (F.col("offset") + F.col("upto") - F.col("n")).alias("before"), "total")
    )


def value_at(rank: Column) -> Column:
    """Aggregate: the value at 0-based ``rank`` of a group of positioned values."""
    return F.min(F.when(F.col("before") + F.col("n") > rank, F.col("value")))


def quantile_of_positions(p: float) -> Column:
    """Aggregate: linearly interpolated quantile of a group of positioned values."""
    h = (F.col("total") - 1) * F.lit(float(p))
    low, high = value_at(F.floor(h)), value_at(F.ceil(h))
    weight = F.max(h - F.floor(h))
    return low + (high - low) * weight


def quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, rows, <name>...)``: exact interpolated quantiles of many columns at once."""
    placed = positions(value_counts(df, columns, by), by)
    return placed.groupBy(*by, "feature").agg(
        F.max("total").alias("rows"), *[quantile_of_positions(p).alias(name) for name, p in probs.items()]
    )


def even_quantiles(df: DataFrame, column: str, points: int) -> DataFrame:
    """``(point, probability, value)`` at probabilities ``(point + 0.5) / points``, for many points.

    Each distinct value works out which of the points it serves, so the cost per value does
    not grow with the number of points.
    """
    placed = positions(value_counts(df, [column]))
    last = F.col("total") - 1
    h = last * ((F.col("point") + 0.5) / F.lit(float(points)))
    near = F.lit(float(points)) / F.greatest(last, F.lit(1))
    first = F.greatest(F.floor((F.col("before") - 1) * near - 0.5) - 1, F.lit(0))
    final = F.least(F.floor((F.col("before") + F.col("n")) * near - 0.5) + 1, F.lit(points - 1))
    served = placed.withColumn("point", F.explode(F.sequence(F.least(first, F.lit(points - 1)), F.greatest(final, F.lit(0)), F.lit(1))))
    holds_low = F.floor(h).between(F.col("before"), F.col("before") + F.col("n") - 1)
    holds_high = F.ceil(h).between(F.col("before"), F.col("before") + F.col("n") - 1)
    ends = (
        served.filter(holds_low | holds_high)
        .groupBy("point")
        .agg(
            F.max(F.when(holds_low, F.col("value"))).alias("low"),
            F.max(F.when(holds_high, F.col("value"))).alias("high"),
            F.max(h - F.floor(h)).alias("weight"),
        )
    )
    return ends.select(
        F.col("point").cast("int").alias("point"),
        ((F.col("point") + 0.5) / F.lit(float(points))).alias("probability"),
        (F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")).alias("value"),
    )


def quantile_values(df: DataFrame, column: str, probs: Sequence[float]) -> list[float]:
    """Exact quantiles of one column on the driver: ``len(probs)`` numbers, empty for no rows."""
    names = {f"q{i}": p for i, p in enumerate(probs)}
    row = quantiles(df, [column], names).first()
    return [] if row is None else [row[name] for name in names]


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians as driver scalars; None for a column without values."""
    if not columns:
        return {}
    found = {r["feature"]: r["median"] for r in quantiles(df, columns, {"median": 0.5}).collect()}
    return {c: found.get(c) for c in columns}


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, mode, n)`` of text columns; on a tie the smallest value."""
    parts = [p for c in columns for p in (F.lit(c), col(c).cast("string"))]
    counts = (
        df.select(*[col(k) for k in by], F.stack(F.lit(len(columns)), *parts).alias("feature", "value"))
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    most_then_smallest = F.struct(-F.col("n"), F.col("value"))
    return counts.groupBy(*by, "feature").agg(
        F.min_by("value", most_then_smallest).alias("mode"), F.max("n").alias("n")
    )


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Modes as driver scalars; None for a column without values."""
    if not columns:
        return {}
    found = {r["feature"]: r["mode"] for r in modes(df, columns).collect()}
    return {c: found.get(c) for c in columns}
