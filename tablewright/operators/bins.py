"""Quantile bins, histograms, density curves, Q-Q points and trend lines: the numbers behind the figures."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moments import pearson
from ..functions.scalar import clean_number, col, nan_to_null, safe_ratio
from ..functions.special import normal_quantile, normal_score_sums
from ..storage import pin_small
from .catalog import complete_rows
from .frequency import even_quantiles, positions, quantile_values, quantiles, value_counts

#: The price segments and their shares.
PRICE_SHARES = [0.0, 0.5, 0.9, 1.0]
PRICE_LABELS = ["Mainstream_50pct", "UpperMid_40pct", "Luxury_10pct"]
THIRDS_LABELS = ["Low", "Mid", "High"]


def even_shares(bins: int) -> list[float]:
    return [i / bins for i in range(bins + 1)]


def bin_edges(df: DataFrame, column: str, shares: Sequence[float]) -> list[float]:
    """Exact quantile edges, equal ones merged."""
    return sorted(set(quantile_values(df, column, shares)))


def bin_number(value: Column, edges: Sequence[float]) -> Column:
    """0-based right-closed bin, the lowest edge included; null outside or without two edges."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    out = F.when(value < edges[0], F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:]):
        out = out.when(value <= edge, F.lit(i))
    return out


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin; needs one label per bin."""
    if len(edges) != len(labels) + 1:
        raise ValueError(f"{len(edges) - 1} bins are left for {len(labels)} labels")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), bin_number(value, edges) + 1)


def with_quantile_bin(
    df: DataFrame, column: str, shares: Sequence[float], labels: Sequence[str] | None = None, name: str = "bin"
) -> DataFrame:
    """Add the quantile bin of a column, as a label or a number."""
    edges = bin_edges(df, column, shares)
    value = bin_label(col(column), edges, labels) if labels else bin_number(col(column), edges)
    return df.withColumn(name, value)


def label_frame(df: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(labels)], f"position int, `{name}` string")


def many_bin_edges(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float]]:
    """Quantile edges of many columns from one job; a column without values gets none."""
    names = {f"e{i}": p for i, p in enumerate(shares)}
    found = {r["feature"]: sorted({r[n] for n in names}) for r in quantiles(df, columns, names).collect()}
    return {c: found.get(c, []) for c in columns}


def variance_ratios(df: DataFrame, features: Sequence[str], target: str, bins: int = 5) -> DataFrame:
    """``(feature, n_bins, variance_ratio)``: largest over smallest target variance of the quantile bins.

    Null where fewer than two bins have a variance or the smallest is zero.
    """
    rows = df.filter(clean_number(col(target)).isNotNull())
    edges = many_bin_edges(rows, features, even_shares(bins))
    parts = [p for c in features for p in (F.lit(c), bin_number(col(c), edges[c]))]
    per_bin = (
        rows.select(col(target).alias("y"), F.stack(F.lit(len(features)), *parts).alias("feature", "bin"))
        .filter("bin IS NOT NULL")
        .groupBy("feature", "bin")
        .agg(F.var_samp("y").alias("v"))
        .filter("v IS NOT NULL")
    )
    low, high, n = F.min("v"), F.max("v"), F.count(F.lit(1))
    return per_bin.groupBy("feature").agg(
        n.alias("n_bins"), F.when((n > 1) & (low > 0), safe_ratio(high, low)).alias("variance_ratio")
    )


def value_range(df: DataFrame, column: str) -> tuple[float, float, int, float | None]:
    """Smallest value, largest value, count and sample deviation of a column."""
    x = nan_to_null(col(column).cast("double"))
    row = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("sd")).first()
    return row["lo"], row["hi"], row["n"], row["sd"]


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``(bin, lower, upper, n)`` of equal-width bins, empty ones included, the last one closed."""
    lo, hi, n, _ = value_range(df, column)
    if not n:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return _histogram(df, column, bins, lo, hi)


def _histogram(df: DataFrame, column: str, bins: int, lo: float, hi: float) -> DataFrame:
    x = nan_to_null(col(column).cast("double"))
    number = F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins).cast("long")).cast("int")
    counted = df.filter(x.isNotNull()).select(number.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    all_bins = df.sparkSession.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


#: Bins per bandwidth of a density, and powers of the offset that a bin keeps.
DENSITY_BINS, DENSITY_POWERS = 16, 6
#: Bandwidths beyond which a bin adds nothing (10^-16 of its height).
DENSITY_REACH = 8.6


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """``(point, x, density)``: Gaussian kernel with Scott's bandwidth over all rows.

    Rows are summed in bins of a sixteenth of the bandwidth, each with the powers of the offsets from its middle up to the sixth; with
    these the kernels of its rows are a series in Hermite polynomials. What the series leaves out is less than 10^-12 of the height of
    a kernel, as offsets are at most 1/32 bandwidth. Bins follow the bandwidth, so their number depends on the spread of the values.
    """
    schema = "point int, x double, density double"
    lo, hi, n, sd = value_range(df, column)
    if not n or not sd:
        return df.sparkSession.createDataFrame([], schema)
    width, step = float(sd) * n ** (-1.0 / 5.0), (hi - lo) / (points - 1)
    value = nan_to_null(col(column).cast("double"))
    scaled = df.select(((value - F.lit(lo)) / F.lit(width)).alias("t")).where("t IS NOT NULL")
    binned = scaled.select(F.round(F.col("t") * DENSITY_BINS).alias("bin"), "t").withColumn("u", F.col("t") - F.col("bin") / DENSITY_BINS)
    powers = [F.sum(F.pow("u", F.lit(k))).alias(f"m{k}") for k in range(1, DENSITY_POWERS + 1)]
    bars = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("m0"), *powers).withColumn("at", F.col("bin") / DENSITY_BINS)
    per_point = step / width
    first = F.greatest(F.ceil((F.col("at") - DENSITY_REACH) / per_point), F.lit(0))
    last = F.least(F.floor((F.col("at") + DENSITY_REACH) / per_point), F.lit(points - 1))
    served = bars.where(first <= last).withColumn("point", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    z = F.col("z")
    hermite = [F.lit(1.0), z]
    for k in range(1, DENSITY_POWERS):
        hermite.append(z * hermite[k] - F.lit(float(k)) * hermite[k - 1])
    series, factorial = F.col("m0").cast("double"), 1.0
    for k in range(1, DENSITY_POWERS + 1):
        factorial *= k
        series = series + F.col(f"m{k}") * hermite[k] / F.lit(factorial)
    placed = served.withColumn("z", F.col("point") * F.lit(per_point) - F.col("at"))
    sums = placed.groupBy("point").agg(F.sum(F.exp(-0.5 * z * z) * series).alias("s"))
    grid = df.sparkSession.range(points, numPartitions=1).select(F.col("id").cast("int").alias("point"))
    density = F.coalesce("s", F.lit(0.0)) / F.lit(n * width * float(np.sqrt(2 * np.pi)))
    return grid.join(sums, "point", "left").select("point", (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"), density.alias("density"))


#: Positions whose normal scores are summed at once.
SCORED_AT_ONCE = 4096


def qq_line(df: DataFrame, column: str) -> DataFrame:
    """``(slope, intercept, r)`` of the line of all values against the medians of normal order statistics.

    Every row has its own position. A distinct value has a run of them, cut into pieces of bounded length, and adds
    the sums of their scores; so no row is sorted twice and a value that many rows share is spread over tasks.
    """
    whole = clean_number(col(column))
    n, mean, variance = df.agg(F.count(whole), F.avg(whole), F.var_pop(whole)).first()
    if n < 2 or not variance:
        return df.sparkSession.createDataFrame([], "slope double, intercept double, r double")
    score = normal_score_sums()
    runs = positions(value_counts(df, [column])).select("value", "before", (F.col("before") + F.col("n")).alias("until"))
    pieces = runs.select("value", "until", F.explode(F.sequence("before", F.col("until") - 1, F.lit(SCORED_AT_ONCE))).alias("start"))
    summed = pieces.select("value", score(F.col("start"), F.least(F.col("start") + SCORED_AT_ONCE, F.col("until")), F.lit(n)).alias("z"))
    x, xx, xy = summed.agg(F.sum("z.s"), F.sum("z.q"), F.sum((F.col("value") - F.lit(mean)) * F.col("z.s"))).first()
    spread = xx - x * x / n
    slope = xy / spread
    row = (slope, mean - slope * x / n, xy / float(np.sqrt(spread * n * variance)))
    return df.sparkSession.createDataFrame([tuple(map(float, row))], "slope double, intercept double, r double")


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """``(point, probability, theoretical, observed, slope, intercept, r)`` against the normal.

    Observed values are exact quantiles at ``(point + 0.5) / points``; line and correlation
    are those of all rows (``qq_line``).
    """
    normal = [(i, normal_quantile((i + 0.5) / points)) for i in range(points)]
    theoretical = df.sparkSession.createDataFrame(normal, "point int, theoretical double")
    observed = even_quantiles(df, column, points).withColumnRenamed("value", "observed")
    line = pin_small(qq_line(df, column))
    return observed.join(theoretical, "point").join(line, F.lit(True), "left").select(
        "point", "probability", "theoretical", "observed", "slope", "intercept", "r"
    )


def trend_lines(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, n, slope, intercept, r2)`` of straight lines, all features in one scan."""
    y = clean_number(col(target))
    parts, sums = [], []
    for i, c in enumerate(features):
        x = clean_number(col(c))
        sums += [
            F.regr_count(y, x).alias(f"n{i}"),
            F.regr_slope(y, x).alias(f"s{i}"),
            F.regr_intercept(y, x).alias(f"i{i}"),
            F.pow(pearson(x, y), 2).alias(f"r{i}"),
        ]
        parts += [F.lit(c), F.col(f"n{i}"), F.col(f"s{i}"), F.col(f"i{i}"), F.col(f"r{i}")]
    stacked = F.stack(F.lit(len(features)), *parts).alias("feature", "n", "slope", "intercept", "r2")
    return df.agg(*sums).select(stacked)


def quadratic_trend(df: DataFrame, column: str, target: str) -> DataFrame:
    """``(feature, c0, c1, c2)`` of ``y = c0 + c1*x + c2*x^2``.

    Power sums of the standardised value keep the small system well conditioned.
    """
    schema = "feature string, c0 double, c1 double, c2 double"
    rows = df.select(col(column).cast("double").alias("x"), col(target).cast("double").alias("y"))
    rows = complete_rows(rows)
    base = rows.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    if not base["s"]:
        return df.sparkSession.createDataFrame([], schema)
    z = (F.col("x") - F.lit(base["m"])) / F.lit(base["s"])
    sums = rows.agg(
        *[F.sum(F.pow(z, F.lit(float(k)))).alias(f"z{k}") for k in range(5)],
        *[F.sum(F.pow(z, F.lit(float(k))) * F.col("y")).alias(f"y{k}") for k in range(3)],
    ).first()
    left = np.array([[sums[f"z{i + j}"] for j in range(3)] for i in range(3)])
    a, b, c = np.linalg.lstsq(left, np.array([sums[f"y{i}"] for i in range(3)]), rcond=1e-12)[0]
    m, s = base["m"], base["s"]
    coefficients = (a - b * m / s + c * m * m / s**2, b / s - 2 * c * m / s**2, c / s**2)
    return df.sparkSession.createDataFrame([(column, *map(float, coefficients))], schema)


def scatter_extract(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The columns of a plot with one point per row: every row, whatever their number."""
    return df.select(col(key), *[col(c) for c in columns])
