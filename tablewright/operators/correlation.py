"""Pearson, mutual information and the tables derived from them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moments import pearson
from ..functions.scalar import col, nan_to_null
from ..functions.special import correlation_p_value
from .bins import bin_number, even_shares, many_bin_edges, variance_ratios
from .comoments import SQL_COLUMNS, pairwise_correlations
from .ranks import spearman
from .shaping import top_k, union_all

#: Pairs per aggregate: more would leave generated code.
PAIRS_PER_SCAN = 24


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(a, b, n, r)`` over the rows complete in both columns of each pair."""
    clean = {c: nan_to_null(col(c).cast("double")) for pair in pairs for c in pair}
    blocks = []
    for start in range(0, len(pairs), PAIRS_PER_SCAN):
        block = list(pairs[start : start + PAIRS_PER_SCAN])
        sums, parts = [], []
        for i, (a, b) in enumerate(block):
            x, y = clean[a], clean[b]
            sums += [F.regr_count(y, x).alias(f"n{i}"), pearson(x, y).alias(f"r{i}")]
            parts += [F.lit(a), F.lit(b), F.col(f"n{i}"), F.col(f"r{i}")]
        blocks.append(df.agg(*sums).select(F.stack(F.lit(len(block)), *parts).alias("a", "b", "n", "r")))
    return union_all(blocks)


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, n, pearson, p_value)`` of every feature with the target."""
    found = pair_correlations(df, [(c, target) for c in features])
    return found.select(
        F.col("a").alias("feature"), "n", F.col("r").alias("pearson"), correlation_p_value(F.col("r"), F.col("n")).alias("p_value")
    )


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, r)`` for all ordered pairs, each over its own complete rows.

    A few columns are one SQL aggregate; many are summed per batch, with the same results.
    """
    if len(columns) > SQL_COLUMNS:
        return _matrix_rows(df, columns, pairwise_correlations(df, columns))
    pairs = [(columns[i], columns[j]) for i in range(len(columns)) for j in range(i, len(columns))]
    half = pair_correlations(df, pairs).select("a", "b", "r")
    mirror = F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    once = F.when(F.col("a") == F.col("b"), F.slice(mirror, 1, 1)).otherwise(mirror)
    return half.select(F.inline(once))


def wide_pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, r)`` of a table without nulls and with many columns, such as an encoded one.

    MLlib sums the cross products per partition and merges them in a tree. A constant
    column has no correlation (null).
    """
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v", handleInvalid="error").transform(
        df.select(*[col(c).cast("double") for c in columns])
    )
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    return _matrix_rows(df, columns, matrix)


def _matrix_rows(df: DataFrame, names: Sequence[str], matrix: np.ndarray) -> DataFrame:
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def target_ranking(matrix: DataFrame, target: str) -> DataFrame:
    """``(feature, pearson)`` of the target's row, largest first, the target itself included."""
    row = matrix.filter((F.col("b") == target) & F.col("r").isNotNull())
    return row.select(F.col("a").alias("feature"), F.col("r").alias("pearson")).orderBy(F.desc("pearson"), "feature")


def correlation_importance(matrix: DataFrame, target: str, k: int = 15) -> DataFrame:
    """The k features most correlated with the target."""
    others = target_ranking(matrix, target).filter(F.col("feature") != target)
    return top_k(others, k, "pearson", "feature")


def top_submatrix(matrix: DataFrame, target: str, k: int = 15) -> DataFrame:
    """The matrix over the k best ranked columns, the target among them."""
    matrix = matrix.sparkSession.createDataFrame(matrix.collect(), matrix.schema)  # a row for each two columns
    best = top_k(target_ranking(matrix, target), k, "pearson", "feature").select("feature")
    kept = matrix.join(best.withColumnRenamed("feature", "a"), "a", "left_semi")
    return kept.join(best.withColumnRenamed("feature", "b"), "b", "left_semi").select("a", "b", "r")


def collinear_pairs(matrix: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """``(feature_a, feature_b, abs_r)`` of distinct pairs at or above the threshold, in column order."""
    place = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    above = F.col("r").isNotNull() & (F.abs("r") >= threshold)
    upper = F.element_at(place, F.col("a")) < F.element_at(place, F.col("b"))
    return (
        matrix.filter(above & upper)
        .select(F.col("a").alias("feature_a"), F.col("b").alias("feature_b"), F.abs("r").alias("abs_r"))
        .orderBy(F.desc("abs_r"), "feature_a", "feature_b")
    )


def feature_gain(df: DataFrame, candidates: Sequence[str], target: str) -> DataFrame:
    """``(feature, pearson)`` of parts and whole with the target; needs three rows."""
    have = [c for c in candidates if c in df.columns]
    found = pair_correlations(df, [(c, target) for c in have]).filter(F.col("n") >= 3)
    return found.select(F.col("a").alias("feature"), F.col("r").alias("pearson")).orderBy(F.desc_nulls_last("pearson"), "feature")


def relationship_diagnostics(df: DataFrame, features: Sequence[str], target: str, bins: int = 5) -> DataFrame:
    """Linear and monotonic strength of each feature, and how unequal the target varies along it.

    ``(feature, n, pearson, pearson_p, spearman, spearman_p, monotonic_minus_linear, variance_ratio)``
    """
    linear = target_correlations(df, features, target).withColumnRenamed("p_value", "pearson_p")
    ranked = spearman(df, features, target).select(
        "feature", "spearman", correlation_p_value(F.col("spearman"), F.col("n")).alias("spearman_p")
    )
    ratios = variance_ratios(df, features, target, bins).select("feature", "variance_ratio")
    return (
        linear.filter(F.col("n") > 3)
        .join(ranked, "feature", "left")
        .join(ratios, "feature", "left")
        .withColumn("monotonic_minus_linear", F.abs("spearman") - F.abs("pearson"))
        .select(
            "feature", "n", "pearson", "pearson_p", "spearman", "spearman_p", "monotonic_minus_linear", "variance_ratio"
        )
    )


def heteroscedasticity(residuals: DataFrame) -> DataFrame:
    """Correlation of the absolute residual with the prediction: one row."""
    linear = target_correlations(residuals, ["predicted"], "abs_residual")
    ranked = spearman(residuals, ["predicted"], "abs_residual")
    return linear.join(ranked.select("feature", "spearman"), "feature").select(
        F.lit("corr(abs_residual, predicted)").alias("metric"),
        "pearson",
        F.col("p_value").alias("pearson_p"),
        "spearman",
        correlation_p_value(F.col("spearman"), F.col("n")).alias("spearman_p"),
    )


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """``(feature, mi)`` in nats over quantile bins of feature and target, largest first.

    Edges are exact quantiles; one more scan counts the cells, at most ``bins * bins`` per
    feature, so the shuffle is small whatever the size of the table.
    """
    edges = many_bin_edges(df, [*features, target], even_shares(bins))
    y_bin = bin_number(col(target), edges[target])
    parts = [p for c in features for p in (F.lit(c), bin_number(col(c), edges[c]))]
    cells = (
        df.select(y_bin.alias("yb"), F.stack(F.lit(len(features)), *parts).alias("feature", "xb"))
        .na.drop()
        .groupBy("feature", "xb", "yb")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    def total(*keys: str):
        return F.sum("n").over(Window.partitionBy("feature", *keys))

    joint, expected = F.col("n") / F.col("nt"), (F.col("nx") / F.col("nt")) * (F.col("ny") / F.col("nt"))
    return (
        cells.withColumns({"nx": total("xb"), "ny": total("yb"), "nt": total()})
        .groupBy("feature")
        .agg(F.sum(joint * F.log(joint / expected)).alias("mi"))
        .orderBy(F.desc("mi"), "feature")
    )
