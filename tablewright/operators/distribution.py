"""Shape of a distribution: skewness, kurtosis, normality test."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import adjusted_kurtosis, adjusted_skewness, jarque_bera, jarque_bera_p
from ..functions.scalar import clean_number, col

FIELDS = ["n", "skewness", "excess_kurtosis", "jb_stat", "jb_p"]


def distribution_diagnostics(df: DataFrame, versions: Mapping[str, Column]) -> DataFrame:
    """``(version, n, skewness, excess_kurtosis, jb_stat, jb_p)``, all versions in one scan.

    A version is an expression that is null for the rows it leaves out.
    """
    sums, parts = [], []
    for i, (name, version) in enumerate(versions.items()):
        x = clean_number(version)
        statistic = jarque_bera(x)
        sums += [
            F.count(x).alias(f"n{i}"),
            adjusted_skewness(x).alias(f"skewness{i}"),
            adjusted_kurtosis(x).alias(f"excess_kurtosis{i}"),
            statistic.alias(f"jb_stat{i}"),
            jarque_bera_p(statistic).alias(f"jb_p{i}"),
        ]
        parts += [F.lit(name), *[F.col(f"{f}{i}") for f in FIELDS]]
    return df.agg(*sums).select(F.stack(F.lit(len(versions)), *parts).alias("version", *FIELDS))


def raw_and_log(target: str) -> dict[str, Column]:
    return {target: col(target), f"log1p({target})": F.log1p(col(target))}


def before_after(target: str, flag: str) -> dict[str, Column]:
    """Raw, without flagged rows, and log1p of the latter."""
    kept = F.when(F.coalesce(col(flag), F.lit(0)) == 0, col(target))
    return {f"before_{target}": col(target), f"after_outlier_{target}": kept, f"after_log1p_{target}": F.log1p(kept)}
