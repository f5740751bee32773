"""Unions, long form, keep-first, top-k and null-last ordering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def labelled(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns; None becomes a null double."""
    return df.withColumns(
        {k: F.lit(v) if v is not None else F.lit(None).cast("double") for k, v in constants.items()}
    )


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def first_per_group(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the smallest ``order``; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[col(c) for c in rest]), col(order)).alias("row")
    return df.groupBy(*[col(k) for k in keys]).agg(first).select(*[col(k) for k in keys], "row.*").select(
        *[col(c) for c in df.columns]
    )


def extreme_row(df: DataFrame, target: str, key: str, largest: bool = True) -> DataFrame:
    """The row with the largest or smallest target; on a tie the smallest key."""
    rows = df.filter(col(target).isNotNull())
    whole = F.struct(*[col(c) for c in df.columns])
    if largest:
        best = F.min_by(whole, F.struct(-col(target), col(key)))
    else:
        best = F.min_by(whole, F.struct(col(target), col(key)))
    return rows.agg(best.alias("row")).filter(F.col("row").isNotNull()).select("row.*")


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "metric", value: str = "value") -> DataFrame:
    """One row per listed column, values as doubles."""
    parts = [p for c in columns for p in (F.lit(c), col(c).cast("double"))]
    return df.select(*[col(k) for k in keep], F.stack(F.lit(len(columns)), *parts).alias(name, value))


def ordered(df: DataFrame, by: str, *ties: str, descending: bool = False) -> DataFrame:
    """Nulls last either way, with tie-break columns for a stable order."""
    main = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return df.orderBy(main, *ties)


def top_k(df: DataFrame, k: int, by: str, *ties: str, descending: bool = True) -> DataFrame:
    return ordered(df, by, *ties, descending=descending).limit(k)


def row_profile(df: DataFrame, target: str, key: str, columns: Sequence[str], k: int = 10) -> DataFrame:
    """``(which, feature, value)``: the k largest values of the rows with the most and least target."""
    out = []
    for which, largest in (("high", True), ("low", False)):
        row = to_long(extreme_row(df, target, key, largest), columns, name="feature")
        out.append(top_k(row.filter(F.col("value").isNotNull()), k, "value", "feature").select(F.lit(which).alias("which"), "*"))
    return union_all(out)


def only_in_first(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def occurs_in(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose value is in a one-column list."""
    return df.join(listed.toDF(column).distinct(), column, "left_semi")


def flag_where(df: DataFrame, name: str, mask: Column) -> DataFrame:
    return df.withColumn(name, F.coalesce(mask, F.lit(False)).cast("int"))
