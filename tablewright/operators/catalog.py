"""Column roles, schema guards and the check of a catalogue against the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import col


@dataclass(frozen=True)
class Catalog:
    """Role of every feature, treatment of every role, and the fixed level lists."""

    roles: dict[str, list[str]]
    treatments: dict[str, str] = field(default_factory=dict)
    ordinal_levels: dict[str, list[str]] = field(default_factory=dict)
    binary_maps: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self):
        seen: dict[str, str] = {}
        for role, columns in self.roles.items():
            for c in columns:
                if c in seen:
                    raise ValueError(f"{c} is listed under both {seen[c]} and {role}")
                seen[c] = role

    def of(self, *roles: str, present_in: DataFrame | None = None) -> list[str]:
        names = [c for r in roles for c in self.roles.get(r, [])]
        return names if present_in is None else present(present_in, names)

    def role_of(self, column: str) -> str | None:
        return next((r for r, columns in self.roles.items() if column in columns), None)


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the table has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def categorical_columns(df: DataFrame, listed: Sequence[str], mapped: Sequence[str] = ()) -> list[str]:
    """Listed categories plus every text column left that no dictionary covers."""
    listed = present(df, listed)
    return listed + [c for c in text_columns(df) if c not in listed and c not in mapped]


def is_missing(df: DataFrame, column: str):
    """Null, or NaN in a floating column."""
    kind = df.schema[column].dataType
    missing = col(column).isNull()
    return missing | F.isnan(col(column)) if isinstance(kind, (T.DoubleType, T.FloatType)) else missing


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a gap in the columns.

    One test per column: ``na.drop`` makes a single predicate over all of them, and the
    planner then derives a variant of it for every subset of the columns renamed above.
    """
    return df.filter(reduce(lambda a, b: a & b, [~is_missing(df, c) for c in columns or df.columns]))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, n_rows, n_null, n_nonzero, n_distinct)`` of many columns.

    Columns of one kind (whole numbers, other numbers, the rest as text) are stacked and
    counted per distinct value first, so the distinct count needs no set in memory and a
    frequent value is one row after the map side.
    """
    whole, real, text = [], [], []
    for c in columns:
        kind = df.schema[c].dataType
        (whole if isinstance(kind, T.IntegralType) else real if isinstance(kind, T.FractionalType) else text).append(c)
    out = []
    for group, kind in ((whole, "bigint"), (real, "double"), (text, "string")):
        if not group:
            continue
        parts = [p for c in group for p in (F.lit(c), F.when(~is_missing(df, c), col(c).cast(kind)))]
        long = df.select(F.stack(F.lit(len(group)), *parts).alias("feature", "value"))
        counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        filled = F.col("value").isNotNull() if kind == "string" else F.coalesce(F.col("value") != 0, F.lit(False))
        out.append(
            counts.groupBy("feature").agg(
                F.sum("n").alias("n_rows"),
                F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
                F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("n_nonzero"),
                F.count("value").alias("n_distinct"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), out)


def catalog_check(df: DataFrame, catalog: Catalog) -> DataFrame:
    """Every catalogued feature with role, treatment, presence, type, null share and level count."""
    types = dict(df.dtypes)
    rows = [
        (c, role, catalog.treatments.get(role, ""), int(c in types), types.get(c))
        for role, columns in catalog.roles.items()
        for c in columns
    ]
    listed = df.sparkSession.createDataFrame(
        rows, "feature string, role string, treatment string, in_table int, data_type string"
    )
    profile = column_profile(df, [r[0] for r in rows if r[3]])
    return (
        listed.join(profile, "feature", "left")
        .withColumn("null_percent", 100.0 * F.col("n_null") / F.nullif(F.col("n_rows"), F.lit(0)))
        .select("feature", "role", "treatment", "in_table", "data_type", "null_percent", "n_distinct")
    )
