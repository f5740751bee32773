"""Registered queries: a builder, the output columns, and the same result as plain SQL.

Output columns are declared as ``name:s`` (text), ``name:l`` (whole number) or ``name:d``
(real number, ``name:d12`` for a digit count of its own, ``name:f4`` for fixed decimals where
a difference of large numbers may come close to zero). Both sides of a check are brought
to these types; real numbers to a fixed count of digits, as sums differ in the last bits
with the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col

#: Real numbers below this are rounding noise around zero.
NOISE = 1e-12

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    columns: tuple[tuple[str, str], ...]
    sql: str | None
    digits: int

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return tidy(self.build(spark, folder), self.columns, self.digits)

    def oracle(self) -> str | None:
        return None if self.sql is None else tidy_sql(self.sql, self.columns, self.digits)


REGISTRY: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None, digits: int = 9):
    """Register a builder under ``name``."""
    declared = tuple(tuple(c.rsplit(":", 1)) for c in columns.split())

    def register(build: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, build, declared, sql, digits)
        return build

    return register


def _format(kind: str, default: int) -> str:
    digits = int(kind[1:]) if len(kind) > 1 else default
    return f"%.{digits}{'e' if kind[0] == 'd' else 'f'}"


def tidy(df: DataFrame, columns, digits: int) -> DataFrame:
    out = []
    for name, kind in columns:
        c = col(name)
        if kind[0] in "df":
            x = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            x = F.when(F.abs(x) < NOISE, 0.0).otherwise(x)
            text = F.format_string(_format(kind, digits), x)
            c = F.when(x.isNotNull(), text).cast("double")
        else:
            c = c.cast("bigint" if kind == "l" else "string")
        out.append(c.alias(name))
    return df.select(*out)


def tidy_sql(sql: str, columns, digits: int) -> str:
    out = []
    for name, kind in columns:
        c = f'"{name}"'
        if kind[0] in "df":
            x = f"CAST({c} AS DOUBLE)"
            text = f"CAST(printf('{_format(kind, digits)}', {x}) AS DOUBLE)"
            out.append(
                f"CASE WHEN {c} IS NULL OR isnan({x}) THEN NULL WHEN abs({x}) < {NOISE!r} THEN 0.0 ELSE {text} END AS {c}"
            )
        else:
            out.append(f"CAST({c} AS {'BIGINT' if kind == 'l' else 'VARCHAR'}) AS {c}")
    return f"SELECT {', '.join(out)} FROM ({sql}) result"
