"""Scalar column expressions (all of them stay inside generated code)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its literal name, also with spaces, dots or a leading digit."""
    return F.col("`" + name.replace("`", "``") + "`")


def log1p_target(c: Column) -> Column:
    return F.log1p(c)


def expm1_inverse(c: Column) -> Column:
    return F.expm1(c)


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """``w1*c1 + w2*c2 + ...``; null as soon as one part is null."""
    return reduce(lambda a, b: a + b, [col(c) if w == 1 else F.lit(w) * col(c) for c, w in weights.items()])


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over columns that skips nulls and NaN; 0 when none is left."""
    return reduce(lambda a, b: a + b, [F.coalesce(clean_number(col(c)), F.lit(0.0)) for c in columns])


def row_mean(columns: Sequence[str]) -> Column:
    """Mean over columns that skips nulls and NaN; null when none is left."""
    present = reduce(lambda a, b: a + b, [clean_number(col(c)).isNotNull().cast("int") for c in columns])
    return row_sum(columns) / F.nullif(present, F.lit(0))


def presence_flag(c: Column) -> Column:
    """1 when ``c > 0``, else 0, also for null."""
    return F.coalesce(c > 0, F.lit(False)).cast("int")


def code_to_text(c: Column, default: str | None = None) -> Column:
    """A numeric code as a category; null stays null unless ``default`` is given."""
    text = c.cast("string")
    return text if default is None else F.coalesce(text, F.lit(default))


def map_values(c: Column, mapping: Mapping, default=None, null_as=None) -> Column:
    """Dictionary lookup. Unmapped gives ``default``; ``null_as`` is put in for null first."""
    key = c if null_as is None else F.coalesce(c, F.lit(null_as))
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.element_at(table, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def tokens_to_null(c: Column, tokens: Sequence[str]) -> Column:
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c) if tokens else c


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def clean_number(c: Column) -> Column:
    """Double with NaN as null and one zero: equal values must fall in one range and one group."""
    return nan_to_null(c.cast("double")) + F.lit(0.0)


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def mentions(text: Column, term: str) -> Column:
    return F.contains(text, F.lit(term))


def format_fixed(c: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", c.cast("double"))


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b``; null instead of an error where ``b`` is 0."""
    return a / F.nullif(b, F.lit(0).cast("double"))
