"""Derived columns, each guarded by the presence of its inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .catalog import present


@dataclass(frozen=True)
class Derived:
    """A new column. ``build`` gets the inputs that are there; with ``partial`` one is enough."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[[list[str]], Column]
    partial: bool = False

    def available(self, have: set[str]) -> list[str] | None:
        found = [c for c in self.inputs if c in have]
        enough = bool(found) if self.partial else len(found) == len(self.inputs)
        return found if enough else None


def total(name: str, weights: Mapping[str, float]) -> Derived:
    return Derived(name, tuple(weights), lambda _: S.weighted_sum(weights))


def difference(name: str, a: str, b: str) -> Derived:
    return Derived(name, (a, b), lambda _: S.col(a) - S.col(b))


def flag(name: str, a: str) -> Derived:
    return Derived(name, (a,), lambda _: S.presence_flag(S.col(a)))


def sum_of_present(name: str, columns: Sequence[str]) -> Derived:
    return Derived(name, tuple(columns), S.row_sum, partial=True)


def mean_of_present(name: str, columns: Sequence[str]) -> Derived:
    return Derived(name, tuple(columns), S.row_mean, partial=True)


def derive(df: DataFrame, specs: Sequence[Derived]) -> DataFrame:
    """Add every derived column whose inputs exist; later ones may use earlier ones."""
    have = set(df.columns)
    pending: dict[str, Column] = {}
    for spec in specs:
        if any(c in pending for c in spec.inputs):
            df, pending = df.withColumns(pending), {}
        found = spec.available(have)
        if found is not None:
            pending[spec.name] = spec.build(found)
            have.add(spec.name)
    return df.withColumns(pending) if pending else df


#: The derived columns of the house table.
HOUSE_FEATURES = [
    total("TotalSF", {"TotalBsmtSF": 1, "1stFlrSF": 1, "2ndFlrSF": 1}),
    difference("HouseAge", "YrSold", "YearBuilt"),
    difference("RemodAge", "YrSold", "YearRemodAdd"),
    total("TotalBath", {"FullBath": 1, "HalfBath": 0.5, "BsmtFullBath": 1, "BsmtHalfBath": 0.5}),
    sum_of_present("TotalPorchSF", ["OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch"]),
    flag("HasGarage", "GarageArea"),
    flag("HasBasement", "TotalBsmtSF"),
    flag("HasFireplace", "Fireplaces"),
    flag("HasPool", "PoolArea"),
    mean_of_present("QualityIndex", ["OverallQual", "OverallCond"]),
]


def map_columns(df: DataFrame, maps: Mapping[str, Mapping], default=None, null_as=None) -> DataFrame:
    """Dictionary lookup on every mapped column that is there."""
    changed = {c: S.map_values(S.col(c).cast("string"), maps[c], default, null_as) for c in present(df, list(maps))}
    return df.withColumns(changed) if changed else df


def codes_to_text(df: DataFrame, columns: Sequence[str], default: str | None = None) -> DataFrame:
    """Number codes that name categories become text; gaps take ``default`` before the cast."""
    changed = {c: S.code_to_text(S.col(c), default) for c in present(df, columns)}
    return df.withColumns(changed) if changed else df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop what is there, ignore the rest."""
    return df.drop(*present(df, columns))


def keep_where(df: DataFrame, mask: Column) -> DataFrame:
    return df.filter(mask)


def keep_where_not(df: DataFrame, mask: Column) -> DataFrame:
    """Rows where the mask is not true; a null mask counts as false."""
    return df.filter(~F.coalesce(mask, F.lit(False)))
