"""Means and co-moments of many columns per group in one scan: all that a linear fit needs.

Only the summary leaves the executors, ``(p + 1)(p + 2) / 2`` numbers per group; groups are
folds or splits, so their number is small. Summaries of disjoint groups can be merged, which
gives every training set of a cross-validation from the folds' summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import ROUNDING
from ..functions.scalar import col, nan_to_null
from .catalog import complete_rows

#: Up to this many columns the summary is a generated SQL aggregate, above it NumPy per batch, as
#: more aggregates leave generated code. Both centre what they sum, so results agree.
SQL_COLUMNS = 8


@dataclass
class CoMoments:
    """Row count, means, and the matrix of centred cross products."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    def merged(self, *others: "CoMoments") -> "CoMoments":
        parts = [self, *others]
        n = sum(p.n for p in parts)
        mean = sum(p.n * p.mean for p in parts) / n
        cross = sum(p.cross + p.n * np.outer(p.mean - mean, p.mean - mean) for p in parts)
        return CoMoments(n, mean, cross)


def comoments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> dict[tuple, CoMoments]:
    """Co-moments per group over rows that are complete in ``columns``."""
    names = [f"x{i}" for i in range(len(columns))]
    rows = complete_rows(df, columns).select(
        *[col(c).cast("double").alias(a) for c, a in zip(columns, names)], *[col(k) for k in by]
    )
    return _by_sql(rows, names, by) if len(columns) <= SQL_COLUMNS else _by_batches(rows, names, by)


def _by_sql(rows: DataFrame, names: list[str], by: Sequence[str]) -> dict[tuple, CoMoments]:
    p = len(names)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    summary = rows.groupBy(*[col(k) for k in by]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
    )
    out = {}
    for row in summary.toLocalIterator():
        if not row["n"]:
            continue
        cross = np.zeros((p, p))
        for i, j in pairs:
            cross[i, j] = cross[j, i] = row[f"c{i}_{j}"] * row["n"]
        out[tuple(row[k] for k in by)] = CoMoments(
            float(row["n"]), np.array([row[f"m_{c}"] for c in names]), cross
        )
    return out


#: What is kept of each group or matrix: counts, means, and centred sums, all merged without cancellation.
Parts = dict[str, np.ndarray]


def _merge(a: Parts, b: Parts) -> Parts:
    """Centred sums of the union of two sets of rows (parallel variance formula); works cell by cell."""
    n = a["n"] + b["n"]
    share = np.divide(b["n"], n, out=np.zeros_like(n), where=n > 0)
    step, other = b["mx"] - a["mx"], b["my"] - a["my"]
    weight = a["n"] * share
    return {
        "n": n,
        "mx": a["mx"] + step * share,
        "my": a["my"] + other * share,
        "sxx": a["sxx"] + b["sxx"] + step * step * weight,
        "syy": a["syy"] + b["syy"] + other * other * weight,
        "sxy": a["sxy"] + b["sxy"] + step * other * weight,
    }


def _complete_parts(x: np.ndarray) -> Parts:
    """Every pair of columns over the same rows, which have no gaps."""
    n, p = x.shape
    mean = x.mean(axis=0)
    z = x - mean
    cross = z.T @ z
    spread = np.diag(cross)
    wide = lambda v: np.repeat(v[:, None], p, axis=1)
    return {"n": np.full((p, p), float(n)), "mx": wide(mean), "my": wide(mean).T, "sxx": wide(spread), "syy": wide(spread).T, "sxy": cross}


def _pair_parts(x: np.ndarray) -> Parts:
    """Every pair of columns over the rows complete in both, each centred on its own means."""
    p = x.shape[1]
    there = ~np.isnan(x)
    out = {k: np.zeros((p, p)) for k in ("n", "mx", "my", "sxx", "syy", "sxy")}
    for i in range(p):
        rows = there[:, i]
        both, own, others = there[rows], x[rows, i][:, None], np.nan_to_num(x[rows])
        n = both.sum(axis=0).astype("float64")
        some = np.maximum(n, 1)
        mx, my = (own * both).sum(axis=0) / some, others.sum(axis=0) / some
        dx, dy = (own - mx) * both, (others - my) * both
        for key, line in (("n", n), ("mx", mx), ("my", my), ("sxx", (dx * dx).sum(axis=0)), ("syy", (dy * dy).sum(axis=0)), ("sxy", (dx * dy).sum(axis=0))):
            out[key][i] = line
    return out


def _summed(rows: DataFrame, names: list[str], by: Sequence[str], parts_of: Callable[[np.ndarray], Parts]) -> Iterator[tuple[tuple, Parts]]:
    """Parts per group from one scan: each task sums its batches, about the square root of the
    number of tasks merge these, and the driver merges what is left, one group row at a time."""
    keys, cells = list(by), ["n", "mx", "my", "sxx", "syy", "sxy"]
    p = len(names)

    def frames(sums: dict[tuple, Parts]) -> Iterator[pd.DataFrame]:
        for key, parts in sums.items():
            yield pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, **{c: [parts[c].ravel().tolist()] for c in cells}})

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, Parts] = {}
        for batch in batches:
            groups = batch.groupby(keys, sort=False, dropna=False) if keys else [((), batch)]
            for key, rows in groups:
                if len(rows):
                    found = parts_of(rows[names].to_numpy(dtype="float64"))
                    sums[key] = _merge(sums[key], found) if key in sums else found
        yield from frames(sums)

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, Parts] = {}
        for batch in batches:
            for _, row in batch.iterrows():
                key, found = tuple(row[k] for k in keys), {c: np.reshape(row[c], (p, p)) for c in cells}
                sums[key] = _merge(sums[key], found) if key in sums else found
        yield from frames(sums)

    schema = ", ".join([*[f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys], *[f"{c} array<double>" for c in cells]])
    slots = max(1, int(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    merged = rows.mapInPandas(first, schema).repartition(slots).mapInPandas(again, schema)
    total: dict[tuple, Parts] = {}
    for row in merged.toLocalIterator():
        key, found = tuple(row[k] for k in keys), {c: np.reshape(row[c], (p, p)) for c in cells}
        total[key] = _merge(total[key], found) if key in total else found
    yield from total.items()


def _by_batches(rows: DataFrame, names: list[str], by: Sequence[str]) -> dict[tuple, CoMoments]:
    """The same as ``_by_sql`` with matrix products per batch, centred per group and batch."""
    return {
        key: CoMoments(float(parts["n"][0, 0]), parts["mx"][:, 0].copy(), parts["sxy"])
        for key, parts in _summed(rows, names, by, _complete_parts)
    }


def pairwise_correlations(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson matrix of many columns, every pair over its own complete rows, from one scan.

    NaN where a side is constant over the rows of the pair, or no row is complete.
    """
    names = [f"x{i}" for i in range(len(columns))]
    rows = df.select(*[nan_to_null(col(c).cast("double")).alias(a) for c, a in zip(columns, names)])
    out = np.full((len(names), len(names)), np.nan)
    for _, parts in _summed(rows, names, [], _pair_parts):
        # Equal values leave rounding errors of their mean behind, nothing else is taken for constant.
        noise = parts["n"] * ROUNDING**2
        constant = (parts["sxx"] <= noise * parts["mx"] ** 2) | (parts["syy"] <= noise * parts["my"] ** 2)
        with np.errstate(invalid="ignore", divide="ignore"):
            r = parts["sxy"] / np.sqrt(parts["sxx"] * parts["syy"])
        out = np.where(constant | (parts["n"] == 0), np.nan, np.clip(r, -1.0, 1.0))
    return out
