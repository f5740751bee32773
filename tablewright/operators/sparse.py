"""A sparse encoder for categories with any number of levels, and a linear model that reads its rows.

Levels and their places are a table, not literals: a column with 100,000 levels is fitted, joined and trained without a list of them on
the driver or in the plan. A row of the matrix is ``(size, indices, values)`` with the columns of all parts one after the other:
scaled numbers, ordinal codes, binary maps and flags first, then one place per level of each nominal column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.scalar import col
from ..storage import stage
from .catalog import Catalog, present
from .encode import dense_codes, fit_scaler, one_hot_name, ordinal_code, scaled, spread_key

SPARSE = "struct<size: bigint, indices: array<bigint>, values: array<double>>"
#: Levels up to which the table of a column is broadcast.
SMALL_LEVELS = 100_000


@dataclass
class SparseEncoder:
    """Plain values for the dense part; a written table of levels and places for each nominal column."""

    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    ordinal_levels: dict = field(default_factory=dict)
    binary_maps: dict = field(default_factory=dict)
    flags: list = field(default_factory=list)
    levels: dict[str, DataFrame] = field(default_factory=dict)  # (level, code), codes from 0
    offsets: dict[str, int] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    @property
    def dense(self) -> list[str]:
        return [*self.means, *self.ordinal_levels, *self.binary_maps, *self.flags]

    @property
    def size(self) -> int:
        return len(self.dense) + sum(self.sizes.values())

    def names(self) -> DataFrame:
        """``(place, name)`` of every column of the matrix, as a table."""
        spark = next(iter(self.levels.values())).sparkSession
        out = spark.createDataFrame(list(enumerate(self.dense)), "place long, name string")
        for c, table in self.levels.items():
            place = (F.col("code") + F.lit(self.offsets[c])).alias("place")
            out = out.unionByName(table.select(place, F.concat(F.lit(one_hot_name(c, "")), "level").alias("name")))
        return out


def fit_sparse_encoder(train: DataFrame, catalog: Catalog, engineered: Sequence[str] = (), flags: Sequence[str] = ()) -> SparseEncoder:
    numeric = catalog.of("numeric continuous", "numeric count", present_in=train) + present(train, engineered)
    means, stds = fit_scaler(train, numeric)
    made = SparseEncoder(
        means,
        stds,
        {c: catalog.ordinal_levels[c] for c in catalog.of("ordinal", present_in=train)},
        {c: catalog.binary_maps[c] for c in catalog.of("binary", present_in=train)},
        present(train, flags),
    )
    for c in catalog.of("nominal", "special", present_in=train):
        made.offsets[c] = made.size
        made.levels[c] = stage(dense_codes(train, c), "levels")
        made.sizes[c] = made.levels[c].count()
    return made


def sparse_encode(df: DataFrame, fitted: SparseEncoder, keep: Sequence[str] = (), name: str = "row") -> DataFrame:
    """The kept columns and the sparse row. A level that the fit has not seen, and null, touch no place; nor do zeros and gaps."""
    values = [scaled(c, fitted.means, fitted.stds) for c in fitted.means]
    values += [ordinal_code(c, v) for c, v in fitted.ordinal_levels.items()]
    values += [S.map_values(col(c).cast("string"), m, 0) for c, m in fitted.binary_maps.items()]
    values += [col(c) for c in fitted.flags]
    numbered = [F.struct(F.lit(i).cast("long").alias("place"), S.nan_to_null(v.cast("double")).alias("value")) for i, v in enumerate(values)]
    rows = df.select(*[col(k) for k in keep], F.array(*numbered).alias("_dense"), *[col(c).alias(f"_n{i}") for i, c in enumerate(fitted.levels)])
    for i, (c, table) in enumerate(fitted.levels.items()):
        codes = table.select(F.col("level").alias("_level"), (F.col("code") + F.lit(fitted.offsets[c])).alias(f"_p{i}"))
        side = F.broadcast(codes) if fitted.sizes[c] <= SMALL_LEVELS else codes
        rows = rows.withColumn("_level", spread_key(rows, f"_n{i}")).join(side, "_level", "left").drop("_level")
    ones = [F.struct(F.when(F.col(f"_n{i}").isNotNull(), F.col(f"_p{i}")).alias("place"), F.lit(1.0).alias("value")) for i in range(len(fitted.levels))]
    cells = F.concat("_dense", F.array(*ones)) if ones else F.col("_dense")
    touched = F.filter(cells, lambda x: x["place"].isNotNull() & (x["value"] != 0))
    row = F.struct(F.lit(fitted.size).cast("long").alias("size"), F.col("_cells.place").alias("indices"), F.col("_cells.value").alias("values"))
    return rows.select(*[col(k) for k in keep], touched.alias("_cells")).select(*[col(k) for k in keep], row.alias(name))


@dataclass
class SparseLinear:
    """A ridge model over sparse rows: a weight per place and an intercept."""

    weights: np.ndarray
    intercept: float
    steps: int = 0

    def prediction(self, row: str = "row") -> Column:
        weights, intercept = self.weights, self.intercept

        @F.pandas_udf("double")
        def score(indices, values):
            return indices.combine(values, lambda i, v: intercept + float(weights[np.asarray(i, np.int64)] @ np.asarray(v)))

        return score(F.col(f"{row}.indices"), F.col(f"{row}.values"))


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, place and value of every touched cell."""
    lists = batch.column("indices")
    at = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    return at, lists.flatten().to_numpy(), batch.column("values").flatten().to_numpy()


def _summed(table: DataFrame, size: int, rows_of) -> np.ndarray:
    """The sum over all rows of (value of the row times its touched cells); a last entry sums the values of the rows alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1)
        for batch in batches:
            at, places, values = _cells(batch)
            of_rows = rows_of(batch, at, places, values)
            total[:size] += np.bincount(places, values * of_rows[at], size)[:size]
            total[size] += of_rows.sum()
        places = np.flatnonzero(total)
        for part in range(0, len(places), 1 << 16):
            some = places[part : part + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "value"])

    merged = table.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size + 1)
    found = merged.toArrow()
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out


def fit_sparse_ridge(df: DataFrame, row: str, label: str, alpha: float = 10.0, steps: int = 200, tolerance: float = 1e-12) -> SparseLinear:
    """Squared error plus ``alpha`` times the squared weights, the intercept free, by conjugate gradients.

    Each step is one scan that touches only cells that are there; tasks send the places they touched. The driver holds a few
    vectors of one number per place. Columns are centred in the algebra, not in the rows, which stay sparse.
    """
    rows = df.where(col(label).isNotNull()).select(F.col(f"{row}.indices").alias("indices"), F.col(f"{row}.values").alias("values"), col(label).cast("double").alias("y"))
    table = stage(rows, "sparse", even=True)
    size, n, mean = df.select(F.max(f"{row}.size")).first()[0], *table.agg(F.count(F.lit(1)), F.avg("y")).first()
    if not n:
        raise ValueError("no row to fit on")
    ones = _summed(table, size, lambda batch, at, places, values: np.ones(batch.num_rows))
    centre = ones[:size] / n
    right = _summed(table, size, lambda batch, at, places, values: batch.column("y").to_numpy() - mean)[:size]

    def times(v: np.ndarray) -> np.ndarray:
        """(centred X)' (centred X) v + alpha v."""
        shift = float(centre @ v)

        def rows_of(batch, at, places, values):
            return np.bincount(at, values * v[places], batch.num_rows) - shift

        out = _summed(table, size, rows_of)
        return out[:size] - centre * out[size] + alpha * v

    # Cells of a place that few rows touch weigh little against alpha: scaling by the diagonal evens them out.
    squares = _summed_squares(table, size) - n * centre**2
    scale = 1.0 / np.sqrt(np.maximum(squares, 0.0) + alpha)
    w, rest = np.zeros(size), right * scale
    way, norm = rest.copy(), float(rest @ rest)
    start, done = norm, 0
    while done < steps and norm > tolerance**2 * max(start, 1e-300):
        there = scale * times(scale * way)
        step = norm / float(way @ there)
        w, rest = w + step * way, rest - step * there
        new = float(rest @ rest)
        way, norm, done = rest + way * (new / norm), new, done + 1
    weights = w * scale
    return SparseLinear(weights, float(mean - centre @ weights), done)


def _summed_squares(table: DataFrame, size: int) -> np.ndarray:
    cells = table.select(F.inline(F.arrays_zip("indices", "values"))).toDF("place", "value")
    found = cells.groupBy("place").agg(F.sum(F.col("value") * F.col("value")).alias("value")).toArrow()
    out = np.zeros(size)
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out


def touched(df: DataFrame, key: str, row: str = "row") -> DataFrame:
    """``(key, size, n_touched, places)`` with the places as text, in order."""
    places = F.array_join(F.transform(F.array_sort(F.col(f"{row}.indices")), lambda i: i.cast("string")), " ")
    return df.select(col(key), F.col(f"{row}.size").alias("size"), F.size(f"{row}.indices").alias("n_touched"), places.alias("places"))
