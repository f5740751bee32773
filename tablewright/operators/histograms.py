"""Trees grown from histograms: boosting of any length and forests, many of them in the same scans.

Features are binned once to a byte each, in a written table whose rows are blocks of thousands of rows, column by column. A scan sums residuals and rows per (leaf, feature, bin) for a whole level
of all trees that grow at that time, so the number of scans is rounds times levels, whatever the number of models, folds and
rows; only histograms leave the tasks, their size is that of the models. Scores are held in the table: trees that are newer than the
table are added as it is read, and every ``CUT`` rounds it is written anew, with a column of scores for each model, so that a scan reads those of
the models that still grow only. The error on held-out rows after each round comes out of the scan that the next round starts with. A task holds
a few blocks at a time, whatever the number of rows and models: blocks and the row groups of the table's files are bounded in bytes.

Which rows a tree sees, and how often, follows from columns of marks and from a hash of the key, so that a fit doesn't depend on
partitions and can be told in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property
from math import exp, factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..storage import discard, stage
from .catalog import complete_rows
from .split import key_hash

#: Bins of a feature, a byte each.
BINS = 64
#: Rounds after which scores are written anew (every scan adds the trees that are newer), and trees of a forest that grow at once.
CUT, TREES_AT_ONCE = 4, 100
#: Rows of a part of the table, at least.
PART_ROWS = 10_000
#: Rows of a block of the table (the last of a part may have fewer), and bytes of a block and of a row group of its files, at most.
BLOCK_ROWS, BLOCK_BYTES, GROUP_BYTES = 32_768, 2**22, 2**24
#: Tasks of a scan for each core, at most: each sends sums of its own. From so many tasks on these are merged in tasks before the driver adds them up.
CORE_TASKS, DIRECT_TASKS = 3, 64
#: Leaves that are found by table, at most (a bit each), and splits up to which it is quicker to try them one by one.
TABLE_LEAVES, FEW_SPLITS = 64, 3
#: A split must gain more than this share of what its node has.
NOISE = 1e-10
#: Fixed values of bagging: the prime and factor of row hashes, as in a multiplicative generator.
PRIME, FACTOR = 2**31 - 1, 48271


@dataclass(frozen=True)
class Growth:
    """How a tree grows: by levels, with one split for a whole level, or best leaf first up to ``leaves``."""

    depth: int
    leaves: int | None = None
    symmetric: bool = False
    l2: float = 0.0
    least_rows: float = 1.0
    features: int | None = None  # so many, drawn anew for each node, are looked at


@dataclass(frozen=True)
class Boosting:
    rounds: int
    step: float
    growth: Growth
    patience: int | None = None
    first: float | None = None  # the step of the first tree, if another


#: The compared boosting models, three ways for trees to grow.
FLAVOURS = {
    "Boosting wide": Boosting(3000, 0.01, Growth(depth=12, leaves=20, least_rows=20)),
    "Boosting shallow": Boosting(3000, 0.01, Growth(depth=3, l2=1.0)),
    "Boosting symmetric": Boosting(3000, 0.01, Growth(depth=6, symmetric=True, l2=3.0)),
}
#: The model that is stopped early.
STOPPED = Boosting(5000, 0.03, Growth(depth=8, symmetric=True, l2=3.0), patience=200)


@dataclass(frozen=True)
class Rows:
    """The rows of a fit: all but those with one of the marks (column, value); in a forest, weighted for a tree."""

    held: tuple[tuple[str, int], ...] = ()
    bag: int | None = None


@dataclass
class Tree:
    """Nodes in the order they were made; children are neighbours. A leaf has feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, cut: int) -> int:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for column, blank in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0)):
            column += [blank, blank]
        return self.left[node]

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row, from a line of bins per feature. Every split is tried on whole columns; a node comes after its parent."""
        at = np.zeros(bins.shape[1], np.min_scalar_type(len(self.feature)))
        for node, feature in enumerate(self.feature):
            if feature >= 0:
                move = (bins[feature] > self.cut[node]).astype(at.dtype)
                move += at.dtype.type(self.left[node] - node)
                if node:
                    move *= at == node
                at += move
        return at

    def route(self, widths: Sequence[int]) -> Route:
        """The way to the leaves, made once for all blocks of a scan."""
        splits = sum(f >= 0 for f in self.feature)
        if splits <= FEW_SPLITS or splits >= TABLE_LEAVES:
            return Route(self, [])
        # The leaves below each node as bits; children come after their parent.
        below, leaves = [0] * len(self.feature), []
        todo = [0]
        while todo:
            node = todo.pop()
            if self.feature[node] >= 0:
                todo += [self.left[node] + 1, self.left[node]]
            else:
                below[node] = 1 << len(leaves)
                leaves.append(node)
        kind = np.min_scalar_type((1 << len(leaves)) - 1).type
        open_to = {f: np.full(widths[f], (1 << len(leaves)) - 1, kind) for f in sorted({f for f in self.feature if f >= 0})}
        for node in range(len(self.feature) - 1, -1, -1):
            f, cut, left = self.feature[node], self.cut[node] + 1, self.left[node]
            if f >= 0:
                below[node] = below[left] | below[left + 1]
                open_to[f][:cut] &= ~kind(below[left + 1])
                open_to[f][cut:] &= ~kind(below[left])
        tables = []
        for features in pairs_of(len(widths)):
            if any(f in open_to for f in features):
                one, *other = [open_to.get(f, np.full(widths[f], -1 & int(np.iinfo(kind).max), kind)) for f in features]
                tables.append((features, (one[:, None] & other[0]).ravel() if other else one))
        return Route(self, tables, np.array(leaves))


def pairs_of(features: int) -> list[tuple[int, ...]]:
    """Neighbouring features; the last is alone if their number is odd."""
    return [tuple(range(i, min(i + 2, features))) for i in range(0, features, 2)]


class Lines:
    """Bins of rows, a line for each feature, and cells of two features each: half as many passes over the rows give the same sums."""

    def __init__(self, bins: np.ndarray, widths: Sequence[int]):
        self.bins, self.widths, self.n = bins, widths, bins.shape[1]

    @cached_property
    def single(self) -> list[tuple[tuple[int, ...], int, np.ndarray]]:
        return [((i,), w, self.bins[i].astype(np.int64)) for i, w in enumerate(self.widths)]

    @cached_property
    def pairs(self) -> list[tuple[tuple[int, ...], int, np.ndarray]]:
        out, w = [], self.widths
        for features in pairs_of(len(w)):
            cells = self.bins[features[0]]
            if len(features) > 1:
                cells = np.multiply(cells, w[features[1]], dtype=np.uint16) + self.bins[features[1]]
            out.append((features, int(np.prod([w[f] for f in features])), cells.astype(np.int64)))
        return out


class Route:
    """The leaves of a tree: splits are tried on whole columns, or each pair of features says by table which leaves the bins of a row leave open.

    All splits above a leaf leave it open and at least one closes each other leaf, so that one bit is left.
    """

    def __init__(self, tree: Tree, tables: list[tuple[tuple[int, ...], np.ndarray]], leaves: np.ndarray | None = None):
        self.tree, self.tables, self.leaves = tree, tables, leaves

    def of(self, by_node: np.ndarray, lines: Lines) -> np.ndarray:
        """What ``by_node`` has for the leaf of each row."""
        if not self.tables:
            return by_node[self.tree.leaf_of(lines.bins)] if self.tree.depth or self.tree.feature[0] >= 0 else np.full(lines.n, by_node[0])
        cells, left = {features: c for features, _, c in lines.pairs}, None
        for features, table in self.tables:
            found = table.take(cells[features], mode="clip")  # bins are in range; no check is made
            left = found if left is None else np.bitwise_and(left, found, out=left)
        left -= left.dtype.type(1)
        return by_node[self.leaves][np.bitwise_count(left)]

    def predict(self, lines: Lines) -> np.ndarray:
        return self.of(np.array(self.tree.value), lines)


@dataclass
class Ensemble:
    """A fitted model with its error curve on held-out rows (root mean squared error after each round)."""

    features: list[str]
    cuts: list[np.ndarray]
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    gains: np.ndarray = field(default_factory=lambda: np.zeros(0))
    errors: list[float] = field(default_factory=list)
    best: int = 0

    def prediction(self) -> Column:
        """The fitted value of a row, worked out for whole batches; null where a feature is."""
        return blind_prediction({0: self}, F.lit(0))

    def importance(self, df: DataFrame) -> DataFrame:
        """``(feature, importance)``: shares of the summed gains in percent."""
        total = float(self.gains.sum()) or 1.0
        rows = [(c, 100.0 * float(g) / total) for c, g in zip(self.features, self.gains)]
        return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def predictions(models: Sequence[Ensemble]) -> Column:
    """The fitted values of several models of one fit, ``array<double>``; rows are binned once for all."""
    cuts, names, parts = models[0].cuts, models[0].features, [(m.start, m.trees) for m in models]

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        routes = [(start, [t.route([len(c) + 1 for c in cuts]) for t in trees]) for start, trees in parts]
        for columns in batches:
            lines = lines_of(cuts, columns)
            out = np.empty((lines.n, len(parts)))
            for i, (start, trees) in enumerate(routes):
                out[:, i] = scored(start, trees, lines)
            yield pd.Series(list(out))

    return score(*[col(c).cast("double") for c in names])


def blind_prediction(models: Mapping[int, Ensemble], fold: Column) -> Column:
    """The fitted value of each row by the model of its fold, worked out for whole batches; null where a feature or the model is."""
    first = next(iter(models.values()))
    cuts, parts = first.cuts, {f: (m.start, m.trees) for f, m in models.items()}

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        routes: dict[int, list[Route]] = {}
        for folds, *columns in batches:
            folds, out = folds.to_numpy(dtype="float64"), np.full(len(folds), np.nan)
            for f, (start, trees) in parts.items():
                rows = np.flatnonzero(folds == f)
                if len(rows):
                    if f not in routes:
                        routes[f] = [t.route([len(c) + 1 for c in cuts]) for t in trees]
                    values = [c.to_numpy(dtype="float64")[rows] for c in columns]
                    gaps = np.any([np.isnan(v) for v in values], axis=0)
                    out[rows] = np.where(gaps, np.nan, scored(start, routes[f], lines_of(cuts, values)))
            yield pd.Series(out)

    out = score(fold.cast("double"), *[col(c).cast("double") for c in first.features])
    return F.when(F.isnan(out), None).otherwise(out)


def lines_of(cuts: Sequence[np.ndarray], columns: Sequence) -> Lines:
    """Rows by their bins; a gap is in the last one."""
    bins = [np.minimum(np.searchsorted(c, np.asarray(x, np.float64)), len(c)).astype(np.uint8) for c, x in zip(cuts, columns)]
    return Lines(np.stack(bins), [len(c) + 1 for c in cuts])


def scored(start: float, routes: Sequence[Route], lines: Lines) -> np.ndarray:
    out = np.full(lines.n, start)
    for route in routes:
        out += route.predict(lines)
    return out


# ---------------------------------------------------------------- bins


def cut_points(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature the upper ends of its bins: all values where there are few, else quantiles. Value ``x`` is in the first bin whose end is not below it."""
    names = [f"x{i}" for i in range(len(features))]
    values = df.select(*[col(c).cast("double").alias(n) for c, n in zip(features, names)])
    shares = [k / bins for k in range(1, bins)]
    found = values.agg(
        *[F.approx_count_distinct(n).alias(f"n_{n}") for n in names],
        *[F.percentile_approx(n, shares, 100 * bins).alias(f"q_{n}") for n in names],
    ).first()
    few = [n for n in names if found[f"n_{n}"] <= 1.2 * bins]
    whole = values.agg(*[F.array_sort(F.collect_set(n)).alias(n) for n in few]).first() if few else {}
    out = []
    for n in names:
        exact = n in few and len(whole[n]) <= bins
        out.append(np.array(whole[n][:-1] if exact else np.unique(found[f"q_{n}"] or []), np.float64))
    return out


def binned(df: DataFrame, features: Sequence[str], label: str, key: str, marks: Sequence[str], cuts: list[np.ndarray], keep: Sequence[str] = ()) -> DataFrame:
    """``y, h`` (hash of the key), ``marks array<int>, bins binary`` of complete rows, and kept columns; scores are added by a fit."""
    names = [f"_x{i}" for i in range(len(features))]
    rows = complete_rows(df, [*features, label]).select(
        *[col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
        col(label).cast("double").alias("y"),
        F.pmod(key_hash(key), F.lit(PRIME)).alias("h"),
        (F.array(*[col(c).cast("int") for c in marks]) if marks else F.array().cast("array<int>")).alias("marks"),
        *[col(c).cast("double").alias(n) for c, n in zip(features, names)],
    )
    kept = rows.drop(*names)
    others = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.column_stack([np.searchsorted(c, batch.column(n).to_numpy(zero_copy_only=False)) for n, c in zip(names, cuts)])
            packed = fixed(bins.astype(np.uint8))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], packed], names=[*others, "bins"])

    out = rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", bins binary")
    return out.withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})


#: A block: columns of its rows one after the other, marks and bins a line for each. Written anew, it has scores of fits as well.
BLOCK = "n int, y binary, h binary, marks binary, bins binary"


def dealt_out(rows: DataFrame, n: int, features: int, slots: int = 0) -> DataFrame:
    """The table that all scans read, written in parts of equal size: as many as there are cores or were parts, unless these get very few rows."""
    most = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    size = max(1024, min(BLOCK_ROWS, BLOCK_BYTES // (8 * (slots + 3) + features)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            while held + batch.num_rows >= size:
                yield block_of([*waiting, batch.slice(0, size - held)], features)
                batch, waiting, held = batch.slice(size - held), [], 0
            if batch.num_rows:
                waiting.append(batch)
                held += batch.num_rows
        if held:
            yield block_of(waiting, features)

    return write_blocks(rows.repartition(max(1, min(most, -(-n // PART_ROWS)))).mapInArrow(blocks, BLOCK), "binned")


def write_blocks(table: DataFrame, name: str) -> DataFrame:
    """Blocks in files of small row groups, so that neither writing nor reading holds many of them; numbers don't get smaller by being packed."""
    how = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": False, "compression": "none"}
    with small_batches(table.sparkSession):
        return stage(table, name, **how)


def block_of(batches: Sequence[pa.RecordBatch], features: int) -> pa.RecordBatch:
    n = sum(b.num_rows for b in batches)
    y, h, marks = (np.concatenate([pick(b).to_numpy(zero_copy_only=False) for b in batches]) for pick in (lambda b: b.column("y"), lambda b: b.column("h"), lambda b: b.column("marks").flatten()))
    bins = np.concatenate([unfixed(b.column("bins"), np.uint8, features) for b in batches])
    lines = [y, h, marks.reshape(n, -1).T, bins.T]
    values = [pa.array([n], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in lines]]
    return pa.RecordBatch.from_arrays(values, names=["n", "y", "h", "marks", "bins"])


def fixed(values: np.ndarray) -> pa.Array:
    """A row of numbers each as one binary value."""
    width = values.shape[1] * values.itemsize
    offsets = pa.py_buffer(np.arange(len(values) + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def unfixed(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


# ---------------------------------------------------------------- scans


class Block(Lines):
    """Rows of a scan, column by column."""

    def __init__(self, batch: pa.RecordBatch, i: int, widths: Sequence[int], marks: Sequence[str]):
        self.batch, self.at, self.widths, self.names = batch, i, widths, marks
        self.n, self.bags, self.known = batch.column("n")[i].as_py(), {}, {}
        self.y = self.line("y", np.float64)
        self.marks = self.line("marks", np.int32).reshape(-1, self.n)
        self.bins = self.line("bins", np.uint8).reshape(-1, self.n)

    def line(self, name: str, kind) -> np.ndarray:
        return np.frombuffer(self.batch.column(name)[self.at].as_buffer(), kind)

    @cached_property
    def h(self) -> np.ndarray:
        return self.line("h", np.int64)

    def scores(self, fit: Sums) -> np.ndarray:
        """What a model says of the rows: the scores that the table has and the trees that are newer."""
        name = score_column(fit.at)
        out = self.line(name, np.float64).copy() if name in self.batch.schema.names else np.zeros(self.n)
        for route in fit.newer:
            out += route.predict(self)
        return out

    def bag(self, tree: int) -> np.ndarray:
        """Weights of a bag, made once for all fits that draw it."""
        if tree not in self.bags:
            self.bags[tree] = bag_weights(self.h, tree)
        return self.bags[tree]

    def seen(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Which rows a fit sees and their places, made once for all fits that see the same."""
        if rows not in self.known:
            out = np.ones(self.n, bool) if rows.bag is None else self.bag(rows.bag) > 0
            for name, value in rows.held:
                out &= self.marks[self.names.index(name)] != value
            self.known[rows] = out, np.flatnonzero(out)
        return self.known[rows]


def score_column(at: int) -> str:
    return f"s{at}"


@dataclass
class Sums:
    """What a scan needs to know of a model that grows."""

    at: int  # its place among the scores
    rows: Rows
    pending: list[Tree]  # trees that the scores don't hold yet
    tree: Tree
    wanted: list[int]  # leaves to sum
    newer: list[Route] = field(default_factory=list)  # the ways of these trees, made in a task
    route: Route | None = None

    def ready(self, widths: Sequence[int]) -> None:
        self.newer, self.route = [t.route(widths) for t in self.pending], self.tree.route(widths)

    def add(self, block: Block, rest: np.ndarray, out: np.ndarray) -> None:
        """Rows and residuals of the wanted leaves, added to ``out`` (two by leaves by cells of all features)."""
        n, widths, slot = len(self.wanted), block.widths, None
        seen, rows = block.seen(self.rows)
        if self.tree.depth:
            place = np.full(len(self.tree.feature), -1, np.int8 if n < 128 else np.int32)
            place[self.wanted] = np.arange(n)
            slot = self.route.of(place, block)
            rows = np.flatnonzero(seen & (slot >= 0))
        weight = None if self.rows.bag is None else block.bag(self.rows.bag).take(rows)
        rest = rest.take(rows) if weight is None else rest.take(rows) * weight
        slot = None if slot is None or n == 1 else slot.take(rows).astype(np.int64)
        starts = np.cumsum(widths) - widths
        few = n * max((size for _, size, _ in block.pairs), default=0) <= len(rows)
        for features, size, cells in block.pairs if few else block.single:
            if len(rows) < block.n:
                cells = cells.take(rows)
            if slot is not None:
                cells = cells + slot * size
            shape = (n, *[widths[f] for f in features])
            for i, values in enumerate((weight, rest)):
                found = np.bincount(cells, values, n * size).reshape(shape)
                for k, f in enumerate(features):
                    out[i, :, starts[f] : starts[f] + widths[f]] += found if len(features) == 1 else found.sum(2 - k)


@dataclass
class Fit:
    """A model while it grows."""

    at: int
    rows: Rows
    growth: Growth
    step: float
    model: Ensemble
    pending: list[Tree] = field(default_factory=list)
    tree: Tree = field(default_factory=Tree)
    wanted: list[int] = field(default_factory=list)
    sums: dict[int, np.ndarray] = field(default_factory=dict)
    splits: dict[int, tuple[float, int, int]] = field(default_factory=dict)
    depths: dict[int, int] = field(default_factory=dict)
    totals: dict[int, tuple[float, float]] = field(default_factory=dict)  # rows and residuals of a node
    active: bool = True
    first: float | None = None

    def asked(self) -> Sums:
        return Sums(self.at, self.rows, self.pending, self.tree, self.wanted)


def bag_factor(tree: int) -> int:
    return pow(FACTOR, tree + 1, PRIME)


#: Shares of rows with at most 0, 1, 2, ... copies in a bag (a Poisson distribution of mean one).
BAG_SHARES = [sum(exp(-1) / factorial(i) for i in range(k + 1)) for k in range(8)]


def bag_weights(h: np.ndarray, tree: int) -> np.ndarray:
    """How often a bag holds a row, from a hash of its key."""
    x = h * bag_factor(tree)
    for _ in range(2):  # the remainder by a prime one below a power of two
        x = (x & PRIME) + (x >> 31)
    share, times = np.where(x == PRIME, 0, x) / PRIME, np.zeros(len(h), np.uint8)
    for below in BAG_SHARES:
        times += share >= below
    return times.astype(np.float64)


class Scan:
    """One pass over the table for all fits: sums per leaf, or the table with new scores."""

    def __init__(self, table: DataFrame, marks: Sequence[str], widths: list[int]):
        self.table, self.marks, self.widths = table, list(marks), widths
        self.tasks = min(table.rdd.getNumPartitions(), CORE_TASKS * table.sparkSession.sparkContext.defaultParallelism)

    def blocks(self, fits: list[Sums]):
        widths, marks = self.widths, self.marks

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
            for fit in fits:
                fit.ready(widths)
            for batch in batches:
                for i in range(batch.num_rows):
                    yield Block(batch, i, widths, marks)

        return read

    def columns(self, fits: list[Sums]) -> DataFrame:
        """What these fits read of the table."""
        names = ["n", "y", "marks", "bins", *["h" for f in fits[:1] if f.rows.bag is not None], *[score_column(f.at) for f in fits]]
        return self.table.select(*[c for c in names if c in self.table.columns])

    def sums(self, fits: list[Fit], errors: bool) -> dict[tuple[int, int], np.ndarray]:
        """``(place of the fit, leaf)`` -> rows and residuals per feature and bin; leaf -1 has held-out rows and squared errors, then those fitted."""
        fits = [f.asked() for f in fits]
        read, size = self.blocks(fits), sum(self.widths)

        def run(batches):
            found = {f.at: np.zeros((2, len(f.wanted), size)) for f in fits}
            four = {f.at: np.zeros(4) for f in fits}
            some = False
            for block in read(batches):
                some = True
                for fit in fits:
                    rest = block.y - block.scores(fit) if fit.rows.bag is None else block.y
                    if errors:
                        square, (seen, rows) = rest * rest, block.seen(fit.rows)
                        four[fit.at] += [block.n - len(rows), square @ ~seen, len(rows), square @ seen]
                    fit.add(block, rest, found[fit.at])
            if some:
                yield from packed({(f.at, -1): four[f.at] for f in fits} if errors else {})
                yield from packed({(f.at, node): found[f.at][:, k] for f in fits for k, node in enumerate(f.wanted)})

        def merge(batches):
            yield from packed(added(batches))

        ddl = "fit int, leaf int, sums binary"
        out = self.columns(fits).coalesce(self.tasks).mapInArrow(run, ddl)
        if self.tasks > DIRECT_TASKS:
            out = out.repartition("fit", "leaf").mapInArrow(merge, ddl)
        with small_batches(out.sparkSession):
            return added([out.toArrow()])

    def rescored(self, fits: list[Fit]) -> DataFrame:
        """The table with the scores of these fits alone."""
        fits = [f.asked() for f in fits]
        read, kept, scores = self.blocks(fits), BLOCK.replace(" binary", "").replace(" int", "").split(", "), [score_column(f.at) for f in fits]

        def run(batches):
            for block in read(batches):
                said = [pa.array([block.scores(f).tobytes()], pa.binary()) for f in fits]
                own = block.batch.slice(block.at, 1)
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in kept], *said], names=[*kept, *scores])

        return self.table.mapInArrow(run, ", ".join([BLOCK, *[f"{c} binary" for c in scores]]))


@contextmanager
def small_batches(session: SparkSession) -> Iterator[None]:
    """A task's Python gets its blocks one or two at a time, not 64 MB at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = session.conf.get(name)
    session.conf.set(name, str(BLOCK_BYTES))
    try:
        yield
    finally:
        session.conf.set(name, before)


def packed(found: Mapping[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    if found:
        fit, leaf = zip(*found)
        sums = pa.array([v.tobytes() for v in found.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(fit, pa.int32()), pa.array(leaf, pa.int32()), sums], names=["fit", "leaf", "sums"])


def added(batches) -> dict[tuple[int, int], np.ndarray]:
    out: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for fit, leaf, sums in zip(*(batch.column(c).to_pylist() for c in ("fit", "leaf", "sums"))):
            out[fit, leaf] = out.get((fit, leaf), 0.0) + np.frombuffer(sums, np.float64)
    return out


# ---------------------------------------------------------------- growing


def gains_of(sums: np.ndarray, widths: list[int], growth: Growth, drawn: set[int] | None = None) -> list[np.ndarray]:
    """Per feature the gain of a split after each bin but the last; -inf where a side has too few rows. None for features that are not drawn."""
    out, at = [], 0
    for i, width in enumerate(widths):
        if drawn is not None and i not in drawn:
            out.append(np.zeros(0))
            at += width
            continue
        n, s = sums[0, at : at + width], sums[1, at : at + width]
        at += width
        total_n, total_s = n.sum(), s.sum()
        left_n, left_s = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
        right_n, right_s = total_n - left_n, total_s - left_s
        square = lambda a, b: np.divide(a * a, b + growth.l2, out=np.zeros_like(a), where=b + growth.l2 > 0)
        gain = square(left_s, left_n) + square(right_s, right_n) - total_s * total_s / max(total_n + growth.l2, 1e-300)
        few = (left_n < growth.least_rows) | (right_n < growth.least_rows)
        out.append(np.where(few, 0.0 if growth.symmetric else -np.inf, gain))
    return out


def drawn(fit: Fit, node: int, features: int) -> set[int] | None:
    """The features that are looked at in a node, drawn by the number of the bag and of the node; all of them without a number to draw."""
    if fit.growth.features is None:
        return None
    return set(np.random.default_rng([fit.rows.bag or 0, node]).permutation(features)[: fit.growth.features].tolist())


def best_split(gains: list[np.ndarray]) -> tuple[float, int, int]:
    """Gain, feature and bin; the first of equals."""
    best = (-np.inf, -1, 0)
    for i, g in enumerate(gains):
        if len(g) and g.max() > best[0]:
            best = (float(g.max()), i, int(g.argmax()))
    return best


def worth(fit: Fit, split: tuple[float, int, int], nodes: list[int]) -> bool:
    has = sum(s * s / max(n, 1.0) for n, s in map(fit.totals.__getitem__, nodes))
    return split[1] >= 0 and split[0] > NOISE * max(1.0, has)


def take_level(fit: Fit, found: Mapping[tuple[int, int], np.ndarray], widths: list[int]) -> None:
    """Split the leaves whose sums came in; what the next scan is to sum is left in ``wanted``."""
    tree, growth = fit.tree, fit.growth
    for node in fit.wanted:
        fit.sums[node] = found[fit.at, node].reshape(2, -1) if (fit.at, node) in found else np.zeros((2, sum(widths)))
        if node:  # its neighbour has what is left of their parent
            fit.sums[beside(node)] = fit.sums[tree.left.index(min(node, beside(node)))] - fit.sums[node]
        else:
            fit.totals[0] = tuple(fit.sums[0][:, : widths[0]].sum(1))
    new = [m for n in fit.wanted for m in (sorted((n, beside(n))) if n else (0,))]
    fit.wanted = []
    if growth.symmetric:
        gains = [gains_of(fit.sums[n], widths, growth) for n in new]
        split = best_split([np.sum(g, axis=0) for g in zip(*gains)])
        divided = new if worth(fit, split, new) else []
        fit.splits |= {n: split for n in divided}
        fit.model.gains[split[1]] += split[0] if divided else 0.0
    else:
        found = {n: best_split(gains_of(fit.sums[n], widths, growth, drawn(fit, n, len(widths)))) for n in new}
        fit.splits |= {n: s for n, s in found.items() if worth(fit, s, [n])}
        divided = chosen(fit) if growth.leaves else [n for n in new if n in fit.splits]
    for n in divided:
        if tree.feature[n] < 0:
            left = divide(fit, n, fit.splits[n], widths)
            if fit.depths[left] < growth.depth:  # the left child is summed, or the other if that saves many rows
                fit.wanted.append(left if fit.totals[left][0] <= fit.totals[left + 1][0] + BLOCK_ROWS else left + 1)


def beside(node: int) -> int:
    """The other child of the same parent: left ones have odd numbers."""
    return node + 1 if node % 2 else node - 1


def chosen(fit: Fit) -> list[int]:
    """The splits that growing the best leaf first makes, as far as they are known: what isn't among them now never will be."""
    leaves, out = {0}, []
    while len(leaves) < fit.growth.leaves:
        known = [n for n in leaves if n in fit.splits]
        if not known:
            break
        n = max(known, key=lambda m: (fit.splits[m][0], -m))
        out.append(n)
        leaves.remove(n)
        if fit.tree.feature[n] >= 0:
            leaves |= {fit.tree.left[n], fit.tree.left[n] + 1}
        else:
            leaves.add(-n - 1)  # two leaves whose splits are not known yet
            leaves.add(-n - 1 - len(fit.tree.feature))
    return out


def divide(fit: Fit, node: int, split: tuple[float, int, int], widths: list[int]) -> int:
    _, feature, cut = split
    left, start = fit.tree.split(node, feature, cut), sum(widths[:feature])
    fit.totals[left] = tuple(fit.sums[node][:, start : start + cut + 1].sum(1))
    fit.totals[left + 1] = tuple(a - b for a, b in zip(fit.totals[node], fit.totals[left]))
    fit.depths[left] = fit.depths[left + 1] = fit.depths[node] + 1
    fit.tree.depth = max(fit.tree.depth, fit.depths[left])
    return left


def close(fit: Fit) -> None:
    """Give the leaves their values; splits that best-first growth has not taken are undone."""
    tree, step = fit.tree, fit.step if fit.first is None or fit.model.trees else fit.first
    if fit.growth.leaves:
        taken = set(chosen(fit))
        for n in range(len(tree.feature)):
            if n not in taken:
                tree.feature[n] = -1
    if not fit.growth.symmetric:
        for n, (gain, feature, _) in fit.splits.items():
            if tree.feature[n] >= 0:
                fit.model.gains[feature] += gain
    for n, (rows, rest) in fit.totals.items():
        tree.value[n] = float(step * rest / (rows + fit.growth.l2)) if rows + fit.growth.l2 > 0 else 0.0
    fit.model.trees.append(tree)
    fit.pending.append(tree)


def grow(scan: Scan, fits: list[Fit], widths: list[int], errors: bool, stop) -> None:
    """One tree for each fit that is active, level by level; ``stop`` gets the errors of the first scan and may end fits."""
    for fit in fits:
        fit.tree, fit.wanted, fit.sums, fit.splits, fit.depths, fit.totals = Tree(), [0], {}, {}, {0: 0}, {}
    first, now = True, fits
    while now:
        found = scan.sums(now, errors and first)
        if first:
            stop(found)
            now = [f for f in now if f.active]
        first = False
        for fit in now:
            take_level(fit, found, widths)
        now = [f for f in now if f.wanted]
    for fit in fits:
        if fit.active:
            close(fit)


def boost(
    df: DataFrame, features: Sequence[str], label: str, key: str, jobs: Mapping[str, tuple[Boosting, Rows]], marks: Sequence[str] = (), bins: int = BINS
) -> dict[str, Ensemble]:
    """Fit all jobs side by side. Held-out rows give the error curve; with patience a fit ends and keeps its best round."""
    complete = complete_rows(df, [*features, label])
    cuts = cut_points(complete, features, bins)
    widths = [len(c) + 1 for c in cuts]
    rows = binned(complete, features, label, key, marks, cuts)
    fits = {n: Fit(i, r, b.growth, b.step, Ensemble(list(features), cuts, gains=np.zeros(len(features))), first=b.first) for i, (n, (b, r)) in enumerate(jobs.items())}
    if not fits:
        return {}
    table = dealt_out(rows, complete.count(), len(features), len(fits))
    scan = Scan(table, marks, widths)
    start_values(scan, list(fits.values()), widths)

    def stop(found):
        for name, fit in fits.items():
            if not fit.active:
                continue
            spec, done = jobs[name][0], len(fit.model.trees)
            n, squares, *_ = found.get((fit.at, -1), np.zeros(4))
            fit.model.best, waited = done, 0
            if n:
                fit.model.errors.append(float(np.sqrt(squares / n)))
                fit.model.best = int(np.argmin(fit.model.errors))
                waited = done - fit.model.best
            fit.active = done < spec.rounds and not (spec.patience and waited >= spec.patience)

    written = 0
    while any(f.active for f in fits.values()):
        grow(scan, [f for f in fits.values() if f.active], widths, True, stop)
        written += 1
        if written % CUT == 0 and any(f.active for f in fits.values()):
            old, scan = scan, Scan(write_blocks(scan.rescored([f for f in fits.values() if f.active]), "scores"), marks, widths)
            discard(old.table)
            for fit in fits.values():
                fit.pending = []
    for name, fit in fits.items():
        if jobs[name][0].patience:
            fit.model.trees = fit.model.trees[: fit.model.best]
    return {n: f.model for n, f in fits.items()}


def start_values(scan: Scan, fits: list[Fit], widths: list[int]) -> None:
    """Each fit starts from the mean of its rows, held as a tree without splits."""
    for fit in fits:
        fit.tree, fit.wanted = Tree(), [0]
    found = scan.sums(fits, False)
    for fit in fits:
        sums = found.get((fit.at, 0), np.zeros(2 * sum(widths))).reshape(2, -1)[:, : widths[0]].sum(1)
        fit.model.start = float(sums[1] / sums[0]) if sums[0] else 0.0
        fit.pending.append(Tree(value=[fit.model.start]))


def forest(
    df: DataFrame, features: Sequence[str], label: str, key: str, trees: int, growth: Growth, jobs: Mapping[str, Rows] | None = None, marks: Sequence[str] = (), bins: int = BINS
) -> dict[str, Ensemble]:
    """Trees on bags of the rows, each the mean of its leaf; an ensemble is their mean. All features are looked at in every split."""
    jobs = jobs or {"forest": Rows()}
    complete = complete_rows(df, [*features, label])
    cuts = cut_points(complete, features, bins)
    widths = [len(c) + 1 for c in cuts]
    table = dealt_out(binned(complete, features, label, key, marks, cuts), complete.count(), len(features))
    scan = Scan(table, marks, widths)
    models = {n: Ensemble(list(features), cuts, gains=np.zeros(len(features))) for n in jobs}
    every = [(n, t) for t in range(trees) for n in jobs]  # jobs that draw the same bag are next to each other
    for at in range(0, len(every), TREES_AT_ONCE):
        fits = [Fit(i, Rows(jobs[n].held, t), growth, 1.0 / trees, models[n]) for i, (n, t) in enumerate(every[at : at + TREES_AT_ONCE])]
        grow(scan, fits, widths, False, lambda found: None)
    return models


# ---------------------------------------------------------------- whole uses


def without(mark: str, values: Sequence[int]) -> dict[int, Rows]:
    """For each value of a mark the rows that don't have it."""
    return {v: Rows(((mark, v),)) for v in values}


def cv_boosting(df: DataFrame, features: Sequence[str], label: str, key: str, fold: str, folds: int, flavours: Mapping[str, Boosting], bins: int = BINS) -> DataFrame:
    """``(model, fold, rounds, rmse)`` of all flavours and folds, fitted side by side; the errors are those of the last scan."""
    jobs = {f"{n}\t{f}": (b, r) for n, b in flavours.items() for f, r in without(fold, range(folds)).items()}
    models = boost(df, features, label, key, jobs, [fold], bins)
    rows = [(*k.split("\t"), len(m.trees), m.errors[len(m.trees)]) for k, m in models.items() if m.errors]
    return df.sparkSession.createDataFrame([(n, int(f), r, e) for n, f, r, e in rows], "model string, fold int, rounds int, rmse double")


def cv_forest(df: DataFrame, features: Sequence[str], label: str, key: str, fold: str, folds: int, trees: int, growth: Growth, bins: int = BINS) -> DataFrame:
    """``(model, fold, rmse)``: every row is predicted by the forest that has not seen its fold."""
    models = forest(df, features, label, key, trees, growth, {str(f): r for f, r in without(fold, range(folds)).items()}, [fold], bins)
    return cv_scores(df, features, label, fold, {int(f): m for f, m in models.items()}, "RandomForest")


def cv_scores(df: DataFrame, features: Sequence[str], label: str, fold: str, models: Mapping[int, Ensemble], name: str) -> DataFrame:
    predicted = blind_prediction(models, col(fold))
    rows = complete_rows(df, [*features, label]).select(col(fold).cast("int").alias("fold"), (col(label) - predicted).alias("e"))
    return rows.groupBy("fold").agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse")).select(F.lit(name).alias("model"), "fold", "rmse")


def error_curve(model: Ensemble, df: DataFrame) -> DataFrame:
    """``(round, rmse, is_best)`` on held-out rows; round 0 is the mean alone."""
    rows = [(i, e, int(i == model.best)) for i, e in enumerate(model.errors)]
    return df.sparkSession.createDataFrame(rows, "round int, rmse double, is_best int")


def stopped_then_refit(
    df: DataFrame, features: Sequence[str], label: str, key: str, validation: str, spec: Boosting, bins: int = BINS
) -> tuple[Ensemble, Ensemble]:
    """A fit that held-out rows (1 in ``validation``) end, and one on all rows with its best number of rounds."""
    stopped = boost(df, features, label, key, {"stopped": (spec, Rows(((validation, 1),)))}, [validation], bins)["stopped"]
    final = Boosting(max(1, stopped.best), spec.step, spec.growth)
    return stopped, boost(df, features, label, key, {"final": (final, Rows())}, (), bins)["final"]
