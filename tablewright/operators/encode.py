"""Scaling and encoding to a model-ready table: fitted on train, applied to both."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.scalar import col, nan_to_null
from ..storage import pin_small, stage
from .catalog import Catalog, column_profile, is_missing, numeric_columns, present
from .missing import fill_for_model
from .shaping import labelled, union_all
from .split import key_hash

#: One-hot output is as wide as the levels; beyond this a column is not a category.
MAX_LEVELS = 1_000


@dataclass
class Encoder:
    """Everything fitted on train, as plain values."""

    numeric: list = field(default_factory=list)
    engineered: list = field(default_factory=list)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    ordinal_levels: dict = field(default_factory=dict)
    nominal_levels: dict = field(default_factory=dict)
    binary_maps: dict = field(default_factory=dict)
    flags: list = field(default_factory=list)

    def feature_names(self) -> list[str]:
        """Output columns in order: scaled, ordinal, one per level, binary, flags."""
        one_hot = [one_hot_name(c, v) for c, levels in self.nominal_levels.items() for v in levels]
        return [*self.numeric, *self.ordinal_levels, *one_hot, *self.binary_maps, *self.flags]

    def feature_types(self) -> dict[str, str]:
        kinds = {c: "Engineered Numeric" if c in self.engineered else "Numeric" for c in self.numeric}
        kinds.update({c: "Ordinal Encoded" for c in self.ordinal_levels})
        kinds.update({one_hot_name(c, v): "OneHot Encoded" for c, vs in self.nominal_levels.items() for v in vs})
        kinds.update({c: "Binary" for c in [*self.binary_maps, *self.flags]})
        return kinds


def one_hot_name(column: str, level: str) -> str:
    return f"{column}_{level}"


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> tuple[dict, dict]:
    """Mean and population deviation of every column in one scan; a constant gets deviation 1."""
    if not columns:
        return {}, {}
    x = [S.nan_to_null(col(c).cast("double")) for c in columns]
    row = df.agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)], *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(x)]
    ).first()
    means = {c: row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i, c in enumerate(columns)}
    return means, {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)}


def scaled(column: str, means: Mapping, stds: Mapping) -> Column:
    return (col(column).cast("double") - F.lit(means[column])) / F.lit(stds[column])


def levels_of(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct levels of all columns from one job; an error where a column has too many.

    Counting first means that a column with very many levels never reaches the driver.
    """
    if not columns:
        return {}
    parts = [p for c in columns for p in (F.lit(c), col(c).cast("string"))]
    distinct = df.select(F.stack(F.lit(len(columns)), *parts).alias("feature", "level")).filter("level IS NOT NULL").distinct()
    rows = distinct.limit(max_levels * len(columns) + 1).collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        out[r["feature"]].append(r["level"])
    wide = [c for c, levels in out.items() if len(levels) > max_levels]
    if wide or len(rows) > max_levels * len(columns):
        raise ValueError(f"more than {max_levels} levels in {wide or list(columns)}; use codes or target encoding")
    return {c: sorted(levels) for c, levels in out.items()}


def ordinal_code(column: str, levels: Sequence[str], unknown: int = -1, null_as: str | None = None) -> Column:
    """Position in a fixed level list; unknown and null give ``unknown``."""
    return S.map_values(col(column), {v: i for i, v in enumerate(levels)}, unknown, null_as).cast("int")


def one_hot(column: str, levels: Sequence[str]) -> list[Column]:
    """One 0/1 column per level; a level not seen in the fit, and null, give only zeros."""
    text = col(column).cast("string")
    return [
        F.coalesce((text == F.lit(v)).cast("int"), F.lit(0)).alias(one_hot_name(column, v)) for v in levels
    ]


def spread_key(df: DataFrame, column: str) -> Column:
    """The text of a column as a join key. Null rows, which match nothing, get a key of their own each, so that they
    are dealt out over the shuffle; a hot level is split by adaptive execution, as the other side has one row for it."""
    own = F.concat(F.lit("\u0001"), F.monotonically_increasing_id().cast("string"))
    return F.coalesce(col(column).cast("string"), own)


def sparse_one_hot(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``, a sparse row ``(size, indices, values)`` with a one at the place of the level.

    For any number of levels: places come from a join, and no row is as long as the list of levels. Null has no
    index.
    """
    codes = stage(dense_codes(df, column), "codes")
    size = codes.count()
    joined = df.withColumn("__level", spread_key(df, column)).join(codes.withColumnsRenamed({"level": "__level", "code": "__code"}), "__level", "left")
    there = F.col("__code").isNotNull() & col(column).isNotNull()
    indices = F.when(there, F.array("__code")).otherwise(F.array().cast("array<bigint>"))
    values = F.transform(indices, lambda _: F.lit(1.0))
    return joined.select(*[col(c) for c in df.columns], F.struct(F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")).alias(name))


def fit_encoder(
    train: DataFrame,
    catalog: Catalog,
    engineered: Sequence[str] = (),
    flags: Sequence[str] = (),
    max_levels: int = MAX_LEVELS,
) -> Encoder:
    """Two jobs: one for means and deviations, one for levels."""
    numeric = catalog.of("numeric continuous", "numeric count", present_in=train) + present(train, engineered)
    means, stds = fit_scaler(train, numeric)
    nominal = catalog.of("nominal", "special", present_in=train)
    return Encoder(
        numeric=numeric,
        engineered=present(train, engineered),
        means=means,
        stds=stds,
        ordinal_levels={c: catalog.ordinal_levels[c] for c in catalog.of("ordinal", present_in=train)},
        nominal_levels=levels_of(train, nominal, max_levels),
        binary_maps={c: catalog.binary_maps[c] for c in catalog.of("binary", present_in=train)},
        flags=present(train, flags),
    )


def encode(df: DataFrame, fitted: Encoder, keep: Sequence[str] = ()) -> DataFrame:
    """The whole matrix in one projection; columns without a role are dropped."""
    out = [col(k) for k in keep]
    out += [scaled(c, fitted.means, fitted.stds).alias(c) for c in fitted.numeric]
    out += [ordinal_code(c, levels).alias(c) for c, levels in fitted.ordinal_levels.items()]
    for c, levels in fitted.nominal_levels.items():
        out += one_hot(c, levels)
    out += [S.map_values(col(c).cast("string"), m, 0).cast("int").alias(c) for c, m in fitted.binary_maps.items()]
    out += [col(c).cast("int").alias(c) for c in fitted.flags]
    return df.select(*out)


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """``(level, code)``: 0-based position of every distinct text in sorted order.

    The distinct values are range partitioned and written, which fixes their partition
    numbers; a value's code is its place in its partition plus the sizes of those before.
    """
    distinct = df.select(col(column).cast("string").alias("level")).filter("level IS NOT NULL").distinct()
    placed = stage(
        distinct.repartitionByRange("level").withColumn("part", F.spark_partition_id()), "levels"
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("level"))
    return placed.withColumn("place", place).join(before, "part").select(
        "level", (F.col("before") + F.col("place") - 1).alias("code")
    )


def label_encode(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS) -> DataFrame:
    """Replace text by its code in sorted order.

    Columns of at most ``max_levels`` levels are mapped by a literal, all from one job; a
    larger one by a join with its codes.
    """
    if not columns:
        return df
    parts = [p for c in columns for p in (F.lit(c), col(c).cast("string"))]
    distinct = df.select(F.stack(F.lit(len(columns)), *parts).alias("feature", "level")).distinct()
    sizes = {r["feature"]: r["n"] for r in distinct.groupBy("feature").agg(F.count("level").alias("n")).collect()}
    small = [c for c in columns if sizes.get(c, 0) <= max_levels]
    coded = {}
    for c, levels in levels_of(df, small, max_levels).items():
        table = {v: i for i, v in enumerate(levels)}
        coded[c] = S.map_values(col(c).cast("string"), table).cast("long") if table else F.lit(None).cast("long")
    out = df.withColumns(coded) if coded else df
    for c in [c for c in columns if c not in coded]:
        codes = pin_small(dense_codes(df, c)).withColumnsRenamed({"level": "__level", "code": c})
        joined = out.withColumn("__level", spread_key(out, c)).drop(c).join(codes, "__level", "left")
        out = joined.select(*[col(x) for x in df.columns])
    return out


def prepare_for_model(df: DataFrame, target: str) -> DataFrame:
    """Fill gaps and label encode every text column except the target."""
    filled = fill_for_model(df, target)
    numbers = set(numeric_columns(filled))
    return label_encode(filled, [c for c in filled.columns if c != target and c not in numbers])


def target_encode(
    df: DataFrame, column: str, target: str, fold: str, name: str, smoothing: float = 10.0
) -> DataFrame:
    """Mean target of the row's level over the other folds, drawn to the overall mean.

    Sums per (level, fold) combine before the shuffle; the table joined back has one row per
    level and fold.
    """
    known = df.filter(col(target).isNotNull())
    sums = known.groupBy(col(column).alias("level"), col(fold).alias("f")).agg(
        F.sum(target).alias("s"), F.count(F.lit(1)).alias("n")
    )
    sums = stage(sums, "sums")
    folds = sums.groupBy("f").agg(F.sum("s").alias("fold_s"), F.sum("n").alias("fold_n"))
    levels = sums.groupBy("level").agg(F.sum("s").alias("level_s"), F.sum("n").alias("level_n"))
    per_fold = {r["f"]: (r["fold_s"], r["fold_n"]) for r in folds.collect()}
    total_s, total_n = sum(s for s, _ in per_fold.values()), sum(n for _, n in per_fold.values())
    priors = {f: (total_s - s) / (total_n - n) for f, (s, n) in per_fold.items() if total_n > n}
    if not priors:
        return df.withColumn(name, F.lit(None).cast("double"))
    prior = F.element_at(F.create_map(*[F.lit(x) for kv in priors.items() for x in kv]), col(fold))
    text = F.col("level").cast("string").alias("__level")
    known_levels = F.col("level").isNotNull()
    own = pin_small(sums.where(known_levels).select(text, F.col("f").alias(fold), "s", "n"))
    all_folds = pin_small(levels.where(known_levels).select(text, "level_s", "level_n"))
    keyed = df.withColumn("__level", spread_key(df, column))
    joined = keyed.join(all_folds, "__level", "left").join(own, ["__level", fold], "left")
    rest_s = F.coalesce("level_s", F.lit(0.0)) - F.coalesce("s", F.lit(0.0))
    rest_n = F.coalesce("level_n", F.lit(0)) - F.coalesce("n", F.lit(0))
    value = (rest_s + F.lit(smoothing) * prior) / (rest_n + F.lit(smoothing))
    return joined.withColumn(name, value).select(*[col(c) for c in df.columns], name)


def ordered_target_encode(df: DataFrame, column: str, target: str, key: str, name: str, weight: float = 1.0, seed: int | None = None) -> DataFrame:
    """Mean target of the rows of the same level that come earlier in a shuffled order, drawn to the overall mean with the given weight.

    The order is that of a hash of the key, so no row sees its own target and results do not depend on partitions. Sums are
    made in two stages: blocks of the order are summed per level, then rows within their block, so that a level
    that holds half of all rows is spread over as many tasks as there are blocks. A null level gets the overall mean; a row without
    a target is encoded and adds nothing.
    """
    known = nan_to_null(col(target).cast("double"))
    overall = df.agg(F.avg(known)).first()[0]
    if overall is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    blocks = 4 * max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = key_hash(key, seed)
    rows = df.withColumns({"__level": col(column).cast("string"), "__y": known, "__at": place, "__block": F.floor(place * blocks / 2**32).cast("int")})
    summed = rows.where("__level IS NOT NULL").groupBy("__level", "__block").agg(F.sum("__y").alias("s"), F.count("__y").alias("n"))
    earlier = Window.partitionBy("__level").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = summed.select("__level", "__block", F.sum("s").over(earlier).alias("__bs"), F.sum("n").over(earlier).alias("__bn"))
    within = Window.partitionBy("__level", "__block").orderBy("__at", col(key)).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(before, ["__level", "__block"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    total_s = zero(F.col("__bs")) + zero(F.sum("__y").over(within))
    total_n = zero(F.col("__bn")) + zero(F.count("__y").over(within))
    encoded = (total_s + F.lit(weight * overall)) / (total_n + F.lit(weight))
    value = F.when(F.col("__level").isNull(), F.lit(overall)).otherwise(encoded)
    return joined.withColumn(name, value).select(*[col(c) for c in df.columns], name)


@dataclass
class TargetMeans:
    """Target mean per column and level: one value per fold left out, and last the one over all rows."""

    folds: list = field(default_factory=list)
    priors: list = field(default_factory=list)
    means: dict = field(default_factory=dict)

    def value(self, column: str, fold: str | None) -> Column:
        """The encoded column: blind to the row's own fold, or over all rows where ``fold`` is None."""
        place = F.lit(len(self.priors))
        if fold is not None:
            place = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(self.folds) for x in (f, i + 1)]), col(fold))
        prior = F.element_at(F.lit(self.priors), place)
        levels = self.means.get(column) or {}
        if not levels:
            return prior
        table = F.create_map(*[x for k, v in levels.items() for x in (F.lit(k), F.lit(v))])
        return F.coalesce(F.element_at(F.element_at(table, col(column).cast("string")), place), prior)


def fit_target_means(
    df: DataFrame, columns: Sequence[str], target: str, fold: str, smoothing: float = 10.0, max_levels: int = MAX_LEVELS
) -> TargetMeans:
    """Fit all columns from one job; a column with more than ``max_levels`` levels is left out."""
    parts = [p for c in columns for p in (F.lit(c), col(c).cast("string"))]
    long = df.filter(col(target).isNotNull()).select(
        col(fold).alias("f"), col(target).alias("y"), F.stack(F.lit(len(columns)), *parts).alias("feature", "level")
    )
    sums = long.groupBy("feature", "level", "f").agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n"))
    per_fold = {r["f"]: (r["s"], r["n"]) for r in df.filter(col(target).isNotNull()).groupBy(col(fold).alias("f")).agg(
        F.sum(target).alias("s"), F.count(F.lit(1)).alias("n")
    ).collect()}
    sizes = sums.groupBy("feature").agg(F.count_distinct("level").alias("levels")).filter(F.col("levels") <= max_levels)
    small = [r["feature"] for r in sizes.collect()]
    folds = sorted(per_fold)
    total_s, total_n = sum(s for s, _ in per_fold.values()), sum(n for _, n in per_fold.values())

    def mean(s: float, n: int, prior: float) -> float:
        return (s + smoothing * prior) / (n + smoothing)

    overall = total_s / total_n
    priors = [(total_s - per_fold[f][0]) / (total_n - per_fold[f][1]) if total_n > per_fold[f][1] else overall for f in folds]
    seen: dict[str, dict[str, dict]] = {c: {} for c in small}
    for r in sums.filter(F.col("feature").isin(small) & F.col("level").isNotNull()).collect():
        seen[r["feature"]].setdefault(r["level"], {})[r["f"]] = (r["s"], r["n"])
    means = {}
    for c, levels in seen.items():
        means[c] = {}
        for level, cells in sorted(levels.items()):
            s, n = sum(v[0] for v in cells.values()), sum(v[1] for v in cells.values())
            own = [cells.get(f, (0.0, 0)) for f in folds]
            blind = [mean(s - os, n - on, p) for (os, on), p in zip(own, priors)]
            means[c][level] = [*blind, mean(s, n, overall)]
    return TargetMeans(folds, [*priors, overall], means)


def target_encode_pair(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str],
    target: str,
    fold: str,
    smoothing: float = 10.0,
    max_levels: int = MAX_LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """Replace categories by target means: over the other folds on train, over all of train on test.

    Columns of few levels are one projection; a column of many is joined with its sums.
    """
    fitted = fit_target_means(train, columns, target, fold, smoothing, max_levels)
    overall = fitted.priors[-1]
    out_train = train.withColumns({c: fitted.value(c, fold) for c in fitted.means})
    out_test = test.withColumns({c: fitted.value(c, None) for c in fitted.means if c in test.columns})
    for c in [c for c in columns if c not in fitted.means]:
        name = "__encoded"
        blind = target_encode(out_train, c, target, fold, name, smoothing)
        out_train = stage(blind.drop(c).withColumnRenamed(name, c).select(*[col(x) for x in train.columns]), "encoded")
        if c in test.columns:
            known = train.filter(col(target).isNotNull())
            sums = known.where(col(c).isNotNull()).groupBy(col(c).cast("string").alias("__level")).agg(F.sum(target).alias("__s"), F.count(F.lit(1)).alias("__n"))
            rest = F.coalesce("__s", F.lit(0.0)) + F.lit(smoothing * overall)
            value = rest / (F.coalesce("__n", F.lit(0)) + F.lit(smoothing))
            keyed = out_test.withColumn("__level", spread_key(out_test, c))
            scored = keyed.join(pin_small(sums), "__level", "left").withColumn(name, value).drop(c, "__level", "__s", "__n")
            out_test = scored.withColumnRenamed(name, c).select(*[col(x) for x in test.columns])
    return out_train, out_test


def encoded_profile(stages: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """``(stage, feature, feature_type, n_rows, n_null, nonzero_rate, n_distinct)`` per stage.

    Each stage is a table and the type tag of its columns; the number of features per stage
    is a count of these rows.
    """
    out = []
    for stage_name, (df, types) in stages.items():
        tags = df.sparkSession.createDataFrame(
            [(c, types.get(c, "Raw")) for c in df.columns], "feature string, feature_type string"
        )
        out.append(labelled(column_profile(df, df.columns).join(tags, "feature"), stage=stage_name))
    rate = F.col("n_nonzero") / F.nullif(F.col("n_rows"), F.lit(0))
    return union_all(out).select(
        "stage", "feature", "feature_type", "n_rows", "n_null", rate.alias("nonzero_rate"), "n_distinct"
    )


def alignment_check(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """``(check, result)``: same number of columns, same columns, and the differences."""
    a, b = {c for c in train.columns if c != target}, set(test.columns)
    verdict = {True: "PASS", False: "FAIL"}
    rows = [
        ("Same columns count", verdict[len(a) == len(b)]),
        ("Exactly matching columns", verdict[a == b]),
        ("Missing cols in test", str(len(a - b))),
        ("Missing cols in train", str(len(b - a))),
    ]
    return train.sparkSession.createDataFrame(rows, "check string, result string")


def tables_aligned(train: DataFrame, test: DataFrame, target: str | None, levels: Sequence[str]) -> DataFrame:
    """``(check, result, n)``: columns, types and levels of two tables as they are, with the number of differences of each kind."""
    a, b = ({f.name: f.dataType.simpleString() for f in df.schema if f.name != target} for df in (train, test))
    counts = {
        "Same columns count": abs(len(a) - len(b)),
        "Exactly matching columns": len(set(a) ^ set(b)),
        "Missing cols in test": len(set(a) - set(b)),
        "Missing cols in train": len(set(b) - set(a)),
        "Same types": sum(a[c] != b[c] for c in set(a) & set(b)),
    }
    plain = train.sparkSession.createDataFrame([(k, int(v)) for k, v in counts.items()], "check string, n long")
    drift = level_drift(train, test, [c for c in levels if c in a and c in b]).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("train only", "test only")]
    )
    alone = drift.select(F.stack(F.lit(2), F.lit("Levels only in train"), F.col("train only"), F.lit("Levels only in test"), F.col("test only")).alias("check", "n"))
    return plain.unionByName(alone).withColumn("result", F.when(F.col("n") == 0, "PASS").otherwise("FAIL"))


def level_drift(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, level, train_rows, test_rows, status)``: levels that only one table has."""
    parts = [p for c in columns for p in (F.lit(c), col(c).cast("string"))]

    def levels(df: DataFrame, name: str) -> DataFrame:
        long = df.select(F.stack(F.lit(len(columns)), *parts).alias("feature", "level")).filter("level IS NOT NULL")
        return long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias(name))

    both = levels(train, "train_rows").join(levels(test, "test_rows"), ["feature", "level"], "full_outer")
    status = F.when(F.col("test_rows").isNull(), "train only").otherwise("test only")
    return both.filter(F.col("train_rows").isNull() | F.col("test_rows").isNull()).select(
        "feature",
        "level",
        F.coalesce("train_rows", F.lit(0)).alias("train_rows"),
        F.coalesce("test_rows", F.lit(0)).alias("test_rows"),
        status.alias("status"),
    )


#: The common quality scale and the scales of single columns of the house table.
QUALITY_LEVELS = ["None", "Po", "Fa", "TA", "Gd", "Ex"]
HOUSE_ORDINALS = {
    **{
        c: QUALITY_LEVELS
        for c in [
            "ExterQual", "ExterCond", "KitchenQual", "HeatingQC", "BsmtQual",
            "BsmtCond", "GarageQual", "GarageCond", "FireplaceQu",
        ]
    },
    "PoolQC": ["None", "Fa", "TA", "Gd", "Ex"],
    "GarageFinish": ["None", "Unf", "RFn", "Fin"],
    "BsmtExposure": ["None", "No", "Mn", "Av", "Gd"],
    "BsmtFinType1": ["None", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "BsmtFinType2": ["None", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "LotShape": [None, "IR3", "IR2", "IR1", "Reg"],
    "LandSlope": [None, "Sev", "Mod", "Gtl"],
}


def ordinal_maps(levels: Mapping[str, Sequence[str | None]]) -> dict[str, dict[str, int]]:
    """Level lists as dictionaries; None marks a code that no level has."""
    return {c: {v: i for i, v in enumerate(vs) if v is not None} for c, vs in levels.items()}
