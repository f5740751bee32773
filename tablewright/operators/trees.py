"""Tree ensembles on MLlib: forests, boosting, early stop, importance, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.moments import rmse
from ..functions.scalar import col
from .catalog import complete_rows
from .histograms import Boosting, Growth, cv_boosting, cv_forest
from .shaping import union_all


@dataclass(frozen=True)
class TreeSpec:
    """Size of an ensemble. MLlib grows one tree per job, so boosting uses fewer, larger steps."""

    kind: str
    trees: int
    depth: int
    step: float = 0.1
    seed: int = 42


def with_rounds(spec: TreeSpec, rounds: int, step: float) -> TreeSpec:
    """The same ensemble with another number of trees and size of step."""
    return replace(spec, trees=rounds, step=step)


#: Fits of one cross-validation that run at the same time, at most, and bytes that MLlib keeps of a row during a fit: its
#: objects, and a count for each tree.
PARALLEL_FITS, ROW_BYTES, TREE_BYTES = 4, 160, 4

#: Rows up to which a cross-validation is fitted by MLlib, model by model. Beyond, the same models grow side by side from histograms, as MLlib reads
#: all rows for each level of each tree of a model. It takes the splits it tries from a sample of 10,000 rows; histograms take them from all. Both have
#: ``MAX_BINS`` bins a feature.
MLLIB_ROWS, MAX_BINS = 100_000, 32

#: A forest and three boosting variants: wide, shallow and default trees. Boosting takes larger and fewer steps
#: than usual libraries do (a job for each level of each tree); ``with_rounds`` sets their number.
TREE_MODELS = {
    "RandomForest": TreeSpec("forest", 300, 6),
    "Boosting wide": TreeSpec("boost", 10, 5, 0.3),
    "Boosting shallow": TreeSpec("boost", 10, 3, 0.3),
    "Boosting default": TreeSpec("boost", 10, 4, 0.3),
}


def estimator(spec: TreeSpec, features: Sequence[str], label: str, validation: str | None = None) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="error")
    common = dict(featuresCol="__features", labelCol=label, maxDepth=spec.depth, seed=spec.seed)
    if spec.kind == "forest":
        model = RandomForestRegressor(numTrees=spec.trees, **common)
    else:
        stop = dict(validationIndicatorCol=validation, validationTol=0.0001) if validation else {}
        model = GBTRegressor(maxIter=spec.trees, stepSize=spec.step, **common, **stop)
    return Pipeline(stages=[assembler, model])


def fit_trees(df: DataFrame, features: Sequence[str], label: str, spec: TreeSpec, validation: str | None = None) -> PipelineModel:
    """Fit on complete rows. With a 0/1 ``validation`` column boosting stops when its error stalls."""
    rows = complete_rows(df, [*features, label])
    if validation:
        rows = rows.withColumn("__held", col(validation) == 1)
    return estimator(spec, features, label, "__held" if validation else None).fit(rows)


def predict(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Add the prediction; other columns stay as they were."""
    scored = model.transform(df).drop("__features")
    return scored if name == "prediction" else scored.withColumnRenamed("prediction", name)


def rounds(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


def feature_importance(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` in percent, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v) * 100.0) for c, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def storage_bytes(session: SparkSession) -> int:
    """What the executors may keep in memory."""
    found, total = session.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator(), 0
    while found.hasNext():
        total += found.next()._1()
    return total


def fits_at_once(rows: DataFrame, specs: Iterable, most: int = PARALLEL_FITS) -> int:
    """So many fits that the rows they keep fill half of the executors' storage, at least one; beyond it they would be written to disk and read again for each level."""
    trees = max((s.trees for s in specs if isinstance(s, TreeSpec) and s.kind == "forest"), default=1)
    kept = rows.count() * (ROW_BYTES + TREE_BYTES * trees)
    return max(1, min(most, storage_bytes(rows.sparkSession) // 2 // max(kept, 1)))


def out_of_fold(
    df: DataFrame, fold: str, folds: int, fit_predict: Callable[[DataFrame, DataFrame], DataFrame], fits: int = PARALLEL_FITS
) -> DataFrame:
    """Each fold predicted by a model that has not seen it; all rows of ``df`` once.

    The fits do not depend on each other, so some run at the same time and fill the cluster.
    """
    return union_all(at_once(df.sparkSession, lambda f: fit_predict(df.filter(col(fold) != f), df.filter(col(fold) == f)), range(folds), fits))


def at_once(session: SparkSession, task: Callable, items, fits: int = PARALLEL_FITS) -> list:
    """Results in order of independent driver-side fits, ``fits`` at a time."""
    with ThreadPoolExecutor(fits) as pool:
        return list(pool.map(inheritable_thread_target(session)(task), items))


def boosting(spec: TreeSpec) -> Boosting:
    """What MLlib's boosting does, for histograms: a whole first tree, then steps along the gradient of the squared error, twice the residual."""
    return Boosting(spec.trees, 2 * spec.step, Growth(spec.depth), first=1.0)


def cv_from_histograms(rows: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, models: dict[str, TreeSpec]) -> DataFrame:
    """``cv_trees`` for many rows: all folds in the same scans. A forest looks at a third of the features in each node and draws bags by row, as MLlib's does."""
    rows, kind, out = rows.withColumn("__row", F.monotonically_increasing_id()), rows.schema[fold].dataType, []
    if boosted := {n: boosting(s) for n, s in models.items() if s.kind == "boost"}:
        out.append(cv_boosting(rows, features, label, "__row", fold, folds, boosted, MAX_BINS))
    for name, s in models.items():
        if s.kind == "forest":
            growth = Growth(s.depth, features=ceil(len(features) / 3))
            out.append(cv_forest(rows, features, label, "__row", fold, folds, s.trees, growth, MAX_BINS).withColumn("model", F.lit(name)))
    return union_all([x.select("model", F.col("fold").cast(kind).alias("fold"), "rmse") for x in out])


def cv_trees(
    df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, models: dict[str, TreeSpec]
) -> DataFrame:
    """``(model, fold, rmse)`` of tree ensembles."""
    rows = complete_rows(df.select(*features, label, fold))
    if rows.count() > MLLIB_ROWS:
        return cv_from_histograms(rows, features, label, fold, folds, models)

    def fit_and_predict(job: tuple[str, int]) -> DataFrame:
        name, f = job
        model = fit_trees(rows.filter(col(fold) != f), features, label, models[name])
        return predict(model, rows.filter(col(fold) == f)).withColumn("model", F.lit(name))

    jobs = [(name, f) for name in models for f in range(folds)]
    predicted = union_all(at_once(df.sparkSession, fit_and_predict, jobs, fits_at_once(rows, models.values())))
    scores = predicted.groupBy("model", col(fold).alias("fold"))
    return scores.agg(rmse(col(label) - F.col("prediction")).alias("rmse"))


def early_stop_then_refit(
    df: DataFrame, features: Sequence[str], label: str, validation: str, spec: TreeSpec
) -> tuple[PipelineModel, PipelineModel, int]:
    """Find the number of rounds on a held-out share, then fit on all rows with that number."""
    stopped = fit_trees(df, features, label, spec, validation)
    best = max(1, rounds(stopped))
    final = fit_trees(df, features, label, TreeSpec(spec.kind, best, spec.depth, spec.step, spec.seed))
    return stopped, final, best
