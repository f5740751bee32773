"""The three batch jobs: diagnose a table pair, encode it, and fit models to it.

Each returns its result tables by name and leaves writing to the caller
(:func:`tablewright.sources.sinks.write_results`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..operators import (
    bins,
    catalog,
    correlation,
    distribution,
    encode,
    evaluate,
    features,
    linear,
    missing,
    outliers,
    ranks,
    segments,
    shaping,
    split,
    trees,
)
from ..sources import sinks
from ..storage import stage
from . import house
from .report import summary_report


@dataclass
class Settings:
    """What the jobs need to know about a table; the defaults are those of the house table."""

    key: str = house.KEY
    target: str = house.TARGET
    impute: missing.ImputePlan = field(default_factory=lambda: house.IMPUTE)
    fit_scope: str = "test"
    derived: Sequence[features.Derived] = field(default_factory=lambda: features.HOUSE_FEATURES)
    rule: outliers.SizePriceRule = outliers.HOUSE_RULE
    drop_outliers: bool = False
    catalog: catalog.Catalog = field(default_factory=lambda: house.CATALOG)
    groups: catalog.Catalog = field(default_factory=lambda: house.GROUPS)
    meanings: Mapping[str, str] = field(default_factory=lambda: house.ABSENT_MEANING)
    sensitivity: Sequence[str] = field(default_factory=lambda: house.SENSITIVITY_FEATURES)
    related: Sequence[str] = field(default_factory=lambda: house.RELATED_FEATURES)
    gain: Sequence[str] = field(default_factory=lambda: house.GAIN_CANDIDATES)
    segments: Sequence[str] = field(default_factory=lambda: house.SEGMENTS)
    engineered: Sequence[str] = field(default_factory=lambda: house.ENGINEERED_NUMERIC)
    flags: Sequence[str] = field(default_factory=lambda: house.ENGINEERED_FLAGS)
    validation_percent: int = 20
    seed: int | None = 42


def clean(train: DataFrame, test: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Impute and derive; both cleaned tables are written once, as every later step reads them."""
    if s.target not in train.columns:
        raise ValueError(f"the train table has no column {s.target}")
    filled_train, filled_test, log = missing.impute(train, test, s.impute, s.fit_scope)
    clean_train = stage(features.derive(filled_train, s.derived), "train", even=True)
    clean_test = stage(features.derive(filled_test, s.derived), "test", even=True)
    tables = {
        "missing_train_before": missing.missing_summary(train),
        "missing_test_before": missing.missing_summary(test),
        "missing_train_after": missing.missing_summary(clean_train),
        "missing_test_after": missing.missing_summary(clean_test),
        "missing_strategy": log,
        "train_clean": clean_train,
        "test_clean": clean_test,
    }
    return clean_train, clean_test, tables


def diagnose(train: DataFrame, test: DataFrame, texts: DataFrame | None = None, settings: Settings | None = None) -> dict[str, DataFrame]:
    """Clean both tables, then profile, correlate and segment the train table and its residuals."""
    s = settings or Settings()
    clean_train, _, out = clean(train, test, s)
    out["feature_groups"] = catalog.catalog_check(clean_train, s.groups)
    out["feature_types"] = catalog.catalog_check(clean_train, s.catalog)
    if texts is not None:
        out["na_semantics"] = missing.na_semantics(train, s.meanings, texts)

    flagged = split.with_validation(outliers.flag_outliers(clean_train, s.rule), s.key, s.validation_percent, s.seed)
    out["outlier_candidates"] = features.keep_where(flagged, F.col("is_outlier") == 1)
    out["outlier_sensitivity"] = outliers.outlier_sensitivity(flagged, "is_outlier", s.sensitivity, s.target, "is_valid")
    rows = stage(outliers.remove_outliers(flagged), "kept") if s.drop_outliers else flagged

    out["distribution"] = distribution.distribution_diagnostics(rows, distribution.raw_and_log(s.target))
    out["distribution_before_after"] = distribution.distribution_diagnostics(
        flagged, distribution.before_after(s.target, "is_outlier")
    )
    related = catalog.present(rows, s.related)
    if related:
        out["relationships"] = correlation.relationship_diagnostics(rows, related, s.target)
    out["feature_gain"] = correlation.feature_gain(rows, s.gain, s.target)

    numeric = catalog.numeric_columns(rows, exclude=["is_outlier", "is_valid"])
    matrix = stage(correlation.pearson_matrix(rows, numeric), "matrix")
    out["pearson_matrix"] = matrix
    out["pearson_ranking"] = correlation.target_ranking(matrix, s.target)
    out["collinear_pairs"] = correlation.collinear_pairs(matrix, numeric)
    out["top_submatrix"] = correlation.top_submatrix(matrix, s.target)
    others = [c for c in numeric if c != s.target]
    out["spearman_ranking"] = ranks.spearman_ranking(rows, others, s.target)

    coded = stage(encode.prepare_for_model(rows.drop("is_outlier", "is_valid"), s.target), "coded")
    inputs = [c for c in coded.columns if c != s.target]
    out["mutual_information"] = correlation.mutual_information(coded, inputs, s.target)
    for c in catalog.present(rows, s.segments):
        out[f"segment_{c}"] = segments.segment_stats(rows, c, s.target)
        out[f"box_{c}"] = segments.box_stats(rows, c, s.target)
    out["histogram"] = bins.histogram(rows, s.target)
    out["qq_points"] = bins.qq_points(rows, s.target)

    model, residuals = residual_analysis(coded, rows, s)
    out["coefficients"] = model.coefficients(coded)
    out["residuals"] = residuals
    out["residual_metrics"] = evaluate.regression_metrics(residuals, F.col("actual"), F.col("predicted"))
    out["residual_summary"] = evaluate.residual_summary(residuals)
    for c in catalog.present(residuals, s.segments):
        out[f"residual_by_{c}"] = segments.residual_by(residuals, c)
    priced = bins.with_quantile_bin(residuals, "actual", bins.PRICE_SHARES, bins.PRICE_LABELS, "segment")
    out["residual_by_price_segment"] = segments.residual_by(priced, "segment", bins.PRICE_LABELS)
    out["heteroscedasticity"] = correlation.heteroscedasticity(residuals)
    out["summary"] = summary_report(
        {
            "skewness": (out["distribution"], "version", "skewness"),
            "pearson": (correlation.correlation_importance(matrix, s.target, 10), "feature", "pearson"),
            "spearman": (out["spearman_ranking"], "feature", "spearman"),
            "mutual information": (out["mutual_information"], "feature", "mi"),
            "residuals": (out["residual_summary"], "metric", "value"),
            "coefficients": (out["coefficients"], "feature", "abs_coefficient"),
        }
    )
    return out


def residual_analysis(coded: DataFrame, rows: DataFrame, s: Settings) -> tuple[linear.LinearModel, DataFrame]:
    """Least squares on every coded column; residuals of the held-out rows with their segments."""
    held = split.with_validation(coded, s.key, s.validation_percent, s.seed)
    inputs = [c for c in coded.columns if c != s.target]
    model = linear.fit_linear(held.filter("is_valid = 0"), inputs, s.target)
    blind = evaluate.residual_table(held.filter("is_valid = 1"), s.key, s.target, model.prediction())
    attached = evaluate.attach_by_key(blind, rows, s.key, catalog.present(rows, s.segments))
    return model, stage(attached, "residuals")


def encode_tables(train: DataFrame, test: DataFrame, settings: Settings | None = None) -> tuple[encode.Encoder, dict[str, DataFrame]]:
    """Model-ready train and test table, and what was done to the columns."""
    s = settings or Settings()
    made_train, made_test = features.derive(train, s.derived), features.derive(test, s.derived)
    fitted = encode.fit_encoder(made_train, s.catalog, s.engineered, s.flags)
    train_matrix = stage(encode.encode(made_train, fitted, [s.key, s.target]), "train-matrix")
    test_matrix = stage(encode.encode(made_test, fitted, [s.key]), "test-matrix")
    names = fitted.feature_names()
    kinds = fitted.feature_types()
    levels = [c for c in fitted.nominal_levels if c in made_test.columns]
    matrix = correlation.wide_pearson_matrix(train_matrix, [*names, s.target])
    return fitted, {
        "train_matrix": train_matrix,
        "test_matrix": test_matrix,
        "feature_list": train.sparkSession.createDataFrame([(c, kinds[c]) for c in names], "feature string, feature_type string"),
        "encoded_profile": encode.encoded_profile(
            {"raw": (train.drop(s.key, s.target), {}), "engineered": (made_train.drop(s.key, s.target), {}), "encoded": (train_matrix.drop(s.key, s.target), kinds)}
        ),
        "alignment": encode.alignment_check(train_matrix, test_matrix, s.target),
        "level_drift": encode.level_drift(made_train, made_test, levels),
        "correlation_after_encoding": matrix,
        "correlation_importance": correlation.correlation_importance(matrix, s.target),
        "row_profile": shaping.row_profile(train_matrix, s.target, s.key, names),
    }


def compare_models(
    matrix: DataFrame,
    inputs: Sequence[str],
    settings: Settings | None = None,
    folds: int = 5,
    tree_models: Mapping[str, trees.TreeSpec] | None = None,
) -> dict[str, DataFrame]:
    """Cross-validated error of linear models and tree ensembles on the log target, and the leaderboard."""
    s = settings or Settings()
    rows = matrix.select(col(s.key), *[col(c) for c in inputs], F.log1p(s.target).alias("y"))
    rows = stage(split.with_fold(rows, s.key, folds, s.seed), "folds")
    baseline = linear.cv_linear(rows, inputs, "y", "fold")
    boosting = trees.cv_trees(rows, inputs, "y", "fold", folds, dict(tree_models or trees.TREE_MODELS))
    board = evaluate.leaderboard({"Baseline": linear.cv_summary(baseline), "Boosting": linear.cv_summary(boosting)})
    return {
        "baseline_scores": baseline,
        "boosting_scores": boosting,
        "leaderboard": board,
        "stability": evaluate.stability(board),
        "best_model": evaluate.best_model(board),
    }


def boost(
    train: DataFrame,
    test: DataFrame,
    settings: Settings | None = None,
    spec: trees.TreeSpec = trees.TreeSpec("boost", 20, 5, 0.2),
) -> dict[str, DataFrame]:
    """Own dictionaries per ordinal column, categories by target means, early stop, refit, scoring."""
    s = settings or Settings()
    maps = encode.ordinal_maps(house.BOOST_ORDINALS)

    def mapped(df: DataFrame) -> DataFrame:
        out = features.derive(df, s.derived)
        out = features.map_columns(out, maps, null_as="None")
        out = features.map_columns(out, house.BOOST_BINARY)
        return features.codes_to_text(out, house.BOOST_SPECIAL, default="None")

    fold = "__fold"
    rows = split.with_fold(mapped(train), s.key, 5, s.seed, fold).withColumn("y", F.log1p(s.target))
    new = mapped(test).withColumn(fold, F.lit(-1))
    done = [*maps, *house.BOOST_BINARY]
    categories = catalog.categorical_columns(rows, [*house.BOOST_NOMINAL, *house.BOOST_SPECIAL], done)
    rows, new = encode.target_encode_pair(rows, new, categories, "y", fold)
    inputs = [c for c in catalog.numeric_columns(rows, exclude=[s.key, s.target, "y", fold]) if c in new.columns]
    middle = missing.medians(rows, missing.missing_columns(rows, inputs) + [c for c in missing.missing_columns(new, inputs)])
    fills = {c: v if v is not None else 0.0 for c, v in middle.items()}
    rows = stage(split.with_validation(missing.apply_fills(rows, fills), s.key, s.validation_percent, s.seed), "boost-train")
    new = stage(missing.apply_fills(new, fills), "boost-test")
    stopped, final, best = trees.early_stop_then_refit(rows, inputs, "y", "is_valid", spec)
    held = trees.predict(stopped, rows.filter("is_valid = 1"))
    return {
        "train_processed": rows,
        "test_processed": new,
        "validation_metrics": evaluate.regression_metrics(held, F.expm1("y"), F.expm1("prediction")).withColumn("rounds", F.lit(best)),
        "importance": trees.feature_importance(final, rows, inputs),
        "scored": sinks.scored(trees.predict(final, new), s.key, "prediction", s.target),
    }
