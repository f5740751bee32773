"""Conventions that differ between engines, one case each."""

import math

import pytest
from pyspark.sql import functions as F

from tablewright.functions import scalar as S
from tablewright.functions.moments import adjusted_kurtosis, adjusted_skewness, pearson
from tablewright.operators import bins, distribution, encode, evaluate, features, frequency, linear, missing, ranks, segments
from tablewright.operators.correlation import pair_correlations


def column(df, name):
    return [r[name] for r in df.collect()]


def test_negated_mask_keeps_null_rows(frame):
    df = frame("x double", (None,), (1.0,), (5.0,))
    assert column(features.keep_where_not(df, F.col("x") > 4), "x") == [None, 1.0]


def test_correlation_with_a_constant_is_null(frame):
    df = frame("a double, b double", (1.0, 1.0), (2.0, 1.0), (3.0, 1.0))
    assert pair_correlations(df, [("a", "b")]).first()["r"] is None
    assert df.agg(pearson(F.col("b"), F.col("a")).alias("r")).first()["r"] is None
    assert ranks.spearman(df, ["b"], "a").first()["spearman"] is None


def test_null_group_is_left_out(frame):
    df = frame("k string, x double", (None, 1.0), ("a", 2.0), ("a", 4.0))
    rows = segments.segment_stats(df, "k", "x").collect()
    assert [(r["k"], r["count"], r["median"]) for r in rows] == [("a", 2, 3.0)]


def test_segment_count_includes_rows_without_target(frame):
    df = frame("k string, x double", ("a", None), ("a", 4.0), ("b", None))
    rows = {r["k"]: (r["count"], r["median"], r["std"]) for r in segments.segment_stats(df, "k", "x").collect()}
    assert rows == {"a": (2, 4.0, None), "b": (1, None, None)}


def test_mode_tie_takes_the_smallest(frame):
    df = frame("x string", ("2",), ("2",), ("1",), ("1",))
    assert frequency.mode_values(df, ["x"]) == {"x": "1"}


def test_constant_column_scales_to_zero(frame):
    df = frame("x double", *[(7.0,)] * 5)
    means, stds = encode.fit_scaler(df, ["x"])
    assert column(df.select(encode.scaled("x", means, stds).alias("z")), "z") == [0.0] * 5


def test_unseen_and_null_levels_are_all_zero(frame):
    train, test = frame("c string", ("a",), ("b",)), frame("c string", ("a",), ("c",), (None,))
    levels = encode.levels_of(train, ["c"])["c"]
    assert [tuple(r) for r in test.select(*encode.one_hot("c", levels)).collect()] == [(1, 0), (0, 0), (0, 0)]


def test_ordinal_unknown_and_null(frame):
    df = frame("q string", ("Ex",), ("None",), (None,), ("zz",))
    assert column(df.select(encode.ordinal_code("q", encode.QUALITY_LEVELS).alias("c")), "c") == [5, 0, -1, -1]
    assert column(df.select(encode.ordinal_code("q", encode.QUALITY_LEVELS, null_as="None").alias("c")), "c") == [5, 0, 0, -1]


def test_quantile_bins_are_right_closed(frame):
    df = frame("x double", *[(float(i),) for i in range(1, 11)])
    binned = bins.with_quantile_bin(df, "x", [0.0, 1 / 3, 2 / 3, 1.0])
    assert column(binned.orderBy("x"), "bin") == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_equal_values_collapse_bins(frame):
    df = frame("x double, y double", *[(3.0, float(i)) for i in range(5)])
    assert bins.bin_edges(df, "x", bins.even_shares(5)) == [3.0]
    row = bins.variance_ratios(df, ["x"], "y").collect()
    assert row == []
    with pytest.raises(ValueError):
        bins.with_quantile_bin(df, "x", bins.even_shares(3), bins.THIRDS_LABELS)


def test_nan_counts_as_null(frame):
    df = frame("x double", (float("nan"),), (None,), (1.0,), (2.0,))
    assert frequency.medians(df, ["x"]) == {"x": 1.5}
    assert missing.missing_summary(df).first()["missing_count"] == 2
    filled = missing.apply_fills(df, {"x": 9.0})
    assert sorted(column(filled, "x")) == [1.0, 2.0, 9.0, 9.0]


def test_histogram_maximum_and_gaps(frame):
    df = frame("x double", (0.0,), (1.0,), (2.0,), (10.0,), (None,))
    counts = {r["bin"]: r["n"] for r in bins.histogram(df, "x", 5).collect()}
    assert counts == {1: 2, 2: 1, 3: 0, 4: 0, 5: 1}
    same = frame("x double", *[(4.0,)] * 3)
    assert sum(r["n"] for r in bins.histogram(same, "x", 5).collect()) == 3


def test_population_and_sample_deviation(frame):
    scores = frame("model string, fold int, rmse double", ("m", 0, 1.0), ("m", 1, 3.0))
    row = linear.cv_summary(scores).first()
    assert (row["cv_rmse"], row["cv_std"]) == (2.0, 1.0)
    residuals = frame("residual double, abs_residual double", (1.0, 1.0), (3.0, 3.0))
    values = {r["metric"]: r["value"] for r in evaluate.residual_summary(residuals).collect()}
    assert values["Residual Std"] == pytest.approx(math.sqrt(2.0))


def test_row_sum_and_mean_skip_nulls_but_plus_does_not(frame):
    df = frame("a double, b double", (1.0, None), (None, None))
    rows = df.select(
        S.row_sum(["a", "b"]).alias("s"), S.row_mean(["a", "b"]).alias("m"), S.weighted_sum({"a": 1, "b": 0.5}).alias("w")
    ).collect()
    assert [tuple(r) for r in rows] == [(1.0, 1.0, None), (0.0, None, None)]


def test_column_names_with_digits_spaces_and_dots(frame):
    df = frame("`1stFlrSF` double, `CV RMSE Mean` double, `a.b` double", (1.0, 2.0, 3.0), (2.0, 4.0, None))
    assert missing.missing_summary(df).first()["column"] == "a.b"
    assert frequency.medians(df, ["1stFlrSF", "CV RMSE Mean", "a.b"]) == {"1stFlrSF": 1.5, "CV RMSE Mean": 3.0, "a.b": 3.0}
    whole = features.derive(df, [features.total("t", {"1stFlrSF": 1, "CV RMSE Mean": 0.5})])
    assert column(whole, "t") == [2.0, 4.0]


@pytest.mark.parametrize("rows", [[], [(1.0, 2.0)]])
def test_empty_and_single_row(frame, rows):
    df = frame("x double, y double", *rows)
    assert missing.missing_summary(df).collect() == []
    shape = distribution.distribution_diagnostics(df, distribution.raw_and_log("x")).collect()
    assert [r["n"] for r in shape] == [len(rows)] * 2
    assert all(r["skewness"] is None or math.isnan(r["skewness"]) for r in shape)
    assert ranks.spearman(df, ["x"], "y").first()["spearman"] is None
    assert bins.density_curve(df, "x").collect() == []
    assert frequency.medians(df, ["x"]) == {"x": 1.0 if rows else None}
    assert pair_correlations(df, [("x", "y")]).first()["r"] is None
    row = df.agg(adjusted_skewness(F.col("x")).alias("s"), adjusted_kurtosis(F.col("x")).alias("k")).first()
    assert row["s"] is None and row["k"] is None
    linear_scores = evaluate.regression_metrics(df, F.col("x"), F.col("y")).first()
    assert linear_scores["r2"] is None


def test_last_places_for_nulls(frame):
    from tablewright.operators.shaping import ordered

    df = frame("x double", (None,), (2.0,), (1.0,))
    assert column(ordered(df, "x"), "x") == [1.0, 2.0, None]
    assert column(ordered(df, "x", descending=True), "x") == [2.0, 1.0, None]
