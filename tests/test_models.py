"""Co-moments, linear models, correlation matrices, trees and stacking."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions.special import correlation_p, incomplete_beta
from tablewright.operators import comoments, correlation, evaluate, linear, outliers, split, stacking, trees

N = 400


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal([2000, 5, 0], [5, 2, 1], (N, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.01 * x[:, 2] + rng.normal(0, 1, N)
    return x, y


@pytest.fixture(scope="module")
def df(spark, data):
    x, y = data
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(N)]
    return split.with_fold(spark.createDataFrame(rows, "id long, a double, b double, c double, y double"), "id").repartition(4)


def test_both_ways_agree(df, data):
    x, y = data
    names = ["x0", "x1", "x2", "x3"]
    rows = df.select(F.col("a").alias("x0"), F.col("b").alias("x1"), F.col("c").alias("x2"), F.col("y").alias("x3"), "fold")
    sql, batches = comoments._by_sql(rows, names, ["fold"]), comoments._by_batches(rows, names, ["fold"])
    assert set(sql) == set(batches)
    for k in sql:
        assert sql[k].n == batches[k].n
        assert sql[k].mean == pytest.approx(batches[k].mean, rel=1e-12)
        assert sql[k].cross == pytest.approx(batches[k].cross, rel=1e-8, abs=1e-6)
    whole = list(sql.values())[0].merged(*list(sql.values())[1:])
    z = np.column_stack([x, y])
    assert whole.cross == pytest.approx((z - z.mean(0)).T @ (z - z.mean(0)), rel=1e-9)


def test_least_squares(df, data):
    x, y = data
    model = linear.fit_linear(df, ["a", "b", "c"], "y")
    want = np.linalg.lstsq(np.column_stack([np.ones(N), x]), y, rcond=None)[0]
    assert [model.intercept, *model.weights] == pytest.approx(want, rel=1e-6)
    names = [r["feature"] for r in model.coefficients(df).collect()]
    assert names == ["a", "b", "c"]


def test_dependent_columns_still_predict(df, data):
    x, y = data
    twice = df.withColumn("d", F.col("a") - F.col("b"))
    model = linear.fit_linear(twice, ["a", "b", "c", "d"], "y")
    plain = linear.fit_linear(df, ["a", "b", "c"], "y")
    gap = twice.agg(F.max(F.abs(model.prediction() - plain.prediction())).alias("g")).first()["g"]
    assert gap < 1e-5


def test_ridge_closed_form(df, data):
    x, y = data
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc)
    assert linear.fit_linear(df, ["a", "b", "c"], "y", ("ridge", 10.0, 0.0)).weights == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("alpha,share", [(0.0005, 1.0), (0.5, 1.0), (0.5, 0.9)])
def test_penalised_solution_is_optimal(df, data, alpha, share):
    x, y = data
    w = np.array(linear.fit_linear(df, ["a", "b", "c"], "y", ("net", alpha, share)).weights)
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (xc @ w - yc) / N + alpha * (1 - share) * w
    for g, v in zip(slope, w):
        assert (abs(g) <= alpha * share + 1e-8) if v == 0 else (g + alpha * share * np.sign(v) == pytest.approx(0, abs=1e-8))


def test_cross_validation_equals_direct_fits(df, data):
    x, y = data
    folds = np.array([r["fold"] for r in df.orderBy("id").select("fold").collect()])
    got = {(r["model"], r["fold"]): r["rmse"] for r in linear.cv_linear(df, ["a", "b", "c"], "y", "fold").collect()}
    assert len(got) == 20
    for f in range(5):
        tr, te = folds != f, folds == f
        one = np.column_stack([np.ones(N), x])
        w = np.linalg.lstsq(one[tr], y[tr], rcond=None)[0]
        assert got["Linear Regression", f] == pytest.approx(np.sqrt(np.mean((y[te] - one[te] @ w) ** 2)), rel=1e-7)


def test_outlier_sensitivity(df, data):
    x, y = data
    rows = split.with_validation(df.withColumn("flag", (F.col("id") % 50 == 0).cast("int")), "id")
    got = {r["scenario"]: r for r in outliers.outlier_sensitivity(rows, "flag", ["a", "b"], "y", "is_valid").collect()}
    ids = np.arange(N)
    held = np.array([r["is_valid"] for r in rows.orderBy("id").collect()]) == 1
    for name, keep in (("with_outliers", ids >= 0), ("without_outliers", ids % 50 != 0)):
        one = np.column_stack([np.ones(N), x[:, :2]])
        w = np.linalg.lstsq(one[keep & ~held], y[keep & ~held], rcond=None)[0]
        e = y[keep & held] - one[keep & held] @ w
        assert got[name]["n_rows"] == keep.sum()
        assert (got[name]["mae"], got[name]["rmse"]) == pytest.approx((np.abs(e).mean(), np.sqrt((e**2).mean())), rel=1e-6)
        assert got[name]["r2"] == pytest.approx(1 - (e**2).sum() / ((y[keep & held] - y[keep & held].mean()) ** 2).sum(), rel=1e-6)
    assert (got["with_outliers"]["outlier_count"], got["without_outliers"]["outlier_count"]) == (8, 0)
    assert outliers.outlier_sensitivity(rows, "flag", ["a", "zz"], "y", "is_valid").collect() == []


def test_correlation_matrices_agree(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (200, 10)) + np.arange(10) * 100
    x[:, 3] = 7.0
    names = [f"c{i}" for i in range(10)]
    full = spark.createDataFrame([tuple(map(float, r)) for r in x], names).repartition(3)
    gaps = full.withColumn("c1", F.when(F.col("c0") > 0, F.col("c1")))
    few = {(r["a"], r["b"]): r["r"] for r in correlation.pearson_matrix(gaps, names[:5]).collect()}
    many = {(r["a"], r["b"]): r["r"] for r in correlation.pearson_matrix(gaps, names).collect()}
    for k, v in few.items():
        assert many[k] == (None if v is None else pytest.approx(v, rel=1e-8))
    assert many["c3", "c0"] is None and many["c3", "c3"] is None
    trees_way = {(r["a"], r["b"]): r["r"] for r in correlation.wide_pearson_matrix(full, names).collect()}
    other = {(r["a"], r["b"]): r["r"] for r in correlation.pearson_matrix(full, names).collect()}
    assert trees_way["c0", "c4"] == pytest.approx(other["c0", "c4"], rel=1e-8)
    assert trees_way["c3", "c0"] is None


@pytest.mark.parametrize("r,n", [(0.3, 20), (-0.3, 20), (0.05, 1500), (0.9, 12), (0.999, 5)])
def test_p_value_by_quadrature(r, n):
    from math import lgamma, pi

    t = np.linspace(abs(r), 1, 2_000_001)[:-1]
    density = np.exp((n - 4) / 2 * np.log1p(-t * t) + lgamma((n - 1) / 2) - lgamma((n - 2) / 2) - 0.5 * np.log(pi))
    assert correlation_p(r, n) == pytest.approx(2 * np.trapezoid(density, t), rel=1e-5)


def test_p_value_edges():
    assert correlation_p(0.0, 50) == 1.0
    assert correlation_p(1.0, 50) == 0.0
    assert correlation_p(None, 50) is None and correlation_p(0.5, 2) is None
    assert 0 < correlation_p(0.5, 3600) < 1e-220
    assert incomplete_beta(2.0, 3.0, 0.4) == pytest.approx(0.5248)


def test_trees_and_early_stop(df):
    rows = split.with_validation(df, "id")
    spec = trees.TreeSpec("boost", 5, 3, 0.3)
    stopped, final, best = trees.early_stop_then_refit(rows, ["a", "b", "c"], "y", "is_valid", spec)
    assert 1 <= best <= 5
    importance = trees.feature_importance(final, rows, ["a", "b", "c"]).collect()
    assert importance[0]["feature"] == "a"
    assert sum(r["importance"] for r in importance) == pytest.approx(100.0)
    models = {"forest": trees.TreeSpec("forest", 5, 4), "boost": spec}
    scores = trees.cv_trees(rows.withColumn("f", F.col("fold") % 2), ["a", "b", "c"], "y", "f", 2, models)
    assert sorted((r["model"], r["fold"]) for r in scores.collect()) == [("boost", 0), ("boost", 1), ("forest", 0), ("forest", 1)]


def test_stack_uses_blind_predictions(df):
    rows = df.withColumn("f", F.col("fold") % 2)
    members = {"ridge": ("ridge", 10.0, 0.0), "boost": trees.TreeSpec("boost", 3, 3, 0.5)}
    blind = stacking.out_of_fold_predictions(rows, ["a", "b", "c"], "y", "f", 2, members)
    assert blind.count() == N and {"ridge", "boost"} <= set(blind.columns)
    other = linear.fit_linear(rows.filter("f = 1"), ["a", "b", "c"], "y", members["ridge"])
    gap = blind.filter("f = 0").agg(F.max(F.abs(F.col("ridge") - other.prediction())).alias("g")).first()["g"]
    assert gap < 1e-6
    stack = stacking.fit_stack(rows, ["a", "b", "c"], "y", "f", 2, members)
    scored = stack.transform(rows)
    assert set(scored.columns) == {*rows.columns, "prediction"}
    metrics = evaluate.regression_metrics(scored, F.col("y"), F.col("prediction")).first()
    assert metrics["r2"] > 0.9


@pytest.mark.parametrize("value, text", [(0.0007, "0.0007"), (-0.00025, "-0.00025"), (12345678.0, "12345678.0"), (0.0703, "0.0703"), (0.0, "0.0"), (1e30, "1.0E30")])
def test_best_model_has_plain_numbers(spark, value, text):
    board = spark.createDataFrame([("a", 0.5, value, "g"), ("b", 0.7, 0.1, "h")], "model string, cv_rmse double, cv_std double, group string")
    found = {r["field"]: r["value"] for r in evaluate.best_model(board).collect()}
    assert found == {"model": "a", "cv_rmse": "0.5", "cv_std": text if value != 1e30 else found["cv_std"], "group": "g"}
    assert value != 1e30 or float(found["cv_std"]) == value


def test_fits_at_once_follow_memory_and_give_the_same(df, monkeypatch):
    names, forest, boost = ["a", "b", "c"], trees.TreeSpec("forest", 6, 2), trees.TreeSpec("boost", 2, 2, 0.5)
    assert trees.storage_bytes(df.sparkSession) > 0
    assert trees.fits_at_once(df, [forest]) == trees.PARALLEL_FITS
    several = sorted(map(tuple, trees.cv_trees(df, names, "y", "fold", 5, {"f": forest}).collect()))
    for storage, fits in ((N * 164 * 2 * 3, 3), (1, 1)):
        monkeypatch.setattr(trees, "storage_bytes", lambda session: storage)
        assert trees.fits_at_once(df, [boost, ("ridge", 1.0, 0.0)]) == fits
        assert trees.fits_at_once(df, [trees.TreeSpec("forest", 300, 6)]) == 1
    running, most = [0], [0]

    def counted(*args, plain=trees.fit_trees, **rest):
        running[0] += 1
        most[0] = max(most[0], running[0])
        try:
            return plain(*args, **rest)
        finally:
            running[0] -= 1

    monkeypatch.setattr(trees, "fit_trees", counted)
    assert sorted(map(tuple, trees.cv_trees(df, names, "y", "fold", 5, {"f": forest}).collect())) == several
    monkeypatch.setattr(stacking, "fit_trees", counted)
    rows = split.with_fold(df, "id", 2, seed=7, name="inner")
    assert stacking.cv_stack(rows, names, "y", "fold", 2, "inner", 2, {"boosted": boost, "ridge": stacking.RIDGE}).count() == 2
    assert most == [1]


def test_many_rows_are_fitted_side_by_side_as_mllib_fits_them(spark, monkeypatch):
    r = np.random.default_rng(9)
    x = np.column_stack([r.integers(0, 20, 900), r.integers(0, 12, 900), r.integers(0, 3, 900)]).astype(float)
    y = x[:, 0] * 1.7 - (x[:, 1] > 5) * x[:, 0] + x[:, 2] ** 2 + r.normal(0, 0.5, 900)
    df = spark.createDataFrame([(*map(float, x[i]), float(y[i]), i % 2, i // 2 % 2) for i in range(900)], "a double, b double, c double, y double, fold long, inner int").coalesce(1)
    names, boosted = ["a", "b", "c"], {"wide": trees.TreeSpec("boost", 2, 3, 0.3), "shallow": trees.TreeSpec("boost", 4, 2, 0.5)}
    models = boosted | {"forest": trees.TreeSpec("forest", 30, 4)}
    cv = lambda: {(r["model"], r["fold"]): r["rmse"] for r in trees.cv_trees(df, names, "y", "fold", 2, models).collect()}
    stack = lambda: {r["fold"]: r["rmse"] for r in stacking.cv_stack(df, names, "y", "fold", 2, "inner", 2, boosted | {"ridge": stacking.RIDGE}).collect()}
    want, stacked = cv(), stack()
    monkeypatch.setattr(trees, "MLLIB_ROWS", 899)
    for module in (trees, stacking):
        monkeypatch.setattr(module, "fit_trees", None)  # not one model is fitted on its own
    got = cv()
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=0.35 if k[0] == "forest" else 1e-9)  # a forest's bags and features are drawn in another way
    assert trees.cv_trees(df, names, "y", "fold", 2, boosted).schema["fold"].dataType.simpleString() == "bigint"
    assert stack() == pytest.approx(stacked, rel=1e-6)
