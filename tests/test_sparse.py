"""The sparse encoder, its linear model, ordered target statistics and linear stacks against NumPy and plain loops."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import encode, histograms, sparse, split, stacking
from tablewright.operators.catalog import Catalog
from tablewright.operators.linear import solve
from tablewright.operators.comoments import CoMoments

CATALOG = Catalog(
    roles={"numeric continuous": ["x"], "ordinal": ["o"], "nominal": ["k", "m"], "binary": ["b"]},
    ordinal_levels={"o": ["low", "mid", "high"]},
    binary_maps={"b": {"yes": 1, "no": 0}},
)


def rows(n=300, seed=2):
    r = random.Random(seed)
    return [
        (i, r.choice([None, 1.0, 2.5, 4.0]), r.choice(["low", "mid", "high", "?"]), r.choice([None, "hot", f"k{i}", f"k{i % 40}"]), r.choice("uvw"), r.choice(["yes", "no"]), r.random() * 9)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "id long, x double, o string, k string, m string, b string, y double")


def dense(matrix):
    out = np.zeros((len(matrix), matrix[0].row.size))
    for i, r in enumerate(matrix):
        out[i, r.row.indices] = r.row["values"]
    return out


def test_rows_of_the_matrix(df):
    train = df.where("id < 200")
    fitted = sparse.fit_sparse_encoder(train, CATALOG)
    names = {r.place: r.name for r in fitted.names().collect()}
    ks, ms = (sorted({r[i] for r in rows()[:200] if r[i] is not None}) for i in (3, 4))
    assert [names[i] for i in range(fitted.size)] == ["x", "o", "b", *[f"k_{v}" for v in ks], *[f"m_{v}" for v in ms]]
    xs = np.array([r[1] for r in rows()[:200] if r[1] is not None])
    matrix = sparse.sparse_encode(df, fitted, ["id"]).orderBy("id").collect()
    assert len(matrix) == 300
    for r, got in zip(rows(), matrix):
        want = {}
        if r[1] is not None and r[1] != xs.mean():
            want[0] = (r[1] - xs.mean()) / xs.std()
        if (o := {"low": 0, "mid": 1, "high": 2}.get(r[2], -1)):
            want[1] = o
        if r[5] == "yes":
            want[2] = 1
        if r[3] in ks:
            want[3 + ks.index(r[3])] = 1
        want[3 + len(ks) + ms.index(r[4])] = 1
        assert dict(zip(got.row.indices, got.row["values"])) == pytest.approx(want) and got.row.size == fitted.size


def test_sparse_ridge_equals_the_dense_solution(df):
    fitted = sparse.fit_sparse_encoder(df, CATALOG)
    encoded = sparse.sparse_encode(df, fitted, ["id", "y"])
    model = sparse.fit_sparse_ridge(encoded, "row", "y", alpha=3.0)
    local = encoded.orderBy("id").collect()
    x, y = dense(local), np.array([r.y for r in local])
    z = np.column_stack([x, y])
    w, b = solve(("ridge", 3.0, 0.0), CoMoments(len(y), z.mean(0), (z - z.mean(0)).T @ (z - z.mean(0))))
    assert model.weights == pytest.approx(w, rel=1e-6, abs=1e-9) and model.intercept == pytest.approx(b, rel=1e-8)
    got = [r.p for r in encoded.select("id", model.prediction().alias("p")).orderBy("id").collect()]
    assert got == pytest.approx(list(x @ w + b), rel=1e-6)


def test_a_hundred_thousand_levels(spark):
    """More levels than any literal list or dense row could hold."""
    many = spark.range(120_000).select(F.col("id"), F.when(F.col("id") < 100_000, F.concat(F.lit("k"), "id")).otherwise("k7").alias("k"), (F.col("id") % 10).cast("double").alias("y"))
    only = Catalog(roles={"nominal": ["k"]})
    fitted = sparse.fit_sparse_encoder(many, only)
    encoded = sparse.sparse_encode(many, fitted, ["y"])
    assert fitted.size == 100_000
    assert encoded.agg(F.count_if(F.size("row.indices") == 1)).first()[0] == 120_000
    model = sparse.fit_sparse_ridge(encoded, "row", "y", alpha=1.0)
    assert len(model.weights) == 100_000 and np.count_nonzero(model.weights) > 80_000 and model.steps < 60


@pytest.mark.parametrize("seed", [None, 5])
def test_ordered_target_statistics(spark, seed):
    r = random.Random(4)
    data = [(i, "hot" if i % 2 else r.choice([None, "a", "b", f"l{i}"]), None if i % 9 == 0 else r.random()) for i in range(400)]
    df = spark.createDataFrame(data, "id long, level string, y double").repartition(5)
    got = {r.id: r.e for r in encode.ordered_target_encode(df, "level", "y", "id", "e", 2.0, seed).collect()}
    mean = np.mean([y for *_, y in data if y is not None])
    text = lambda i: str(i) if seed is None else f"{seed}:{i}"
    order = sorted(data, key=lambda x: (int(hashlib.md5(text(x[0]).encode()).hexdigest()[:8], 16), x[0]))
    seen, want = {}, {}
    for i, level, y in order:
        s, n = seen.get(level, (0.0, 0))
        want[i] = mean if level is None else (s + 2.0 * mean) / (n + 2.0)
        if y is not None:
            seen[level] = (s + y, n + 1)
    assert got == pytest.approx(want)
    nothing = df.withColumn("y", F.lit(None).cast("double"))
    assert {r.e for r in encode.ordered_target_encode(nothing, "level", "y", "id", "e").collect()} == {None}


def test_linear_stack_equals_fits_on_rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.5] + r.normal(size=300)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(300)], "id long, a double, b double, c double, y double")
    df = split.with_fold(df, "id", 3)
    fold = np.array([r.fold for r in df.orderBy("id").collect()])

    def fit(spec, z, t):
        both = np.column_stack([z, t])
        d = both - both.mean(0)
        return solve(spec, CoMoments(len(t), both.mean(0), d.T @ d))

    specs = list(stacking.LINEAR_MEMBERS.values())
    blind = np.zeros((300, len(specs)))
    for f in range(3):
        for k, spec in enumerate(specs):
            w, b = fit(spec, x[fold != f], y[fold != f])
            blind[fold == f, k] = x[fold == f] @ w + b
    v, c = fit(stacking.RIDGE, blind, y)
    members = [fit(s, x, y) for s in specs]
    want = sum(vk * (x @ w + b) for vk, (w, b) in zip(v, members)) + c
    model = stacking.fit_stack_linear(df, ["a", "b", "c"], "y", "fold")
    got = [r.p for r in df.select("id", model.prediction().alias("p")).orderBy("id").collect()]
    assert got == pytest.approx(list(want), rel=1e-8)


def test_stack_of_boosters_equals_fits_one_by_one(spark):
    r = random.Random(6)
    data = [(i, float(r.randrange(8)), float(r.randrange(5)), r.random()) for i in range(240)]
    data = [(i, a, b, a * 0.7 - (b > 2) * a + e, i % 3, (i // 3) % 2) for i, a, b, e in data]
    df = spark.createDataFrame(data, "id long, a double, b double, y double, o int, g int")
    spec = histograms.Boosting(3, 0.5, histograms.Growth(2, l2=1.0))
    got = {x.fold: x.rmse for x in stacking.cv_stack_boosted(df, ["a", "b"], "y", "id", "o", 3, "g", 2, {"b": spec}).collect()}

    def said(where, rows):
        """A ridge and a booster fitted where told, on rows."""
        seen = [d for d in data if where(d)]
        z = np.array([[d[1], d[2], d[3]] for d in seen])
        w, b = solve(("ridge", 10.0, 0.0), CoMoments(len(z), z.mean(0), (z - z.mean(0)).T @ (z - z.mean(0))))
        train = spark.createDataFrame(seen, df.schema)
        model = histograms.boost(train, ["a", "b"], "y", "id", {"m": (spec, histograms.Rows())})["m"]
        scored = {x.id: x.p for x in df.select("id", model.prediction().alias("p")).collect()}
        return {d[0]: (d[1] * w[0] + d[2] * w[1] + b, scored[d[0]]) for d in rows}

    for f in range(3):
        blind = {}
        for g in range(2):
            blind |= said(lambda d: d[4] != f and d[5] != g, [d for d in data if d[4] != f and d[5] == g])
        z = np.array([[*blind[d[0]], d[3]] for d in data if d[4] != f])
        w, b = solve(stacking.RIDGE, CoMoments(len(z), z.mean(0), (z - z.mean(0)).T @ (z - z.mean(0))))
        held = said(lambda d: d[4] != f, [d for d in data if d[4] == f])
        errors = [np.dot(held[d[0]], w) + b - d[3] for d in data if d[4] == f]
        assert got[f] == pytest.approx(float(np.sqrt(np.mean(np.square(errors)))), rel=1e-6)
