"""Boosting and forests from histograms against plain loops over rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import histograms
from tablewright.operators.histograms import Boosting, Growth, Rows

FEATURES = ["a", "b", "c"]


def table(n=400, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = r.randrange(6), r.randrange(4) / 2, r.choice([-1.5, 0.0, 2.0, 7.0])
        y = a * 1.3 - (b > 0.5) * c + r.random()
        rows.append((i, a, b, c, y, int(i % 5 == 0)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return table()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, a int, b double, c double, y double, held int").repartition(7)


def best_split(rows, rest, weight, l2, least):
    """Gain, feature and threshold over rows given by number."""
    n, s = sum(weight[i] for i in rest), sum(weight[i] * rest[i] for i in rest)
    out = []
    for f in range(3):
        values = sorted({rows[i][1 + f] for i in rest})
        for v in values[:-1]:
            left = [i for i in rest if rows[i][1 + f] <= v]
            ln, ls = sum(weight[i] for i in left), sum(weight[i] * rest[i] for i in left)
            if ln >= least and n - ln >= least:
                out.append((ls * ls / (ln + l2) + (s - ls) ** 2 / (n - ln + l2) - s * s / (n + l2), f, v))
    return max(out, key=lambda x: (round(x[0], 9), -x[1], -x[2]), default=None)


def plain_tree(rows, rest, weight, growth, step):
    """A list of leaves: conditions on a row, and the value."""
    leaves = [((), rest, 0)]
    if growth.leaves:
        while len(leaves) < growth.leaves:
            found = [(best_split(rows, r, weight, growth.l2, growth.least_rows), k) for k, (_, r, d) in enumerate(leaves) if d < growth.depth and r]
            found = [(s, k) for s, k in found if s and s[0] > 1e-9]
            if not found:
                break
            (_, f, v), k = max(found, key=lambda x: x[0][0])
            conditions, r, d = leaves.pop(k)
            leaves += [(conditions + ((f, v, side),), {i: x for i, x in r.items() if (rows[i][1 + f] <= v) == side}, d + 1) for side in (True, False)]
    else:
        for _ in range(growth.depth):
            new = []
            for conditions, r, d in leaves:
                split = best_split(rows, r, weight, growth.l2, growth.least_rows) if r else None
                if split and split[0] > 1e-9:
                    _, f, v = split
                    new += [(conditions + ((f, v, side),), {i: x for i, x in r.items() if (rows[i][1 + f] <= v) == side}, d + 1) for side in (True, False)]
                else:
                    new.append((conditions, r, d))
            leaves = new
    value = lambda r: step * sum(weight[i] * x for i, x in r.items()) / (sum(weight[i] for i in r) + growth.l2) if r else 0.0
    return [(conditions, value(r)) for conditions, r, _ in leaves]


def apply(tree, row):
    return next(value for conditions, value in tree if all((row[1 + f] <= v) == side for f, v, side in conditions))


def plain_boost(rows, spec):
    seen = [r[0] for r in rows if not r[5]]
    start = sum(rows[i][4] for i in seen) / len(seen)
    score, errors = {r[0]: start for r in rows}, []
    for _ in range(spec.rounds + 1):
        held = [(r[4] - score[r[0]]) ** 2 for r in rows if r[5]]
        errors.append(math.sqrt(sum(held) / len(held)))
        if len(errors) <= spec.rounds:
            rest = {i: rows[i][4] - score[i] for i in seen}
            tree = plain_tree(rows, rest, dict.fromkeys(seen, 1.0), spec.growth, spec.step)
            for r in rows:
                score[r[0]] += apply(tree, r)
    return score, errors


GROWTHS = {"levels": Growth(3, l2=1.0), "leaves": Growth(12, leaves=5, least_rows=10), "few rows": Growth(4, least_rows=40)}


@pytest.mark.parametrize("kind", GROWTHS)
@pytest.mark.parametrize("merged", [False, True])
def test_boosting_equals_plain_loops(df, rows, kind, merged, monkeypatch):
    monkeypatch.setattr(histograms, "CUT", 3)
    if merged:
        monkeypatch.setattr(histograms, "DIRECT_TASKS", 0)
    spec = Boosting(7, 0.3, GROWTHS[kind])
    model = histograms.boost(df, FEATURES, "y", "id", {"m": (spec, Rows((("held", 1),)))}, ["held"])["m"]
    score, errors = plain_boost(rows, spec)
    assert model.errors == pytest.approx(errors, rel=1e-9)
    got = {r.id: r.p for r in df.select("id", model.prediction().alias("p")).collect()}
    assert got == pytest.approx(score, rel=1e-9)


def test_symmetric_trees_split_a_whole_level_once(df):
    spec = Boosting(5, 0.3, Growth(3, symmetric=True, l2=3.0))
    model = histograms.boost(df, FEATURES, "y", "id", {"m": (spec, Rows((("held", 1),)))}, ["held"])["m"]
    for tree in model.trees:
        level = [0]
        while level:
            assert len({(tree.feature[n], tree.cut[n]) for n in level}) == 1
            level = [m for n in level if tree.feature[n] >= 0 for m in (tree.left[n], tree.left[n] + 1)]
    assert model.errors[-1] < 0.6 * model.errors[0]


def test_jobs_side_by_side_do_not_touch_each_other(df):
    jobs = {f"{k}{h}": (Boosting(4, 0.4, g), Rows((("held", h),))) for k, g in GROWTHS.items() for h in (0, 1)}
    together = histograms.boost(df, FEATURES, "y", "id", jobs, ["held"])
    for name, job in jobs.items():
        alone = histograms.boost(df, FEATURES, "y", "id", {name: job}, ["held"])[name]
        assert alone.errors == pytest.approx(together[name].errors, rel=1e-12)
        assert [t.feature for t in alone.trees] == [t.feature for t in together[name].trees]


def test_patience_keeps_the_best_round(df):
    noise = df.withColumn("y", F.rand(3) + F.col("a") * 0.05)
    spec = Boosting(60, 0.9, Growth(4), patience=3)
    model = histograms.boost(noise, FEATURES, "y", "id", {"m": (spec, Rows((("held", 1),)))}, ["held"])["m"]
    best = model.errors.index(min(model.errors))
    assert model.best == best == len(model.trees) and len(model.errors) == best + 1 + 3 < 60
    curve = histograms.error_curve(model, df).collect()
    assert [r["round"] for r in curve if r.is_best] == [best]


def test_stopped_then_refit_uses_all_rows(df):
    spec = Boosting(30, 0.5, Growth(2), patience=2)
    stopped, final = histograms.stopped_then_refit(df, FEATURES, "y", "id", "held", spec)
    assert len(final.trees) == max(1, stopped.best)
    assert final.start == pytest.approx(df.agg(F.avg("y")).first()[0])


def test_forest_equals_plain_loops(df, rows):
    growth, trees = Growth(3), 4
    model = histograms.forest(df, FEATURES, "y", "id", trees, growth)["forest"]
    total = dict.fromkeys(range(len(rows)), 0.0)
    for t in range(trees):
        factor = pow(48271, t + 1, 2**31 - 1)
        weight = {}
        for i in range(len(rows)):
            h = int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % (2**31 - 1)
            u, k, p, below = (h * factor % (2**31 - 1)) / (2**31 - 1), 0, math.exp(-1), math.exp(-1)
            while u >= below:
                k += 1
                p /= k
                below += p
            weight[i] = float(k)
        rest = {r[0]: r[4] for r in rows if weight[r[0]]}
        tree = plain_tree(rows, rest, weight, growth, 1.0)
        for r in rows:
            total[r[0]] += apply(tree, r) / trees
    got = {r.id: r.p for r in df.select("id", model.prediction().alias("p")).collect()}
    assert got == pytest.approx(total, rel=1e-9)


def test_cross_validation(df):
    scores = histograms.cv_boosting(df, FEATURES, "y", "id", "held", 2, {k: Boosting(5, 0.5, g) for k, g in GROWTHS.items()}).collect()
    assert sorted((r.model, r.fold) for r in scores) == sorted((k, f) for k in GROWTHS for f in (0, 1))
    forest = histograms.cv_forest(df, FEATURES, "y", "id", "held", 2, 6, Growth(4)).collect()
    assert sorted(r.fold for r in forest) == [0, 1] and all(r.rmse < 1.5 for r in forest)


def test_gaps_ties_and_constants(spark):
    rows = [(i, 1.0, float(i % 2) if i % 7 else None, None if i == 3 else 5.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, x double, z double, y double")
    model = histograms.boost(df, ["x", "z"], "y", "id", {"m": (Boosting(2, 0.5, Growth(2)), Rows())})["m"]
    assert model.start == 5.0 and all(t.feature == [-1] for t in model.trees) and model.errors == []
    got = {r.id: r.p for r in df.select("id", model.prediction().alias("p")).collect()}
    assert all((p is None) == (i % 7 == 0) for i, p in got.items())
    assert model.importance(df).count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, x double, y double")
    model = histograms.boost(df, ["x"], "y", "id", {"m": (Boosting(2, 0.5, Growth(2)), Rows())})["m"]
    assert (model.start, len(model.trees)) == (0.0, 2)


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(20_000).withColumn("x", F.col("id") * 0.5).withColumn("y", (F.col("x") > 5000).cast("double"))
    (cuts,) = histograms.cut_points(df, ["x"], 16)
    assert len(cuts) == 15
    model = histograms.boost(df, ["x"], "y", "id", {"m": (Boosting(1, 1.0, Growth(1)), Rows())}, bins=16)["m"]
    assert model.cuts[0][model.trees[0].cut[0]] == pytest.approx(5000, abs=20)


def test_scans_read_blocks_of_rows(spark):
    n = 50_000
    df = spark.range(n).select("id", (F.col("id") % 9).cast("double").alias("x"), F.col("id").cast("double").alias("y"), (F.col("id") % 3).cast("int").alias("held"))
    rows = histograms.binned(df, ["x"], "y", "id", ["held"], histograms.cut_points(df, ["x"]))
    blocks = histograms.dealt_out(rows, n, 1).select("n", F.length("bins").alias("b"), F.length("y").alias("y")).collect()
    assert len(blocks) <= 5 and sum(r.n for r in blocks) == n
    assert all((r.b, r.y) == (r.n, 8 * r.n) for r in blocks)


def test_fast_bags_and_leaves_equal_plain_ones():
    r = random.Random(5)
    h = np.array([0, 1, 2**31 - 2, *[r.randrange(2**31 - 1) for _ in range(2000)]])
    for tree in (0, 7, 299):
        u = (h * pow(48271, tree + 1, 2**31 - 1) % (2**31 - 1)) / (2**31 - 1)
        assert histograms.bag_weights(h, tree).tolist() == np.searchsorted(histograms.BAG_SHARES, u, "right").tolist()
    tree, leaves = histograms.Tree(), [0]
    for _ in range(300):  # more nodes than a byte counts
        node = leaves.pop(r.randrange(len(leaves)))
        left = tree.split(node, r.randrange(3), r.randrange(60))
        leaves += [left, left + 1]
    bins = np.array([[r.randrange(64) for _ in range(500)] for _ in range(3)], np.uint8)
    for row, got in enumerate(tree.leaf_of(bins).tolist()):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] + int(bins[tree.feature[node], row] > tree.cut[node])
        assert got == node


def random_tree(r, splits, widths):
    tree, leaves = histograms.Tree(), [0]
    for k in range(splits):
        node, f = leaves.pop(r.randrange(len(leaves))), r.randrange(len(widths))
        left = tree.split(node, f, r.randrange(max(1, widths[f] - 1)))
        leaves += [left, left + 1]
        tree.depth = k + 1
    tree.value = [r.random() for _ in tree.feature]
    return tree


@pytest.mark.parametrize("widths", [[3, 64, 5], [64], [1, 2, 64, 60]])
def test_leaves_by_table_equal_splits_one_by_one(widths):
    r = random.Random(len(widths))
    bins = np.array([[r.randrange(w) for _ in range(700)] for w in widths], np.uint8)
    lines = histograms.Lines(bins, widths)
    for splits in (0, 1, 4, 7, 8, 31, 32, 63, 64, 200):
        tree = random_tree(r, splits, widths)
        route = tree.route(widths)
        assert bool(route.tables) == (4 <= splits < 64)
        assert route.predict(lines).tolist() == np.array(tree.value).take(tree.leaf_of(bins)).tolist()


def test_tasks_hold_few_blocks_of_many_models(spark, monkeypatch):
    """Neither a block nor a row group of the table grows with the number of models."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(histograms, "CUT", 1)
    for name, value in (("BLOCK_BYTES", 2**19), ("GROUP_BYTES", 2**20)):
        monkeypatch.setattr(histograms, name, value)
    tables, plain = [], histograms.stage

    def staged(df, *args, **how):
        tables.append(plain(df, *args, **how))
        return tables[-1]

    sizes = []

    def discarded(table):
        files = [f.removeprefix("file://") for f in tables[-1].inputFiles()]
        for meta in (pq.read_metadata(f) for f in files):
            sizes.extend(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups))

    monkeypatch.setattr(histograms, "stage", staged)
    monkeypatch.setattr(histograms, "discard", discarded)
    df = spark.range(20_000).select("id", (F.col("id") % 9).alias("x"), F.hash("id").cast("double").alias("y")).coalesce(1)
    jobs = {str(i): (Boosting(2, 0.5, Growth(1)), Rows()) for i in range(40)}
    models = histograms.boost(df, ["x"], "y", "id", jobs)
    assert len({m.trees[1].value[1] for m in models.values()}) == 1
    assert sum(sizes) > 40 * 8 * 20_000 and max(sizes) < 2**20 + 2**19


def test_rows_are_predicted_by_the_model_of_their_fold_alone(df):
    models = histograms.forest(df, FEATURES, "y", "id", 3, Growth(3), {str(f): Rows((("held", f),)) for f in (0, 1)}, ["held"])
    said = df.select("held", *[m.prediction().alias(f"p{f}") for f, m in models.items()], histograms.blind_prediction({int(f): m for f, m in models.items() if f == "1"}, F.col("held")).alias("p"))
    for r in said.collect():
        assert r.p == (r.p1 if r.held == 1 else None)
