"""Quantiles, ranks and folds against NumPy and pandas, with ties, gaps and hot values."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.operators import bins, frequency, ranks, segments, split


def table(seed=1, n=3000):
    rng = np.random.default_rng(seed)
    x = np.round(rng.lognormal(3, 1, n), 1)
    x[rng.random(n) < 0.35] = 7.5  # a third of all rows share one value
    y = np.round(x * rng.normal(1, 0.4, n) + rng.normal(0, 5, n), 0)
    g = np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n))
    df = pd.DataFrame({"id": np.arange(n), "g": g, "x": x, "y": y})
    df.loc[rng.random(n) < 0.05, "x"] = np.nan
    df.loc[rng.random(n) < 0.05, "y"] = np.nan
    return df


@pytest.fixture(scope="module")
def pdf():
    return table()


@pytest.mark.parametrize("partitions", [1, 7])
def test_quantiles_by_group(spark, pdf, partitions):
    probs = {"a": 0.0, "b": 0.1, "c": 1 / 3, "d": 0.5, "e": 0.999, "f": 1.0}
    df = spark.createDataFrame(pdf).repartition(partitions)
    for r in frequency.quantiles(df, ["x", "y"], probs, ["g"]).collect():
        values = pdf.loc[pdf["g"] == r["g"], r["feature"]].dropna()
        assert r["rows"] == len(values)
        assert [r[k] for k in probs] == pytest.approx(np.quantile(values, list(probs.values())), rel=1e-12)


@pytest.mark.parametrize("points", [3, 99, 500])
def test_many_quantiles(spark, pdf, points):
    got = sorted(tuple(r) for r in frequency.even_quantiles(spark.createDataFrame(pdf[["x"]]), "x", points).collect())
    probs = (np.arange(points) + 0.5) / points
    assert [p for p, _, _ in got] == list(range(points))
    assert [v for _, _, v in got] == pytest.approx(np.quantile(pdf["x"].dropna(), probs), rel=1e-12)


def test_few_rows_many_points(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    got = sorted(tuple(r) for r in frequency.even_quantiles(df, "x", 10).collect())
    assert [v for _, _, v in got] == pytest.approx(np.quantile([1.0, 2.0], (np.arange(10) + 0.5) / 10))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=30), st.floats(0, 1))
def test_any_quantile(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert frequency.quantile_values(df, "x", [p])[0] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_range_cut_points_do_not_change_results(spark, pdf):
    df = spark.createDataFrame(pdf)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in ("1", "8", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(frequency.medians(df, ["x", "y"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def test_segment_and_box_statistics(spark, pdf):
    df = spark.createDataFrame(pdf)
    got = {r["g"]: r for r in segments.segment_stats(df, "g", "x").collect()}
    box = {r["g"]: r for r in segments.box_stats(df, "g", "x").collect()}
    outside = segments.box_outliers(df, "g", "x").toPandas()
    for g, part in pdf.groupby("g"):
        x = part["x"].dropna()
        q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (got[g]["count"], got[g]["median"], got[g]["iqr"]) == (len(part), pytest.approx(med), pytest.approx(q3 - q1))
        assert got[g]["std"] == pytest.approx(x.std())
        inside = x[(x >= low) & (x <= high)]
        assert (box[g]["whisker_low"], box[g]["whisker_high"]) == (inside.min(), inside.max())
        assert box[g]["n_outliers"] == len(x) - len(inside) == (outside["g"] == g).sum()


def test_spearman_with_ties_gaps_and_hot_values(spark, pdf):
    pdf = pdf.assign(z=(pdf["y"] > 10).astype(float), w=-pdf["y"])
    df = spark.createDataFrame(pdf).repartition(5)
    got = {r["feature"]: (r["n"], r["spearman"]) for r in ranks.spearman(df, ["x", "z", "w"], "y").collect()}
    for c in ("x", "z", "w"):
        both = pdf[[c, "y"]].dropna()
        want = both[c].rank().corr(both["y"].rank())
        assert got[c] == (len(both), pytest.approx(want, rel=1e-10))


def test_every_row_gets_its_rank(spark, pdf):
    both = pdf[["x", "y"]].dropna()
    got = ranks.rank_pairs(spark.createDataFrame(pdf), ["x"], "y").toPandas()
    want = both.assign(rx=both["x"].rank(), ry=both["y"].rank())
    order = ["x", "y", "rx", "ry"]
    assert got[order].sort_values(order).to_numpy() == pytest.approx(want[order].sort_values(order).to_numpy())


@pytest.mark.parametrize("n,folds", [(10, 5), (13, 5), (3, 2)])
def test_contiguous_folds(spark, n, folds):
    df = spark.range(n).repartition(3)
    got = [r["fold"] for r in split.with_contiguous_fold(df, "id", folds).orderBy("id").collect()]
    assert got == [i for i, part in enumerate(np.array_split(np.arange(n), folds)) for _ in part]


def test_hash_splits_ignore_partitioning(spark):
    df = spark.range(500)
    a = {tuple(r) for r in split.with_fold(split.with_validation(df, "id"), "id").collect()}
    b = {tuple(r) for r in split.with_fold(split.with_validation(df.repartition(9), "id"), "id").collect()}
    assert a == b
    assert {f for _, _, f in a} == set(range(5))
    other = {tuple(r) for r in split.with_validation(df, "id", seed=42).collect()}
    assert 50 < sum(v for _, v in other) < 150


def test_bins_partition_the_rows(spark, pdf):
    df = spark.createDataFrame(pdf[["x"]])
    got = bins.with_quantile_bin(df, "x", bins.even_shares(4)).toPandas()
    want = pd.qcut(pdf["x"], 4, labels=False, duplicates="drop")
    merged = got.dropna().groupby("x")["bin"].first()
    expected = pd.DataFrame({"x": pdf["x"], "bin": want}).dropna().groupby("x")["bin"].first()
    assert merged.astype(int).to_dict() == expected.astype(int).to_dict()
