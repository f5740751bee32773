"""Cases that once gave wrong results: many columns, large keys, quoted CSV, NaN, wide categories."""

import numpy as np
import pytest

from tablewright.operators import bins, comoments, correlation, distribution, encode, segments, split
from tablewright.sources import readers, sinks
from tablewright.storage import checkpoint_root

NAMES = [f"x{i}" for i in range(12)]
COLUMNS = ", ".join(f"{c} double" for c in NAMES)


def table(spark, values, schema=COLUMNS):
    return spark.createDataFrame([tuple(r) for r in values], schema).repartition(5)


@pytest.fixture(scope="module")
def gaps(spark):
    """Columns with gaps, one very large only where the next is missing, one constant."""
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 12))
    x[:, 1] = x[:, 0] + 0.1 * r.normal(size=1500)
    rows = [[None if r.random() < 0.15 else float(v) for v in line] for line in x]
    for line in rows[:300]:
        line[0], line[1] = 1e14 * float(r.random()), None
    for line in rows:
        line[5] = 3.3
    return rows


def test_correlations_do_not_depend_on_the_number_of_columns(spark, gaps):
    df = table(spark, gaps)
    narrow = {(r.a, r.b): r.r for r in correlation.pearson_matrix(df, NAMES[:6]).collect()}
    wide = {(r.a, r.b): r.r for r in correlation.pearson_matrix(df, NAMES).collect()}
    assert wide["x0", "x1"] > 0.99
    for pair, r in narrow.items():
        assert (r is None) == (wide[pair] is None) and (r is None or abs(r - wide[pair]) < 1e-9)
    assert wide["x5", "x0"] is None and wide["x5", "x5"] is None


def test_sums_of_folds_with_means_far_apart(spark):
    r = np.random.default_rng(4)
    fold = np.arange(900) % 3
    x = r.normal(size=(900, 12)) + fold[:, None] * 1e9
    df = table(spark, [(*map(float, v), int(f)) for v, f in zip(x, fold)], COLUMNS + ", fold int")
    sql, batches = comoments._by_sql(df, NAMES, ["fold"]), comoments._by_batches(df, NAMES, ["fold"])
    assert sql.keys() == batches.keys()
    for key in sql:
        want = np.cov(x[fold == key[0]].T, bias=True) * 300
        for found in (sql[key], batches[key]):
            assert found.n == 300 and np.allclose(found.cross, want, rtol=1e-5, atol=1e-4)


@pytest.mark.parametrize("keys", [[2**60 + i for i in range(23)], [f"key {i:03d}" for i in range(23)], [None, *range(10)], [7] * 6, []])
def test_contiguous_folds_of_any_key(spark, keys):
    kind = "string" if keys and isinstance(keys[0], str) else "long"
    df = spark.createDataFrame([(k,) for k in keys], f"k {kind}").repartition(3)
    got = {r.k: r.fold for r in split.with_contiguous_fold(df, "k").collect() if r.k is not None}
    known = sorted(k for k in keys if k is not None)
    if len(set(known)) == len(known):
        assert got == {k: f for f, part in enumerate(np.array_split(known, 5)) for k in part.tolist()}
    assert len(df.collect()) == len(keys)


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path):
    rows = [(1, 'a ""b"" "c", d'), (2, "line one\nline, two"), (3, '"'), (4, "back\\slash"), (5, "plain")]
    df = spark.createDataFrame(rows, "id long, text string")
    path = sinks.write_result(df, str(tmp_path), "texts", "csv")
    again = readers.read_csv(spark, path, df.schema, na_tokens=(), multi_line=True)
    assert sorted(map(tuple, again.collect())) == rows
    (tmp_path / "own.csv").write_text('id,text\n1,"a ""b"" c"\n2,"x, y"\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "own.csv")).collect()] == [(1, 'a "b" c'), (2, "x, y")]


def test_nan_counts_as_missing_everywhere(spark):
    values = [("a", v, float(i)) for i, v in enumerate([1.0, 2.0, float("nan"), 4.0, None, 90.0, 3.0, 2.0])]
    clean = [(g, v, x) for g, v, x in values if v is not None and v == v]
    schema = "g string, v double, x double"
    df, without = spark.createDataFrame(values, schema), spark.createDataFrame(clean, schema)
    rows = lambda d: [tuple(r) for r in d.collect()]
    drop_count = lambda d: rows(d.drop("count"))
    assert drop_count(segments.segment_stats(df, "g", "v")) == drop_count(segments.segment_stats(without, "g", "v"))
    assert rows(segments.group_mean(df, "g", "v")) == rows(segments.group_mean(without, "g", "v"))
    assert rows(segments.box_outliers(df, "g", "v")) == [("a", 90.0, 5.0)]
    assert rows(bins.trend_lines(df, ["x"], "v")) == rows(bins.trend_lines(without, ["x"], "v"))
    assert rows(bins.variance_ratios(df, ["x"], "v", 2)) == rows(bins.variance_ratios(without, ["x"], "v", 2))
    shape = lambda d: rows(distribution.distribution_diagnostics(d, distribution.raw_and_log("v")))
    assert shape(df) == shape(without)


def test_sparse_rows_for_many_levels(spark):
    levels = [f"level {i:05d}" for i in range(3000)]
    data = [(i, v) for i, v in enumerate(levels)] + [(5000 + i, "level 00007") for i in range(3000)] + [(9000 + i, None) for i in range(1500)]
    hot = encode.sparse_one_hot(spark.createDataFrame(data, "id long, c string"), "c", "hot").collect()
    assert len(hot) == len(data)
    for r in hot:
        assert r.hot.size == 3000
        assert r.hot.indices == ([] if r.c is None else [int(r.c[-5:])]) and len(r.hot["values"]) == len(r.hot.indices)


def test_scatter_holds_every_row(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    assert bins.scatter_extract(df.withColumn("y", df.k * 2), "k", ["y"]).count() == 5000


def test_the_callers_checkpoint_folder_stays(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert checkpoint_root(spark) and spark.sparkContext.getCheckpointDir() == before
