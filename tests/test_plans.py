"""Physical plans: one scan where one is enough, pruned columns, no pair joins; and the registry itself."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, compare
from tablewright.operators import bins, correlation, distribution, evaluate, linear, missing, outliers, segments, split
from tablewright.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    rows = spark.range(2000)
    rows.selectExpr(
        "id", "id % 7 AS g", "cast(id % 100 AS double) AS x", "cast(id * 3 % 101 AS double) AS y", "rand(1) AS z", "'t' AS unused"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_statistics_of_many_columns_take_one_scan(wide):
    for df in (
        missing.missing_summary(wide),
        distribution.distribution_diagnostics(wide, distribution.raw_and_log("x")),
        correlation.pair_correlations(wide, [("x", "y"), ("x", "z"), ("y", "z")]),
        bins.trend_lines(wide, ["x", "z"], "y"),
        evaluate.regression_metrics(wide, F.col("x"), F.col("y")),
    ):
        assert plan_of(df).count("FileScan") == 1


def test_columns_not_asked_for_are_not_read(wide):
    for df in (
        segments.segment_stats(wide, "g", "x"),
        bins.histogram(wide, "x"),
        correlation.mutual_information(wide, ["x", "z"], "y"),
        evaluate.residual_table(split.with_validation(wide, "id").filter("is_valid = 1"), "id", "y", F.lit(2.0) * F.col("x")),
    ):
        assert "unused" not in plan_of(df)


def test_all_folds_and_models_share_one_scan(spark, wide):
    rows = split.with_fold(wide, "id")
    group = f"one-scan-{id(rows)}"
    spark.sparkContext.setJobGroup(group, "cross-validation")
    linear.cv_linear(rows, ["x", "z"], "y", "fold")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("other", "")
    assert 1 <= len(jobs) <= 3  # the stages of one aggregate, started one by one by adaptive execution


def test_filters_reach_the_scan(wide):
    kept = split.with_validation(wide, "id").filter((F.col("g") == 3) & (F.col("x") > 10))
    plan = plan_of(kept.select("id", "is_valid"))
    assert "EqualTo(g,3)" in plan and "GreaterThan(x,10.0)" in plan


def test_outliers_of_groups_join_by_broadcast(wide):
    assert "BroadcastHashJoin" in plan_of(segments.box_outliers(wide, "g", "x"))
    flagged = outliers.flag_outliers(wide, outliers.SizePriceRule("x", "y", 50, 50))
    assert "Join" not in plan_of(outliers.remove_outliers(flagged))


NO_PAIRS = [
    "impute_test_scope", "segment_stats", "boxplot_stats", "qq_points", "density_curve", "spearman_ranking", "target_encoded",
    "mutual_information", "level_drift", "label_encoded_large", "range_folds", "residual_by_price_segment", "na_semantics",
]


@needs_tables
@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_query_pairs_all_rows(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


COMPARED = [
    "missing_summary", "impute_median_mode", "segment_stats", "price_segments", "boxplot_outliers", "histogram50",
    "spearman_ranking", "pearson_p_values", "mutual_information", "encoded_profile", "target_encoded", "cv_linear", "best_model",
]


@needs_tables
@pytest.mark.parametrize("name", COMPARED)
def test_same_result_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    text, _, equal = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert equal, text


@needs_tables
def test_profile_of_all_encoded_columns(spark):
    """Each encoded column has a row, and all rows are those of the SQL form."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    name = "encoded_profile_all"
    text, _, equal = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert equal, text
    stages = [r.stage for r in entry.queries()[name](spark, FOLDER).collect()]
    sizes = {r.stage: r.n_features for r in entry.queries()["encoded_dimension"](spark, FOLDER).collect()}
    assert {s: stages.count(s) for s in sizes} == sizes


def test_registry_is_complete():
    queries, oracles = entry.queries(), entry.oracle_sql()
    without = set(REGISTRY) - set(oracles)
    assert set(REGISTRY) <= set(queries)
    assert without == {"boosting_long", "boosting_flavours", "forest_cv", "stacking_boosted", "rf_cv", "gbt_cv", "gbt_early_stop", "feature_importance", "scored_output", "stacking", "leaderboard_all"}
    assert set(oracles) <= set(queries)


def test_ranks_shuffle_distinct_pairs_only(spark):
    """Two columns of few values: however many rows there are, what is ranked is a row per pair of values."""
    from tablewright.operators import ranks

    df = spark.range(50_000).selectExpr("cast(id % 7 as double) x", "cast(id % 5 as double) y", "cast(id % 3 as double) z")
    pairs = ranks.ranked_pairs(df, ["x", "z"], "y")
    assert pairs.count() == 7 * 5 + 3 * 5 and pairs.agg({"n": "sum"}).first()[0] == 100_000


@needs_tables
def test_keys_times_two_to_the_fortieth_may_pass_64_bits(spark, tmp_path):
    con = duckdb.connect()
    shifted = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    for t in ("customer", "nation", "orders", "lineitem"):
        columns = f"* REPLACE ({shifted[t]} + 8999000 AS {shifted[t]})" if t in shifted else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{FOLDER}/{t}.parquet') TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    name = "range_folds_keys"
    text, _, ok = compare(spark, con, str(tmp_path), name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, text
