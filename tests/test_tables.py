"""Missing values, catalogue, encoding, sources, sinks, leaderboards and whole jobs."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import bins, catalog, encode, evaluate, features, missing, outliers, segments, shaping, trees
from tablewright.operators.missing import ImputePlan
from tablewright.plans import house, report, workflows
from tablewright.sources import readers, sinks, store
from tablewright.storage import pin_small, stage


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---------------------------------------------------------------- missing values


@pytest.fixture
def pair(frame):
    train = frame(
        "a string, n long, x double, t string, u string",
        ("p", 1, 1.0, "r", None), (None, None, 2.0, "r", None), ("q", 3, None, None, None), ("q", 4, 9.0, "s", None),
    )
    test = frame("a string, n long, x double, t string, only string", (None, None, None, None, "k"), ("z", 7, 3.0, "w", None))
    return train, test


def test_impute_follows_the_plan(pair):
    train, test = pair
    plan = ImputePlan(absent=["a"], zero=["n"], median=["x"])
    filled, filled_test, log = missing.impute(train, test, plan)
    assert rows_of(filled) == [
        ("p", 1, 1.0, "r", "None"), ("None", 0, 2.0, "r", "None"), ("q", 3, 2.0, "r", "None"), ("q", 4, 9.0, "s", "None"),
    ]
    assert rows_of(filled_test) == [("None", 0, 2.0, "r", "k"), ("z", 7, 3.0, "w", "k")]
    steps = {r["column"]: (r["strategy"], r["reason"]) for r in log.collect()}
    assert steps["x"] == ("fillna(median=2.0000)", "True missing numeric")
    assert steps["t"] == ("fallback fillna(mode=r)", "Remaining categorical missing")
    assert steps["u"] == ("fallback fillna(mode=None)", "Remaining categorical missing")
    assert steps["only"][0] == "test-only fillna(mode=k)"
    assert missing.missing_summary(filled).collect() == [] == missing.missing_summary(filled_test).collect()


def test_fit_scope(frame):
    train, test = frame("x double", (1.0,), (3.0,)), frame("x double", (None,), (10.0,))
    for scope, want in (("train", 2.0), ("test", 10.0)):
        assert missing.fit_imputer(train, test, ImputePlan(), scope).test_fills == {"x": want}


def test_fractional_median_of_whole_numbers(frame):
    df = frame("n long", (1,), (2,), (None,))
    filled, _, _ = missing.impute(df, df, ImputePlan(median=["n"]))
    assert sorted(r["n"] for r in filled.collect()) == [1.0, 1.5, 2.0]


def test_log_keeps_the_first_of_equal_steps(frame):
    steps = frame("step int, column string, strategy string, reason string", (0, "a", "s", "x"), (1, "a", "s", "y"), (2, "b", "s", "z"))
    assert rows_of(shaping.first_per_group(steps, ["column", "strategy"], "step"), "step") == [(0, "a", "s", "x"), (2, "b", "s", "z")]


def test_missing_summary_reads_the_table_once(spark, tmp_path):
    spark.range(10).selectExpr("id", "nullif(id, 3) AS x").write.parquet(str(tmp_path / "t"))
    summary = missing.missing_summary(spark.read.parquet(str(tmp_path / "t")))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert rows_of(summary) == [("x", 1, 10.0)]


def test_term_coverage_and_meanings(frame):
    texts = frame("text string", ("PoolQC: quality of the pool",), ("Fence and PoolQC",), (None,))
    table = frame("PoolQC string, Fence string", (None, "x"), (None, None))
    got = {r["column"]: r for r in missing.na_semantics(table, {"PoolQC": "No Pool", "Alley": "No alley"}, texts).collect()}
    assert (got["PoolQC"]["n_texts"], got["PoolQC"]["missing_count"], got["PoolQC"]["mentioned"]) == (2, 2, 1)
    assert (got["Alley"]["in_table"], got["Alley"]["missing_count"], got["Alley"]["mentioned"]) == (0, None, 0)


# ---------------------------------------------------------------- catalogue, features, encoding


def test_catalogue_rejects_two_roles():
    with pytest.raises(ValueError, match="LotShape"):
        catalog.Catalog({"ordinal": ["LotShape"], "nominal": ["LotShape"]})


def test_categories_listed_and_left_over(frame):
    df = frame("a string, b string, c string, n long", ("x", "y", "z", 1))
    assert catalog.categorical_columns(df, ["n", "a", "gone"], mapped=["b"]) == ["n", "a", "c"]


def test_house_features(frame):
    df = frame(
        "TotalBsmtSF long, `1stFlrSF` long, `2ndFlrSF` long, YrSold long, YearBuilt long, FullBath long, HalfBath long, "
        "BsmtFullBath long, BsmtHalfBath long, `3SsnPorch` long, ScreenPorch long, GarageArea long, OverallQual long",
        (100, 200, 50, 2008, 1990, 2, 1, 1, 1, None, 30, 0, 7),
    )
    row = features.derive(df, features.HOUSE_FEATURES).first()
    assert (row["TotalSF"], row["HouseAge"], row["TotalBath"]) == (350, 18, 4.0)
    assert (row["TotalPorchSF"], row["HasGarage"], row["HasBasement"], row["QualityIndex"]) == (30.0, 0, 1, 7.0)
    assert "RemodAge" not in row.asDict() and "HasPool" not in row.asDict()


def test_ordinal_dictionaries():
    maps = encode.ordinal_maps(encode.HOUSE_ORDINALS)
    assert maps["LotShape"] == {"IR3": 1, "IR2": 2, "IR1": 3, "Reg": 4}
    assert maps["PoolQC"]["Fa"] == 1 and maps["ExterQual"]["Fa"] == 2 and maps["LandSlope"]["Gtl"] == 3


def test_outlier_rule_without_its_columns(frame):
    assert rows_of(outliers.flag_outliers(frame("x double", (1.0,)), outliers.HOUSE_RULE)) == [(1.0, 0)]


def test_codes_by_literal_and_by_join_agree(spark):
    words = [(i, random.Random(i).choice("abcdefghij") * (i % 3 + 1)) for i in range(200)] + [(200, None)]
    df = spark.createDataFrame(words, "id long, w string").repartition(4)
    levels = sorted({w for _, w in words if w})
    want = [(i, None if w is None else levels.index(w)) for i, w in words]
    assert rows_of(encode.label_encode(df, ["w"]), "id") == want
    assert rows_of(encode.label_encode(df, ["w"], max_levels=3), "id") == want


def test_too_many_levels(spark):
    with pytest.raises(ValueError, match="more than 5 levels"):
        encode.levels_of(spark.range(20).selectExpr("cast(id AS string) AS c"), ["c"], 5)


def test_target_encoding_leaves_the_own_fold_out(frame):
    df = frame("id long, c string, f int, y double", (1, "a", 0, 10.0), (2, "a", 1, 20.0), (3, "b", 0, 30.0), (4, "b", 1, None), (5, None, 0, 1.0))
    got = {r["id"]: r["e"] for r in encode.target_encode(df, "c", "y", "f", "e", smoothing=1.0).collect()}
    prior0, prior1 = 20.0, 41.0 / 3
    assert got[1] == pytest.approx((20.0 + prior0) / 2)
    assert got[2] == pytest.approx((10.0 + prior1) / 2)
    assert got[3] == pytest.approx(prior0) and got[5] == pytest.approx(prior0)
    assert got[4] == pytest.approx((30.0 + prior1) / 2)


def test_target_means_by_literal_and_by_join_agree(spark):
    rows = [(i, random.Random(i).choice("abcd"), i % 3, None if i % 7 == 0 else float(i % 11)) for i in range(60)]
    train = spark.createDataFrame([(*r, "k" + str(r[0])) for r in rows], "id long, c string, f int, y double, d string")
    test = spark.createDataFrame([(1, "a", "k1"), (2, "zz", "k2"), (3, None, None)], "id long, c string, d string")
    small = encode.target_encode_pair(train, test, ["c", "d"], "y", "f")
    large = encode.target_encode_pair(train, test, ["c", "d"], "y", "f", max_levels=10)
    for a, b in zip(small, large):
        for x, y in zip(a.orderBy("id").collect(), b.orderBy("id").collect()):
            assert (x["c"], x["d"]) == (pytest.approx(y["c"]), pytest.approx(y["d"]))
    want = encode.target_encode(train, "c", "y", "f", "e")
    for x, y in zip(small[0].orderBy("id").collect(), want.orderBy("id").collect()):
        assert x["c"] == pytest.approx(y["e"])


def test_alignment_and_drift(frame):
    train, test = frame("c string, y double", ("a", 1.0), ("b", 2.0)), frame("c string, z int", ("a", 1), ("x", 2))
    assert [r["result"] for r in encode.alignment_check(train, test, "y").collect()] == ["FAIL", "FAIL", "0", "1"]
    assert rows_of(encode.level_drift(train, test, ["c"]), "level") == [("c", "b", 1, 0, "train only"), ("c", "x", 0, 1, "test only")]


def test_one_hot_sums_to_one_on_train(spark):
    train = spark.range(30).selectExpr("cast(id % 7 AS string) AS c", "id")
    hot = encode.one_hot("c", encode.levels_of(train, ["c"])["c"])
    encoded = train.select(*hot)
    assert {sum(r) for r in encoded.collect()} == {1}


# ---------------------------------------------------------------- reports


def test_leaderboard_of_three_result_tables(frame):
    """Published results of the compared models: linear, boosting, stacking."""
    baseline = frame(
        "Model string, `CV RMSE Mean` double, `CV RMSE Std` double",
        ("ElasticNet", 0.15616, 0.03505), ("Lasso", 0.15622, 0.03523), ("Ridge", 0.15682, 0.03438), ("Linear Regression", 0.15944, 0.03340),
    )
    boosting = frame(
        "Model string, `CV RMSE` double, `CV Std` double",
        ("CatBoost", 0.13491, 0.01523), ("XGBoost", 0.14052, 0.01625), ("LightGBM", 0.14544, 0.01755), ("RandomForest", 0.14707, 0.01566),
    )
    board = evaluate.leaderboard({"Baseline": baseline, "Boosting": boosting, "Stacking": frame("Model string, `CV RMSE` double", ("Stacking", 0.14061))})
    names = ["CatBoost", "XGBoost", "Stacking", "LightGBM", "RandomForest", "ElasticNet", "Lasso", "Ridge", "Linear Regression"]
    assert [r["model"] for r in board.collect()] == names
    assert board.filter("model = 'Stacking'").first()["cv_std"] is None
    assert evaluate.stability(board).count() == 8
    best = {r["field"]: r["value"] for r in evaluate.best_model(board).collect()}
    assert best == {"model": "CatBoost", "cv_rmse": "0.13491", "cv_std": "0.01523", "group": "Boosting"}


def test_price_segments_keep_empty_labels(frame):
    residuals = frame("s string, residual double, abs_residual double", ("UpperMid_40pct", 2.0, 2.0))
    got = rows_of(segments.residual_by(residuals, "s", bins.PRICE_LABELS))
    assert got == [("Mainstream_50pct", 0, None, None), ("UpperMid_40pct", 1, 2.0, 2.0), ("Luxury_10pct", 0, None, None)]


def test_row_profile_and_report(frame):
    df = frame("id long, y double, a double, b double", (1, 5.0, 1.0, 9.0), (2, 5.0, 3.0, 4.0), (3, 1.0, None, 2.0))
    assert rows_of(shaping.row_profile(df, "y", "id", ["a", "b"])) == [("high", "b", 9.0), ("high", "a", 1.0), ("low", "b", 2.0)]
    long = report.summary_report({"s": (df, "id", "y")}, k=2)
    assert rows_of(long, "rank") == [("s", 1, "1", 5.0), ("s", 2, "2", 5.0)]
    text = "\n".join(r["line"] for r in report.as_markdown(long, "Title").collect())
    assert text.startswith("# Title") and "## s" in text and "- 1: 5.0000" in text


def test_set_operations(frame):
    a, b = frame("k int, x int", (1, 1), (2, 2)), frame("k int, y int", (2, 5))
    assert rows_of(shaping.only_in_first(a, b, ["k"])) == [(1, 1)]
    assert rows_of(shaping.union_all([a, b]), "k", "x") == [(1, 1, None), (2, None, 5), (2, 2, None)]
    assert rows_of(shaping.occurs_in(a, "k", frame("v int", (2,)))) == [(2, 2)]
    assert rows_of(features.drop_columns(a, ["x", "gone"])) == [(1,), (2,)]


# ---------------------------------------------------------------- sources and sinks


def test_csv_tokens_decide_what_is_null(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write('id,q,x,w\n1,NA,1.5,7\n2,,NA,8\n3,None,2,\n4,"a, b",bad,9\n')
    got = readers.read_csv(spark, path)
    assert dict(got.dtypes) == {"id": "bigint", "q": "string", "x": "string", "w": "bigint"}
    assert [r["q"] for r in got.orderBy("id").collect()] == [None, None, None, "a, b"]
    kept = readers.read_csv(spark, path, na_tokens=readers.BLANK_ONLY)
    assert [r["q"] for r in kept.orderBy("id").collect()] == ["NA", None, "None", "a, b"]
    typed = readers.read_csv(spark, path, schema=spark.createDataFrame([], "id long, q string, x double, w double").schema)
    assert [r["x"] for r in typed.orderBy("id").collect()] == [1.5, None, 2.0, None]


def test_sql_goes_first_and_files_are_the_fallback(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    spark.range(5).createOrReplaceTempView("five")
    df, source = readers.read(spark, label="train", table="five", path=path)
    assert (df.count(), source) == (5, "SQL:train (SELECT * FROM five)")
    df, source = readers.read(spark, label="train", table="five", query="SELECT * FROM five WHERE id > 3", path=path)
    assert (df.count(), source) == (1, "SQL:train (SELECT * FROM five WHERE id > 3)")
    df, source = readers.read(spark, label="test", table="no_such_table", path=path)
    assert df.count() == 3 and source.startswith("PARQUET:test")
    no_driver = {"url": "jdbc:nosuch://host/db", "driver": "no.such.Driver"}
    df, source = readers.read(spark, label="test", table="t", jdbc=no_driver, path=path)
    assert df.count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read(spark, label="test", table="no_such_table")
    train, test, source = readers.read_pair(spark, {"table": "five"}, {"path": path})
    assert (train.count(), test.count()) == (5, 3) and "; " in source


def test_whole_text_and_results(spark, tmp_path):
    (tmp_path / "d.txt").write_bytes(b"PoolQC: ok\nline \xff two")
    assert readers.read_whole_text(spark, str(tmp_path / "d.txt")).first()["text"] == "PoolQC: ok\nline  two"
    df = spark.createDataFrame([("None",), (None,)], "q string")
    paths = sinks.write_results({"r": df}, str(tmp_path / "out"))
    assert sorted(str(r["q"]) for r in spark.read.parquet(paths["r"]).collect()) == ["None", "None"]
    assert spark.read.parquet(paths["r"]).filter("q IS NULL").count() == 1
    sinks.write_result(df, str(tmp_path / "out"), "r")
    assert spark.read.parquet(paths["r"]).count() == 2
    for fmt in ("csv", "orc", "json"):
        assert readers.read_files(spark, sinks.write_result(spark.range(3).toDF("a"), str(tmp_path / "out"), "x", fmt)).count() == 3


def test_csv_into_table(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("id,q\n1,NA\n2,\n")
    with_location = str(tmp_path / "wh")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch_load LOCATION '{with_location}'")
    try:
        sinks.load_csv_into_table(spark, path, "scratch_load.t")
        sinks.load_csv_into_table(spark, path, "scratch_load.t")
        assert rows_of(spark.table("scratch_load.t"), "id") == [(1, "NA"), (2, None)]
    finally:
        spark.sql("DROP DATABASE scratch_load CASCADE")


def test_fitted_objects_survive_a_round_trip(spark, tmp_path):
    train = spark.createDataFrame([("a", 1.0, "Ex"), ("b", 3.0, "TA")], "c string, x double, q string")
    cat = catalog.Catalog({"nominal": ["c"], "numeric continuous": ["x"], "ordinal": ["q"]}, ordinal_levels={"q": encode.QUALITY_LEVELS})
    fitted = encode.fit_encoder(train, cat)
    store.save_params(spark, fitted, str(tmp_path / "enc"))
    again = store.load_params(spark, encode.Encoder, str(tmp_path / "enc"))
    assert again == fitted
    assert rows_of(encode.encode(train, again)) == [(-1.0, 5, 1, 0), (1.0, 3, 0, 1)]
    with pytest.raises(ValueError):
        store.load_params(spark, missing.Imputer, str(tmp_path / "enc"))
    rows = spark.range(40).selectExpr("cast(id AS double) AS x", "cast(id * 2 AS double) AS y")
    model = trees.fit_trees(rows, ["x"], "y", trees.TreeSpec("forest", 3, 3))
    store.save_model(model, str(tmp_path / "m"))
    loaded = trees.predict(store.load_model(str(tmp_path / "m")), rows)
    assert rows_of(loaded, "x") == rows_of(trees.predict(model, rows), "x")


def test_stage_and_pin(spark):
    df = stage(spark.range(10).toDF("a"))
    assert df.count() == 10 and "FileScan" in df._jdf.queryExecution().executedPlan().toString()
    small = spark.range(50).toDF("a").join(pin_small(df), "a")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert spark.range(50).toDF("a").join(pin_small(df, max_rows=3), "a").count() == 10


# ---------------------------------------------------------------- whole jobs


def houses(spark, n, with_target, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        qual, area = rng.randint(3, 9), rng.randint(600, 4500)
        row = {
            "Id": seed * 1000 + i, "MSSubClass": rng.choice([20, 60]), "LotFrontage": rng.choice([None, 60.0, 70.0, 80.5]),
            "LotArea": rng.randint(3000, 9000), "GrLivArea": area, "OverallQual": qual, "OverallCond": rng.randint(4, 7),
            "YearBuilt": rng.randint(1950, 2005), "YearRemodAdd": 2006, "TotalBsmtSF": rng.choice([0, 800, 900]), "1stFlrSF": area,
            "2ndFlrSF": 0, "FullBath": rng.randint(1, 3), "HalfBath": 1, "BsmtFullBath": rng.choice([None, 1]), "BsmtHalfBath": 0,
            "GarageArea": rng.choice([None, 0, 400]), "GarageCars": rng.choice([None, 1, 2]), "Fireplaces": rng.randint(0, 2),
            "MoSold": rng.randint(1, 12), "YrSold": rng.randint(2006, 2010), "Neighborhood": rng.choice(["A", "B", "C"]),
            "HouseStyle": rng.choice(["1Story", "2Story"]), "SaleCondition": rng.choice(["Normal", "Partial"]),
            "ExterQual": rng.choice(["TA", "Gd", "Ex"]), "PoolQC": rng.choice([None, None, "Gd"]), "CentralAir": rng.choice(["Y", "N"]),
            "Street": "Pave", "Electrical": rng.choice([None, "SBrkr", "FuseA"]), "LotShape": rng.choice(["Reg", "IR1"]),
        }
        if with_target:
            row["SalePrice"] = float(40 * area + 9000 * qual + rng.randint(0, 20000))
        rows.append(row)
    names = list(rows[0])
    kinds = {c: next(type(r[c]) for r in rows if r[c] is not None) for c in names}
    ddl = ", ".join(f"`{c}` " + {int: "long", float: "double", str: "string"}[kinds[c]] for c in names)
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ddl)


def test_the_three_jobs_on_a_house_table(spark):
    train, test = houses(spark, 160, True, 1), houses(spark, 60, False, 2)
    texts = spark.createDataFrame([("PoolQC: pool quality",)], "text string")
    settings = workflows.Settings(rule=outliers.SizePriceRule("GrLivArea", "SalePrice", 4000.0, 260000.0))
    out = workflows.diagnose(train, test, texts, settings)
    for name, df in out.items():
        assert df.columns, name
        df.collect()
    assert out["missing_train_after"].count() == 0 == out["missing_test_after"].count()
    assert out["residuals"].count() == out["residual_by_price_segment"].agg(F.sum("count")).first()[0]
    assert out["collinear_pairs"].filter("feature_a = '1stFlrSF' OR feature_b = '1stFlrSF'").count() > 0
    assert out["spearman_ranking"].first()["spearman"] > 0.8
    assert out["feature_types"].filter("in_table = 1").count() > 10
    assert out["na_semantics"].filter("mentioned = 1").count() == 1
    assert {r["section"] for r in out["summary"].collect()} >= {"pearson", "spearman", "mutual information", "residuals"}

    fitted, encoded = workflows.encode_tables(out["train_clean"], out["test_clean"], settings)
    for name, df in encoded.items():
        assert df.collect() or name == "level_drift", name
    matrix = encoded["train_matrix"]
    assert matrix.columns == ["Id", "SalePrice", *fitted.feature_names()]
    assert [r["result"] for r in encoded["alignment"].collect()][:2] == ["PASS", "PASS"]
    mean, std = matrix.agg(F.avg("TotalSF"), F.stddev_pop("TotalSF")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)

    small = {"boost": trees.TreeSpec("boost", 3, 2, 0.5)}
    compared = workflows.compare_models(matrix, fitted.feature_names(), settings, 3, small)
    assert compared["leaderboard"].count() == 5 and compared["best_model"].count() == 4

    boosted = workflows.boost(out["train_clean"], out["test_clean"], settings, trees.TreeSpec("boost", 4, 3, 0.3))
    assert boosted["scored"].count() == 60
    assert boosted["scored"].filter("SalePrice > 0").count() == 60
    assert boosted["validation_metrics"].first()["mae"] > 0


def test_columns_without_any_value(frame):
    train = frame("id long, x double, t string", (1, None, None), (2, None, None))
    filled, _, log = missing.impute(train, train, ImputePlan(median=["x"], mode={"t": "SBrkr"}))
    assert rows_of(filled, "id") == [(1, 0.0, "SBrkr"), (2, 0.0, "SBrkr")]
    assert [r["strategy"] for r in log.orderBy("step").collect()] == ["fillna(median=0.0000)", "fillna(mode=SBrkr)"]
    assert segments.segment_stats(train, "id", "x").filter("median IS NULL AND count = 1").count() == 2
    assert rows_of(bins.qq_points(train, "x", 5)) == []
