"""Splits, models, tuning, the feature plan, the registry and the preparation plan."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parcelwise.operators import metrics, models, split, tuning
from parcelwise.plans import preprocess, registry, stages
from parcelwise.sources import tabular


def as_dict(df, key="PID", value="split"):
    return {r[key]: r[value] for r in df.select(key, value).collect()}


def test_quantile_bins_match_pandas(spark, sales):
    frame = sales.toPandas()
    got = sales.select("PID", split.quantile_bin(F.col("SalePrice"), split.quantile_edges(sales, "SalePrice")).alias("b"))
    assert as_dict(got, value="b") == dict(zip(frame["PID"], pd.qcut(frame["SalePrice"], 5, labels=False)))
    ties = spark.createDataFrame([(0.0,)] * 50 + [(float(i),) for i in range(50)], "x double")
    want = pd.qcut(ties.toPandas()["x"], 5, labels=False, duplicates="drop")
    b = split.quantile_bin(F.col("x"), split.quantile_edges(ties, "x"))
    assert Counter(r[0] for r in ties.select(b).collect()) == Counter(want)


def test_stratified_split_sizes_and_invariance(sales):
    one = as_dict(split.split_by_target(sales.repartition(1), "PID"))
    assert one == as_dict(split.split_by_target(sales.repartition(7), "PID"))
    sizes = Counter(one.values())
    assert sum(sizes.values()) == 300 and (sizes["test"], sizes["val"]) == (45, 45)
    bins = as_dict(sales.select("PID", split.quantile_bin(F.col("SalePrice"), split.quantile_edges(sales, "SalePrice")).alias("split")))
    assert set(Counter(bins[k] for k, s in one.items() if s == "test").values()) == {9}
    assert one != as_dict(split.split_by_target(sales, "PID", seed=1))


def test_missing_stratum_is_split_too(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 40, None).otherwise("a"))
    got = split.stratified_split(df, "id", F.col("g")).groupBy("g", "split").count().collect()
    assert {(r["g"], r["split"]): r["count"] for r in got} == {
        (None, "test"): 6, (None, "val"): 6, (None, "train"): 28, ("a", "test"): 9, ("a", "val"): 9, ("a", "train"): 42}


def test_many_strata_are_joined_to_the_same_result(sales, monkeypatch):
    few = as_dict(split.split_by_target(sales, "PID"))
    monkeypatch.setattr(split, "LITERAL_STRATA", 2)
    many = split.split_by_target(sales, "PID")
    assert many.columns == [*sales.columns, "split"] and as_dict(many) == few


def test_random_split_and_folds(sales):
    parts = Counter(as_dict(split.random_split(sales, "PID")).values())
    assert abs(parts["train"] / 300 - 0.7) < 0.1 and abs(parts["val"] - parts["test"]) < 40
    folds = as_dict(split.with_fold(sales, "PID"), value="fold")
    assert set(folds.values()) == set(range(5)) and folds == as_dict(split.with_fold(sales.repartition(3), "PID"), value="fold")


def test_metrics(spark):
    df = spark.createDataFrame([("perfect", 1e5, 1e5), ("perfect", 3e5, 3e5), ("off", 2e5, 2.1e5), ("off", 2e5, 2.1e5), ("noisy", 1e5, 1.5e5), ("noisy", 3e5, 2e5)], "m string, y double, p double")
    got = {r["m"]: r for r in metrics.regression_metrics(df, "y", "p", ["m"]).collect()}
    assert (got["perfect"]["r2"], got["perfect"]["rmse"], got["perfect"]["mae"]) == (1.0, 0.0, 0.0)
    assert got["off"]["rmse"] == pytest.approx(10000) and got["off"]["mape"] == pytest.approx(5.0) and got["off"]["r2"] == 0.0
    assert got["noisy"]["r2"] < 1 and got["noisy"]["mae"] == pytest.approx(75000)
    logs = df.select(F.log1p("y").alias("y"), F.log1p("p").alias("p"))
    assert metrics.regression_metrics(logs, "y", "p", log_target=True).head()["mae"] == pytest.approx(got_all(df))


def got_all(df):
    return metrics.regression_metrics(df, "y", "p").head()["mae"]


SKIP = ["PID", "Order", "SalePrice", "label", "split", "fold"]


@pytest.fixture(scope="module")
def data(sales):
    df = split.with_fold(split.random_split(sales, "PID"), "PID").withColumn("label", F.log1p("SalePrice"))
    model = stages.build_features(scale=False, exclude=SKIP).fit(df)
    return model.transform(df).select(*SKIP, "features").cache()


def test_feature_plan_is_numeric_finite_and_stable(spark, sales, tmp_path):
    train, unseen = sales.where("PID < 200"), sales.where("PID >= 200").withColumn("Neighborhood", F.lit("new place"))
    widths = set()
    for scale in (True, False):
        model = stages.build_features(scale=scale, exclude=["PID", "Order", "SalePrice"]).fit(train)
        for part in (train, unseen, unseen.drop("Lot Frontage", "MS Zoning")):
            rows = np.array([r[0] for r in model.transform(part).select(vector_to_array("features")).collect()])
            widths.add(rows.shape[1])
            assert np.isfinite(rows).all()
        if scale:
            out = model.transform(train)
            names, counts = stages.feature_names(out), stages.feature_summary(out)
            got = np.array([r[0] for r in out.select(vector_to_array("features")).collect()])
            np.testing.assert_allclose(got[:, :counts["numeric"]].mean(axis=0), 0, atol=1e-9)
            assert len(names) == counts["total"] == counts["numeric"] + counts["one_hot"] and "MS Zoning_RL" in names and "Alley" not in str(names)
            model.write().overwrite().save(str(tmp_path / "m"))
            again = PipelineModel.load(str(tmp_path / "m")).transform(train)
            assert again.select("PID", "features").exceptAll(out.select("PID", "features")).count() == 0
    assert len(widths) == 1


def test_model_comparison_and_adaboost(data):
    fitted, found = models.compare_models(data, {
        "Linear Regression": models.linear_regression(), "Gradient Boosting": models.boosted_trees(trees=5),
        "AdaBoost": models.AdaBoostR2(rounds=3, cut_every=2)}, log_target=True)
    rows = found.collect()
    assert len(rows) == 9 and all(r["r2"] > 0.3 for r in rows if r["dataset"] == "train")
    assert metrics.best_by(found.where("dataset = 'test'")).count() == 1
    ada = fitted["AdaBoost"].transform(data)
    assert not [n for n in ada.columns if n.startswith("__")]


def test_weighted_median(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0)], "a double, b double, d double")
    pick = lambda w: df.select(models.weighted_median([F.col("a"), F.col("b"), F.col("d")], w)).head()[0]
    assert pick([1.0, 1.0, 1.0]) == 2.0 and pick([5.0, 1.0, 1.0]) == 3.0 and pick([1.0, 5.0, 1.0]) == 1.0


def test_grid_prefixes_equal_refits(data):
    small = data.where("fold < 2")
    grid = {"learning_rate": [0.1], "n_estimators": [2, 4], "max_depth": [2], "min_samples_leaf": [1]}
    got = {r["n_estimators"]: r["mse"] for r in tuning.boosting_grid(small, grid, folds=2).collect()}
    errors = []
    for k in range(2):
        m = models.boosted_trees(trees=2, rate=0.1, depth=2).fit(small.where(F.col("fold") != k))
        errors.append(m.transform(small.where(F.col("fold") == k)).select(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).head()[0])
    assert got[2] == pytest.approx(sum(errors) / 2)


def test_random_search_is_seeded(data):
    tree = models.decision_tree(max_depth=3, max_bins=32)
    space = {"maxDepth": [1, 2, 3], "minInstancesPerNode": [1, 5]}
    assert tuning.sample_params(tree, space, 3) == tuning.sample_params(tree, space, 3)
    best, trials = tuning.random_search(data, tree, space, trials=2, folds=5)
    rows = trials.collect()
    assert len(rows) == 2 and rows[0]["rmse"] <= rows[1]["rmse"] and best.bestModel is not None


def test_fold_predictions_cover_every_row_once(data):
    got = tuning.fold_predictions(data, models.linear_regression())
    assert sorted(r[0] for r in got.select("PID").collect()) == list(range(300))
    assert tuning.fold_scores(data, models.linear_regression()).count() == 5


def test_prediction_sanity_and_importance(spark, data, sales):
    tree = models.boosted_trees(trees=10).fit(data)
    ranked = models.feature_importance(tree, stages.feature_names(data), spark).collect()
    assert ranked[0]["rank"] == 1 and sum(r["importance"] for r in ranked) == pytest.approx(1.0)
    df = sales.withColumn("label", F.log1p("SalePrice"))
    model = Pipeline(stages=[stages.build_features(False, ["PID", "Order", "SalePrice", "label"]), models.boosted_trees(trees=10)]).fit(df)
    prices = model.transform(df).select(F.expm1("prediction").alias("p")).agg(F.min("p"), F.max("p")).head()
    assert 10_000 < prices[0] <= prices[1] < 2_000_000
    for column, values in (("Overall Qual", [2, 9]), ("Gr Liv Area", [800.0, 3500.0])):
        means = {r["value"]: r["mean_prediction"] for r in models.counterfactual_means(model, df, column, values, True).collect()}
        assert means[float(values[0])] < means[float(values[1])]


def test_registry(spark, sales, tmp_path):
    model = Pipeline(stages=[VectorAssembler(inputCols=["Gr Liv Area"], outputCol="features"), models.linear_regression("SalePrice")]).fit(sales)
    path = registry.save_model(spark, model, str(tmp_path / "reg"), ["Gr Liv Area"], {"test": {"r2": 0.9, "rmse": 2.0}}, {"n": 200}, "abc123")
    again = registry.load_model(spark, path)
    assert again.transform(sales).select("prediction").exceptAll(model.transform(sales).select("prediction")).count() == 0
    meta = registry.load_meta(spark, path).head()
    assert meta["run_id"] == "abc123" and meta["best_params"] == {"n": "200"} and meta["metrics"] == {"test": {"r2": 0.9, "rmse": 2.0}}
    assert tabular.read_feature_names(spark, f"{path}/feature_names") == ["Gr Liv Area"]
    with pytest.raises(FileNotFoundError, match="No saved model"):
        registry.load_model(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="metadata"):
        registry.load_meta(spark, str(tmp_path / "none"))


def test_preparation_plan_from_csv(spark, sales, tmp_path):
    sales.repartition(2).write.option("header", True).option("nullValue", "NA").csv(str(tmp_path / "raw"))
    done = preprocess.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert done.dropped == ["Alley"] and "Neighborhood_NAmes" in done.features
    parts = {s: preprocess.read_prepared_split(spark, str(tmp_path / "out"), s) for s in tabular.SPLITS}
    assert sum(p.count() for p in parts.values()) == done.table.count()
    assert not [n for n, t in parts["train"].dtypes if t == "string"] and "PID" not in parts["train"].columns
    assert preprocess.read_prepared_names(spark, str(tmp_path / "out")) == done.features
    plan = parts["val"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ValueError):
        tabular.read_split(spark, str(tmp_path / "out/splits"), "holdout")
    with pytest.raises(FileNotFoundError):
        tabular.read_split(spark, str(tmp_path / "absent"), "train")
    with pytest.raises(FileNotFoundError, match="Raw data not found"):
        tabular.load_raw(spark, str(tmp_path / "absent.csv"))


def test_an_ensemble_is_one_short_expression(spark, data, tmp_path):
    from pyspark.ml.regression import DecisionTreeRegressor

    trees = [DecisionTreeRegressor(labelCol="label", maxDepth=d, maxBins=32, seed=d).fit(data.where(F.col("fold") != d)) for d in (0, 1, 3)]
    weights = [0.5, 1.0, 2.5]
    model = models.TreeEnsembleModel(trees, weights)
    scored = data
    for i, tree in enumerate(trees):
        scored = tree.setPredictionCol(f"p{i}").transform(scored)
    want = scored.withColumn("want", models.weighted_median([F.col(f"p{i}") for i in range(3)], weights))
    assert model.transform(want).where("abs(prediction - want) > 1e-9").count() == 0
    model.write().overwrite().save(str(tmp_path / "m"))
    again = models.TreeEnsembleModel.load(str(tmp_path / "m"))
    assert again.transform(want).where("abs(prediction - want) > 1e-9").count() == 0
    many = models.TreeEnsembleModel(trees[:1] * 500, [1.0] * 500)
    assert many.n_trees == 500 and many.transform(data)._jdf.queryExecution().analyzed().toString().count("Project") <= data._jdf.queryExecution().analyzed().toString().count("Project") + 3
    assert many.transform(want.limit(20)).where("abs(prediction - p0) > 1e-9").count() == 0


def test_adaboost_is_an_estimator_with_params(tmp_path):
    ada = models.AdaBoostR2(rounds=4, depth=2)
    ada.write().overwrite().save(str(tmp_path / "a"))
    again = models.AdaBoostR2.load(str(tmp_path / "a"))
    assert again.getOrDefault("rounds") == 4 and ada.copy({ada.getParam("rounds"): 9}).getOrDefault("rounds") == 9
    assert [p.name for m in tuning.sample_params(ada, {"rounds": [1, 2], "rate": tuning.Between(0.1, 1.0)}, 2) for p in m] == ["rounds", "rate"] * 2
