"""Pipelines, cross-validation and metrics."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tripspark import schema as S
from tripspark.ml import evaluation, modeling, moments


@pytest.fixture(scope="module")
def parts(spark):
    df = spark.range(600).selectExpr(
        "cast(id as string) as vehid", "'1' as tripid",
        "if(id % 10 = 0, null, cast(id % 37 as double)) as speed",
        "cast(null as double) as never",
        "case id % 3 when 0 then 'A' when 1 then 'B' end as kind",
        "3.0D * (id % 37) + if(id % 3 = 0, 10, 0) as label")
    train = df.where("vehid % 4 <> 0").cache()
    return train, df.where("vehid % 4 = 0").cache()


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0)], "label double, prediction double")
    row = evaluation.evaluate(df).first()
    assert row["rmse"] == pytest.approx(math.sqrt(4 / 3))
    assert (row["mae"], row["r2"]) == (pytest.approx(2 / 3), pytest.approx(-1.0))


def test_empty_columns_are_left_out(parts):
    assert modeling.usable_columns(parts[0]) == (["speed"], ["kind"])


def test_learners_beat_the_mean_and_reload(spark, parts, tmp_path):
    train, test = parts
    grids = {"LinearRegression": {"regParam": [0.0, 0.1]},
             "RandomForestRegressor": {"numTrees": [5], "maxDepth": [4]},
             "GBTRegressor": {"maxDepth": [3]}}
    specs = modeling.default_specs(grids)
    specs[2].model.setMaxIter(5)
    results = modeling.train_all(specs, train, test, folds=2, model_root=str(tmp_path))
    log = modeling.training_log(spark, results).collect()
    assert [r["model_index"] for r in log] == [1, 2, 3] and all(r["r2"] > 0.3 for r in log)
    assert modeling.cv_results(spark, results).count() == 4
    assert "maxDepth=3" in log[2]["best_params"]
    loaded = modeling.load_model(f"{tmp_path}/model1")
    mine = {(r["vehid"], r["prediction"]) for r in
            results[0].predictions.select("vehid", "prediction").collect()}
    again = {(r["vehid"], r["prediction"]) for r in
             loaded.transform(test).select("vehid", "prediction").collect()}
    assert mine == again


@pytest.mark.parametrize("index", [0, 2])
def test_cross_validation_equals_the_builtin_one(parts, index):
    """Preparing once per fold changes nothing against refitting the whole pipeline."""
    train, test = parts
    grids = {"LinearRegression": {"regParam": [0.0, 50.0]}, "GBTRegressor": {"maxDepth": [1, 3]}}
    spec = modeling.default_specs(grids)[index]
    if index == 2:
        spec.model.setMaxIter(2)
    mine = modeling.cross_validate(spec, train, ["speed"], ["kind"], folds=2)
    builtin = CrossValidator(
        estimator=modeling.build_pipeline(spec.model, ["speed"], ["kind"], spec.scale),
        estimatorParamMaps=spec.param_maps(), numFolds=2, foldCol="fold",
        evaluator=RegressionEvaluator(labelCol="label", metricName="rmse")).fit(
            modeling.add_folds(train, 2, S.TRIP_KEYS))
    assert mine.avg_metrics == pytest.approx(builtin.avgMetrics, rel=1e-6)
    key = "vehid"
    a = {r[key]: r["prediction"] for r in mine.best_model.transform(test).collect()}
    b = {r[key]: r["prediction"] for r in builtin.bestModel.transform(test).collect()}
    assert a == pytest.approx(b, rel=1e-6)


@pytest.mark.parametrize("center", [False, True])
def test_whole_linear_grid_equals_the_builtin_one(spark, center):
    """Every penalty solved from sums has the error that fitting it has, to 1e-6."""
    train = spark.range(900).selectExpr(
        "cast(id as string) as vehid", "'1' as tripid",
        "if(id % 10 = 0, null, cast(id % 37 as double)) as speed",
        "cast(pmod(xxhash64(id), 1000) as double) / 100 as noise", "5.0D as constant",
        "sqrt(id % 37) as bent", "case id % 3 when 0 then 'A' when 1 then 'B' end as kind",
        "100 + 3.0D * (id % 37) + if(id % 3 = 0, 10, 0) + pmod(xxhash64(id, 1), 100) / 9.0D as label")
    spec = modeling.default_specs()[0] if not center else modeling.two_model_specs()[0]
    numeric = ["speed", "noise", "constant", "bent"]
    mine = modeling.cross_validate(spec, train, numeric, ["kind"], folds=2)
    maps = [m for m in spec.param_maps()
            if {p.name: v for p, v in m.items()}.get("aggregationDepth", 2) == 2]
    chosen = [v for m, v in zip(spec.param_maps(), mine.avg_metrics) if m in maps]
    builtin = CrossValidator(
        estimator=modeling.build_pipeline(spec.model.copy({spec.model.maxIter: 1000,
                                                           spec.model.tol: 1e-12}),
                                          numeric, ["kind"], spec.scale, center),
        estimatorParamMaps=maps, numFolds=2, foldCol="fold", parallelism=4,
        evaluator=RegressionEvaluator(labelCol="label", metricName="rmse")).fit(
            modeling.add_folds(train, 2, S.TRIP_KEYS))
    assert len(chosen) == 9 and chosen == pytest.approx(builtin.avgMetrics, rel=1e-6)


def test_sums_of_parts_against_numpy(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(300, 3)), rng.normal(size=300)
    rows = [(Vectors.dense(a), float(b), int(i % 2)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["features", "label", "part"]).repartition(7)
    found = moments.moments(df)
    for part in (0, 1):
        own = np.column_stack([np.ones(150), x[part::2], y[part::2]])
        assert np.allclose(found[part], own.T @ own)
    one = moments.Standardised(found[0])
    line = np.linalg.lstsq(np.column_stack([np.ones(150), x[::2]]), y[::2], rcond=None)[0]
    intercept, coefficients = one.solve(0.0, 0.0)
    assert np.allclose([intercept, *coefficients], line) and one.unique()
    errors = y[1::2] - intercept - x[1::2] @ coefficients
    assert moments.rmse(found[1], intercept, coefficients) == pytest.approx(
        math.sqrt(np.mean(errors ** 2)))
    assert moments.moments(df.limit(0)) == {} and math.isnan(moments.rmse(None, 0.0, line))
    assert not np.any(one.solve(10.0, 1.0)[1])  # a heavy penalty leaves the mean


def test_cross_validation_without_keys(parts):
    spec = modeling.default_specs({"LinearRegression": {"regParam": [0.0]}})[0]
    out = modeling.cross_validate(spec, parts[0].drop("vehid", "tripid"), ["speed"], ["kind"])
    assert len(out.avg_metrics) == 1 and out.avg_metrics[0] > 0


def test_folds_depend_on_the_key_only(parts):
    df = modeling.add_folds(parts[0], 3, S.TRIP_KEYS)
    again = modeling.add_folds(parts[0].repartition(5), 3, S.TRIP_KEYS)
    assert {(r["vehid"], r["fold"]) for r in df.collect()} == {
        (r["vehid"], r["fold"]) for r in again.collect()}
    assert {r["fold"] for r in df.collect()} == {0, 1, 2}


def test_unseen_category_is_all_zero(spark, parts):
    train, _ = parts
    fitted = modeling.build_pipeline(LinearRegression(maxIter=5), [], ["kind"]).fit(train)
    odd = spark.createDataFrame([("Z",), (None,)], "kind string")
    assert all(r["features"].toArray().sum() == 0 for r in fitted.transform(odd).collect())


def test_grids():
    sizes = [len(s.param_maps()) for s in modeling.default_specs()]
    assert sizes == [27, 27, 27]
    assert [len(s.param_maps()) for s in modeling.two_model_specs()] == [9, 4]


def test_prediction_tables(spark):
    df = spark.createDataFrame([(1.0, "2"), (2.0, "2"), (4.0, "bad"), (3.0, "3.5")],
                               "label double, prediction string")
    rows = evaluation.prediction_rows(df, "M", limit=2).collect()
    assert [(r["row_id"], r["error"]) for r in rows] == [(1, 1.0), (2, 0.0)]
    kept = evaluation.prediction_rows(df, "M").collect()
    assert [r["row_id"] for r in kept] == [1, 2, 3]  # ordered by label; the last is no number
    gap = evaluation.prediction_rows(df, "M", order=["prediction", "label"]).collect()
    assert sorted(r["row_id"] for r in gap) == [1, 2, 3]
    report = evaluation.prediction_report(df.where("label < 4").withColumn(
        "prediction", F.col("prediction").cast("double")))
    best = evaluation.specific_prediction(report, "M").first()
    assert (best["actual_fuel_l_per_100km"], best["absolute_error"]) == (2.0, 0.0)
    scores = spark.createDataFrame([("a", 2.0, 1.0, 0.1), ("b", 1.0, 1.0, 0.2)],
                                   "model_name string, rmse double, mae double, r2 double")
    assert evaluation.best_model(scores).first()["model_name"] == "b"
    assert evaluation.unpivot_metrics(scores).count() == 6
