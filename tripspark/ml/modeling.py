"""Model pipelines, cross-validation, prediction and persistence."""

import time
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..operators.cleaning import nan_to_null, split_columns_by_type
from ..operators.selection import split_bucket, split_train_test
from ..sources.shared import ensure_checkpoints, materialise
from . import evaluation, moments


def impute_stage(numeric, relative_error=0.001):
    """NULL and NaN to the median, an element of the column, within the given rank error."""
    return Imputer(inputCols=list(numeric), outputCols=[c + "_imputed" for c in numeric],
                   strategy="median", relativeError=relative_error)


def index_stage(categorical):
    """Category to index by descending frequency; unseen and NULL share one extra index."""
    return StringIndexer(inputCols=list(categorical), outputCols=[c + "_idx" for c in categorical],
                         handleInvalid="keep")


def one_hot_stage(categorical):
    """Index to indicator vector; the extra index becomes the zero vector."""
    return OneHotEncoder(inputCols=[c + "_idx" for c in categorical],
                         outputCols=[c + "_oh" for c in categorical])


def scale_stage(center=False):
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=center,
                          withStd=True)


def preparation(numeric, categorical, scale=False, center=False) -> list:
    """Stages from raw columns to the ``features`` vector.

    All categorical columns are indexed in one pass.
    """
    stages, inputs = [], []
    if numeric:
        stages.append(impute_stage(numeric))
        inputs += [c + "_imputed" for c in numeric]
    if categorical:
        stages += [index_stage(categorical), one_hot_stage(categorical)]
        inputs += [c + "_oh" for c in categorical]
    assembled = "raw_features" if scale else "features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=assembled, handleInvalid="keep"))
    if scale:
        stages.append(scale_stage(center))
    return stages


def build_pipeline(model, numeric, categorical, scale=False, center=False) -> Pipeline:
    """Imputation, encoding, assembly, optional scaling and the model as one estimator."""
    return Pipeline(stages=[*preparation(numeric, categorical, scale, center), model])


@dataclass
class ModelSpec:
    """A learner, its parameter grid, and whether its inputs are scaled."""

    name: str
    model: Any
    grid: dict = field(default_factory=dict)
    scale: bool = False
    center: bool = False

    def param_maps(self):
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder = builder.addGrid(self.model.getParam(name), values)
        return builder.build()


# --- fixed values: parameter grids and learner settings -----------------------------------
GRIDS = {
    "LinearRegression": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0],
                         "aggregationDepth": [2, 3, 4]},
    "RandomForestRegressor": {"maxDepth": [4, 6, 8], "numTrees": [20, 40, 60],
                              "subsamplingRate": [0.7, 0.85, 1.0]},
    "GBTRegressor": {"maxDepth": [3, 4, 5], "maxBins": [32, 64, 128],
                     "stepSize": [0.03, 0.05, 0.1]},
}
TWO_MODEL_GRIDS = {
    "LinearRegression": {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]},
    "GBTRegressor": {"maxDepth": [3, 5], "stepSize": [0.05, 0.1]},
}
ABLATION_NUMERIC = ["duration_min", "distance_km", "speed_mean", "speed_median", "speed_p95",
                    "rpm_mean", "maf_mean", "abs_load_mean", "oat_mean", "eng_dis", "gen_weight"]
ABLATION_CATEGORICAL = ["vehtype", "vehclass", "transmission", "drive_wheels"]
# -----------------------------------------------------------------------------------------


def default_specs(grids=None, seed=S.SEED) -> list:
    """Linear regression, random forest and gradient-boosted trees, with their whole grids."""
    grids = {**GRIDS, **(grids or {})}
    linear = grids["LinearRegression"]
    return [
        ModelSpec("LinearRegression", LinearRegression(labelCol=S.LABEL, maxIter=50), linear,
                  scale=True),
        ModelSpec("RandomForestRegressor", RandomForestRegressor(labelCol=S.LABEL, seed=seed),
                  grids["RandomForestRegressor"]),
        ModelSpec("GBTRegressor", GBTRegressor(labelCol=S.LABEL, seed=seed, maxIter=20),
                  grids["GBTRegressor"]),
    ]


def two_model_specs(grids=None, seed=S.SEED) -> list:
    """The two-model preset: centred linear regression and longer boosting."""
    grids = {**TWO_MODEL_GRIDS, **(grids or {})}
    return [
        ModelSpec("LinearRegression", LinearRegression(labelCol=S.LABEL, maxIter=100),
                  grids["LinearRegression"], scale=True, center=True),
        ModelSpec("GBTRegressor", GBTRegressor(labelCol=S.LABEL, seed=seed, maxIter=50),
                  grids["GBTRegressor"], scale=True, center=True),
    ]


def usable_columns(train: DataFrame, exclude=(*S.TRIP_KEYS, S.LABEL, "fold")) -> tuple:
    """(numeric, categorical) inputs that have at least one value in the training rows."""
    numeric, categorical = split_columns_by_type(train, exclude)
    row = train.agg(*[F.count(c).alias(c) for c in numeric + categorical]).first()
    return [c for c in numeric if row[c]], [c for c in categorical if row[c]]


def add_folds(df: DataFrame, folds, keys, seed=S.SEED) -> DataFrame:
    """Fold number from a row's key: the same on every retry and partitioning."""
    return df.withColumn("fold", split_bucket(keys, f"{seed}-fold", folds).cast("int"))


def param_text(params: dict) -> str:
    return "; ".join(sorted(f"{p.name}={v}" for p, v in params.items()))


def best_params(model: PipelineModel) -> str:
    """All parameters of the final stage as sorted text."""
    last = model.stages[-1]
    return param_text({p: v for p, v in last.extractParamMap().items() if p.parent == last.uid})


@dataclass
class Trained:
    """Outcome of one training: the model, its predictions, and the report rows."""

    model: PipelineModel
    predictions: DataFrame
    summary: dict
    cv_rows: list


@dataclass
class CrossValidated:
    """The refitted best pipeline and the mean validation error per grid point."""

    best_model: PipelineModel
    avg_metrics: list


#: Prepared rows of a fold that one task should hold while learners are fitted.
FIT_ROWS = 50_000


def _packed(rows: DataFrame) -> DataFrame:
    """Cached rows in as few partitions as their number needs.

    Tree learners run several jobs for each level of each tree, so small folds dealt over many tasks
    cost far more in scheduling than in work.
    """
    held = rows.persist()
    return held.coalesce(max(1, -(-held.count() // FIT_ROWS)))


def _solved_from_sums(model, maps) -> bool:
    """Whether the grid is one of plain linear regressions, whose every point follows from sums.

    ``aggregationDepth`` says how sums are added up and changes no result.
    """
    return (isinstance(model, LinearRegression) and model.getLoss() == "squaredError"
            and model.getSolver() in ("auto", "normal") and model.getFitIntercept()
            and model.getStandardization() and not model.isDefined("weightCol")
            and {p.name for m in maps for p in m} <= {
                "regParam", "elasticNetParam", "aggregationDepth"})


def _scores_from_sums(spec, maps, rest, held, evaluator):
    """RMSE on ``held`` of each grid point fitted on ``rest``, from one scan; None if vectors are
    too wide.

    Where a regression without penalty has no unique solution, the learner itself is fitted once, so
    that rows outside the span of the training rows get its predictions.
    """
    first = rest.select("features").first()
    if first is None or first["features"].size > moments.MAX_FEATURES:
        return None
    sums = moments.moments(rest.withColumn("part", F.lit(0)).unionByName(
        held.withColumn("part", F.lit(1))), label=S.LABEL)
    fitted, known, out = moments.Standardised(sums[0]), {}, []
    for params in maps:
        values = {p.name: v for p, v in {**spec.model.extractParamMap(), **params}.items()}
        point = values["regParam"], values["elasticNetParam"]
        if not point[0]:
            point = 0.0, 0.0  # without a penalty its kind does not matter
        if point not in known:
            if point[0] or fitted.unique():
                known[point] = moments.rmse(sums.get(1), *fitted.solve(*point))
            else:
                known[point] = evaluator.evaluate(
                    spec.model.copy(params).fit(rest).transform(held))
        out.append(known[point])
    return out


def cross_validate(spec: ModelSpec, train: DataFrame, numeric, categorical, folds=S.CV_FOLDS,
                   parallelism=None, seed=S.SEED,
                   keys=tuple(S.TRIP_KEYS)) -> CrossValidated:
    """Choose the grid point with the lowest RMSE over k folds and refit it on all rows.

    Gives what ``CrossValidator`` gives for the whole pipeline: preparation is fitted on the
    training rows of each fold only.  As the grid concerns the learner alone, that is done once
    per fold and not once per grid point, and the learners of a fold share its cached vectors.
    So many learners are fitted at once as ``parallelism`` says, by default as the session has cores.
    A grid of linear regressions is solved from one scan per fold, see ``moments``.
    """
    parallelism = parallelism or train.sparkSession.sparkContext.defaultParallelism
    keys = [k for k in keys if k in train.columns] or train.columns
    data = add_folds(train, folds, keys, seed)
    maps = spec.param_maps()
    evaluator = RegressionEvaluator(labelCol=S.LABEL, metricName="rmse")
    totals = [0.0] * len(maps)
    linear = _solved_from_sums(spec.model, maps)
    for fold in range(folds):
        rest, held = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        prepared = Pipeline(stages=preparation(numeric, categorical, spec.scale,
                                               spec.center)).fit(rest)
        vectors = [prepared.transform(part).select("features", S.LABEL) for part in (rest, held)]
        if linear:
            solved = _scores_from_sums(spec, maps, *vectors, evaluator)
            if solved is not None:
                totals = [total + rmse for total, rmse in zip(totals, solved)]
                continue
        fit_rows, check_rows = map(_packed, vectors)

        def score(fitted):
            index, model = next(fitted)
            return index, evaluator.evaluate(model.transform(check_rows))

        models = spec.model.fitMultiple(fit_rows, maps)
        with ThreadPool(min(parallelism, len(maps))) as pool:
            for index, rmse in pool.imap_unordered(score, [models] * len(maps)):
                totals[index] += rmse
        for rows in vectors:
            rows.unpersist()
    metrics = [total / folds for total in totals]
    best = maps[min(range(len(maps)), key=metrics.__getitem__)]
    pipeline = build_pipeline(spec.model.copy(best), numeric, categorical, spec.scale,
                              spec.center)
    return CrossValidated(pipeline.fit(train), metrics)


def train_model(spec: ModelSpec, train: DataFrame, test: DataFrame, index=1, folds=S.CV_FOLDS,
                parallelism=None, seed=S.SEED, keys=tuple(S.TRIP_KEYS),
                columns=None, model_path=None) -> Trained:
    """Cross-validate one learner, predict the test rows and report.

    ``train`` and ``test`` are read many times; pass tables that have been written out.
    """
    ensure_checkpoints(train.sparkSession)
    numeric, categorical = columns or usable_columns(train)
    started = time.monotonic()
    fitted = cross_validate(spec, train, numeric, categorical, folds, parallelism, seed, keys)
    trained_at = time.monotonic()
    predictions = materialise(
        fitted.best_model.transform(test).select(
            *[k for k in keys if k in test.columns], S.LABEL, "prediction"), spec.name)
    test_rows = predictions.count()
    predicted_at = time.monotonic()
    metrics = evaluation.evaluate(predictions).first()
    if model_path:
        save_model(fitted.best_model, model_path)
    maps = spec.param_maps()
    summary = {
        "model_index": index, "model": spec.name, "cv_folds": folds,
        "param_grid_size": len(maps), "train_time_sec": round(trained_at - started, 4),
        "prediction_time_sec": round(predicted_at - trained_at, 4), "test_rows": test_rows,
        **{m: metrics[m] for m in evaluation.METRICS}, "best_params": best_params(fitted.best_model),
        "hdfs_model_path": model_path or "", "local_model_path": "",
    }
    rows = [(spec.name, param_text(p), float(v)) for p, v in zip(maps, fitted.avg_metrics)]
    return Trained(fitted.best_model, predictions, summary, rows)


def train_all(specs, train: DataFrame, test: DataFrame, model_root=None, **options) -> list:
    """Train every spec on the same rows and columns."""
    numeric, categorical = usable_columns(train)
    clean = [nan_to_null(df) for df in (train, test)]
    return [train_model(spec, *clean, index=i, columns=(numeric, categorical),
                        model_path=f"{model_root}/model{i}" if model_root else None, **options)
            for i, spec in enumerate(specs, 1)]


_LOG_SCHEMA = ("model_index int, model string, cv_folds int, param_grid_size int, "
               "train_time_sec double, prediction_time_sec double, test_rows long, rmse double, "
               "mae double, r2 double, best_params string, hdfs_model_path string, "
               "local_model_path string")


def training_log(spark, results) -> DataFrame:
    """One row per trained model."""
    names = [part.split()[0] for part in _LOG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.summary[n] for n in names) for r in results],
                                 _LOG_SCHEMA)


def evaluation_table(spark, results) -> DataFrame:
    return training_log(spark, results).select("model", *evaluation.METRICS)


def cv_results(spark, results) -> DataFrame:
    """One row per model and grid point."""
    return spark.createDataFrame([row for r in results for row in r.cv_rows],
                                 "model string, params string, avg_cv_rmse double")


def best_result(results) -> Trained:
    return min(results, key=lambda r: r.summary["rmse"])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return evaluation.prediction_report(model.transform(df))


def save_model(model: PipelineModel, path) -> None:
    model.write().overwrite().save(path)


def load_model(path) -> PipelineModel:
    return PipelineModel.load(path)


def ablation_models(seed=S.SEED) -> dict:
    """Learners with fixed parameters for comparing feature sets."""
    return {
        "LinearRegression": LinearRegression(labelCol=S.LABEL, regParam=0.1, elasticNetParam=0.0),
        "RandomForestRegressor": RandomForestRegressor(labelCol=S.LABEL, maxDepth=8, numTrees=50,
                                                       seed=seed),
        "GBTRegressor": GBTRegressor(labelCol=S.LABEL, maxDepth=5, maxIter=30, seed=seed),
    }


def feature_ablation(trips: DataFrame, models=None, target=S.TARGET, ratio=S.TRAIN_RATIO,
                     seed=S.SEED) -> DataFrame:
    """Train and prediction time and quality of each learner with all or selected features."""
    spark = trips.sparkSession
    ensure_checkpoints(spark)
    rows = trips.where(F.col(target) > 0).withColumnRenamed(target, S.LABEL)
    train, test = (materialise(part) for part in split_train_test(rows, ratio, seed))
    exclude = (*(S.NOT_CANDIDATES - {"daynum", "n_sensor_points", "fuel_valid_points"}), S.LABEL)
    numeric, categorical = usable_columns(train, exclude)
    cases = {"all_features": (numeric, categorical),
             "selected_features": ([c for c in ABLATION_NUMERIC if c in numeric],
                                   [c for c in ABLATION_CATEGORICAL if c in categorical])}
    out = []
    for case, (numbers, texts) in cases.items():
        for name, model in (models or ablation_models(seed)).items():
            started = time.monotonic()
            fitted = build_pipeline(model, numbers, texts).fit(train)
            trained_at = time.monotonic()
            predictions = materialise(fitted.transform(test).select(S.LABEL, "prediction"))
            n = predictions.count()
            predicted_at = time.monotonic()
            m = evaluation.evaluate(predictions).first()
            out.append((case, name, len(numbers) + len(texts), trained_at - started,
                        predicted_at - trained_at, n, m["rmse"], m["mae"], m["r2"]))
    return spark.createDataFrame(
        out, "feature_set string, model string, num_features_before_encoding int, "
             "train_time_sec double, prediction_time_sec double, test_rows long, rmse double, "
             "mae double, r2 double")
