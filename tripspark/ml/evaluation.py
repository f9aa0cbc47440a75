"""Prediction errors, model metrics and model comparison, as DataFrame aggregates."""

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..functions.text import model_display_name

METRICS = ["rmse", "mae", "r2"]


def prediction_error(df: DataFrame, label=S.LABEL, prediction="prediction") -> DataFrame:
    """Signed and absolute error of each prediction."""
    error = F.col(prediction) - F.col(label)
    return df.withColumns({"error": error, "abs_error": F.abs(error)})


def prediction_report(predictions: DataFrame, label=S.LABEL) -> DataFrame:
    """Actual and predicted consumption with the absolute error."""
    return predictions.select(
        F.col(label).alias("actual_fuel_l_per_100km"),
        F.col("prediction").alias("predicted_fuel_l_per_100km"),
        F.abs(F.col(label) - F.col("prediction")).alias("absolute_error"))


def evaluate(predictions: DataFrame, label=S.LABEL, prediction="prediction",
             by=()) -> DataFrame:
    """RMSE, MAE and R², over all rows or per group, in one aggregate."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    spread = F.var_pop(y) * F.count(y)
    return predictions.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("r2"))


def normalized_evaluation(evaluation: DataFrame, name="model") -> DataFrame:
    """Model metrics under display names and with numeric types."""
    return evaluation.select(model_display_name(name).alias("model_name"),
                             *[F.expr(f"try_cast(`{m}` as double)").alias(m) for m in METRICS])


def unpivot_metrics(evaluation: DataFrame, name="model_name") -> DataFrame:
    """One row per model and metric."""
    long = evaluation.unpivot([name], METRICS, "metric", "metric_value")
    return long.withColumn("metric", F.upper("metric"))


def best_model(evaluation: DataFrame, metric="rmse", name="model_name") -> DataFrame:
    """The model with the lowest value of the metric."""
    return (evaluation.orderBy(metric, name).limit(1)
            .select(name, F.lit(metric.upper()).alias("selection_metric"),
                    F.col(metric).alias("selection_value"), *METRICS))


def specific_prediction(predictions: DataFrame, model: str, order=()) -> DataFrame:
    """The prediction with the smallest absolute error."""
    columns = ["actual_fuel_l_per_100km", "predicted_fuel_l_per_100km", "absolute_error"]
    tie = list(order) or columns[:2]
    return (predictions.orderBy("absolute_error", *tie).limit(1)
            .select(F.lit(model).alias("model"), *columns))


def prediction_samples(predictions: DataFrame, n=100, order=()) -> DataFrame:
    """The first n predictions in key order."""
    tie = list(order) or predictions.columns
    return predictions.orderBy(*tie).limit(n)


def prediction_rows(predictions: DataFrame, model: str, limit=5000, order=(),
                    label=S.LABEL) -> DataFrame:
    """The usable ones of the first ``limit`` predictions of a model, numbered from 1 in key order.

    Rows are numbered before those without numbers are left out, so ids keep gaps.  A top-n
    selection comes first, so the single-partition window only ever sees ``limit`` rows.
    """
    keys = list(order) or [label, "prediction"]
    top = predictions.select(*dict.fromkeys([*order, label, "prediction"])).orderBy(
        *keys).limit(limit)
    numbered = top.withColumn("row_id", F.row_number().over(
        Window.partitionBy(F.lit(model)).orderBy(*keys)))
    usable = numbered.select(
        "row_id", F.expr(f"try_cast(`{label}` as double)").alias("label"),
        F.expr("try_cast(prediction as double)").alias("prediction")).dropna(
            subset=["label", "prediction"])
    return prediction_error(usable).select(
        F.lit(model).alias("model_name"), "row_id", "label", "prediction", "error", "abs_error")
