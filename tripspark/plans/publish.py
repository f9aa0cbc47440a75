"""Publishing report tables as catalog tables over files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources import writers

# --- fixed values: published table name -> artifact of the jobs ----------------------------
EDA_TABLES = {
    "stage2_eda_data_characteristics": "eda_data_characteristics",
    "stage2_eda_missingness": "eda_missingness",
    "stage2_vehicle_type_distribution": "insight_01_vehicle_type_distribution",
    "stage2_fuel_by_vehicle_type": "insight_02_fuel_by_vehicle_type",
    "stage2_fuel_by_speed_bin": "insight_03_fuel_by_speed_bin",
    "stage2_stop_go_vs_fuel": "insight_04_stop_go_vs_fuel",
    "stage2_temperature_hvac_fuel": "insight_05_temperature_hvac_fuel",
    "stage2_engine_displacement_fuel": "insight_06_engine_displacement_fuel",
    "stage2_geo_activity": "insight_07_geo_activity",
    "stage2_trip_features": "trip_features",
}
_MODEL_LOG = ("model_index INT, model STRING, cv_folds INT, param_grid_size INT, "
              "train_time_sec DOUBLE, prediction_time_sec DOUBLE, test_rows BIGINT, rmse DOUBLE, "
              "mae DOUBLE, r2 DOUBLE, best_params STRING, hdfs_model_path STRING, "
              "local_model_path STRING")
_PREDICTION = ("actual_fuel_l_per_100km DOUBLE, predicted_fuel_l_per_100km DOUBLE, "
               "absolute_error DOUBLE")
# Artifact of a job -> declared columns of its dashboard table.
DASHBOARD_COLUMNS = {
    "data_audit": "file_path STRING, file_name STRING, extension STRING, size_mb DOUBLE, "
                  "row_count BIGINT, column_count STRING, excel_sheets STRING",
    "table_overview": "table_name STRING, row_count BIGINT, column_count INT, hdfs_path STRING",
    "column_types": "table_name STRING, column_name STRING, data_type STRING",
    "missingness": "table_name STRING, column_name STRING, total_rows BIGINT, "
                   "null_count BIGINT, null_pct DOUBLE",
    "numeric_summary": "table_name STRING, column_name STRING, non_null_count BIGINT, "
                       "mean DOUBLE, stddev DOUBLE, variance DOUBLE, min_value DOUBLE, "
                       "max_value DOUBLE",
    "numeric_quantiles": "table_name STRING, column_name STRING, p01 DOUBLE, p25 DOUBLE, "
                         "p50 DOUBLE, p75 DOUBLE, p99 DOUBLE",
    "categorical_summary": "table_name STRING, column_name STRING, approx_distinct_count BIGINT",
    "feature_selection": "feature STRING, feature_type STRING, score STRING, "
                         "feature_rank STRING, selected INT, selection_method STRING",
    "train_test_metadata": "dataset STRING, row_count BIGINT, columns_count INT, "
                           "hdfs_path STRING",
    "model_evaluation": "model STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE",
    "best_model": _MODEL_LOG,
    "model_training_log": _MODEL_LOG,
    "model_cv_results": "model STRING, params STRING, avg_cv_rmse DOUBLE",
    "specific_prediction": "model STRING, " + _PREDICTION,
    "model_prediction_samples": _PREDICTION,
    "ingest_benchmark": "method STRING, operation STRING, runtime_sec DOUBLE, "
                        "row_count STRING, details STRING",
    "storage_benchmark": "storage_format STRING, compression STRING, write_time_sec DOUBLE, "
                         "read_time_sec DOUBLE, read_rows BIGINT, source_rows BIGINT, "
                         "hdfs_path STRING, hdfs_size_mb DOUBLE",
    "processing_benchmark": "stage_name STRING, output_rows BIGINT, runtime_sec DOUBLE",
}
DASHBOARD_TABLES = {"stage4_" + a: a for a in DASHBOARD_COLUMNS}
# -----------------------------------------------------------------------------------------


def _quoted(path):
    return "'" + str(path).replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_parquet(spark: SparkSession, name, path) -> DataFrame:
    """Table over Parquet files; dropping it later leaves the files alone."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)}")
    return spark.table(name)


def publish_csv(spark: SparkSession, name, path, schema) -> DataFrame:
    """Table over CSV files with headers, typed by the given schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING csv OPTIONS (header 'true') "
              f"LOCATION {_quoted(path)}")
    return spark.table(name)


def as_declared(df: DataFrame, columns) -> DataFrame:
    """Rename and cast the columns, by position, to a declared column list."""
    declared = T.StructType.fromDDL(columns)
    if len(declared) != len(df.columns):
        raise ValueError(f"expected the columns {declared.names}, got {df.columns}")
    return df.select(*[F.col(have).cast(want.dataType).alias(want.name)
                       for have, want in zip(df.columns, declared)])


def publish_reports(spark: SparkSession, out, tables=EDA_TABLES, prefix="") -> DataFrame:
    """Publish the Parquet outputs of the EDA job found below ``out``."""
    report = []
    for name, artifact in tables.items():
        path = f"{out}/{artifact}"
        if _exists(spark, path):
            publish_parquet(spark, prefix + name, path)
            report.append((prefix + name, "published", path))
        else:
            report.append((prefix + name, "missing", path))
    return _report(spark, report)


def publish_dashboard(spark: SparkSession, artifacts: dict, root, tables=DASHBOARD_TABLES,
                      prefix="") -> DataFrame:
    """Write each available artifact as a small CSV and publish it; list those missing."""
    report = []
    for name, artifact in tables.items():
        df = artifacts.get(artifact)
        path = f"{root}/{artifact}"
        if df is None:
            report.append((prefix + name, "missing", path))
            continue
        df = as_declared(df, DASHBOARD_COLUMNS[artifact])
        writers.write_small_csv(df, path)
        publish_csv(spark, prefix + name, path, df.schema)
        report.append((prefix + name, "published", path))
    return _report(spark, report)


def _report(spark, rows):
    return spark.createDataFrame(rows, "table_name string, status string, path string")


def _exists(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
