"""Timed jobs that help to choose formats and to size clusters.

Work is timed with the ``noop`` sink.  A ``count`` would let the optimizer drop every column and
aggregate that the count does not need.
"""

import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import joins, trips as trip_ops
from ..sources import audit, readers, writers

# --- fixed values: format and codec pairs ---------------------------------------------------
VARIANTS = [("parquet", "snappy"), ("parquet", "gzip"), ("parquet", "zstd"),
            ("avro", "snappy"), ("avro", "deflate"), ("orc", "snappy"), ("orc", "zlib"),
            ("csv", "gzip")]
# -----------------------------------------------------------------------------------------


def timed(action):
    """(result, seconds) of a call."""
    started = time.monotonic()
    result = action()
    return result, time.monotonic() - started


def run_fully(df: DataFrame) -> int:
    """Compute every row and column of the table; the number of rows is observed on the way."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
     .write.format("noop").mode("overwrite").save())
    return seen.get["n_rows"]


def has_avro(spark: SparkSession) -> bool:
    """Whether the optional Avro module is on the class path."""
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(
            "avro", spark._jsparkSession.sessionState().conf())
        return True
    except Exception:
        return False


def bench_ingest(df: DataFrame, root) -> DataFrame:
    """Time CSV read with inference, Parquet write and Parquet read of one table."""
    spark = df.sparkSession
    csv_path, parquet_path = f"{root}/raw_csv", f"{root}/parquet_snappy"
    _, put = timed(lambda: writers.write_csv(df, csv_path))
    parsed, infer = timed(lambda: readers.sanitize_columns(
        readers.read_csv_inferred(spark, csv_path)))
    _, scan = timed(lambda: run_fully(parsed))
    _, write = timed(lambda: writers.write_parquet(parsed, parquet_path))
    back = readers.read_parquet(spark, parquet_path)
    rows, read = timed(lambda: run_fully(back))
    return spark.createDataFrame([
        ("raw_csv", "write", put, rows, "Spark write CSV"),
        ("spark_csv", "read", infer + scan, rows, "Spark read CSV with inferred schema"),
        ("spark_parquet_snappy", "write", write, rows, "Spark write Parquet Snappy"),
        ("spark_parquet_snappy", "read", read, rows, "Spark read Parquet Snappy"),
    ], "method string, operation string, runtime_sec double, row_count long, details string")


def bench_storage(df: DataFrame, root, variants=None, files=8) -> DataFrame:
    """Write and read time, size and row parity per format and codec, fastest read first."""
    spark = df.sparkSession
    source = df.count()
    rows, sizes = [], None
    for fmt, codec in variants or VARIANTS:
        if fmt == "avro" and not has_avro(spark):
            continue
        path = f"{root}/{fmt}_{codec}"
        _, write = timed(lambda: writers.write_variant(df, path, fmt, codec, files))
        back = readers.read_format(spark, fmt, path, df.schema,
                                   **({"header": "true"} if fmt == "csv" else {}))
        found, read = timed(lambda: run_fully(back))
        rows.append((fmt, codec, write, read, found, source, path))
        size = audit.path_size(spark, path).select(
            F.lit(fmt).alias("format"), F.lit(codec).alias("compression"),
            F.lit(path).alias("hdfs_path"), F.col("size_mb").alias("hdfs_size_mb"))
        sizes = size if sizes is None else sizes.unionByName(size)
    runs = spark.createDataFrame(
        rows, "format string, compression string, write_time_sec double, read_time_sec double, "
              "read_rows long, source_rows long, hdfs_path string")
    return join_sizes(runs, sizes)


def join_sizes(runs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Attach stored sizes by format, codec and path; fastest read, then smallest, first."""
    return (runs.join(sizes, ["format", "compression", "hdfs_path"], "left")
            .select(*runs.columns, "hdfs_size_mb").orderBy("read_time_sec", "hdfs_size_mb"))


def bench_processing(telemetry: DataFrame, vehicles: DataFrame,
                     trip_features: DataFrame | None = None) -> DataFrame:
    """Time scan, filter, dimension scan, join, trip aggregation and feature scan."""
    stages = {
        "read_trips": telemetry,
        "filter_valid_speed": telemetry.where(F.col("speed").isNotNull()),
        "read_vehicles": vehicles,
        "join_trips_vehicles": joins.join_broadcast(telemetry, vehicles, "vehid"),
        "trip_level_aggregation": trip_ops.trip_aggregation(telemetry),
    }
    if trip_features is not None:
        stages["read_trip_features"] = trip_features
    rows = []
    for name, df in stages.items():
        found, seconds = timed(lambda: run_fully(df))
        rows.append((name, found, seconds))
    return telemetry.sparkSession.createDataFrame(
        rows, "stage_name string, output_rows long, runtime_sec double")
