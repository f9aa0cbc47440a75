"""Readers for telemetry, vehicles and generic tables."""

import re

from pyspark.sql import DataFrame, SparkSession, types as T

from .. import schema as S


def read_csv(spark: SparkSession, path, schema=None, header=True, sep=",", null="null",
             **options) -> DataFrame:
    """CSV with a known schema, or with one inferred by an extra pass when none is given."""
    reader = spark.read.option("header", header).option("sep", sep).option("nullValue", null)
    reader = reader.options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_telemetry_csv(spark: SparkSession, path) -> DataFrame:
    """Weekly telemetry files (path or glob); columns are bound by position."""
    return read_csv(spark, path, S.TELEMETRY_SCHEMA, enforceSchema=True)


def read_vehicles_csv(spark: SparkSession, path) -> DataFrame:
    """The cleaned vehicle table."""
    return read_csv(spark, path, S.VEHICLE_SCHEMA, enforceSchema=True)


def read_csv_inferred(spark: SparkSession, path, **options) -> DataFrame:
    """CSV whose types Spark infers; costs a second pass, so for exploration only."""
    return read_csv(spark, path, **options)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_format(spark: SparkSession, fmt, path, schema=None, **options) -> DataFrame:
    """Any format Spark knows by name."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def jdbc_options(url, table, driver=None, split_by=None, lower=None, upper=None,
                 partitions=1, fetch_size=10000, **extra) -> dict:
    """Options of a JDBC read: one reader, or several that split a numeric column's range."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if driver:
        options["driver"] = driver
    if split_by is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs its lower and upper bound")
        options.update(partitionColumn=split_by, lowerBound=str(lower), upperBound=str(upper),
                       numPartitions=str(partitions))
    return options


def read_jdbc(spark: SparkSession, url, table, **options) -> DataFrame:
    """Database table, read in parallel when a split column is given (see ``jdbc_options``)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def safe_name(name: str) -> str:
    """Lower-case name of letters, digits and single underscores."""
    words = re.findall(r"[A-Za-z0-9]+", name)
    return "_".join(words).lower() or "column"


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Make all column names safe and unique; repeats get the suffix _1, _2 and so on."""
    uses: dict = {}
    names = []
    for name in map(safe_name, df.columns):
        again = uses.get(name, 0)
        uses[name] = again + 1
        names.append(f"{name}_{again}" if again else name)
    return df.toDF(*names)


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """Small table of constants with an explicit schema."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return spark.createDataFrame(rows, schema)


def sample_rows(df: DataFrame, n, keys) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*keys).limit(n)
