"""Checks for the constraints a database would have enforced."""

from pyspark.sql import DataFrame, functions as F

from .. import schema as S


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def null_violations(df: DataFrame, columns=tuple(S.MANDATORY_TELEMETRY)) -> DataFrame:
    """One row per mandatory column: how many rows lack a value."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def unknown_references(df: DataFrame, dimension: DataFrame, key="vehid") -> DataFrame:
    """Key values of the fact table that the dimension lacks, with their row counts.

    Rows are counted per key first, so the join sees one row per key however hot the key is.
    """
    per_key = (df.where(F.col(key).isNotNull())
               .groupBy(key).agg(F.count("*").alias("n_rows")))
    return per_key.join(dimension.select(key), key, "left_anti")
