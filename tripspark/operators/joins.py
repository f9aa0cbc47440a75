"""Joins of a large fact table with a much smaller dimension."""

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from . import cleaning

# A dimension is copied to every executor only when the optimizer's bound is below this size.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
HOT_SHARES = 1000  # a key with more than 1/1000 of the fact rows is hot, so at most 999 are
SALTS = 32


def estimated_bytes(df: DataFrame) -> int:
    """Size of the result as Spark's optimizer bounds it; starts no job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def join_broadcast(fact: DataFrame, dimension: DataFrame, key, how="left",
                   limit=BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join without shuffling the fact table if the dimension is certain to be small.

    Beyond the limit Spark picks the join; adaptive execution still broadcasts a side that turns out
    small, and splits the partition of a hot key.
    """
    if how in ("left", "inner", "left_semi", "left_anti") and estimated_bytes(dimension) <= limit:
        dimension = F.broadcast(dimension)
    return fact.join(dimension, key, how)


def hot_keys(fact: DataFrame, key, shares=HOT_SHARES) -> DataFrame:
    """Keys with more than 1/``shares`` of the rows: fewer than ``shares`` of them."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col(key).isNotNull() & (F.col("_n") * shares > rows)).select(key)


def join_salted(fact: DataFrame, dimension: DataFrame, key, how="left", salts=SALTS,
                shares=HOT_SHARES) -> DataFrame:
    """Join by shuffling, the fact rows of hot keys spread over ``salts`` copies of their dimension
    rows; all other keys are joined as they are.

    Rows are dealt by their position, so columns of any type will do and equal rows part.  ``how``
    is inner, left, left_semi, left_anti, right or full.
    """
    if how in ("right", "full"):
        both = join_salted(fact, dimension, key, "inner" if how == "right" else "left", salts,
                           shares)
        alone = dimension.join(fact.select(key).distinct(), key, "left_anti")
        return both.unionByName(alone, allowMissingColumns=True)
    # Fewer than `shares` keys.
    hot = F.broadcast(hot_keys(fact, key, shares).withColumn("_hot", F.lit(True)))
    dealt = fact.withColumn("_place", F.monotonically_increasing_id()).join(
        hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod("_place", F.lit(salts))).otherwise(F.lit(0)))
    copies = dimension.join(hot, key, "left").withColumn("_salt", F.explode(F.when(
        F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.drop("_hot", "_place").join(copies.drop("_hot"), [key, "_salt"], how).drop("_salt")


def enrich_telemetry(telemetry: DataFrame, vehicles: DataFrame, key="vehid",
                     limit=BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Every telemetry row with its vehicle's attributes, NULL when the vehicle is unknown."""
    return join_broadcast(telemetry, vehicles, key, "left", limit)


def enriched_telemetry(raw_telemetry: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Raw telemetry to the cleaned, enriched sensor table."""
    return enrich_telemetry(cleaning.prepare_telemetry(raw_telemetry), vehicles)


def attach_vehicle(df: DataFrame, vehicles: DataFrame, columns=None) -> DataFrame:
    """Vehicle attributes for a table with few rows per vehicle (trips, per-vehicle sums).

    Spark picks the join: broadcast under its size threshold, else sort-merge, where adaptive
    execution splits a skewed vehicle.
    """
    return df.join(vehicles.select("vehid", *(columns or S.VEHICLE_ATTRIBUTES)), "vehid", "left")
