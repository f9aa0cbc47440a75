"""Exact quantiles, profiles and feature selection against brute force."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tripspark.operators import profiling, quantiles, selection

PROBS, NAMES = [0.01, 0.5, 0.9], ["a", "b", "c"]
FEW = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute(values):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return tuple(ordered[max(0, math.ceil(p * len(ordered)) - 1)] for p in PROBS)


@given(st.lists(st.one_of(st.none(), st.just(math.nan), st.floats(-50, 50, width=16)),
                min_size=1, max_size=60).filter(lambda v: any(x == x and x is not None
                                                              for x in v)))
@FEW
def test_exact_small(spark, values):
    df = spark.createDataFrame([("k", v) for v in values], "g string, x double")
    got = quantiles.grouped_quantiles(df, ["g"], "x", PROBS, NAMES, exact=True).first()
    assert tuple(got)[1:] == brute(values)
    flat = quantiles.column_quantiles(df, ["x"], PROBS, NAMES, exact=True).first()
    assert tuple(flat)[1:] == brute(values)


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_exact_with_a_coarse_sketch(spark, accuracy):
    """The answer is exact however coarse the bracketing sketch is."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 else "cold", rng.choice([7.0, rng.gauss(0, 10), float(i % 11)]))
            for i in range(30000)]
    rows += [("hot", 1.5)] * 5000 + [(None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(8)
    got = quantiles.grouped_quantiles(df, ["g"], "x", PROBS, NAMES, True, accuracy).collect()
    expected = {g: brute([x for k, x in rows if k == g]) for g in ("hot", "cold", None)}
    assert {r["g"]: tuple(r)[1:] for r in got} == expected
    whole = quantiles.column_quantiles(df, ["x"], PROBS, NAMES, True, accuracy).first()
    assert tuple(whole)[1:] == brute([x for _, x in rows])


def test_trim_keeps_both_bounds(spark):
    df = spark.range(1, 1001).withColumn("x", F.col("id").cast("double"))
    kept = quantiles.quantile_trim(df, "x").agg(F.min("x"), F.max("x"), F.count("*")).first()
    assert tuple(kept) == (10.0, 990.0, 981)


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a", None), (2, math.nan, "a", None), (3, None, None, None)],
        "i int, `x y` double, s string, empty string")
    tables = {"t": df}
    missing = {r["column_name"]: (r["null_count"], r["null_pct"])
               for r in profiling.missing_values(tables).collect()}
    assert missing == {"i": (0, 0.0), "x y": (2, 66.6667), "s": (1, 33.3333), "empty": (3, 100.0)}
    numbers = {r["column_name"]: r for r in profiling.numeric_summary(tables).collect()}
    assert numbers["x y"]["non_null_count"] == 1 and numbers["x y"]["stddev"] is None
    assert numbers["i"]["variance"] == 1.0
    for exact in (False, True):
        texts = {r["column_name"]: r[2]
                 for r in profiling.categorical_summary(tables, exact).collect()}
        assert texts == {"s": 1, "empty": 0}
    types = [tuple(r) for r in profiling.column_types(tables).collect()]
    assert ("t", "x y", "double") in types


def test_long_texts_are_told_apart_whole(spark):
    base = "x" * 5000
    df = spark.createDataFrame([(base + "a",), (base + "b",), (base + "b",)], "s string")
    assert profiling.categorical_summary({"t": df}, exact=True).first()[2] == 2


def scores(spark, df, features):
    return {r["feature"]: r["score"]
            for r in selection.mutual_information(df, features, "y", bins=8).collect()}


def test_mutual_information(spark):
    df = spark.range(4000).selectExpr(
        "cast(id % 8 as double) as y", "cast(id % 8 as double) * 2 as same",
        "1.0D as constant", "cast(null as double) as empty",
        "cast(pmod(xxhash64(id), 8) as double) as noise")
    got = scores(spark, df, ["same", "constant", "empty", "noise"])
    assert got["same"] == pytest.approx(math.log(8))
    assert got["constant"] == pytest.approx(0.0, abs=1e-12) and got["empty"] is None
    assert 0 <= got["noise"] < 0.05
    ranked = selection.select_k_best(selection.mutual_information(
        df, ["same", "constant", "empty", "noise"], "y", bins=8), k=3).collect()
    chosen = {r["feature"]: (r["rank"], r["selected"]) for r in ranked}
    assert chosen["same"] == (1, 1) and chosen["empty"] == (4, 0)


def test_split_is_stable(spark):
    df = spark.range(2000).selectExpr("cast(id as string) as vehid", "'1' as tripid")
    train, test = selection.split_train_test(df)
    again, _ = selection.split_train_test(df.repartition(7).orderBy(F.desc("vehid")))
    keys = {r["vehid"] for r in train.collect()}
    assert keys == {r["vehid"] for r in again.collect()}
    assert len(keys) + test.count() == 2000 and 1300 < len(keys) < 1500
