"""Cleaning, text, binning and quality operators."""

import math

import pytest
from pyspark.sql import functions as F

from tripspark.functions import derive, text
from tripspark.operators import cleaning, insights, joins, quality
from tripspark.sources import readers


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_engine_text(spark):
    texts = ["I4 2.0L", "2.0L", "ELECTRIC MOTOR", "V8 12.0L", None, ""]
    dis = column(spark, texts, "string", text.engine_displacement("x"))
    conf = column(spark, texts, "string", text.engine_configuration("x"))
    assert dis == [2.0, 2.0, None, 2.0, None, None]
    assert conf == ["I4", None, "ELECTRIC MOTOR", "V8 1", None, ""]
    loose = column(spark, ["V8 12.0L", "1.2.3L", "x"], "string", text.displacement_loose("x"))
    assert loose == [12.0, None, None]


def test_speed_bins(spark):
    telemetry = spark.createDataFrame(
        [(v, 1.0, 1.0, 1.0) for v in (-1.0, 0.0, 9.99, 10.0, 160.0, 160.01)],
        "speed double, fuel_rate_est_lhr double, rpm double, abs_load double")
    out = {r["speed_bin_kmh"]: r["rows_count"]
           for r in insights.fuel_by_speed_bin(telemetry).collect()}
    assert out == {0: 2, 10: 1, 160: 1}


def test_driving_modes(spark):
    modes = column(spark, [-1.0, 4.9, 5.0, 30.0, 80.0], "double", derive.driving_mode("x"))
    assert [m.split("_")[0] for m in modes] == ["stop", "stop", "city", "normal", "highway"]


def test_temperature_bins_go_down(spark):
    assert column(spark, [-0.5, -5.0, 4.9], "double", derive.floor_bin("x", 5.0)) == [-5, -5, 0]


def test_column_names(spark):
    df = spark.range(1).selectExpr("1", "2", "3", "4").toDF("A [x]", "a x", "%%", "a-x")
    assert readers.sanitize_columns(df).columns == ["a_x", "a_x_1", "column", "a_x_2"]


def test_nan_to_null_leaves_other_types(spark):
    df = spark.createDataFrame([(math.nan, 1, "NaN")], "a double, b int, c string")
    assert tuple(cleaning.nan_to_null(df).first()) == (None, 1, "NaN")
    assert math.isnan(cleaning.nan_to_null(df, ["b"]).first()["a"])


def test_tidy_text(spark):
    got = column(spark, ["a\tb\nc\rd", "nan", None, "nano"], "string", text.tidy_text("x"))
    assert got == ["a b c d", "", "", "nano"]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("x",), (None,)], "x string")
    assert [r[0] for r in cleaning.coerce_numeric(df, ["x"]).collect()] == [1.5, 2.0, None, None]


def test_prepare_vehicles(spark):
    raw = spark.createDataFrame(
        [(7, "ICE", "Car", "NO DATA", "FWD", 1500.0, "I4", "I4 2.0L")],
        "VehId int, `Vehicle Type` string, `Vehicle Class` string, Transmission string, "
        "`Drive Wheels` string, Generalized_Weight double, EngineType string, "
        "`Engine Configuration & Displacement` string")
    row = cleaning.prepare_vehicles(raw).first()
    assert row["vehid"] == "7" and row["transmission"] is None
    assert (row["eng_dis"], row["eng_conf"]) == (2.0, "I4")


def test_unknown_vehicle_is_listed_and_null(spark):
    facts = spark.createDataFrame([("1", 1), ("2", 2), ("2", 3), (None, 4)], "vehid string, i int")
    known = spark.createDataFrame([("1", "ICE")], "vehid string, vehtype string")
    assert [tuple(r) for r in quality.unknown_references(facts, known).collect()] == [("2", 2)]
    joined = joins.enrich_telemetry(facts, known)
    assert {(r["i"], r["vehtype"]) for r in joined.collect()} == {
        (1, "ICE"), (2, None), (3, None), (4, None)}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(spark, how):
    facts = spark.range(3000).selectExpr(
        "id", "case when id % 3 > 0 then 'hot' when id % 30 = 0 then null "
        "else cast(id % 50 as string) end as vehid", "map('k', id % 2) as m")
    known = spark.createDataFrame([("hot", 1.0), ("1", 2.0), ("6", None), ("none", 4.0),
                                   (None, 5.0)], "vehid string, w double")
    plain = facts.join(known, "vehid", how)
    salted = joins.join_salted(facts, known, "vehid", how).select(plain.columns)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_dimension_is_broadcast_by_the_optimizers_bound(spark):
    facts = spark.range(100).selectExpr("id", "cast(id % 5 as string) as vehid", "map('k', 1) as m")
    known = spark.createDataFrame([("1", 2.0)], "vehid string, w double")
    for limit in (0, joins.BROADCAST_LIMIT_BYTES):
        joined = joins.join_broadcast(facts, known, "vehid", limit=limit)
        assert joined.count() == 100 and joined.where("w = 2").count() == 20


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def test_characteristics_count_like_distinct(spark):
    telemetry = spark.createDataFrame([("1", "1"), ("1", "2"), ("2", "1"), ("1", "1")],
                                      "vehid string, tripid string")
    vehicles = spark.createDataFrame([("1", "x")], "vehid string, vehtype string")
    got = dict(map(tuple, insights.data_characteristics(telemetry, vehicles).collect()))
    assert got == {"trips_rows": "4", "vehicles_rows": "1", "unique_vehicles_in_trips": "2",
                   "unique_trips": "3", "trip_columns_count": "22", "vehicle_columns_count": "2"}


def test_histogram_ends(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 9.9, 10.0, 100.0, 100.1)], "x double")
    rows = {r["bin"]: r["rows_count"] for r in insights.histogram(df, "x", 0, 100, 10).collect()}
    assert rows[0] == 2 and rows[1] == 1 and rows[9] == 1 and sum(rows.values()) == 4


def test_trim_corrected_rate(spark):
    df = spark.createDataFrame(
        [(1, 3.0, None, None, None, None, 1.0, None, None, None),
         (2, None, 10.0, None, None, None, 4.0, 6.0, 2.0, None),
         (3, None, None, 50.0, 1200.0, 2.0, 5.0, None, None, -5.0),
         (4, None, 10.0, None, None, None, None, None, 1.0, 1.0)],
        "i int, fuel_rate double, maf double, abs_load double, rpm double, eng_dis double, "
        "stfb_1 double, stfb_2 double, ltfb_1 double, ltfb_2 double")
    got = [r[0] for r in df.orderBy("i").select(derive.fuel_rate_trim_corrected()).collect()]
    assert got[0] == 3.0 and got[3] is None
    assert math.isclose(got[1], 10 * (1 + 0.05 + 0.02) * 14.08)
    assert math.isclose(got[2], 50 / 100 * 1.225 * 2.0 * 1200 / 120 * 14.08)


def test_union_loose(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert [tuple(r) for r in cleaning.union_loose(a, b).orderBy("k").collect()] == [
        (1, "x", None), (2, None, "y")]


def test_coverage(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "maf double, fuel_rate_est_lhr double")
    got = {r["column_name"]: r["missing"] for r in insights.coverage_after_estimate(df).collect()}
    assert got == {"maf": 1, "fuel_rate_est_lhr": 1}
    empty = insights.missingness(df.where(F.lit(False)), ["maf"]).first()
    assert (empty["rows_total"], empty["null_count"], empty["null_share"]) == (0, 0, 0.0)
