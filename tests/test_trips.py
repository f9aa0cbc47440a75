"""Gaps, integrals and trip features on small tables worked out by hand."""

import math

import pytest
from pyspark.sql import Window, functions as F

from tripspark import schema as S
from tripspark.functions import derive
from tripspark.operators import cleaning, trips

SAMPLE = "vehid string, tripid string, time double, speed double, fuel_rate double, maf double"


def samples(spark, rows):
    df = spark.createDataFrame([("1", "1", *r) for r in rows], SAMPLE)
    return cleaning.prepare_telemetry(df)


def gaps(spark, seconds):
    df = samples(spark, [(1000.0 * s, 10.0, None, None) for s in seconds])
    rows = trips.gap_clamp(df).select("time_seconds", "dt_s").collect()
    return [r["dt_s"] for r in sorted(rows, key=lambda r: r["time_seconds"])]


def integrals(spark, rows, **options):
    return trips.segment_integrals(samples(spark, rows), **options).first().asDict()


def test_two_samples(spark):
    assert gaps(spark, [0, 100]) == [100.0, 0.0]
    out = integrals(spark, [(0.0, 36.0, None, None), (100000.0, 0.0, None, None)])
    assert out["distance_km"] == pytest.approx(1.0)
    assert out["observed_seconds"] == 100.0


def test_gap_limits(spark):
    assert gaps(spark, [0, 3599, 7199, 10800]) == [3599.0, 0.0, 0.0, 0.0]


def test_equal_times(spark):
    assert gaps(spark, [5, 5]) == [0.0, 0.0]


def test_gap_across_chunks(spark):
    edge = trips.LEVELS_S[-1]
    assert gaps(spark, [edge - 10, edge + 3000, edge + 3500]) == [3010.0, 500.0, 0.0]
    assert gaps(spark, [edge - 1, edge, edge + 3599]) == [1.0, 3599.0, 0.0]
    rows = [(1000.0 * s, 36.0, 2.0, None) for s in (edge - 10, edge + 90, 5 * edge, 5 * edge + 50)]
    out = integrals(spark, rows)
    assert (out["observed_seconds"], out["distance_km"]) == (150.0, pytest.approx(1.5))
    assert out["fuel_used_l"] == pytest.approx(150 * 2 / 3600)


def test_missing_speed_counts_as_standing(spark):
    flags = samples(spark, [(0.0, None, None, None)]).first()
    assert (flags["is_stop_go"], flags["is_idle"]) == (0, 0)
    out = integrals(spark, [(0.0, None, None, None), (60000.0, 50.0, None, None)])
    assert (out["stop_go_s"], out["idle_s"], out["distance_km"]) == (60.0, 60.0, 0.0)


def test_fuel_paths(spark):
    df = samples(spark, [(0.0, 1.0, 2.0, 5.0), (1.0, 1.0, None, 10.0), (2.0, 1.0, None, None),
                         (3.0, 1.0, math.nan, 10.0)])
    rates = [r[0] for r in df.orderBy("time").select("fuel_rate_est_lhr").collect()]
    from_air = 10 / 14.7 / 745 * 3600
    assert rates == [2.0, pytest.approx(from_air), None, pytest.approx(from_air)]


def test_last_of_equal_times_decides(spark):
    rows = [("1", "1", 0.0, 36.0, 1), ("1", "1", 0.0, 72.0, 2), ("1", "1", 100000.0, 0.0, 3)]
    df = spark.createDataFrame(rows, "vehid string, tripid string, time double, speed double, "
                                     "sample_id long")
    df = cleaning.cast_ids(df).withColumn("fuel_rate_est_lhr", F.lit(None).cast("double"))
    out = trips.segment_integrals(df, tie="sample_id").first()
    assert out["distance_km"] == pytest.approx(2.0)
    shuffled = trips.segment_integrals(df.orderBy(F.desc("sample_id"))).first()
    assert shuffled["distance_km"] == trips.segment_integrals(df).first()["distance_km"]


def telemetry(spark, rows):
    """rows: (vehid, tripid, seconds, speed, fuel)"""
    df = spark.createDataFrame(rows, "vehid string, tripid string, seconds double, "
                                     "speed double, fuel_rate double")
    other = {f.name: F.lit(None).cast("double") for f in S.TELEMETRY_SCHEMA
             if f.name not in ("vehid", "tripid", "speed", "fuel_rate")}
    other.update(time=F.col("seconds") * 1000, daynum=F.lit(1.0))
    return cleaning.prepare_telemetry(df.withColumns(other).drop("seconds"))


def vehicle_table(spark):
    return spark.createDataFrame([("1", "ICE", "Car", None, "FWD", 1500.0, "I4", 2.0, "I4")],
                                 S.VEHICLE_SCHEMA)


def test_trip_features_of_known_trips(spark):
    rows = [("1", "1", 0.0, 36.0, 2.0), ("1", "1", 1800.0, 72.0, None),
            ("1", "1", 3600.0, 0.0, 4.0), ("1", "2", 0.0, 0.0, 1.0), ("1", "2", 60.0, 0.0, 1.0),
            ("9", "1", 0.0, 60.0, None), ("9", "1", 600.0, 60.0, None)]
    out = trips.trip_features(telemetry(spark, rows), vehicle_table(spark))
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in S.TRIP_FEATURE_SCHEMA]
    found = {r["trip_id"]: r for r in out.collect()}
    assert set(found) == {"1_1", "9_1"}, "the trip without distance is dropped"
    a, b = found["1_1"], found["9_1"]
    assert a["distance_km"] == pytest.approx(18 + 36)
    assert a["fuel_used_l"] == pytest.approx(1.0) and a["fuel_valid_points"] == 2
    assert a["fuel_l_per_100km"] == pytest.approx(100 / 54)
    assert (a["duration_min"], a["observed_seconds"]) == (60.0, 3600.0)
    assert (a["speed_median"], a["speed_p95"], a["vehtype"]) == (36.0, 72.0, "ICE")
    assert b["fuel_used_l"] is None and b["fuel_l_per_100km"] is None
    assert b["vehtype"] is None, "unknown vehicle"


def test_safe_ratio_needs_a_positive_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -1.0), (1.0, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(derive.safe_ratio("n", "d")).collect()] == [None, None, 0.5]


def plain_features(df, max_gap):
    """The integrals written the simple way, one window over the whole trip."""
    w = Window.partitionBy("vehid", "tripid").orderBy("time_seconds", "sample_id")
    gap = F.lead("time_seconds").over(w) - F.col("time_seconds")
    dt = F.when((gap > 0) & (gap < max_gap), gap).otherwise(0.0)
    v = F.coalesce("speed", F.lit(0.0))
    return (df.withColumn("dt", dt).groupBy("vehid", "tripid").agg(
        F.sum("dt").alias("observed_seconds"), F.sum(v * F.col("dt") / 3600).alias("distance_km"),
        F.sum(F.when(v < 5, F.col("dt")).otherwise(0.0)).alias("stop_go_s")))


@pytest.mark.parametrize("levels", [(), (60.0, 86400.0), (7.0, 500.0, 4e5)])
def test_one_hot_trip_with_copies(spark, levels):
    """A trip that holds most samples, with many copies of one time, gives the plain result."""
    n = 20000
    df = spark.range(n).selectExpr(
        "id as sample_id", "if(id % 3 = 0, cast(id % 50 as string), 'hot') as vehid",
        "'1' as tripid",
        # A third of all samples share one time; the rest spread over 40 days.
        "if(id % 3 = 1, 500000.0D, cast((id * 7919) % 3456000 as double)) as time_seconds",
        "cast((id * 31) % 120 as double) as speed",
        "cast((id * 17) % 9 as double) as fuel_rate_est_lhr")
    plain = {r["vehid"]: r for r in plain_features(df, 3600).collect()}
    mine = trips.segment_integrals(df, tie="sample_id", levels=levels).collect()
    assert len(mine) == len(plain)
    for r in mine:
        for c in ("observed_seconds", "distance_km", "stop_go_s"):
            assert r[c] == pytest.approx(plain[r["vehid"]][c], rel=1e-9), (r["vehid"], c)


@pytest.mark.parametrize("pieces", [1, 4, 37])
def test_lead_over_pauses_and_copies(spark, pieces, monkeypatch):
    ranged = type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange",
                        lambda self, *order: ranged(self, pieces, *order))
    df = spark.range(4000).selectExpr(
        "id as sample_id", "if(id % 2 = 0, 'hot', cast(id % 3 as string)) as vehid",
        "'1' as tripid",
        # Long pauses, and two times that hold a third of the samples.
        "case when id % 6 = 0 then 7000000.0D when id % 6 = 2 then 7000100.0D "
        "else cast((id * 7919 % 1000) * 50000 as double) end as time_seconds",
        "if(id % 7 = 0, null, cast(id as double)) as speed")
    w = Window.partitionBy("vehid", "tripid").orderBy("time_seconds", "sample_id")
    plain = df.select("sample_id", F.lead("time_seconds").over(w), F.lead("speed").over(w))
    mine = trips.lead_next_sample(df, tie="sample_id").select(
        "sample_id", "next_time_seconds", "next_speed")
    assert sorted(map(str, mine.collect())) == sorted(
        map(str, plain.toDF(*mine.columns).collect()))


def test_untimed_sample_keeps_its_row(spark):
    df = samples(spark, [(None, 10.0, None, None), (0.0, 10.0, None, None),
                         (1000.0, 10.0, None, None)])
    assert sorted(r[0] for r in trips.gap_clamp(df).select("dt_s").collect()) == [0.0, 0.0, 1.0]


def test_null_keys_and_nan_speeds_are_kept(spark):
    rows = [(None, "1", 0.0, 36.0), (None, "1", 100.0, 0.0), ("1", None, 0.0, math.nan),
            ("1", None, 50.0, 72.0), ("1", None, 100.0, math.nan), ("2", "2", 0.0, 50.0)]
    df = spark.createDataFrame(rows, "vehid string, tripid string, time_seconds double, "
                                     "speed double").withColumns({
        c: F.lit(None).cast("double") for c in (
            "daynum", "fuel_rate_est_lhr", "maf", "rpm", "abs_load", "oat", "hv_battery_current",
            "hv_battery_soc", "hv_battery_vol")})
    found = {r[:2]: r["distance_km"] for r in trips.segment_integrals(df).collect()}
    assert found == {(None, "1"): 1.0, ("1", None): 1.0, ("2", "2"): 0.0}
    vehicles = spark.createDataFrame([], "vehid string, vehtype string, vehclass string, "
                                         "transmission string, drive_wheels string, gen_weight "
                                         "double, eng_type string, eng_dis double, eng_conf string")
    for exact in (False, True):
        kept = trips.trip_features(df, vehicles, exact=exact).collect()
        assert {r["distance_km"] for r in kept} == {1.0} and len(kept) == 2
    led = trips.lead_next_sample(df).collect()
    assert len(led) == 6 and sum(r["next_time_seconds"] is None for r in led) == 3
