"""Samples to trips: gaps between samples, integrals over time, and the trip feature table.

A trip may hold a large share of all samples, so no step puts a whole trip into one task:

* For integrals, samples of equal time become one point, combined before the shuffle.  Points are
  joined to segments level by level: minutes, days, the trip.  A level sees one row per group of the
  level below, so its size depends on the time a trip spans, not on the number of samples.
* For row-level successors, sampled splitters cut the rows in their order into pieces of about
  equal size, wherever a trip or a time begins.  A second look at the first row of each piece
  joins the ends.
* Counts, means and percentile sketches need no order and merge, so they are aggregated
  straight from the scan and only their partial states are shuffled.
"""

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..functions import derive
from ..sources.shared import materialise
from . import quantiles
from .joins import attach_vehicle

LEVELS_S = (60.0, 86400.0)  # lengths of the levels of time below a whole trip, in seconds


def clamp_gap(gap, max_gap_s=S.MAX_GAP_S):
    """The gap in seconds if it lies strictly between zero and the limit, else 0."""
    return F.when((gap > 0) & (gap < max_gap_s), gap).otherwise(0.0)


def gap_clamp(df: DataFrame, keys=tuple(S.TRIP_KEYS), time="time_seconds", tie=None,
              max_gap_s=S.MAX_GAP_S, output="dt_s") -> DataFrame:
    """Add the seconds from each sample to the next one of its trip.

    0 for the last sample and for gaps of ``max_gap_s`` or more.  ``tie`` names a unique column
    that orders samples of equal time.
    """
    following = "next_" + time
    led = lead_next_sample(df, keys, time, tie, ())
    gap = F.col(following) - F.col(time)
    return led.withColumn(output, clamp_gap(gap, max_gap_s)).drop(following)


def lead_next_sample(df: DataFrame, keys=tuple(S.TRIP_KEYS), time="time_seconds", tie=None,
                     carry=("speed",)) -> DataFrame:
    """Add the next sample's time (``next_<time>``) and carried values, however far away it is.

    The rows are written once in the order of keys, time and ``tie``, cut into ranges by sampled
    splitters, and the window runs per range.  The last row of a range takes its successor from
    the first row of the next, of which there is one per range.  Without ``tie``, samples of equal
    time are ordered by a hash of their values; only equal rows can then tie.  NULL keys are keys
    like others, and samples without a time come first in their trip.
    """
    names = [time, *carry]
    by = F.col(tie) if tie else F.xxhash64(*[
        F.to_json(F.struct(F.col(c))) if t.startswith(("map", "struct", "array", "variant"))
        else F.col(c) for c, t in df.dtypes])
    order = [F.col(c).asc_nulls_first() for c in (*keys, time, "_tie")]
    cut = df.withColumn("_tie", by).repartitionByRange(*order).sortWithinPartitions(*order)
    # Written, so that every later step sees the same cut even after a task is run again.
    rows = materialise(cut.withColumn("_piece", F.spark_partition_id()), "ordered")
    own = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                   *[F.col(n).alias(f"n{i}") for i, n in enumerate(names)])
    place = F.struct(*[F.col(c) for c in (*keys, time, "_tie")])
    heads = rows.groupBy("_piece").agg(F.min_by(own, place).alias("_head"))
    after = F.lead("_head").over(Window.orderBy("_piece"))  # one row per piece
    heads = heads.select("_piece", after.alias("_head"))
    led = F.lead(own).over(Window.partitionBy("_piece").orderBy(*order))
    found = rows.withColumn("_next", led).join(F.broadcast(heads), "_piece").withColumn(
        "_next", F.coalesce("_next", "_head"))
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(f"_next.k{i}").eqNullSafe(F.col(key))
    return found.select(*df.columns, *[F.when(same, F.col(f"_next.n{i}")).alias("next_" + n)
                                       for i, n in enumerate(names)])


def _integrals(v, f, dt, stop, idle):
    return {"observed_seconds": dt, "distance_km": v * dt / S.SECONDS_PER_HOUR,
            "fuel_used_l": f * dt / S.SECONDS_PER_HOUR,
            "stop_go_s": F.when(v < stop, dt).otherwise(0.0),
            "idle_s": F.when(v < idle, dt).otherwise(0.0)}


def segment_integrals(df: DataFrame, keys=tuple(S.TRIP_KEYS), time="time_seconds",
                      speed="speed", fuel="fuel_rate_est_lhr", tie=None,
                      max_gap_s=S.MAX_GAP_S, stop=S.STOP_GO_KMH, idle=S.IDLE_KMH,
                      levels=LEVELS_S) -> DataFrame:
    """Per trip: observed seconds, distance, fuel, and seconds below the stop and idle speeds.

    Left Riemann sums over the gaps; a missing or NaN speed counts as 0 km/h, a missing or NaN fuel
    rate adds nothing.  Of samples of equal time the last by ``tie`` counts, the only one with a
    gap.  ``fuel_used_l`` is 0, not NULL, for a trip without any fuel rate.  Samples without a
    time are left out; NULL keys are keys like others.
    """
    zero = F.lit(0.0)
    v = F.coalesce(F.nanvl(F.col(speed).cast("double"), zero), zero)
    f = F.coalesce(F.nanvl(F.col(fuel).cast("double"), zero), zero)
    last = F.col(tie) if tie else F.xxhash64(speed, fuel)
    timed = df.where(F.col(time).isNotNull() & ~F.isnan(F.col(time).cast("double")))
    names = list(_integrals(v, f, zero, stop, idle))
    # A segment: its first and last time, the values at its end, and what it sums up.
    segments = timed.groupBy(*keys, F.col(time).cast("double").alias("first")).agg(
        F.max_by(F.struct(v.alias("v"), f.alias("f")), F.struct(last.isNotNull(), last)).alias("e"))
    segments = segments.select(*keys, "first", F.col("first").alias("last"), "e",
                               *[zero.alias(n) for n in names])
    for length in (*levels, None):
        group = [*keys, "_part"] if length else list(keys)
        if length:
            segments = segments.withColumn("_part", F.floor(F.col("first") / length))
        following = F.lead("first").over(Window.partitionBy(*group).orderBy("first"))
        across = clamp_gap(following - F.col("last"), max_gap_s)
        segments = segments.withColumn("_dt", across)
        between = _integrals(F.col("e.v"), F.col("e.f"), F.col("_dt"), stop, idle)
        segments = segments.groupBy(*group).agg(
            F.min("first").alias("first"), F.max("last").alias("last"),
            F.max_by("e", "last").alias("e"),
            *[F.sum(F.col(n) + between[n]).alias(n) for n in names]).drop("_part")
    return segments.select(*keys, *names)


# Output column, aggregate, input column; percentiles come from one sketch per signal.
_MEANS = {"speed_mean": "speed", "maf_mean": "maf", "rpm_mean": "rpm",
          "abs_load_mean": "abs_load", "oat_mean": "oat",
          "hv_current_mean": "hv_battery_current", "hv_soc_mean": "hv_battery_soc",
          "hv_voltage_mean": "hv_battery_vol", "fuel_rate_mean_lhr": "fuel_rate_est_lhr"}
_PERCENTILES = {"speed": {"speed_median": 0.5, "speed_p95": 0.95},
                "maf": {"maf_p95": 0.95}, "rpm": {"rpm_p95": 0.95}}


def trip_statistics(df: DataFrame, keys=tuple(S.TRIP_KEYS), time="time_seconds",
                    accuracy=10000, exact=False) -> DataFrame:
    """Per trip: the statistics that do not depend on the order of samples.

    Percentiles are elements of the data; within one part in ``accuracy`` by rank, or ``exact`` for
    two more passes per signal.
    """
    aggs = [F.min("daynum").alias("daynum"), F.count("*").alias("n_sensor_points"),
            ((F.max(time) - F.min(time)) / 60).alias("duration_min"),
            F.count("fuel_rate_est_lhr").alias("fuel_valid_points")]
    aggs += [F.avg(c).alias(out) for out, c in _MEANS.items()]
    outputs = {}
    for signal, wanted in _PERCENTILES.items():
        if exact:
            continue
        probabilities = F.array(*[F.lit(p) for p in wanted.values()])
        aggs.append(F.percentile_approx(signal, probabilities, accuracy).alias("_q_" + signal))
        outputs.update({out: F.col("_q_" + signal)[i] for i, out in enumerate(wanted)})
    found = df.groupBy(*keys).agg(*aggs)
    if not exact:
        return found.withColumns(outputs).drop(*["_q_" + s for s in _PERCENTILES])
    for signal, wanted in _PERCENTILES.items():
        found = join_trips(found, quantiles.grouped_quantiles(
            df, keys, signal, list(wanted.values()), list(wanted), exact=True), keys, "left")
    return found


def join_trips(left: DataFrame, right: DataFrame, keys=tuple(S.TRIP_KEYS),
               how="inner") -> DataFrame:
    """Join on trip keys, a NULL key being equal to a NULL key."""
    right = right.withColumnsRenamed({k: "_r_" + k for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_r_" + k))
    return left.join(right, same, how).drop(*["_r_" + k for k in keys])


def trip_features(telemetry: DataFrame, vehicles: DataFrame, time="time_seconds", tie=None,
                  max_gap_s=S.MAX_GAP_S, min_distance_km=S.MIN_TRIP_KM, stop=S.STOP_GO_KMH,
                  idle=S.IDLE_KMH, accuracy=10000, exact=False) -> DataFrame:
    """One row per trip with the columns of ``TRIP_FEATURE_SCHEMA``.

    ``telemetry`` is the output of ``prepare_telemetry``.  Vehicle attributes are joined to the
    finished trips, not to every sample.  Percentiles are elements of the data, by rank within one
    part in ``accuracy``, or ``exact``.  Samples with a NULL key form trips of their own.
    """
    keys = list(S.TRIP_KEYS)
    statistics = trip_statistics(telemetry, keys, time, accuracy, exact)
    integrals = segment_integrals(telemetry, keys, time, tie=tie, max_gap_s=max_gap_s,
                                  stop=stop, idle=idle)
    long_enough = integrals.where(F.col("distance_km") >= min_distance_km)
    trips = attach_vehicle(join_trips(statistics, long_enough, keys), vehicles)
    trips = trips.withColumn("fuel_used_l",
                             F.when(F.col("fuel_valid_points") > 0, F.col("fuel_used_l")))
    return trips.withColumns({
        "trip_id": derive.trip_key(keys),
        "stop_go_ratio": derive.safe_ratio("stop_go_s", "observed_seconds"),
        "idle_time_min": F.col("idle_s") / 60,
        "fuel_l_per_100km": derive.safe_ratio(100 * F.col("fuel_used_l"), "distance_km"),
    }).select(*S.TRIP_FEATURE_SCHEMA.names)


def longest_trips(trips: DataFrame, n=S.LONGEST_TRIPS) -> DataFrame:
    """The n trips with the greatest distance; equal distances in key order."""
    return trips.orderBy(F.desc("distance_km"), *S.TRIP_KEYS).limit(n)


def trip_aggregation(telemetry: DataFrame, keys=tuple(S.TRIP_KEYS)) -> DataFrame:
    """Light per-trip summary: count, mean and top speed, mean engine speed and air flow."""
    return telemetry.groupBy(*keys).agg(
        F.count("*").alias("records"), F.avg("speed").alias("avg_speed"),
        F.max("speed").alias("max_speed"), F.avg("rpm").alias("avg_rpm"),
        F.avg("maf").alias("avg_maf"))
