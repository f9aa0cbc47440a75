"""Derived sensor columns, all plain Column expressions inside whole-stage codegen."""

from pyspark.sql import Column, functions as F

from .. import schema as S


def nan_null(column):
    """NaN becomes NULL; everything else is unchanged."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(c), c)


def fuel_rate_estimate(direct="fuel_rate", maf="maf", afr=S.STOICHIOMETRIC_AFR,
                       density=S.GASOLINE_DENSITY_G_PER_L) -> Column:
    """Fuel rate in L/h: the reported rate, else air mass flow over the stoichiometric ratio."""
    reported = nan_null(F.col(direct).cast("double"))
    from_air = nan_null(F.col(maf).cast("double")) / afr / density * S.SECONDS_PER_HOUR
    return F.coalesce(reported, from_air)


def _bank_mean(first, second) -> Column:
    a, b = nan_null(first), nan_null(second)
    return F.coalesce((a + b) / 2, a, b)


def fuel_rate_trim_corrected(direct="fuel_rate", maf="maf", load="abs_load", rpm="rpm",
                             displacement="eng_dis", short_trims=("stfb_1", "stfb_2"),
                             long_trims=("ltfb_1", "ltfb_2"), afr=S.E10_AFR,
                             air_density=S.AIR_DENSITY_KG_M3) -> Column:
    """Fuel rate with short and long term fuel trims applied to measured or modelled air flow.

    The factor multiplies by the air-fuel ratio and keeps g/s, so the result is an index rather
    than L/h; use ``fuel_rate_estimate`` for a physical rate.  NULL when either trim is missing.
    """
    factor = (1 + _bank_mean(*short_trims) / 100 + _bank_mean(*long_trims) / 100) * afr
    modelled = (nan_null(load) / 100 * air_density * nan_null(displacement) * nan_null(rpm) / 120)
    return F.coalesce(nan_null(direct), F.coalesce(nan_null(maf), modelled) * factor)


def below(column, limit) -> Column:
    """1 when the value is under the limit, else 0; a missing value counts as 0."""
    return F.coalesce((F.col(column) < limit).cast("int"), F.lit(0))


def floor_bin(column, width) -> Column:
    """Lower edge of the fixed-width bin; negative values go down, not towards zero."""
    return (F.floor(F.col(column) / width) * width).cast("int")


def driving_mode(speed="speed", stop=S.STOP_GO_KMH, city=S.CITY_KMH,
                 normal=S.NORMAL_KMH) -> Column:
    v = F.col(speed)
    return (F.when(v < stop, "stop_go_under_5_kmh")
            .when(v < city, "city_5_30_kmh")
            .when(v < normal, "normal_30_80_kmh")
            .otherwise("highway_80_plus_kmh"))


def geo_cell(column, digits=S.GEO_DIGITS) -> Column:
    return F.round(F.col(column), digits)


def ac_kw(kw="air_cp_kw", watts="air_cp_watts") -> Column:
    return F.coalesce(F.col(kw), F.col(watts) / S.WATTS_PER_KW)


def heater_kw(watts="heater_power") -> Column:
    return F.col(watts) / S.WATTS_PER_KW


def trip_key(keys=tuple(S.TRIP_KEYS)) -> Column:
    return F.concat_ws("_", *keys)


def safe_ratio(numerator, denominator) -> Column:
    """Numerator over denominator where the denominator is positive, NULL elsewhere."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.when(den > 0, num / den)
