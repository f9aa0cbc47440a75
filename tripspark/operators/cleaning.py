"""Projection, cleaning and row-filter operators."""

from pyspark.sql import DataFrame, functions as F, types as T

from .. import schema as S
from ..functions import derive, text

_FLOATING = (T.FloatType, T.DoubleType)


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Turn NaN into NULL in the named columns, or in every float and double column.

    One projection whatever the number of columns.  Named columns of another numeric type
    cannot hold NaN and pass through untouched.
    """
    wanted = set(df.columns if columns is None else columns)
    out = []
    for field in df.schema:
        if field.name in wanted and isinstance(field.dataType, _FLOATING):
            out.append(derive.nan_null(_col(field.name)).alias(field.name))
        else:
            out.append(_col(field.name))
    return df.select(*out)


def _col(name):
    return F.col("`" + name.replace("`", "``") + "`")


def cast_ids(df: DataFrame, ids=tuple(S.TRIP_KEYS), time="time") -> DataFrame:
    """Ids to string, time to a double in milliseconds and in seconds."""
    casts = {i: F.col(i).cast("string") for i in ids}
    ms = F.col(time).cast("double")
    return df.withColumns({**casts, "time_raw_ms": ms, "time_seconds": ms / 1000})


def sentinel_to_null(df: DataFrame, sentinel=S.NO_DATA, columns=None) -> DataFrame:
    """Replace a text marker for missing data by NULL in string columns."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.nullif(F.col(n), F.lit(sentinel)) for n in names})


def rename_columns(df: DataFrame, mapping) -> DataFrame:
    """Rename by dictionary; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def parse_engine_config(df: DataFrame, source, dis="eng_dis", conf="eng_conf") -> DataFrame:
    """Split the engine text into displacement and configuration and drop the source column."""
    return (df.withColumns({dis: text.engine_displacement(source),
                            conf: text.engine_configuration(source)})
            .drop(source))


def prepare_vehicles(df: DataFrame, engine="engine_raw") -> DataFrame:
    """Raw vehicle sheet to the vehicle table: names, engine text, missing markers, key type."""
    named = rename_columns(df, S.RAW_VEHICLE_HEADERS)
    parsed = parse_engine_config(named, engine)
    typed = nan_to_null(parsed).withColumn("vehid", F.col("vehid").cast("string"))
    return sentinel_to_null(typed).select(*existing_columns(typed, S.VEHICLE_SCHEMA.names))


def prepare_telemetry(df: DataFrame) -> DataFrame:
    """Clean, typed telemetry with the estimated fuel rate and the stop and idle flags."""
    return add_driving_flags(add_fuel_rate(cast_ids(nan_to_null(df))))


def add_fuel_rate(df: DataFrame, direct="fuel_rate", maf="maf", afr=S.STOICHIOMETRIC_AFR,
                  density=S.GASOLINE_DENSITY_G_PER_L, output="fuel_rate_est_lhr") -> DataFrame:
    return df.withColumn(output, derive.fuel_rate_estimate(direct, maf, afr, density))


def add_driving_flags(df: DataFrame, speed="speed", stop=S.STOP_GO_KMH,
                      idle=S.IDLE_KMH) -> DataFrame:
    return df.withColumns({"is_stop_go": derive.below(speed, stop),
                           "is_idle": derive.below(speed, idle)})


def existing_columns(df: DataFrame, wanted) -> list:
    """The wanted names that the table has, in the wanted order."""
    have = set(df.columns)
    return [name for name in wanted if name in have]


def split_columns_by_type(df: DataFrame, exclude=()) -> tuple:
    """(numeric names, string names), without the excluded ones."""
    numeric, strings = [], []
    for field in df.schema:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            strings.append(field.name)
    return numeric, strings


def require_not_null(df: DataFrame, *columns) -> DataFrame:
    """Rows where every named column has a value."""
    return df.dropna(subset=list(columns))


def within(df: DataFrame, column, low, high) -> DataFrame:
    """Rows whose value lies in the closed range."""
    return df.where(F.col(column).between(low, high))


def positive_target(df: DataFrame, target=S.TARGET) -> DataFrame:
    return df.where(F.col(target) > 0)


def plausible_trips(df: DataFrame, min_km=S.MIN_TRIP_KM, speed_range=S.SPEED_RANGE_KMH):
    """Trips with enough distance, a positive duration and a mean speed in range.

    A rule applies only when the table has its column.
    """
    rules = {"distance_km": F.col("distance_km") >= min_km,
             "duration_min": F.col("duration_min") > 0,
             "speed_mean": F.col("speed_mean").between(*speed_range)}
    for column, rule in rules.items():
        if column in df.columns:
            df = df.where(rule)
    return df


def coerce_numeric(df: DataFrame, columns) -> DataFrame:
    """Text to double; what does not parse becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(trim(`{c}`) as double)") for c in columns})


def clean_text(df: DataFrame) -> DataFrame:
    """Every string column made safe for a one-line-per-row text file."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: text.tidy_text(n) for n in names})


def union_loose(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two tables by column name; a column that one side lacks is NULL there."""
    return first.unionByName(second, allowMissingColumns=True)


def distinct_trips(df: DataFrame, keys=tuple(S.TRIP_KEYS)) -> DataFrame:
    return df.select(*keys).distinct()
