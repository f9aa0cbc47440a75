"""Telemetry and vehicle tables derived from the generic star-schema test tables.

``events`` plays the sensor stream, one trip per user and five-day block; ``customer`` joined
with ``nation`` plays the vehicle sheet.  The view covers NaN and NULL signals, unknown
vehicles, missing engine data and every way to obtain a fuel rate.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cleaning

# Samples of the view lie hours apart, so gaps up to this many seconds count.
MAX_GAP_S = 21600.0
_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 22 telemetry columns plus ``sample_id``, a unique tie-breaker."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as sample_id", "user_id", "event_type", "value", "ts",
        "cast(get_json_object(props, '$.k') as int) as k",
    ).selectExpr(
        "cast(day(ts) as double) as daynum",
        "cast(user_id as string) as vehid",
        "cast(cast(floor((day(ts) - 1) / 5) as int) as string) as tripid",
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts) / 1000.0D as time",
        "42.2D + (sample_id % 97) * 0.00113D as lat",
        "-83.8D + (sample_id % 89) * 0.00117D as lon",
        """case when sample_id % 50 = 7 then double('NaN')
                when event_type = 'signup' then null else value end as speed""",
        "case when event_type in ('click', 'view') then value / 10 end as maf",
        "600.0D + 20 * k as rpm",
        "cast(k as double) as abs_load",
        "case when sample_id % 11 <> 0 then (k - 50) / 2.0D end as oat",
        "case when event_type = 'purchase' then value / 20 end as fuel_rate",
        "case when event_type = 'error' then k / 50.0D end as air_cp_kw",
        "case when event_type = 'view' then k * 10.0D end as air_cp_watts",
        "case when event_type = 'click' then k * 5.0D end as heater_power",
        "case when user_id % 10 = 0 then value - 50 end as hv_battery_current",
        "case when user_id % 10 = 0 then cast(k as double) end as hv_battery_soc",
        "case when user_id % 10 = 0 then 200.0D + k end as hv_battery_vol",
        "case when sample_id % 2 = 0 then k / 10.0D - 5 end as stfb_1",
        "case when sample_id % 3 = 0 then k / 20.0D - 2 end as stfb_2",
        "case when sample_id % 2 = 0 then k / 25.0D end as ltfb_1",
        "case when sample_id % 5 = 0 then -k / 25.0D end as ltfb_2",
        "sample_id",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned telemetry with the estimated fuel rate."""
    return cleaning.prepare_telemetry(raw_telemetry(spark, sf_dir))


def raw_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicle sheet before cleaning: engine text in one column, gaps marked by text."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.selectExpr(
        # Some ids never occur in telemetry, so that their users drive unknown vehicles.
        "concat(if(c_custkey % 20 = 0, 'spare-', ''), c_custkey) as vehid",
        "case when c_mktsegment = 'HOUSEHOLD' then 'NO DATA' else c_mktsegment end as vehtype",
        "n_name as vehclass",
        """case c_custkey % 3 when 0 then 'CVT' when 1 then 'NO DATA'
                else '6-SP AUTOMATIC' end as transmission""",
        "case when c_custkey % 2 = 0 then 'FWD' else 'AWD' end as drive_wheels",
        "abs(c_acctbal) as gen_weight",
        "case when c_custkey % 4 = 0 then 'HEV' else 'ICE' end as eng_type",
        """case when c_mktsegment = 'MACHINERY' then 'ELECTRIC MOTOR'
                when c_custkey % 7 = 0 then '2.0L'
                else concat('I', 4 + c_custkey % 3, ' ', 1 + c_custkey % 4, '.',
                            c_custkey % 10, 'L') end as engine_raw""",
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.prepare_vehicles(raw_vehicles(spark, sf_dir))
