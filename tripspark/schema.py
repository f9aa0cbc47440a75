"""Table schemas, default thresholds and the column lists the operators share."""

from pyspark.sql import types as T


def _struct(columns):
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns])


# --- fixed values: column names, types and order of the base and trip tables, model inputs ---
TELEMETRY_SCHEMA = _struct([
    ("daynum", "double"), ("vehid", "string"), ("tripid", "string"), ("time", "double"),
    ("lat", "double"), ("lon", "double"), ("speed", "double"), ("maf", "double"),
    ("rpm", "double"), ("abs_load", "double"), ("oat", "double"), ("fuel_rate", "double"),
    ("air_cp_kw", "double"), ("air_cp_watts", "double"), ("heater_power", "double"),
    ("hv_battery_current", "double"), ("hv_battery_soc", "double"), ("hv_battery_vol", "double"),
    ("stfb_1", "double"), ("stfb_2", "double"), ("ltfb_1", "double"), ("ltfb_2", "double"),
])
VEHICLE_SCHEMA = _struct([
    ("vehid", "string"), ("vehtype", "string"), ("vehclass", "string"),
    ("transmission", "string"), ("drive_wheels", "string"), ("gen_weight", "double"),
    ("eng_type", "string"), ("eng_dis", "double"), ("eng_conf", "string"),
])
TRIP_FEATURE_SCHEMA = _struct([
    ("vehid", "string"), ("tripid", "string"), ("daynum", "double"),
    ("n_sensor_points", "bigint"), ("duration_min", "double"), ("observed_seconds", "double"),
    ("distance_km", "double"), ("fuel_used_l", "double"), ("fuel_valid_points", "bigint"),
    ("speed_mean", "double"), ("speed_median", "double"), ("speed_p95", "double"),
    ("maf_mean", "double"), ("maf_p95", "double"), ("rpm_mean", "double"), ("rpm_p95", "double"),
    ("abs_load_mean", "double"), ("oat_mean", "double"), ("hv_current_mean", "double"),
    ("hv_soc_mean", "double"), ("hv_voltage_mean", "double"), ("fuel_rate_mean_lhr", "double"),
    ("vehtype", "string"), ("vehclass", "string"), ("transmission", "string"),
    ("drive_wheels", "string"), ("gen_weight", "double"), ("eng_type", "string"),
    ("eng_dis", "double"), ("eng_conf", "string"), ("trip_id", "string"),
    ("stop_go_ratio", "double"), ("idle_time_min", "double"), ("fuel_l_per_100km", "double"),
])
TARGET = "fuel_l_per_100km"
LABEL = "label"
# Columns that may become model inputs; a column added to the trip table is none by itself.
NUMERIC_CANDIDATES = [
    "duration_min", "observed_seconds", "distance_km", "speed_mean", "speed_median", "speed_p95",
    "maf_mean", "maf_p95", "rpm_mean", "rpm_p95", "abs_load_mean", "oat_mean", "hv_current_mean",
    "hv_soc_mean", "hv_voltage_mean", "gen_weight", "eng_dis", "stop_go_ratio", "idle_time_min",
]
CATEGORICAL_FEATURES = [
    "vehtype", "vehclass", "transmission", "drive_wheels", "eng_type", "eng_conf",
]
# Keys, the target, the two columns the target is computed from, and bookkeeping counts.
NOT_CANDIDATES = {
    "daynum", "fuel_l_per_100km", "fuel_rate_mean_lhr", "fuel_used_l", "fuel_valid_points",
    "n_sensor_points", "trip_id", "tripid", "vehid",
}
# Header of the raw weekly telemetry files, in file order.
RAW_TELEMETRY_HEADERS = [
    "DayNum", "VehId", "Trip", "Timestamp(ms)", "Latitude[deg]", "Longitude[deg]",
    "Vehicle Speed[km/h]", "MAF[g/sec]", "Engine RPM[RPM]", "Absolute Load[%]", "OAT[DegC]",
    "Fuel Rate[L/hr]", "Air Conditioning Power[kW]", "Air Conditioning Power[Watts]",
    "Heater Power[Watts]", "HV Battery Current[A]", "HV Battery SOC[%]",
    "HV Battery Voltage[V]", "Short Term Fuel Trim Bank 1[%]",
    "Short Term Fuel Trim Bank 2[%]", "Long Term Fuel Trim Bank 1[%]",
    "Long Term Fuel Trim Bank 2[%]",
]
RAW_VEHICLE_HEADERS = {
    "VehId": "vehid",
    "Vehicle Type": "vehtype",
    "Vehicle Class": "vehclass",
    "Transmission": "transmission",
    "Drive Wheels": "drive_wheels",
    "Generalized_Weight": "gen_weight",
    "EngineType": "eng_type",
    "Engine Configuration & Displacement": "engine_raw",
}
MANDATORY_TELEMETRY = ["daynum", "vehid", "tripid", "time", "lat", "lon"]
NO_DATA = "NO DATA"
# -----------------------------------------------------------------------------------------

TRIP_KEYS = ["vehid", "tripid"]
VEHICLE_ATTRIBUTES = VEHICLE_SCHEMA.names[1:]

# Sensor signals that may be missing: everything after the six mandatory columns.
SENSOR_SIGNALS = TELEMETRY_SCHEMA.names[len(MANDATORY_TELEMETRY):]

# --- fixed values: thresholds --------------------------------------------------------------
GASOLINE_DENSITY_G_PER_L = 745.0
STOICHIOMETRIC_AFR = 14.7
SECONDS_PER_HOUR = 3600
MAX_GAP_S = 3600.0
STOP_GO_KMH = 5.0
IDLE_KMH = 0.1
SPEED_RANGE_KMH = (0.0, 160.0)
SPEED_BIN_KMH = 10.0
CITY_KMH = 30.0
NORMAL_KMH = 80.0
TEMPERATURE_BIN_C = 5.0
WATTS_PER_KW = 1000.0
GEO_DIGITS = 2
GEO_TOP_CELLS = 5000
LONGEST_TRIPS = 5000
MIN_TRIP_KM = 0.5
# Used by the trim-corrected variant of the fuel estimate only.
E10_AFR = 14.08
AIR_DENSITY_KG_M3 = 1.225
# Modelling.
SEED = 42
TRAIN_RATIO = 0.7
SELECT_K = 10
CV_FOLDS = 3
CV_PARALLELISM = 2
# -----------------------------------------------------------------------------------------
