"""Registered queries: every operator run on the test tables, with its SQL where one exists.

``@query(sql)`` registers a function under its own name.  Aggregates of many floating-point
values are rounded the same way on both sides, after a small offset that keeps exact decimal
ties from falling on different sides.
"""

import functools
import itertools

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import derive, text
from ..ml import evaluation, modeling
from ..operators import (cleaning, insights, joins, profiling, quality, quantiles, selection,
                         trips)
from ..sources import audit, readers, writers
from ..sources.shared import materialise, scratch_path
from . import benchmarks, publish
from .oracle import (ENRICHED, MODEL, SCORES, TELEMETRY, TRIPS, VEHICLES, rounded as R)
from .proxy import MAX_GAP_S, raw_telemetry, raw_vehicles, table, telemetry, vehicles

QUERIES: dict = {}
ORACLE: dict = {}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KEYS = list(S.TRIP_KEYS)
FUEL = insights.FUEL


# The columns the column-wise profiles must list, by table: numeric and text.
_NUMERIC = {
    "region": "r_regionkey", "nation": "n_nationkey n_regionkey",
    "customer": "c_custkey c_nationkey c_acctbal", "supplier": "s_suppkey s_nationkey s_acctbal",
    "part": "p_partkey p_size p_retailprice", "orders": "o_orderkey o_custkey o_totalprice",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                "l_discount l_tax",
    "events": "event_id user_id value", "documents": "doc_id n_chars",
    "embeddings": "vec_id label", "pages": "page_id", "benchmark": "item_id",
    "labels": "doc_id quality toxic", "conversations": "conv_id turn",
}
_TEXT = {
    "region": "r_name", "nation": "n_name", "customer": "c_name c_mktsegment",
    "supplier": "s_name", "part": "p_name p_brand p_type", "orders": "o_orderstatus "
    "o_orderpriority", "lineitem": "l_returnflag l_linestatus", "events": "event_type props",
    "documents": "text lang source", "pages": "url html", "benchmark": "text",
    "conversations": "role text",
}
_OTHER = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts",
          "embeddings": "embedding"}
_COLUMNS = str(sum(len(c.split()) for part in (_NUMERIC, _TEXT, _OTHER) for c in part.values()))


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return register


def rounded(df, names):
    """Round the named columns to four decimals, after the offset of oracle.rounded."""
    return df.withColumns({n: F.round(F.col(n) + 1e-7, 4) for n in names.split()})


def all_tables(spark, sf):
    return {name: table(spark, sf, name) for name in TABLES}


def trip_table(spark, sf):
    return trips.trip_features(telemetry(spark, sf), vehicles(spark, sf), tie="sample_id",
                               max_gap_s=MAX_GAP_S)


@functools.lru_cache(maxsize=None)
def _model_rows(app, sf):
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    # The bounds of the target take two passes, so the trips are written out first as well.
    written = materialise(trip_table(spark, sf), "trip_features")
    return materialise(selection.modelling_rows(written), "modelling_rows")


def model_rows(spark, sf):
    """Modelling rows, written once per session because many queries start from them."""
    return _model_rows(spark.sparkContext.applicationId, sf)


# ---------------------------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------------------------

_SIGNALS = ", ".join(c for c in S.TELEMETRY_SCHEMA.names if c != "speed")


@query(TELEMETRY + f" select {_SIGNALS}, speed, is_nan from (select * replace (case when "
       "isnan(speed) then null else speed end as speed), case when isnan(speed) then 1 else 0 "
       "end as is_nan from raw_telemetry)")
def src_telemetry_csv(spark, sf):
    path = scratch_path(spark, "telemetry_csv")
    raw = raw_telemetry(spark, sf).drop("sample_id").toDF(*S.RAW_TELEMETRY_HEADERS)
    raw.write.option("header", True).option("nullValue", "null").csv(path)
    back = readers.read_telemetry_csv(spark, path)
    flag = F.coalesce(F.isnan("speed").cast("int"), F.lit(0))
    return cleaning.nan_to_null(back.withColumn("is_nan", flag))


@query(VEHICLES + " select * from vehicles")
def src_vehicles_csv(spark, sf):
    path = scratch_path(spark, "vehicles_csv")
    vehicles(spark, sf).write.option("header", True).option("nullValue", "null").csv(path)
    return readers.read_vehicles_csv(spark, path)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def src_csv_infer(spark, sf):
    path = scratch_path(spark, "customer_csv")
    writers.write_csv(table(spark, sf, "customer"), path)
    found = readers.read_csv_inferred(spark, path)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("select n_nationkey as nation_key, n_name as nation_key_1, n_regionkey as \"column\" "
       "from nation")
def src_sanitize_columns(spark, sf):
    return readers.sanitize_columns(
        table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
        .toDF("Nation [Key]", "nation  key", "%%"))


@query("select * from orders")
def src_parquet(spark, sf):
    return readers.read_parquet(spark, f"{sf}/orders.parquet")


@query("select * from part")
def src_format_generic(spark, sf):
    path = scratch_path(spark, "part_orc")
    writers.write_variant(table(spark, sf, "part"), path, "orc", "zlib")
    return readers.read_format(spark, "orc", path)


@query("select * from supplier")
def sink_parquet(spark, sf):
    path = scratch_path(spark, "supplier")
    writers.write_parquet(table(spark, sf, "supplier"), path, "gzip")
    return readers.read_parquet(spark, path)


_MODE_SQL = """
  select case when speed < 5 then 'stop_go_under_5_kmh' when speed < 30 then 'city_5_30_kmh'
              when speed < 80 then 'normal_30_80_kmh' else 'highway_80_plus_kmh' end
         as driving_mode, * from telemetry
  where speed is not null and fuel_rate_est_lhr is not null"""
_BY_MODE = (" select driving_mode, count(*) as rows_count, "
            "round(avg(fuel_rate_est_lhr) + 1e-7, 4) as avg_fuel_rate_lhr, "
            "round(avg(rpm) + 1e-7, 4) as avg_rpm, "
            "round(avg(abs_load) + 1e-7, 4) as avg_engine_load, "
            f"round(avg(speed) + 1e-7, 4) as avg_speed_kmh from ({_MODE_SQL}) group by 1")
_MODE_AVERAGES = "avg_fuel_rate_lhr avg_rpm avg_engine_load avg_speed_kmh"


@query(TELEMETRY + _BY_MODE)
def sink_small_csv(spark, sf):
    path = scratch_path(spark, "modes_csv")
    report = insights.fuel_by_driving_mode(telemetry(spark, sf))
    writers.write_small_csv(report, path, sort=["driving_mode"])
    return rounded(readers.read_csv(spark, path, report.schema), _MODE_AVERAGES)


@query(TELEMETRY + " select vehid, count(*) as n, 1 as same from telemetry group by vehid")
def sink_dual(spark, sf):
    parquet, csv = scratch_path(spark, "parquet"), scratch_path(spark, "csv")
    counts = telemetry(spark, sf).groupBy("vehid").agg(F.count("*").alias("n"))
    writers.write_dual(counts, parquet, csv)
    both = readers.read_parquet(spark, parquet).unionAll(
        readers.read_csv(spark, csv, counts.schema))
    return both.groupBy("vehid").agg(F.max("n").alias("n"),
                                     F.count_distinct("n").cast("int").alias("same"))


@query(MODEL + " select vehid, tripid, round(speed_mean + 1e-7, 4) as speed_mean, "
       "round(fuel_l_per_100km + 1e-7, 4) as label from model")
def sink_json(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    path = scratch_path(spark, "features_json")
    rows = model_rows(spark, sf).withColumnRenamed(S.TARGET, S.LABEL)
    vectors = VectorAssembler(inputCols=["speed_mean"], outputCol="features").transform(rows)
    writers.write_json(vectors.select(*KEYS, "features", S.LABEL), path)
    back = readers.read_format(
        spark, "json", path, "vehid string, tripid string, features array<double>, label double")
    return rounded(back.select(*KEYS, F.col("features")[0].alias("speed_mean"), S.LABEL),
                   "speed_mean label")


_CLEAN_DOC = "translate(text, chr(9) || chr(10) || chr(13), '   ')"


@query("select conv_id, turn, role, case when text is null or "
       f"{_CLEAN_DOC} = 'nan' then '' else {_CLEAN_DOC} end as text from conversations")
def sink_tsv(spark, sf):
    path = scratch_path(spark, "conversations_tsv")
    source = table(spark, sf, "conversations")
    writers.write_tsv(source, path)
    back = readers.read_csv(spark, path, source.schema, sep="\t", null="\0", emptyValue="")
    return cleaning.clean_text(back)


@query("select * from (values ('parquet', 'snappy'), ('parquet', 'gzip'), ('orc', 'snappy'), "
       "('csv', 'gzip')) v(format, compression), (select count(*) as n_rows, "
       "sum(l_orderkey)::bigint as key_sum from lineitem)")
def sink_variant(spark, sf):
    out = None
    source = table(spark, sf, "lineitem")
    for fmt, codec in [("parquet", "snappy"), ("parquet", "gzip"), ("orc", "snappy"),
                       ("csv", "gzip")]:
        path = scratch_path(spark, f"{fmt}_{codec}")
        writers.write_variant(source, path, fmt, codec, 8, spread=False)
        options = {"header": "true"} if fmt == "csv" else {}
        one = readers.read_format(spark, fmt, path, source.schema, **options).agg(
            F.lit(fmt).alias("format"), F.lit(codec).alias("compression"),
            F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("key_sum"))
        out = one if out is None else out.unionByName(one)
    return out


@query(ENRICHED + " select coalesce(vehtype, 'NO DATA') as vehicle_type, "
       "count(*) as sensor_rows, count(distinct vehid) as vehicles_count, "
       "count(distinct concat(vehid, '_', tripid)) as trips_count from enriched group by 1")
def publish_external_parquet(spark, sf):
    path = scratch_path(spark, "types")
    writers.write_parquet(
        insights.vehicle_type_distribution(telemetry(spark, sf), vehicles(spark, sf)), path)
    return publish.publish_parquet(spark, "tripspark_vehicle_type_distribution", path)


@query(" union all ".join(
    f"select 'orders' as table_name, '{c}' as column_name, count(*) as total_rows, count(*) "
    f"filter ({c} is null) as null_count, 0.0::double as null_pct from orders"
    for c in "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"
    .split()))
def publish_external_csv(spark, sf):
    path = scratch_path(spark, "missingness")
    report = profiling.missing_values({"orders": table(spark, sf, "orders")})
    declared = publish.as_declared(report, publish.DASHBOARD_COLUMNS["missingness"])
    writers.write_small_csv(declared, path)
    return publish.publish_csv(spark, "tripspark_missingness", path, declared.schema)


@query(" union all ".join(
    f"select 'tripspark_stage4_{name}' as table_name, 'published' as status, {n} as n_rows"
    for name, n in (
        ("table_overview", "14"), ("column_types", _COLUMNS), ("missingness", _COLUMNS),
        ("numeric_summary", str(sum(len(c.split()) for c in _NUMERIC.values()))))))
def publish_dashboard(spark, sf):
    """Reads the published tables back; artifacts that no job has left are listed as missing."""
    tables = all_tables(spark, sf)
    artifacts = {"table_overview": profiling.overview(tables),
                 "column_types": profiling.column_types(tables),
                 "missingness": profiling.missing_values(tables),
                 "numeric_summary": profiling.numeric_summary(tables)}
    root = scratch_path(spark, "dashboard")
    report = publish.publish_dashboard(spark, artifacts, root, prefix="tripspark_")
    found = report.where("status = 'published'")
    counts = [spark.table(r["table_name"]).agg(
        F.lit(r["table_name"]).alias("table_name"), F.count("*").cast("int").alias("n_rows"))
        for r in found.collect()]
    return found.select("table_name", "status").join(
        functools.reduce(lambda a, b: a.unionByName(b), counts), "table_name")


_EVENT_KINDS = [("click", "pointer"), ("error", "fault"), ("purchase", "sale"),
                ("signup", "account"), ("view", "display")]


@query("select event_type, label, count(*) as n from events left join (values "
       + ", ".join(map(str, _EVENT_KINDS)) + ") v(kind, label) on event_type = kind group by 1, 2")
def literal_table(spark, sf):
    names = readers.literal_table(spark, _EVENT_KINDS, "event_type string, label string")
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.join(names, "event_type", "left").select("event_type", "label", "n")


@query(TELEMETRY + " select daynum, vehid, tripid, time_raw_ms, speed, maf, rpm, fuel_rate, oat "
       "from telemetry order by vehid, tripid, time_raw_ms, sample_id limit 20")
def sample_limit(spark, sf):
    columns = "daynum vehid tripid time_raw_ms speed maf rpm fuel_rate oat".split()
    return readers.sample_rows(telemetry(spark, sf), 20,
                               ["vehid", "tripid", "time_raw_ms", "sample_id"]).select(*columns)


_AUDITED = {"nation": "na tion+%41", "orders": "orders", "conversations": "said"}
_NAMES = {"customer": "c_custkey c_name", "supplier": "s_suppkey s_name", "part": "p_partkey p_name"}


@query(" union all ".join(
    f"select '{folder}' as folder, '.csv' as extension, true as named, true as sized, "
    f"count(*) as n_rows, (select count(*) from (describe {t})) as n_columns from {t}"
    for t, folder in _AUDITED.items()) + " union all select 'total', '', true, true, "
       + " + ".join(f"(select count(*) from {t})" for t in _AUDITED) + ", null")
def file_audit(spark, sf):
    """Folders with signs that paths escape, and texts with quoted line breaks."""
    root = scratch_path(spark, "audit")
    for name, folder in _AUDITED.items():
        writers.write_csv(table(spark, sf, name), f"{root}/{folder}")
    listing = audit.file_audit(spark, root, multiline=True).where(
        (F.col("extension") == ".csv") | (F.col("file_path") == audit.TOTAL))
    total = F.col("file_path") == audit.TOTAL
    folder = F.element_at(F.split("file_path", "/"), -2)
    return listing.groupBy(
        F.when(total, "total").otherwise(folder).alias("folder"), "extension").agg(
        F.bool_and(total | F.col("file_path").endswith(F.col("file_name"))).alias("named"),
        F.bool_and(F.col("size_mb") >= 0).alias("sized"), F.sum("rows").alias("n_rows"),
        F.max("columns").cast("long").alias("n_columns"))


@query("select sum(bytes)::bigint as size_bytes, round(sum(bytes) / 1048576, 3) as size_mb from ("
       + " union all ".join(
           f"select {len(c) + 1} + sum(strlen({c.split()[0]}::varchar) + strlen({c.split()[1]}) + 2) "
           f"as bytes from {t}" for t, c in _NAMES.items()) + ")")
def path_size(spark, sf):
    root = scratch_path(spark, "a b+c%20d")
    for name, columns in _NAMES.items():
        writers.write_small_csv(table(spark, sf, name).select(*columns.split()), f"{root}/{name} x")
    return audit.path_size(spark, root)


# ---------------------------------------------------------------------------------------------
# Projections, cleaning, predicates
# ---------------------------------------------------------------------------------------------

@query(TELEMETRY + " select sample_id, speed, maf, oat from telemetry")
def nan_to_null_all(spark, sf):
    return cleaning.nan_to_null(raw_telemetry(spark, sf)).select("sample_id", "speed", "maf",
                                                                 "oat")


@query(TELEMETRY + " select sample_id, speed, rpm from telemetry")
def nan_to_null_cols(spark, sf):
    return cleaning.nan_to_null(raw_telemetry(spark, sf), ["speed", "rpm"]).select(
        "sample_id", "speed", "rpm")


@query(TELEMETRY + " select sample_id, vehid, tripid, time_raw_ms, time_seconds from telemetry")
def cast_ids(spark, sf):
    return cleaning.cast_ids(raw_telemetry(spark, sf)).select(
        "sample_id", "vehid", "tripid", "time_raw_ms", "time_seconds")


@query(VEHICLES + " select vehid, vehtype, transmission from vehicles")
def sentinel_to_null(spark, sf):
    return cleaning.sentinel_to_null(
        raw_vehicles(spark, sf).select("vehid", "vehtype", "transmission"))


@query(VEHICLES + " select vehid, coalesce(vehtype, 'NO DATA') as vehicle_type from vehicles")
def null_to_label(spark, sf):
    return vehicles(spark, sf).select(
        "vehid", text.null_to_label("vehtype", S.NO_DATA).alias("vehicle_type"))


@query("select event_id as sample, value as reading, user_id from events")
def rename_map(spark, sf):
    return cleaning.rename_columns(
        table(spark, sf, "events").select("event_id", "value", "user_id"),
        {"event_id": "sample", "value": "reading", "not_there": "x"})


@query(VEHICLES + " select vehid, eng_dis, eng_conf from vehicles")
def parse_engine_config(spark, sf):
    raw = raw_vehicles(spark, sf).select("vehid", "engine_raw")
    return cleaning.parse_engine_config(raw, "engine_raw")


@query(VEHICLES + " select vehid, try_cast(nullif(regexp_extract(engine_raw, '([\\d\\.]+)L', 1),"
       " '') as double) as eng_dis from raw_vehicles")
def parse_displacement_loose(spark, sf):
    return raw_vehicles(spark, sf).select(
        "vehid", text.displacement_loose("engine_raw").alias("eng_dis"))


@query("select c_custkey, c_name, c_nationkey from customer")
def drop_columns(spark, sf):
    return table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment")


@query("select o_totalprice, o_orderkey from orders")
def existing_columns(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*cleaning.existing_columns(
        orders, ["o_totalprice", "not_there", "o_orderkey"]))


@query("select column_name, case when data_type = 'VARCHAR' then 'categorical' else 'numeric' "
       "end as kind, (select count(*) from lineitem) as n_rows from (describe lineitem) "
       "t(column_name, data_type, a, b, c, d) where data_type <> 'TIMESTAMP' "
       "and column_name <> 'l_orderkey'")
def split_columns_by_type(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    numeric, strings = cleaning.split_columns_by_type(lineitem, exclude=["l_orderkey"])
    counted = lineitem.agg(F.count("*").alias("n_rows"))
    kinds = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"))
             for k, names in (("numeric", numeric), ("categorical", strings)) for c in names]
    return counted.select(F.inline(F.array(*kinds)), "n_rows")


@query(TELEMETRY + " select sample_id, speed, fuel_rate_est_lhr from telemetry "
       "where speed is not null and fuel_rate_est_lhr is not null")
def filter_not_null(spark, sf):
    return cleaning.require_not_null(telemetry(spark, sf), "speed", FUEL).select(
        "sample_id", "speed", FUEL)


@query(TELEMETRY + " select sample_id, speed from telemetry where speed between 0 and 160")
def filter_range(spark, sf):
    return cleaning.within(telemetry(spark, sf), "speed", 0, 160).select("sample_id", "speed")


@query(TRIPS + " select trip_id from trips where fuel_l_per_100km > 0")
def filter_target(spark, sf):
    return cleaning.positive_target(trip_table(spark, sf)).select("trip_id")


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem, (select "
       "quantile_disc(l_extendedprice, 0.01) as lo, quantile_disc(l_extendedprice, 0.99) as hi "
       "from lineitem) where l_extendedprice between lo and hi")
def filter_quantile_trim(spark, sf):
    return quantiles.quantile_trim(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"),
        "l_extendedprice")


@query(TRIPS + " select trip_id from trips where distance_km >= 100 and duration_min > 0 "
       "and speed_mean between 10 and 60")
def filter_plausible_trips(spark, sf):
    return cleaning.plausible_trips(trip_table(spark, sf), 100, (10, 60)).select("trip_id")


@query(TELEMETRY + " select sample_id, maf, oat from telemetry "
       "where maf is not null and oat is not null")
def drop_null_rows(spark, sf):
    return cleaning.require_not_null(telemetry(spark, sf).select("sample_id", "maf", "oat"),
                                     "maf", "oat")


_MIXED = "case when event_id % 3 = 0 then event_type else cast(user_id as varchar) end"


@query(f"select event_id, try_cast({_MIXED} as double) as x from events")
def coerce_numeric(spark, sf):
    mixed = table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_id % 3 = 0 then event_type else cast(user_id as string) end as x")
    return cleaning.coerce_numeric(mixed, ["x"])


@query(f"select doc_id, case when text is null or {_CLEAN_DOC} = 'nan' then '' "
       f"else {_CLEAN_DOC} end as text from documents")
def clean_text(spark, sf):
    return cleaning.clean_text(table(spark, sf, "documents").select("doc_id", "text"))


_NAME = ("concat('models/', case event_id % 4 when 0 then 'LinearRegressionModel' when 1 then "
         "'GBTRegressionModel' when 2 then 'GBTRegressor' else 'RandomForest' end, '/', "
         "event_type)")


@query("select event_id, case when event_id % 4 = 0 then 'Linear Regression' when event_id % 4 "
       f"in (1, 2) then 'Gradient-Boosted Trees' else {_NAME} end as model_name from events")
def normalize_model_name(spark, sf):
    named = table(spark, sf, "events").selectExpr("event_id", f"{_NAME} as model")
    return named.select("event_id", text.model_display_name("model").alias("model_name"))


@query("select o_custkey, count(*) as n_rows from orders group by 1 having count(*) > 1")
def q_primary_key(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "orders"), ["o_custkey"])


@query(TELEMETRY + " unpivot (select " + ", ".join(
    f"count(*) - count({c}) as {c}" for c in [*S.MANDATORY_TELEMETRY, "speed", "maf"])
    + " from telemetry) on columns(*) into name column_name value null_rows")
def q_not_null(spark, sf):
    return quality.null_violations(telemetry(spark, sf), [*S.MANDATORY_TELEMETRY, "speed", "maf"])


@query(ENRICHED + " select vehid, count(*) as n_rows from telemetry t anti join vehicles v "
       "using (vehid) group by vehid")
def q_foreign_key(spark, sf):
    return quality.unknown_references(telemetry(spark, sf), vehicles(spark, sf))


# ---------------------------------------------------------------------------------------------
# Derived columns
# ---------------------------------------------------------------------------------------------

@query(TELEMETRY + f" select sample_id, {R(FUEL)} from telemetry")
def fuel_rate_estimate(spark, sf):
    rate = derive.fuel_rate_estimate().alias(FUEL)
    return rounded(raw_telemetry(spark, sf).select("sample_id", rate), FUEL)


@query(ENRICHED + """, banks as (
  select *, coalesce((stfb_1 + stfb_2) / 2, stfb_1, stfb_2) as st,
         coalesce((ltfb_1 + ltfb_2) / 2, ltfb_1, ltfb_2) as lt from enriched)
  select sample_id, round(coalesce(fuel_rate,
    coalesce(maf, abs_load / 100 * 1.225::double * eng_dis * rpm / 120)
    * ((1 + st / 100 + lt / 100) * 14.08::double)) + 1e-7, 4) as fuel_index from banks""")
def fuel_rate_trim_corrected(spark, sf):
    sized = joins.enrich_telemetry(raw_telemetry(spark, sf),
                                   vehicles(spark, sf).select("vehid", "eng_dis"))
    index = derive.fuel_rate_trim_corrected().alias("fuel_index")
    return rounded(sized.select("sample_id", index), "fuel_index")


@query(TELEMETRY + " select sample_id, is_stop_go, is_idle from telemetry")
def flags_stop_idle(spark, sf):
    return cleaning.add_driving_flags(cleaning.nan_to_null(raw_telemetry(spark, sf))).select(
        "sample_id", "is_stop_go", "is_idle")


@query(TELEMETRY + " select sample_id, cast(floor(speed / 10) * 10 as int) as speed_bin_kmh "
       "from telemetry")
def bin_speed(spark, sf):
    return telemetry(spark, sf).select(
        "sample_id", derive.floor_bin("speed", S.SPEED_BIN_KMH).alias("speed_bin_kmh"))


@query(TELEMETRY + " select sample_id, cast(floor(oat / 5) * 5 as int) as oat_bin_c "
       "from telemetry")
def bin_temperature(spark, sf):
    return telemetry(spark, sf).select(
        "sample_id", derive.floor_bin("oat", S.TEMPERATURE_BIN_C).alias("oat_bin_c"))


@query(TELEMETRY + f" select sample_id, driving_mode from ({_MODE_SQL})")
def driving_mode(spark, sf):
    valid = cleaning.require_not_null(telemetry(spark, sf), "speed", FUEL)
    return valid.select("sample_id", derive.driving_mode().alias("driving_mode"))


@query(TELEMETRY + " select sample_id, round(lat, 2) as lat_bin, round(lon, 2) as long_bin "
       "from telemetry")
def geo_cell(spark, sf):
    return telemetry(spark, sf).select("sample_id", derive.geo_cell("lat").alias("lat_bin"),
                                       derive.geo_cell("lon").alias("long_bin"))


@query(TELEMETRY + " select sample_id, round(coalesce(air_cp_kw, air_cp_watts / 1000) + 1e-7, 4)"
       " as ac_kw, round(heater_power / 1000 + 1e-7, 4) as heater_kw from telemetry")
def hvac_kw(spark, sf):
    powers = telemetry(spark, sf).select("sample_id", derive.ac_kw().alias("ac_kw"),
                                         derive.heater_kw().alias("heater_kw"))
    return rounded(powers, "ac_kw heater_kw")


@query(TELEMETRY + " select sample_id, concat(vehid, '_', tripid) as trip_id from telemetry")
def trip_key(spark, sf):
    return telemetry(spark, sf).select("sample_id", derive.trip_key().alias("trip_id"))


@query("select o_orderkey, round(case when o_totalprice - 50000 > 0 then o_orderkey / "
       "(o_totalprice - 50000) end + 1e-7, 4) as ratio from orders")
def safe_ratio(spark, sf):
    ratio = derive.safe_ratio("o_orderkey", F.col("o_totalprice") - 50000).alias("ratio")
    return rounded(table(spark, sf, "orders").select("o_orderkey", ratio), "ratio")


@query("select l_orderkey, l_linenumber, round(l_discount - l_tax + 1e-7, 4) as error, "
       "round(abs(l_discount - l_tax) + 1e-7, 4) as abs_error from lineitem")
def prediction_error(spark, sf):
    pairs = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_tax as label", "l_discount as prediction")
    return rounded(evaluation.prediction_error(pairs), "error abs_error").drop(
        "label", "prediction")


# ---------------------------------------------------------------------------------------------
# Joins, unions
# ---------------------------------------------------------------------------------------------

_VEHICLE = ", ".join(S.VEHICLE_ATTRIBUTES)


@query(ENRICHED + f" select sample_id, vehid, speed, {_VEHICLE} from enriched")
def enrich_telemetry(spark, sf):
    return joins.enrich_telemetry(telemetry(spark, sf), vehicles(spark, sf)).select(
        "sample_id", "vehid", "speed", *S.VEHICLE_ATTRIBUTES)


@query("select l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey from lineitem left join "
       "supplier on l_suppkey = s_suppkey")
def join_broadcast(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    supplier = table(spark, sf, "supplier").selectExpr("s_suppkey as l_suppkey", "s_name",
                                                       "s_nationkey")
    return joins.join_broadcast(items, supplier, "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name", "s_nationkey")


@query(ORACLE["enrich_telemetry"])
def join_salted(spark, sf):
    """The join that spreads hot keys over copies of their dimension rows."""
    joined = joins.join_salted(telemetry(spark, sf), vehicles(spark, sf), "vehid")
    return joined.select("sample_id", "vehid", "speed", *S.VEHICLE_ATTRIBUTES)


_RUNS = ("select l_returnflag as format, l_linestatus as compression, concat('/', l_linenumber) "
         "as hdfs_path, sum(l_quantity) as read_time_sec from lineitem group by 1, 2, 3")


@query(f"select runs.*, hdfs_size_mb from ({_RUNS}) runs left join (select l_returnflag as format, "
       "l_linestatus as compression, concat('/', l_linenumber) as hdfs_path, sum(l_tax) * 0 + "
       "count(*) as hdfs_size_mb from lineitem where l_linenumber % 2 = 1 group by 1, 2, 3) sizes "
       "using (format, compression, hdfs_path)")
def join_multi_key(spark, sf):
    """Half of the runs have no size."""
    items = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag as format", "l_linestatus as compression",
        "concat('/', l_linenumber) as hdfs_path", "l_quantity", "l_linenumber")
    keys = ["format", "compression", "hdfs_path"]
    runs = items.groupBy(*keys).agg(F.sum("l_quantity").alias("read_time_sec"))
    sizes = items.where("l_linenumber % 2 = 1").groupBy(*keys).agg(
        F.count("*").cast("double").alias("hdfs_size_mb"))
    return benchmarks.join_sizes(runs, sizes)


@query("select 'customer' as source, c_custkey as k, c_nationkey as nation, c_acctbal as balance "
       "from customer union all select 'supplier', s_suppkey, s_nationkey, null from supplier")
def union_loose_schema(spark, sf):
    a = table(spark, sf, "customer").selectExpr(
        "'customer' as source", "c_custkey as k", "c_nationkey as nation", "c_acctbal as balance")
    b = table(spark, sf, "supplier").selectExpr("s_nationkey as nation", "s_suppkey as k",
                                                "'supplier' as source")
    return cleaning.union_loose(a, b)


@query("select o_orderkey as k, 'orders' as origin from orders union all select l_orderkey, "
       "'lineitem' from lineitem")
def union_all(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey as k", "'orders' as origin") \
        .unionByName(table(spark, sf, "lineitem").selectExpr("'lineitem' as origin",
                                                             "l_orderkey as k"))


@query(TELEMETRY + " select distinct vehid, tripid from telemetry")
def distinct_trips(spark, sf):
    return cleaning.distinct_trips(telemetry(spark, sf))


# ---------------------------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------------------------

@query(ENRICHED + """
  select 'trips_rows' as metric, cast(count(*) as varchar) as value from telemetry
  union all select 'vehicles_rows', cast(count(*) as varchar) from vehicles
  union all select 'unique_vehicles_in_trips', cast(count(distinct vehid) as varchar)
    from telemetry
  union all select 'unique_trips', cast(count(*) as varchar)
    from (select distinct vehid, tripid from telemetry)
  union all select 'trip_columns_count', '22'
  union all select 'vehicle_columns_count', '9'""")
def eda_characteristics(spark, sf):
    return insights.data_characteristics(telemetry(spark, sf), vehicles(spark, sf))


def _missing(names, title, share):
    parts = [f"select '{c}' as {title}, count(*) as rows_total, count(*) - count({c}) as "
             f"{share[0]}, (count(*) - count({c})) / count(*) as {share[1]} from telemetry"
             for c in names]
    return " " + " union all ".join(parts)


@query(TELEMETRY + _missing(S.SENSOR_SIGNALS, "feature", ("null_count", "null_share")))
def eda_missingness(spark, sf):
    return insights.missingness(telemetry(spark, sf))


@query(ORACLE["publish_external_parquet"])
def insight_vehicle_type(spark, sf):
    return insights.vehicle_type_distribution(telemetry(spark, sf), vehicles(spark, sf))


@query(ENRICHED + " select coalesce(vehtype, 'NO DATA') as vehicle_type, count(*) as rows_count,"
       " round(avg(fuel_rate_est_lhr) + 1e-7, 4) as avg_fuel_rate_lhr, "
       "round(quantile_disc(fuel_rate_est_lhr, 0.5) + 1e-7, 4) as median_fuel_rate_lhr, "
       "round(quantile_disc(fuel_rate_est_lhr, 0.9) + 1e-7, 4) as p90_fuel_rate_lhr "
       "from enriched where fuel_rate_est_lhr is not null group by 1")
def insight_fuel_by_type(spark, sf):
    report = insights.fuel_by_vehicle_type(telemetry(spark, sf), vehicles(spark, sf), exact=True)
    return rounded(report, "avg_fuel_rate_lhr median_fuel_rate_lhr p90_fuel_rate_lhr")


@query(TELEMETRY + " select cast(floor(speed / 10) * 10 as int) as speed_bin_kmh, "
       "count(*) as rows_count, round(avg(speed) + 1e-7, 4) as avg_speed_kmh, "
       "round(avg(fuel_rate_est_lhr) + 1e-7, 4) as avg_fuel_rate_lhr, "
       "round(avg(rpm) + 1e-7, 4) as avg_rpm, "
       "round(avg(abs_load) + 1e-7, 4) as avg_engine_load from telemetry "
       "where speed between 0 and 160 and fuel_rate_est_lhr is not null group by 1")
def insight_fuel_by_speed_bin(spark, sf):
    return rounded(insights.fuel_by_speed_bin(telemetry(spark, sf)),
                   "avg_speed_kmh avg_fuel_rate_lhr avg_rpm avg_engine_load")


@query(TELEMETRY + _BY_MODE)
def insight_driving_mode(spark, sf):
    return rounded(insights.fuel_by_driving_mode(telemetry(spark, sf)), _MODE_AVERAGES)


@query(TELEMETRY + " select cast(floor(oat / 5) * 5 as int) as oat_bin_c, "
       "count(*) as rows_count, round(avg(fuel_rate_est_lhr) + 1e-7, 4) as avg_fuel_rate_lhr, "
       "round(avg(coalesce(air_cp_kw, air_cp_watts / 1000)) + 1e-7, 4) as avg_ac_kw, "
       "round(avg(heater_power / 1000) + 1e-7, 4) as avg_heater_kw from telemetry "
       "where oat is not null group by 1")
def insight_temperature_hvac(spark, sf):
    return rounded(insights.temperature_hvac(telemetry(spark, sf)),
                   "avg_fuel_rate_lhr avg_ac_kw avg_heater_kw")


@query(ENRICHED + " select eng_dis, count(*) as rows_count, "
       "count(distinct vehid) as vehicles_count, "
       "round(avg(fuel_rate_est_lhr) + 1e-7, 4) as avg_fuel_rate_lhr, "
       "round(avg(speed) + 1e-7, 4) as avg_speed_kmh, round(avg(rpm) + 1e-7, 4) as avg_rpm "
       "from enriched where eng_dis is not null and fuel_rate_est_lhr is not null group by 1")
def insight_displacement(spark, sf):
    return rounded(insights.displacement_fuel(telemetry(spark, sf), vehicles(spark, sf)),
                   "avg_fuel_rate_lhr avg_speed_kmh avg_rpm")


_GEO = (" select round(lat, 2) as lat_bin, round(lon, 2) as long_bin, count(*) as rows_count, "
        "count(distinct concat(vehid, '_', tripid)) as trips_count, "
        "round(avg(speed) + 1e-7, 4) as avg_speed_kmh, "
        "round(avg(fuel_rate_est_lhr) + 1e-7, 4) as avg_fuel_rate_lhr from telemetry "
        "group by 1, 2 order by rows_count desc, lat_bin, long_bin limit ")


@query(TELEMETRY + _GEO + "5000")
def insight_geo(spark, sf):
    return rounded(insights.geo_activity(telemetry(spark, sf)), "avg_speed_kmh avg_fuel_rate_lhr")


@query(TELEMETRY + _GEO + "20")
def topk_geo_cells(spark, sf):
    return rounded(insights.geo_activity(telemetry(spark, sf), top=20),
                   "avg_speed_kmh avg_fuel_rate_lhr")


_EXACT = ("vehid tripid daynum n_sensor_points fuel_valid_points speed_median speed_p95 rpm_p95 "
          "vehtype vehclass transmission drive_wheels gen_weight eng_type eng_dis eng_conf trip_id")
_ROUNDED = " ".join(c for c in S.TRIP_FEATURE_SCHEMA.names if c not in _EXACT.split())
_TRIP_LIST = ", ".join(_EXACT.split()) + ", " + R(_ROUNDED)


@query(TRIPS + f" select {_TRIP_LIST} from trips")
def trip_features(spark, sf):
    return rounded(trip_table(spark, sf), _ROUNDED)


@query(TRIPS + f" select {_TRIP_LIST} from trips order by trips.distance_km desc, vehid, tripid "
       "limit 5000")
def topk_longest_trips(spark, sf):
    return rounded(trips.longest_trips(trip_table(spark, sf)), _ROUNDED)


@query(TELEMETRY + " select vehid, tripid, count(*) as records, "
       "round(avg(speed) + 1e-7, 4) as avg_speed, max(speed) as max_speed, "
       "round(avg(rpm) + 1e-7, 4) as avg_rpm, round(avg(maf) + 1e-7, 4) as avg_maf "
       "from telemetry group by 1, 2")
def trip_aggregation(spark, sf):
    return rounded(trips.trip_aggregation(telemetry(spark, sf)), "avg_speed avg_rpm avg_maf")


@query(" union all ".join(
    f"select '{t}' as table_name, count(*) as row_count, (select count(*)::int from (describe "
    f"{t})) as column_count, '{t}.parquet' as hdfs_path from {t}" for t in TABLES))
def profile_overview(spark, sf):
    return profiling.overview(all_tables(spark, sf), {t: f"{t}.parquet" for t in TABLES})


_DESCRIBED = """
  select '{t}' as table_name, column_name, case column_type when 'VARCHAR' then 'string'
         when 'TIMESTAMP' then 'timestamp_ntz' when 'INTEGER' then 'int' when 'FLOAT[]' then
         'array<float>' else lower(column_type) end as data_type, 'YES' as is_nullable,
         row_number() over ()::int as ordinal_position, (select count(*) from {t}) as n_rows
  from (describe {t})"""


@query(" union all ".join(_DESCRIBED.format(t=t) for t in TABLES))
def profile_column_types(spark, sf):
    tables = all_tables(spark, sf)
    return profiling.column_types(tables, details=True).join(
        profiling.table_counts(tables).withColumnRenamed("records_count", "n_rows"), "table_name")


def _per_column(columns, select):
    return " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, {select.format(c=c)} from {t}"
        for t, names in columns.items() for c in names.split())


_ALL = {t: " ".join(part.get(t, "") for part in (_NUMERIC, _TEXT, _OTHER)) for t in TABLES}


@query(_per_column(_ALL, "count(*) as total_rows, count(*) - count({c}) as null_count, "
                         "round(100.0 * (count(*) - count({c})) / count(*), 4)::double "
                         "as null_pct"))
def profile_missingness(spark, sf):
    return profiling.missing_values(all_tables(spark, sf))


_SUMMARY = ("count({c}) as non_null_count, round(avg({c}) + 1e-7, 4) as mean, "
            "round(stddev({c}) + 1e-7, 4) as stddev, round(variance({c}) / pow(10, floor(log10("
            "nullif(variance({c}), 0)))) + 1e-7, 6) as variance, "
            "floor(log10(nullif(variance({c}), 0)))::double as magnitude, min({c})::double as min, max({c})::double as max")


@query(_per_column(_NUMERIC, _SUMMARY))
def profile_numeric_summary(spark, sf):
    summary = profiling.numeric_summary(all_tables(spark, sf))
    size = F.floor(F.log10(F.nullif(F.col("variance"), F.lit(0.0)))).cast("double")
    summary = summary.withColumn("magnitude", size).withColumn(
        "variance", F.round(F.col("variance") / F.pow(F.lit(10.0), "magnitude") + 1e-7, 6))
    return rounded(summary, "mean stddev")


@query(_per_column(_NUMERIC, ", ".join(
    f"quantile_disc({{c}}, {p})::double as {o}" for o, p in profiling.PROBABILITIES.items())))
def profile_numeric_quantiles(spark, sf):
    return profiling.numeric_quantiles(all_tables(spark, sf), exact=True)


@query(_per_column(_NUMERIC, ", ".join(
    f"count({{c}}) > 0 as {o}" for o in profiling.PROBABILITIES)))
def profile_numeric_quantiles_approx(spark, sf):
    """Whether each sketched quantile is as near to the wanted rank as promised."""
    tables, parts = all_tables(spark, sf), []
    found = profiling.numeric_quantiles(tables)
    for name, columns in _NUMERIC.items():
        columns = columns.split()
        values = tables[name].select(*[F.col(c).cast("double") for c in columns]).unpivot(
            [], columns, "column_name", "v").join(F.broadcast(
                found.where(F.col("table_name") == name)), "column_name")
        n = F.count("v")
        parts.append(values.groupBy("table_name", "column_name").agg(*[
            ((F.count_if(F.col("v") < F.col(o)) <= (p + 4e-4) * n + 1)
             & (F.count_if(F.col("v") <= F.col(o)) >= (p - 4e-4) * n - 1)).alias(o)
            for o, p in profiling.PROBABILITIES.items()]))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query(_per_column(_TEXT, "count(distinct {c}) as approx_distinct_count"))
def profile_categorical(spark, sf):
    return profiling.categorical_summary(all_tables(spark, sf), exact=True)


@query(_per_column(_TEXT, "count(*) >= 0 as near"))
def profile_categorical_approx(spark, sf):
    """Whether each estimate is within a fifth, four times its standard error, of the exact count."""
    tables = all_tables(spark, sf)
    exact = profiling.categorical_summary(tables, exact=True).withColumnRenamed(
        "approx_distinct_count", "n")
    near = F.abs(F.col("approx_distinct_count") - F.col("n")) <= F.greatest(
        F.lit(1.0), 0.2 * F.col("n"))
    return profiling.categorical_summary(tables).join(exact, ["table_name", "column_name"]).select(
        "table_name", "column_name", near.alias("near"))


@query(" union all ".join(f"select '{t}' as table_name, count(*) as records_count from {t}"
                          for t in TABLES))
def table_counts(spark, sf):
    return profiling.table_counts(all_tables(spark, sf))


@query("select p_type as feature_group, count(p_name) as features_count from part group by 1")
def group_summary(spark, sf):
    return profiling.group_summary(table(spark, sf, "part"), "p_type", "p_name") \
        .withColumnRenamed("p_type", "feature_group")


@query(TELEMETRY + """, hits as (
  select least(floor(fuel_rate_est_lhr / (25.0::double / 45)), 44) as bin, count(*) as n
  from telemetry where fuel_rate_est_lhr between 0 and 25 group by 1)
  select cast(b.bin as int) as bin, round(b.bin * (25.0::double / 45) + 1e-7, 4) as bin_low,
         round((b.bin + 1) * (25.0::double / 45) + 1e-7, 4) as bin_high,
         coalesce(n, 0) as rows_count,
         (select round(avg(fuel_rate_est_lhr) + 1e-7, 4) from telemetry) as mean,
         (select round(stddev_pop(fuel_rate_est_lhr) + 1e-7, 4) from telemetry) as std
  from range(45) b(bin) left join hits on hits.bin = b.bin""")
def histogram(spark, sf):
    return rounded(insights.histogram(telemetry(spark, sf), FUEL, 0.0, 25.0),
                   "bin_low bin_high mean std")


@query(TELEMETRY + _missing([*S.TELEMETRY_SCHEMA.names, FUEL], "column_name",
                            ("missing", "missing_share")))
def coverage_after_estimate(spark, sf):
    return insights.coverage_after_estimate(telemetry(spark, sf))


# ---------------------------------------------------------------------------------------------
# Windows, sorts
# ---------------------------------------------------------------------------------------------

# A view with NULL keys, many equal times, NaN speeds, and a trip with a third of all samples.
_ODD = """, odd as (
  select * replace (case when sample_id % 7 = 0 then null when sample_id % 3 = 0 then '5'
                         else vehid end as vehid,
                    case when sample_id % 3 = 0 then '1' when sample_id % 11 = 0 then null
                         else tripid end as tripid,
                    floor(time_seconds / 900) * 900 as time_seconds)
  from telemetry)"""
_ODD_TRIPS = TRIPS.replace("telemetry t left join", "odd t left join").replace(
    "enriched as (", _ODD[2:].strip() + ",\nenriched as (", 1).replace(
    "concat(vehid, '_', tripid) as trip_id", "concat_ws('_', vehid, tripid) as trip_id")


def _odd(spark, sf, nan=False):
    speed = "if(speed is null, double('NaN'), speed)" if nan else "speed"
    return telemetry(spark, sf).withColumns({
        "vehid": F.expr("case when sample_id % 7 = 0 then null when sample_id % 3 = 0 then '5' "
                        "else vehid end"),
        "tripid": F.expr("case when sample_id % 3 = 0 then '1' when sample_id % 11 = 0 then null "
                         "else tripid end"),
        "time_seconds": F.expr("floor(time_seconds / 900) * 900.0D"), "speed": F.expr(speed)})


@query(TELEMETRY + _ODD + " select sample_id, lead(time_seconds) over w as next_time_seconds, "
       "lead(speed) over w as next_speed from odd window w as (partition by vehid, tripid "
       "order by time_seconds, sample_id)")
def lead_next_sample_odd(spark, sf):
    return trips.lead_next_sample(
        _odd(spark, sf).select("sample_id", *KEYS, "time_seconds", "speed"),
        tie="sample_id").select("sample_id", "next_time_seconds", "next_speed")


@query(_ODD_TRIPS + " select sample_id, round(dt_s + 1e-7, 4) as dt_s from steps")
def gap_clamp_odd(spark, sf):
    gaps = trips.gap_clamp(_odd(spark, sf).select("sample_id", *KEYS, "time_seconds"),
                           tie="sample_id", max_gap_s=MAX_GAP_S)
    return rounded(gaps.select("sample_id", "dt_s"), "dt_s")


@query(TELEMETRY + " select sample_id, lead(time_seconds) over w as next_time_seconds, "
       "lead(speed) over w as next_speed from telemetry window w as (partition by vehid, tripid "
       "order by time_seconds, sample_id)")
def lead_next_sample(spark, sf):
    return trips.lead_next_sample(
        telemetry(spark, sf).select("sample_id", *KEYS, "time_seconds", "speed"),
        tie="sample_id").select("sample_id", "next_time_seconds", "next_speed")


@query(TRIPS + " select sample_id, round(dt_s + 1e-7, 4) as dt_s from steps")
def gap_clamp(spark, sf):
    gaps = trips.gap_clamp(telemetry(spark, sf).select("sample_id", *KEYS, "time_seconds"),
                           tie="sample_id", max_gap_s=MAX_GAP_S)
    return rounded(gaps.select("sample_id", "dt_s"), "dt_s")


_INTEGRALS = "observed_seconds distance_km fuel_used_l stop_go_s idle_s"


@query(TRIPS + " select vehid, tripid, round(observed_seconds + 1e-7, 4) as observed_seconds, "
       "round(distance_km + 1e-7, 4) as distance_km, "
       "round(coalesce(fuel_used_l, 0) + 1e-7, 4) as fuel_used_l, "
       "round(stop_go_s + 1e-7, 4) as stop_go_s, round(idle_s + 1e-7, 4) as idle_s from sums")
def segment_integrals(spark, sf):
    return rounded(trips.segment_integrals(telemetry(spark, sf), tie="sample_id",
                                           max_gap_s=MAX_GAP_S), _INTEGRALS)


@query(ORACLE["segment_integrals"].replace(TRIPS, _ODD_TRIPS))
def segment_integrals_odd(spark, sf):
    return rounded(trips.segment_integrals(_odd(spark, sf, nan=True), tie="sample_id",
                                           max_gap_s=MAX_GAP_S), _INTEGRALS)


@query(_ODD_TRIPS + f" select {_TRIP_LIST} from trips")
def trip_features_odd(spark, sf):
    return rounded(trips.trip_features(_odd(spark, sf), vehicles(spark, sf), tie="sample_id",
                                       max_gap_s=MAX_GAP_S, exact=True), _ROUNDED)


@query("select l_returnflag, l_linestatus, count(*) as n_rows, sum(l_linenumber)::bigint as lines"
       " from lineitem group by 1, 2 order by lines, n_rows, 1, 2")
def sort_multi_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_rows"), F.sum("l_linenumber").alias("lines")).orderBy(
            "lines", "n_rows", "l_returnflag", "l_linestatus")


# ---------------------------------------------------------------------------------------------
# Feature selection, modelling, evaluation
# ---------------------------------------------------------------------------------------------

@query(MODEL + f" select {_TRIP_LIST} from model")
def fs_modelling_rows(spark, sf):
    return rounded(model_rows(spark, sf), _ROUNDED)


@query(SCORES + " select feature, round(score + 1e-7, 4) as score, n_rows from scores")
def fs_mutual_information(spark, sf):
    return rounded(selection.mutual_information(model_rows(spark, sf), exact=True), "score")


_RANKED = (" select feature, 'numeric' as feature_type, round(score + 1e-7, 4) as score, "
           "cast(row_number() over (order by round(scores.score, 9) desc, feature) as int) as rank, "
           "case when row_number() over (order by round(scores.score, 9) desc, feature) <= 10 "
           f"then 1 else 0 end as selected, '{selection.METHOD}' as selection_method from scores")


@query(SCORES + _RANKED)
def fs_select_k_best(spark, sf):
    scores = selection.mutual_information(model_rows(spark, sf), exact=True)
    return rounded(selection.select_k_best(scores), "score")


@query(SCORES + " select feature, round(score + 1e-7, 4) as score, cast(row_number() over "
       "(order by round(scores.score, 9) desc, feature) as int) as rank from scores")
def feature_rank(spark, sf):
    scores = selection.mutual_information(model_rows(spark, sf), exact=True)
    return rounded(selection.feature_rank(scores).select("feature", "score", "rank"), "score")


@query(MODEL + " unpivot (select " + ", ".join(
    f"count({c}) as {c}" for c in S.CATEGORICAL_FEATURES)
    + " from model) on columns(*) into name feature value n_values")
def fs_keep_categorical(spark, sf):
    rows = model_rows(spark, sf)
    kept = selection.keep_categorical(rows).select("feature")
    names = list(S.CATEGORICAL_FEATURES)
    counts = rows.agg(*[F.count(c).alias(c) for c in names]).unpivot(
        [], names, "feature", "n_values")
    return kept.join(counts, "feature")


_BUCKET = ("cast(concat('0x', substr(md5(concat(vehid, '_', tripid, '_42')), 1, 8)) as bigint) "
           "% 10000")


@query(MODEL + f" select trip_id, case when {_BUCKET} < 7000 then 'train' else 'test' end "
       "as part from model")
def split_train_test(spark, sf):
    train, test = selection.split_train_test(model_rows(spark, sf))
    return train.select("trip_id", F.lit("train").alias("part")).unionByName(
        test.select("trip_id", F.lit("test").alias("part")))


@query(MODEL + f" select case when {_BUCKET} < 7000 then 'train' else 'test' end as dataset, "
       "count(*) as row_count, 34 as columns_count, '' as hdfs_path from model group by 1")
def split_metadata(spark, sf):
    return selection.split_metadata(*selection.split_train_test(model_rows(spark, sf)))


_IMPUTED = ["maf_mean", "speed_mean", "eng_dis"]


@query(MODEL + " select trip_id, " + ", ".join(
    f"round(coalesce({c}, (select quantile_disc({c}, 0.5) from model)) + 1e-7, 4) as {c}_imputed"
    for c in _IMPUTED) + " from model")
def ml_impute_median(spark, sf):
    rows = model_rows(spark, sf)
    filled = modeling.impute_stage(_IMPUTED, 1e-6).fit(rows).transform(rows)
    outputs = [c + "_imputed" for c in _IMPUTED]
    return rounded(filled.select("trip_id", *outputs), " ".join(outputs))


def _index_sql(column):
    return (f"(select {column} as v, row_number() over (order by count(*) desc, {column}) - 1 "
            f"as i from model where {column} is not null group by {column})")


@query(MODEL + " select trip_id, vehtype, cast(coalesce(i, (select count(distinct vehtype) from "
       f"model)) as double) as vehtype_idx from model left join {_index_sql('vehtype')} x on "
       "vehtype = v")
def ml_string_index(spark, sf):
    rows = model_rows(spark, sf)
    return modeling.index_stage(["vehtype"]).fit(rows).transform(rows).select(
        "trip_id", "vehtype", "vehtype_idx")


@query(MODEL + " select trip_id, cast(coalesce(i, -1) as int) as hot, (select count(distinct "
       f"vehtype)::int from model) as width from model left join {_index_sql('vehtype')} x on "
       "vehtype = v")
def ml_one_hot(spark, sf):
    rows = model_rows(spark, sf)
    stages = Pipeline(stages=[modeling.index_stage(["vehtype"]),
                              modeling.one_hot_stage(["vehtype"])])
    encoded = vector_to_array("vehtype_oh")
    return stages.fit(rows).transform(rows).select(
        "trip_id", (F.array_position(encoded, F.lit(1.0)) - 1).cast("int").alias("hot"),
        F.size(encoded).alias("width"))


@query(MODEL + " select trip_id, round(distance_km + coalesce(eng_dis, 0) + 1e-7, 4) as total, "
       "2 as width from model")
def ml_assemble(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    rows = model_rows(spark, sf)
    vectors = VectorAssembler(inputCols=["distance_km", "eng_dis"], outputCol="v",
                              handleInvalid="keep").transform(rows)
    values = vector_to_array("v")
    total = F.aggregate(values, F.lit(0.0),
                        lambda a, x: a + F.when(F.isnan(x), 0.0).otherwise(x))
    return rounded(vectors.select("trip_id", total.alias("total"), F.size(values).alias("width")),
                   "total")


@query(MODEL + " select trip_id, round(distance_km / (select stddev(distance_km) from model) "
       "+ 1e-7, 4) as scaled from model")
def ml_scale(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    rows = model_rows(spark, sf)
    stages = Pipeline(stages=[
        VectorAssembler(inputCols=["distance_km"], outputCol="raw_features"),
        modeling.scale_stage()])
    scaled = vector_to_array("features")[0].alias("scaled")
    return rounded(stages.fit(rows).transform(rows).select("trip_id", scaled), "scaled")


def _line(rows, feature):
    """Ordinary least squares on one feature, as a fitted pipeline."""
    model = LinearRegression(labelCol=S.LABEL, maxIter=50)
    return modeling.build_pipeline(model, [feature], []).fit(rows)


def _labelled(spark, sf):
    return model_rows(spark, sf).withColumnRenamed(S.TARGET, S.LABEL)


@query(MODEL + " select round(regr_slope(fuel_l_per_100km, speed_mean) + 1e-7, 4) as slope, "
       "round(regr_intercept(fuel_l_per_100km, speed_mean) + 1e-7, 4) as intercept from model")
def ml_linear(spark, sf):
    rows = _labelled(spark, sf)
    line = _line(rows, "speed_mean").stages[-1]
    fitted = rows.agg(F.count("*")).select(F.lit(float(line.coefficients[0])).alias("slope"),
                                           F.lit(float(line.intercept)).alias("intercept"))
    return rounded(fitted, "slope intercept")


_LINES = ["speed_mean", "distance_km"]
_PREDICTED = MODEL + ", predicted as (" + " union all ".join(
    f"select 'LinearRegression {c}' as model, vehid, tripid, fuel_l_per_100km as label, "
    f"{c} * (select regr_slope(fuel_l_per_100km, {c}) from model) + "
    f"(select regr_intercept(fuel_l_per_100km, {c}) from model) as prediction from model"
    for c in _LINES) + """),
evaluated as (
  select model, sqrt(avg((label - prediction) ** 2)) as rmse, avg(abs(label - prediction)) as mae,
         1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)) as r2
  from predicted group by model)"""


def _predicted(spark, sf):
    rows = _labelled(spark, sf)
    parts = [_line(rows, c).transform(rows).select(
        F.lit(f"LinearRegression {c}").alias("model"), *KEYS, S.LABEL, "prediction")
        for c in _LINES]
    return parts[0].unionByName(parts[1])


def _evaluated(spark, sf):
    return evaluation.evaluate(_predicted(spark, sf), by=["model"])


@query(_PREDICTED + " select round(label + 1e-7, 4) as actual_fuel_l_per_100km, "
       "round(prediction + 1e-7, 4) as predicted_fuel_l_per_100km, "
       "round(abs(label - prediction) + 1e-7, 4) as absolute_error from predicted "
       "where model = 'LinearRegression speed_mean'")
def ml_predict(spark, sf):
    rows = _labelled(spark, sf)
    report = modeling.predict(_line(rows, "speed_mean"), rows)
    return rounded(report, " ".join(report.columns))


@query(_PREDICTED + f" select model, {R('rmse mae r2')} from evaluated")
def eval_regression(spark, sf):
    return rounded(_evaluated(spark, sf), "rmse mae r2")


@query(_PREDICTED + f" select 'Linear Regression' as model_name, {R('rmse mae r2')} "
       "from evaluated")
def eval_normalized(spark, sf):
    return rounded(evaluation.normalized_evaluation(_evaluated(spark, sf)), "rmse mae r2")


@query(_PREDICTED + " select model, upper(m) as metric, round(v + 1e-7, 4) as metric_value from "
       "(unpivot evaluated on rmse, mae, r2 into name m value v)")
def unpivot_metrics(spark, sf):
    return rounded(evaluation.unpivot_metrics(_evaluated(spark, sf), "model"), "metric_value")


@query(_PREDICTED + " select model, 'RMSE' as selection_metric, round(rmse + 1e-7, 4) as "
       f"selection_value, {R('rmse mae r2')} from evaluated order by evaluated.rmse, model "
       "limit 1")
def best_model(spark, sf):
    best = evaluation.best_model(_evaluated(spark, sf), name="model")
    return rounded(best, "selection_value rmse mae r2")


_LINE1 = " from predicted where model = 'LinearRegression speed_mean'"
_REPORT1 = ("round(label + 1e-7, 4) as actual_fuel_l_per_100km, round(prediction + 1e-7, 4) as "
            "predicted_fuel_l_per_100km, round(abs(label - prediction) + 1e-7, 4) as "
            "absolute_error")


@query(_PREDICTED + f" select 'LinearRegression' as model, {_REPORT1}" + _LINE1
       + " order by abs(label - prediction), label, prediction limit 1")
def specific_prediction(spark, sf):
    rows = _labelled(spark, sf)
    found = evaluation.specific_prediction(modeling.predict(_line(rows, "speed_mean"), rows),
                                           "LinearRegression")
    return rounded(found, " ".join(found.columns[1:]))


@query(_PREDICTED + f" select vehid, tripid, {_REPORT1}" + _LINE1
       + " order by vehid, tripid limit 100")
def prediction_samples(spark, sf):
    rows = _labelled(spark, sf)
    predicted = _line(rows, "speed_mean").transform(rows)
    errors = predicted.select(
        *KEYS, F.col(S.LABEL).alias("actual_fuel_l_per_100km"),
        F.col("prediction").alias("predicted_fuel_l_per_100km"),
        F.abs(F.col(S.LABEL) - F.col("prediction")).alias("absolute_error"))
    return rounded(evaluation.prediction_samples(errors, 100, KEYS),
                   " ".join(errors.columns[2:]))


@query(_PREDICTED + " select model as model_name, row_id, round(label + 1e-7, 4) as label, "
       "round(prediction + 1e-7, 4) as prediction, round(prediction - label + 1e-7, 4) as error, "
       "round(abs(prediction - label) + 1e-7, 4) as abs_error from (select *, cast(row_number() "
       "over (partition by model order by vehid, tripid) as int) as row_id from predicted) "
       "where row_id <= 5000 and tripid <> '2'")
def row_id_per_model(spark, sf):
    """Predictions as text, some of which are no numbers."""
    predicted = _predicted(spark, sf).withColumn("prediction", F.when(
        F.col("tripid") == "2", "n/a").otherwise(F.col("prediction").cast("string")))
    parts = [evaluation.prediction_rows(predicted.where(F.col("model") == name), name, order=KEYS)
             for name in (f"LinearRegression {c}" for c in _LINES)]
    return rounded(parts[0].unionByName(parts[1]), "label prediction error abs_error")


@functools.lru_cache(maxsize=None)
def _parts(app, sf):
    """Train and test rows with the features that the selection reports as selected."""
    from pyspark.sql import SparkSession
    rows = model_rows(SparkSession.active(), sf)
    report = materialise(selection.feature_selection(rows))
    prepared = selection.prepare(rows, *selection.selected_names(report))
    return tuple(materialise(p) for p in selection.split_train_test(prepared))


def _train_test(spark, sf):
    return _parts(spark.sparkContext.applicationId, sf)


# Learners cannot be restated in SQL, so their queries have none: they return the metrics, errors and
# parameters of the run, and whether reported metrics are those of the stored predictions.
_TEST_ROWS = f"(select count(*) from model where {_BUCKET} >= 7000)"


def _sound(predictions, name, on_train, metrics=None):
    """Rows of the test part, whether reported metrics are those of the stored predictions, and
    whether the model fits its own training rows no worse than their mean does."""
    fit = evaluation.evaluate(on_train).select("rmse").scalar()
    spread = on_train.agg(F.stddev_pop(S.LABEL)).scalar()
    again = evaluation.evaluate(predictions).withColumns({
        "test_rows": predictions.agg(F.count("prediction")).scalar(),
        "fits": fit <= spread * (1 + 1e-9)})
    agrees = F.lit(True)
    for m in evaluation.METRICS:
        if metrics is not None:
            agrees = agrees & (F.abs(F.col(m) - F.lit(metrics[m])) <= 1e-9 * F.abs(F.col(m)))
    return again.select(F.lit(name).alias("model"), "test_rows", *evaluation.METRICS,
                        agrees.alias("agrees"), "fits")


def _fit_and_score(spark, sf, name, model, scale=False):
    train, test = _train_test(spark, sf)
    numeric, categorical = modeling.usable_columns(train)
    fitted = modeling.build_pipeline(model, numeric, categorical, scale).fit(train)
    return _sound(materialise(fitted.transform(test).select(S.LABEL, "prediction")), name,
                  fitted.transform(train))


@query()
def ml_pipeline(spark, sf):
    model = LinearRegression(labelCol=S.LABEL, maxIter=50, regParam=0.1)
    return _fit_and_score(spark, sf, "LinearRegression", model, scale=True)


@query()
def ml_linear_grid(spark, sf):
    """Error over the folds of every penalty of the linear grid, solved from sums."""
    train, _ = _train_test(spark, sf)
    numeric, categorical = modeling.usable_columns(train)
    spec = modeling.default_specs()[0]
    found = modeling.cross_validate(spec, train, numeric, categorical)
    return spark.createDataFrame(
        [(spec.name, modeling.param_text(p), float(v))
         for p, v in zip(spec.param_maps(), found.avg_metrics)],
        "model string, params string, avg_cv_rmse double")


@query()
def ml_random_forest(spark, sf):
    name = "RandomForestRegressor"
    return _fit_and_score(spark, sf, name, modeling.ablation_models()[name])


@query()
def ml_gbt(spark, sf):
    name = "GBTRegressor"
    return _fit_and_score(spark, sf, name, modeling.ablation_models()[name])


@functools.lru_cache(maxsize=None)
def _trained(app, sf, preset):
    """A whole training with the preset's own grids, folds and iterations, once per session."""
    from pyspark.sql import SparkSession
    train, test = _train_test(SparkSession.active(), sf)
    specs = modeling.default_specs if preset == "three" else modeling.two_model_specs
    return modeling.train_all(specs(), train, test)


def _results(spark, sf, preset="three"):
    return _trained(spark.sparkContext.applicationId, sf, preset)


def _grid_sql(grids):
    """Every model with every grid point, as ``param_text`` writes it."""
    rows = [(model, "; ".join(sorted(f"{k}={v}" for k, v in zip(grid, point))))
            for model, grid in grids.items() for point in itertools.product(*grid.values())]
    return "(values " + ", ".join(map(str, rows)) + ") v(model, params)"


@query()
def ml_cross_validate(spark, sf):
    return modeling.cv_results(spark, _results(spark, sf))


@query(f"select model, count(*) as grid_points, {S.CV_FOLDS} as cv_folds from "
       f"{_grid_sql(modeling.GRIDS)} group by model")
def ml_cv_results(spark, sf):
    results = _results(spark, sf)
    folds = modeling.training_log(spark, results).select("model", "cv_folds")
    return modeling.cv_results(spark, results).groupBy("model").agg(
        F.count("*").alias("grid_points")).join(folds, "model")


@query()
def ml_best_params(spark, sf):
    """The chosen parameters, and the lowest error of all grid points."""
    results = _results(spark, sf)
    lowest = modeling.cv_results(spark, results).groupBy("model").agg(
        F.min("avg_cv_rmse").alias("avg_cv_rmse"))
    return modeling.training_log(spark, results).select("model", "best_params").join(lowest, "model")


def _all_sound(spark, sf, results, reported):
    train, _ = _train_test(spark, sf)
    return functools.reduce(lambda a, b: a.unionByName(b), [
        _sound(r.predictions, r.summary["model"], r.model.transform(train),
               reported[r.summary["model"]]) for r in results])


@query()
def eval_table(spark, sf):
    results = _results(spark, sf)
    reported = {r["model"]: r for r in modeling.evaluation_table(spark, results).collect()}
    return _all_sound(spark, sf, results, reported)


@query()
def training_log(spark, sf):
    return modeling.training_log(spark, _results(spark, sf))


@query()
def ml_legacy_two_model(spark, sf):
    results = _results(spark, sf, "two")
    return _all_sound(spark, sf, results, {r.summary["model"]: r.summary for r in results})


@query(ORACLE["ml_predict"])
def model_save_load(spark, sf):
    rows = _labelled(spark, sf)
    path = scratch_path(spark, "model")
    modeling.save_model(_line(rows, "speed_mean"), path)
    report = modeling.predict(modeling.load_model(path), rows)
    return rounded(report, " ".join(report.columns))


@query(MODEL + " select feature_set, model, " + _TEST_ROWS.replace(
    "where", "where fuel_l_per_100km > 0 and") + " as test_rows, true as sound from (values "
    "('all_features'), ('selected_features')) f(feature_set), (values "
    + ", ".join(f"('{m}')" for m in modeling.GRIDS) + ") m(model)")
def ml_feature_ablation(spark, sf):
    found = modeling.feature_ablation(model_rows(spark, sf))
    sound = (F.col("rmse") > 0) & (F.col("mae") <= F.col("rmse")) & (F.col("train_time_sec") > 0)
    return found.select("feature_set", "model", "test_rows", sound.alias("sound"))


# ---------------------------------------------------------------------------------------------
# Benchmark jobs
# ---------------------------------------------------------------------------------------------

@query("select method, operation, n as row_count, details from (select count(*) as n from events), "
       "(values ('raw_csv', 'write', 'Spark write CSV'), ('spark_csv', 'read', 'Spark read CSV with "
       "inferred schema'), ('spark_parquet_snappy', 'write', 'Spark write Parquet Snappy'), "
       "('spark_parquet_snappy', 'read', 'Spark read Parquet Snappy')) v(method, operation, details)")
def bench_ingest(spark, sf):
    return benchmarks.bench_ingest(raw_telemetry(spark, sf), scratch_path(spark, "ingest")).drop(
        "runtime_sec")


@query(MODEL + " select format, compression, n as read_rows, n as source_rows, true as sized from "
       "(select count(*) as n from model), (values "
       + ", ".join(str(v) for v in benchmarks.VARIANTS if v[0] != "avro")
       + ") v(format, compression)")
def bench_storage(spark, sf):
    """Without Avro, which needs a module that is not always there."""
    found = benchmarks.bench_storage(model_rows(spark, sf), scratch_path(spark, "storage"))
    return found.where("format <> 'avro'").select(
        "format", "compression", "read_rows", "source_rows",
        (F.col("hdfs_size_mb") > 0).alias("sized"))


@query(MODEL + " select 'read_trips' as stage_name, count(*) as output_rows from telemetry "
       "union all select 'filter_valid_speed', count(speed) from telemetry "
       "union all select 'read_vehicles', count(*) from vehicles "
       "union all select 'join_trips_vehicles', count(*) from enriched "
       "union all select 'trip_level_aggregation', count(*) from (select distinct vehid, tripid "
       "from telemetry) union all select 'read_trip_features', count(*) from model")
def bench_processing(spark, sf):
    return benchmarks.bench_processing(telemetry(spark, sf), vehicles(spark, sf),
                                       model_rows(spark, sf)).drop("runtime_sec")
