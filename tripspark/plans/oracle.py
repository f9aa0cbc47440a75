"""DuckDB SQL that states what each registered query must return."""

from .. import schema as S

# The telemetry and vehicle view of proxy.py, restated in DuckDB.
_EVENTS = """
ev as (
  select event_id as sample_id, user_id, event_type, value, ts,
         cast(json_extract_string(props, '$.k') as int) as k
  from events),
raw_telemetry as (
  select cast(day(ts) as double) as daynum,
         cast(user_id as varchar) as vehid,
         cast(cast(floor((day(ts) - 1) / 5) as int) as varchar) as tripid,
         epoch_us(ts) / 1000.0::double as time,
         42.2::double + (sample_id % 97) * 0.00113::double as lat,
         -83.8::double + (sample_id % 89) * 0.00117::double as lon,
         case when sample_id % 50 = 7 then 'nan'::double
              when event_type = 'signup' then null else value end as speed,
         case when event_type in ('click', 'view') then value / 10 end as maf,
         600.0::double + 20 * k as rpm,
         cast(k as double) as abs_load,
         case when sample_id % 11 <> 0 then (k - 50) / 2.0::double end as oat,
         case when event_type = 'purchase' then value / 20 end as fuel_rate,
         case when event_type = 'error' then k / 50.0::double end as air_cp_kw,
         case when event_type = 'view' then k * 10.0::double end as air_cp_watts,
         case when event_type = 'click' then k * 5.0::double end as heater_power,
         case when user_id % 10 = 0 then value - 50 end as hv_battery_current,
         case when user_id % 10 = 0 then cast(k as double) end as hv_battery_soc,
         case when user_id % 10 = 0 then 200.0::double + k end as hv_battery_vol,
         case when sample_id % 2 = 0 then k / 10.0::double - 5 end as stfb_1,
         case when sample_id % 3 = 0 then k / 20.0::double - 2 end as stfb_2,
         case when sample_id % 2 = 0 then k / 25.0::double end as ltfb_1,
         case when sample_id % 5 = 0 then -k / 25.0::double end as ltfb_2,
         sample_id
  from ev),
telemetry as (
  select * replace (case when isnan(speed) then null else speed end as speed),
         time as time_raw_ms, time / 1000 as time_seconds,
         coalesce(fuel_rate, maf / 14.7::double / 745.0::double * 3600) as fuel_rate_est_lhr,
         case when not isnan(speed) and speed < 5 then 1 else 0 end as is_stop_go,
         case when not isnan(speed) and speed < 0.1 then 1 else 0 end as is_idle
  from raw_telemetry)"""

_VEHICLES = """
raw_vehicles as (
  select concat(case when c_custkey % 20 = 0 then 'spare-' else '' end, c_custkey) as vehid,
         case when c_mktsegment = 'HOUSEHOLD' then 'NO DATA' else c_mktsegment end as vehtype,
         n_name as vehclass,
         case c_custkey % 3 when 0 then 'CVT' when 1 then 'NO DATA'
              else '6-SP AUTOMATIC' end as transmission,
         case when c_custkey % 2 = 0 then 'FWD' else 'AWD' end as drive_wheels,
         abs(c_acctbal) as gen_weight,
         case when c_custkey % 4 = 0 then 'HEV' else 'ICE' end as eng_type,
         case when c_mktsegment = 'MACHINERY' then 'ELECTRIC MOTOR'
              when c_custkey % 7 = 0 then '2.0L'
              else concat('I', 4 + c_custkey % 3, ' ', 1 + c_custkey % 4, '.',
                          c_custkey % 10, 'L') end as engine_raw
  from customer join nation on c_nationkey = n_nationkey),
engines as (
  select *, regexp_extract(engine_raw, '(\\d\\.\\d)L', 1) as dis_text,
         trim(regexp_replace(engine_raw, '(\\d\\.\\d)L', '', 'g')) as conf_text
  from raw_vehicles),
vehicles as (
  select vehid, nullif(vehtype, 'NO DATA') as vehtype, vehclass,
         nullif(transmission, 'NO DATA') as transmission, drive_wheels, gen_weight, eng_type,
         cast(nullif(dis_text, '') as double) as eng_dis,
         case when dis_text <> '' and conf_text = '' then null else conf_text end as eng_conf
  from engines)"""

_ENRICHED = """
enriched as (
  select t.*, v.* exclude (vehid) from telemetry t left join vehicles v on t.vehid = v.vehid)"""

_TRIPS = """
steps as (
  select *, case when next_s - time_seconds > 0 and next_s - time_seconds < 21600
                 then next_s - time_seconds else 0 end as dt_s
  from (select *, lead(time_seconds) over (partition by vehid, tripid
                                           order by time_seconds, sample_id) as next_s
        from enriched)),
sums as (
  select vehid, tripid, min(daynum) as daynum, count(*) as n_sensor_points,
         (max(time_seconds) - min(time_seconds)) / 60 as duration_min,
         sum(dt_s) as observed_seconds,
         sum(coalesce(speed, 0) * dt_s / 3600) as distance_km,
         sum(fuel_rate_est_lhr * dt_s / 3600) as fuel_used_l,
         count(fuel_rate_est_lhr) as fuel_valid_points,
         sum(case when coalesce(speed, 0) < 5 then dt_s else 0 end) as stop_go_s,
         sum(case when coalesce(speed, 0) < 0.1 then dt_s else 0 end) as idle_s,
         avg(speed) as speed_mean, quantile_disc(speed, 0.5) as speed_median,
         quantile_disc(speed, 0.95) as speed_p95,
         avg(maf) as maf_mean, quantile_disc(maf, 0.95) as maf_p95,
         avg(rpm) as rpm_mean, quantile_disc(rpm, 0.95) as rpm_p95,
         avg(abs_load) as abs_load_mean, avg(oat) as oat_mean,
         avg(hv_battery_current) as hv_current_mean, avg(hv_battery_soc) as hv_soc_mean,
         avg(hv_battery_vol) as hv_voltage_mean, avg(fuel_rate_est_lhr) as fuel_rate_mean_lhr,
         max(vehtype) as vehtype, max(vehclass) as vehclass, max(transmission) as transmission,
         max(drive_wheels) as drive_wheels, max(gen_weight) as gen_weight,
         max(eng_type) as eng_type, max(eng_dis) as eng_dis, max(eng_conf) as eng_conf
  from steps group by vehid, tripid),
trips as (
  select * exclude (stop_go_s, idle_s), concat(vehid, '_', tripid) as trip_id,
         case when observed_seconds > 0 then stop_go_s / observed_seconds end as stop_go_ratio,
         idle_s / 60 as idle_time_min,
         case when distance_km > 0 then 100 * fuel_used_l / distance_km end as fuel_l_per_100km
  from sums where distance_km >= 0.5)"""


_MODEL = """
bounds as (
  select quantile_disc(fuel_l_per_100km, 0.01) as lo, quantile_disc(fuel_l_per_100km, 0.99) as hi
  from trips where fuel_l_per_100km > 0),
model as (
  select trips.* from trips, bounds
  where fuel_l_per_100km > 0 and fuel_l_per_100km between lo and hi and distance_km >= 0.5
    and duration_min > 0 and speed_mean between 0 and 160)"""


def _cells(feature):
    filled = (f"select coalesce({feature}, (select quantile_disc({feature}, 0.5) from model)) "
              "as x, fuel_l_per_100km as y from model")
    return f"""
  select '{feature}' as feature, count(*) as n,
         case when hi > lo then least(floor((x - lo) / (hi - lo) * 32), 31)
              when hi = lo then 0 end as bin_x,
         least(floor((y - ylo) / (yhi - ylo) * 32), 31) as bin_y
  from ({filled}) f,
       (select min(x) as lo, max(x) as hi, min(y) as ylo, max(y) as yhi from ({filled}))
  group by all"""


_SCORES = """
cells as (""" + " union all ".join(map(_cells, S.NUMERIC_CANDIDATES)) + """),
marginals as (
  select *, sum(n) over (partition by feature) as n_all,
         sum(n) over (partition by feature, bin_x) as n_x,
         sum(n) over (partition by feature, bin_y) as n_y
  from cells),
scores as (
  select feature, sum(n / n_all * ln(n * n_all / (n_x * n_y))) as score,
         cast(sum(n) as bigint) as n_rows
  from marginals group by feature)"""


def _view(*parts):
    return "with" + ",".join(parts)


TELEMETRY = _view(_EVENTS)
VEHICLES = _view(_VEHICLES)
ENRICHED = _view(_EVENTS, _VEHICLES, _ENRICHED)
TRIPS = _view(_EVENTS, _VEHICLES, _ENRICHED, _TRIPS)
MODEL = _view(_EVENTS, _VEHICLES, _ENRICHED, _TRIPS, _MODEL)
SCORES = _view(_EVENTS, _VEHICLES, _ENRICHED, _TRIPS, _MODEL, _SCORES)


def rounded(names, prefix=""):
    """Select list with the same offset rounding as registry.rounded."""
    return ", ".join(f"round({prefix}{n} + 1e-7, 4) as {n}" for n in names.split())
