"""The registered queries as plain SQL over the same tables.

Written apart from the operators: joins where they aggregate, sorted row numbers where they count.
"""

from __future__ import annotations

from hourgrid import fixed_values as fv

T = "(l_shipdate + to_hours(cast(l_partkey % 24 as integer)))"
LAT = "(38.0::double + (l_suppkey % 27) * 0.25::double)"
LON = "(68.0::double + (l_suppkey % 57) * 0.25::double)"
AT = "time, latitude, longitude"


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double, and no negative zero."""
    return f"(cast(round(cast(cast({expr} as varchar) as decimal(38, 16)), {digits}) as double) + 0.0::double)"


def time_key(ts: str) -> str:
    return f"cast(strftime({ts}, '%Y%m%d%H') as bigint)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


KEYS = f"keys as (select {T} as time, {LAT} as latitude, {LON} as longitude from lineitem)"
G = f"""g as (
  select {T} as time, {LAT} as latitude, {LON} as longitude,
         max(l_quantity) q, max(l_partkey) pk, max(l_tax) tax, max(l_discount) disc,
         max(l_extendedprice) ep, max(l_linenumber) ln, max(l_suppkey) sk
  from lineitem group by 1, 2, 3)"""
W = (
    G
    + """,
w as (
  select time, latitude, longitude,
         year(time) as year, month(time) as month, day(time) as day, hour(time) as hour,
         isodow(time) as day_of_week, quarter(time) as quarter,
         q * 1.25::double - 25 as temperature_c,
         q * 1.25::double - 25 - (pk % 40) * 0.25::double as dewpoint_c,
         (90000::double + pk) / 100 as pressure_hpa,
         tax * 10 as precipitation_mm,
         sqrt((ln * ln + (sk % 10) * (sk % 10))::double) as wind_speed_ms,
         disc * 10 as cloud_cover,
         ep as solar_radiation
  from g)"""
)
# The same as stored in the star, where three measures are floats.
WS = (
    W
    + """,
ws as (
  select * replace (precipitation_mm::float::double as precipitation_mm, cloud_cover::float::double as cloud_cover,
                    solar_radiation::float::double as solar_radiation) from w)"""
)
STREAMS = (
    G
    + f""",
instant as (
  select {AT}, q * 1.25::double - 25 + 273.15::double as t2m,
         q * 1.25::double - 25 + 273.15::double - (pk % 40) * 0.25::double as d2m,
         90000::double + pk as msl, ln::double as u10, (sk % 10)::double as v10, disc * 10 as tcc
  from g where pk % 89 <> 0),
accum as (select {AT}, tax / 100 as tp from g where pk % 97 <> 0),
average as (select {AT}, ep as avg_sdswrf from g where pk % 101 <> 0),
extreme as (
  select {AT}, q * 1.25::double - 25 + 274.15::double as mx2t, q * 1.25::double - 25 + 272.15::double as mn2t
  from g where pk % 103 <> 0)"""
)
AGREES = """select time::date as day, count(*) filter (pk % 89 <> 0) as instant, count(*) filter (pk % 97 <> 0) as accum,
       count(*) filter (pk % 101 <> 0) as avg, count(*) filter (pk % 103 <> 0) as max,
       bool_and((pk % 89 <> 0) = (pk % 97 <> 0) and (pk % 97 <> 0) = (pk % 101 <> 0) and (pk % 101 <> 0) = (pk % 103 <> 0)) as agrees
from g group by 1"""
JOINED = (
    STREAMS
    + f""",
joined as (
  select * from instant join accum using ({AT}) join average using ({AT}) join extreme using ({AT}))"""
)
CONFORMED = (
    JOINED
    + f""",
conformed as (
  select {AT}, {time_key('time')} as time_id,
         {rounded('t2m - 273.15::double', 2)} as temperature_c,
         {rounded('d2m - 273.15::double', 2)} as dewpoint_c,
         {rounded('mx2t - 273.15::double', 2)} as max_temp_c,
         {rounded('mn2t - 273.15::double', 2)} as min_temp_c,
         {rounded('msl / 100', 2)} as pressure_hpa,
         {rounded('tp * 1000', 4)} as precipitation_mm,
         {rounded('sqrt(u10 * u10 + v10 * v10)', 2)} as wind_speed_ms,
         tcc as cloud_cover, avg_sdswrf as solar_radiation
  from joined)"""
)
# The same over streams stored as floats.
STORED = (
    JOINED
    + f""",
stored as (
  select {AT}, {time_key('time')} as time_id, time as timestamp,
         {rounded('t2m::float::double - 273.15::double', 2)} as temperature_c,
         {rounded('d2m::float::double - 273.15::double', 2)} as dewpoint_c,
         {rounded('mx2t::float::double - 273.15::double', 2)} as max_temp_c,
         {rounded('mn2t::float::double - 273.15::double', 2)} as min_temp_c,
         {rounded('msl::float::double / 100', 2)} as pressure_hpa,
         {rounded('tp::float::double * 1000', 4)}::float::double as precipitation_mm,
         {rounded('sqrt(u10 * u10 + v10 * v10)', 2)} as wind_speed_ms,
         tcc::float::double as cloud_cover, avg_sdswrf::float::double as solar_radiation
  from joined)"""
)
MEASURES = "temperature_c, dewpoint_c, pressure_hpa, precipitation_mm, wind_speed_ms, cloud_cover, solar_radiation"
FEATURES = "time, " + ", ".join([fv.TARGET, *fv.FEATURES])
LATEST = W + f""",
latest as (select {FEATURES} from w order by time desc, latitude, longitude limit 168),
frame as (
  select *, row_number() over (order by time, latitude, longitude) as step, max(time) over () as newest from latest)"""
KPI = W + f""",
lasty as (select max(year) as y from w),
kpi as (
  select coalesce(max(y), 2024) as year,
         {rounded('avg(temperature_c) filter (year = y)', 2)} as current_temp,
         {rounded('avg(temperature_c) filter (year < y)', 2)} as history_temp,
         count(distinct time::date) filter (year = y and (temperature_c > 35 or temperature_c < -20)) as extreme_days,
         {rounded('count(distinct time::date) filter (year < y and (temperature_c > 35 or temperature_c < -20))'
                  '::double / count(distinct year)', 1)} as extreme_hist_avg
  from w, lasty)"""
SPLIT = W + f""",
numbered as (
  select {FEATURES}, row_number() over (order by time, latitude, longitude) as rn, count(*) over () as n from w),
split as (select *, rn > n - ceil(0.2::double * n)::bigint as is_test from numbered),
means as (select month, hour, avg(temperature_c) as prediction from split where not is_test group by 1, 2),
scored as (select s.*, m.prediction from split s left join means m using (month, hour) where is_test)"""
SUMMARY = LATEST + """,
summary as (
  select avg(temperature_c) as avg_temp, min(temperature_c) as min_temp, max(temperature_c) as max_temp,
         avg(wind_speed_ms) as avg_wind, sum(precipitation_mm) as total_precip from frame)"""


def _correlation(column: str) -> str:
    ratio = f"covar_pop(temperature_c, {column}) / nullif(stddev_pop(temperature_c) * stddev_pop({column}), 0)"
    return rounded(ratio, 3)


CORRELATIONS = (
    W + ",\ncorrelations as (select " + ", ".join(f"{_correlation(col)} as {code}" for code, _, col in fv.FACTORS)
    + " from w)"
)


def _drill(grain: str, func: str, source: str = "w") -> str:
    label = {"year": "strftime(time, '%Y')", "month": "strftime(time, '%Y-%m')", "day": "strftime(time, '%Y-%m-%d')"}
    rain = "sum" if func == "avg" else func
    return f"""with {WS}
select {label[grain]} as label, {rounded(f'{func}(temperature_c)', 2)} as temp,
       {rounded(f'{rain}(precipitation_mm)', 2)} as precip
from {source} group by 1"""


def _advice(values: tuple[str, ...]) -> str:
    names = ("sector", "icon", "status", "action", "detail")
    return "{" + ", ".join(f"{text(n)}: {text(v)}" for n, v in zip(names, values, strict=True)) + "}"


def _coverage() -> str:
    parts = []
    for stream, view in (("instant", "instant"), ("accum", "accum"), ("avg", "average"), ("max", "extreme")):
        parts.append(
            f"select {text(stream)} as stream, (select count(*) from {view}) as cells, "
            f"(select count(*) from {view} anti join joined using ({AT})) as lost"
        )
    return f"with {JOINED}\n" + "\nunion all ".join(parts)


def oracle_sql() -> dict[str, str]:
    sql = {
        "scan_stream": "select event_id, ts, user_id, event_type, value from events",
        "backfill_scan": f"""with {W}
select strftime(time, '%Y_%m') as period, count(*) as rows, min(temperature_c) as min_temp,
       max(temperature_c) as max_temp from w group by 1""",
        "bbox_subset": f"""with {W}
select {AT}, temperature_c, pressure_hpa from w
where latitude between 39 and 43 and longitude between 70 and 80 and hour between 6 and 17""",
        "lagged_day": """select event_id, ts, user_id, value from events
where ts::date = date '2024-01-20' - interval 5 day""",
        "last_year": f"with {KEYS} select coalesce(max(year(time)), 2024) as year from keys",
        "write_clean": "select event_id, ts as time, value, strftime(ts, '%Y-%m-%d') as date from events",
        "dim_upsert": """with marked as (
  select *, o_orderdate >= timestamp '1998-07-01' as since from orders),
ranked as (
  select *, row_number() over (partition by o_custkey order by since desc, o_orderkey desc) as rn from marked)
select o_custkey, o_orderdate, o_orderstatus, o_totalprice from ranked where rn = 1""",
        "fact_append_antijoin": f"""with {W},
f as (select {AT}, {time_key('time')} as time_id, temperature_c, pressure_hpa from w),
second as (select * from f where time_id >= 1999070100),
first as (select * from f where time_id < 2000010100)
select time_id, temperature_c, pressure_hpa from first
union all
select time_id, temperature_c + 100, pressure_hpa from second
where not exists (select 1 from first where first.time = second.time
                  and first.latitude = second.latitude and first.longitude = second.longitude)""",
        "batched_sink": f"""with {W}
select count(*) as rows, sum(temperature_c) as sum_temp, true as within_batch from w""",
        "delivered_batches": f"""with {W}
select count(*) as rows, sum(temperature_c) as sum_temp, count(*) as counted, true as within_batch from w""",
        "load_audit": f"""with {G}
select 'dim_location' as "table", count(*) as written, count(*) as rows from (select distinct latitude, longitude from g)
union all select 'dim_time', count(*), count(*) from (select distinct time from g)
union all select 'fact_weather', count(*), count(*) from g""",
        "pending_days": f"""with {KEYS}
select distinct strftime(time, '%Y-%m-%d') as day from keys
where time::date not in (select o_orderdate::date from orders)""",
        "grid_flatten": """select vec_id, 38::double + ((i - 1) // 8) * 0.25::double as latitude,
       68::double + ((i - 1) % 8) * 0.25::double as longitude, embedding[i]::double as value
from (select vec_id, embedding, unnest(generate_series(1, 64)) as i from embeddings)""",
        "version_merge": f"""with v as (
  select date_trunc('day', l_shipdate)::timestamp as time, {LAT} as latitude, {LON} as longitude,
         case when l_suppkey % 5 = 0 then 'none' else l_linestatus end as s,
         max(case when l_suppkey % 5 <> 0 and l_linestatus = 'O' and l_linenumber = 3 then null else l_quantity end) as t2m,
         max(l_tax) as tp
  from lineitem group by 1, 2, 3, 4),
p as (select * from v where s = 'O'), f as (select * from v where s not in ('O', 'none')),
n as (select * from v where s = 'none')
select time, latitude, longitude, coalesce(p.t2m, f.t2m, n.t2m) as t2m, coalesce(p.tp, f.tp, n.tp) as tp
from p full outer join f using (time, latitude, longitude) full outer join n using (time, latitude, longitude)""",
        "clean_stream": f"with {STREAMS} select {AT}, tp from accum",
        "conform_units": f"with {CONFORMED} select * from conformed",
        "fact_build": f"""with {CONFORMED}
select time_id, temperature_c, dewpoint_c, max_temp_c, min_temp_c, pressure_hpa,
       precipitation_mm::float::double as precipitation_mm, wind_speed_ms,
       cloud_cover::float::double as cloud_cover, solar_radiation::float::double as solar_radiation
from conformed""",
        "ml_features": f"with {W} select {FEATURES} from w order by time, latitude, longitude",
        "hash_sample": """select event_id, user_id, value from events
where ('0x' || substr(md5(event_id::varchar || '|' || user_id::varchar), 1, 8))::bigint % 20 = 0""",
        "stream_join4": f"with {JOINED} select * from joined",
        "bucketed_join4": f"with {JOINED} select * from joined",
        "fact_time_join": f"""with {W},
dim as (select distinct time, {time_key('time')} as time_id from w)
select d.time_id, d.time as timestamp, year(d.time) as year, month(d.time) as month, day(d.time) as day,
       hour(d.time) as hour, isodow(d.time) as day_of_week, quarter(d.time) as quarter, {MEASURES}
from w join dim d using (time)""",
        "weather_full": f"""with {W}
select {time_key('time')} as time_id, time as timestamp, year, month, day, hour, day_of_week, latitude, longitude,
       {MEASURES} from w""",
        "join_coverage": _coverage(),
        "dim_time": f"""with {KEYS}
select distinct {time_key('time')} as time_id, time as timestamp, year(time) as year, month(time) as month,
       day(time) as day, hour(time) as hour, isodow(time) as day_of_week, quarter(time) as quarter from keys""",
        "dim_location": f"with {KEYS} select distinct latitude, longitude from keys",
        "kpi": f"""with {KPI}
select *, {rounded('current_temp - history_temp', 2)} as temp_anomaly from kpi""",
        "kpi_status": f"""with {KPI},
k as (select *, {rounded('current_temp - history_temp', 2)} as a, extreme_days - extreme_hist_avg as more from kpi)
select year,
       case when a > 0 then '+' else '' end || regexp_replace(a::varchar, '\\.0$', '') as anomaly_text,
       case when a > 0 then {text(fv.KPI_WARMER)} when a < 0 then {text(fv.KPI_COLDER)}
            else {text(fv.KPI_NORMAL)} end as anomaly_status,
       case when a > 0 then 'delta-negative' when a < 0 then 'delta-positive' else 'delta-neutral' end
         as anomaly_class,
       case when more > 0 then {text(fv.KPI_MORE_DAYS[0])} || floor(more + 0.5::double)::bigint::varchar
              || {text(fv.KPI_MORE_DAYS[1])}
            else {text(fv.KPI_NOT_MORE_DAYS)} end as extreme_status,
       case when more > 0 then 'delta-negative' else 'delta-positive' end as extreme_class
from k""",
        "extreme_days": f"""with {W}
select year, count(distinct time::date) filter (temperature_c > 35 or temperature_c < -20) as extreme_days
from w group by 1""",
        "yearly_trend": f"""with {W},
years as (select year, avg(temperature_c) as m from w group by 1)
select year, {rounded('m', 2)} as avg_temp,
       {rounded('avg(m) over (order by year rows between 9 preceding and current row)', 2)} as trend_line from years""",
        "temp_histogram": f"""with {W},
daily as (select time::date as d, avg(temperature_c) as m from w group by 1)
select floor(m)::bigint as temp_bin, count(*) as days_count from daily group by 1""",
        "correlations": f"with {CORRELATIONS} select * from correlations",
        "correlation_ranking": f"""with {CORRELATIONS},
long as ("""
        + " union all ".join(
            f"select {i} as place, {text(name)} as name, {code} as value from correlations"
            for i, (code, name, _) in enumerate(fv.FACTORS)
        )
        + f""")
select row_number() over (order by abs(value) desc, place) as rank, name, value,
       case when value > 0 then {text(fv.POSITIVE_COLOUR)} else {text(fv.OTHER_COLOUR)} end as colour from long""",
        "forecast_summary": f"""with {SUMMARY}
select {rounded('avg_temp', 6)} as avg_temp, min_temp, max_temp, {rounded('avg_wind', 6)} as avg_wind,
       {rounded('total_precip', 6)} as total_precip,
       'Прогноз: ' || round_even(min_temp, 0)::bigint::varchar || '...'
         || round_even(max_temp, 0)::bigint::varchar || '°C' as forecast_text from summary""",
        "eval_metrics": f"""with {SPLIT},
m as (
  select count(*) as rows, avg(abs(temperature_c - prediction)) as mae,
         1 - sum((temperature_c - prediction) * (temperature_c - prediction))
             / (var_pop(temperature_c) * count(*)) as r2 from scored)
select rows, {rounded('mae', 6)} as mae, {rounded('r2', 6)} as r2,
       case when r2 > 0.9 then {text(fv.GRADE_EXCELLENT)} when r2 > 0.7 then {text(fv.GRADE_GOOD)}
            else {text(fv.GRADE_MORE_DATA)} end as grade from m""",
        "eval_extents": f"""with {SPLIT}
select least(min(temperature_c), min(prediction)) + 0.0::double as min_val,
       greatest(max(temperature_c), max(prediction)) + 0.0::double as max_val from scored""",
        "chrono_split": f"with {SPLIT} select {AT}, is_test from split",
        "latest_168_rows": f"with {LATEST} select * from latest",
        "latest_168h_per_location": f"""with {W},
n as (select *, row_number() over (partition by latitude, longitude order by time desc) as rn from w)
select {AT}, temperature_c from n where rn <= 168""",
        "forecast_per_location": f"""with {W},
n as (select *, row_number() over (partition by latitude, longitude order by time desc) as rn from w)
select {AT}, temperature_c, time + to_hours(168) as forecast_time from n where rn <= 168""",
        "eval_slice": f"""with {SPLIT}
select {AT}, temperature_c, prediction from scored order by time, latitude, longitude limit 150""",
        "calendar_parts": """select event_id, year(ts) as year, month(ts) as month, day(ts) as day, hour(ts) as hour,
       isodow(ts) as day_of_week, quarter(ts) as quarter from events""",
        "drill_labels": """select o_orderkey, strftime(o_orderdate, '%Y') as year_label,
       strftime(o_orderdate, '%Y-%m') as month_label, strftime(o_orderdate, '%Y-%m-%d') as day_label from orders""",
        "time_key": f"select event_id, {time_key('ts')} as time_id from events",
        "star_load": f"""with {STORED}
select time_id, timestamp, year(time) as year, month(time) as month, day(time) as day, hour(time) as hour,
       isodow(time) as day_of_week, latitude, longitude, max_temp_c, min_temp_c, {MEASURES} from stored""",
        "stream_ingest": f"select {time_key('ts')} as time_id, event_id, user_id, value from events",
        "forecast_frame": f"""with {LATEST}
select {FEATURES}, step, newest + to_hours(step::integer) as forecast_time from frame""",
        "forecast_band": f"""with {LATEST}
select step, newest + to_hours(step::integer) as forecast_time, temperature_c as prediction,
       {rounded('temperature_c + (1.5::double + (step - 1) * 0.05::double)', 6)} as upper,
       {rounded('temperature_c - (1.5::double + (step - 1) * 0.05::double)', 6)} as lower from frame""",
        "recommendations": f"""with {SUMMARY},
advice as (
  select case when min_temp < -15 then {_advice(fv.UTILITIES_FROST)}
              when min_temp < 0 then {_advice(fv.UTILITIES_WINTER)} else {_advice(fv.UTILITIES_MILD)} end as a
  from summary
  union all
  select case when max_temp > 30 and total_precip < 1 then {_advice(fv.FARMING_DROUGHT)}
              when avg_temp > 5 and avg_temp < 25 then {_advice(fv.FARMING_GOOD)}
              else {_advice(fv.FARMING_FROST)} end from summary
  union all
  select case when avg_wind > 10 or total_precip > 20 then {_advice(fv.TRANSPORT_STORM)}
              when min_temp < 0 and total_precip > 5 then {_advice(fv.TRANSPORT_ICE)}
              else {_advice(fv.TRANSPORT_CLEAR)} end from summary)
select a.sector as sector, a.icon as icon, a.status as status, a.action as action, a.detail as detail from advice""",
        "quality_checks": f"""with {W},
times as (select distinct {time_key('time')} as id, time from w),
places as (select distinct latitude, longitude from w),
bad as (
  select 'fact_not_empty' as "check", (count(*) = 0)::bigint as bad_rows from w
  union all select 'fact_null_keys', count(*) filter (time is null or latitude is null or longitude is null) from w
  union all select 'fact_unique_keys', count(*) - (select count(*) from (select distinct {AT} from w)) from w
  union all select 'dim_time_not_empty', (count(*) = 0)::bigint from times
  union all select 'dim_time_null_keys', count(*) filter (id is null) from times
  union all select 'dim_time_unique_keys', count(*) - count(distinct id) from times
  union all select 'dim_location_not_empty', (count(*) = 0)::bigint from places
  union all select 'dim_location_null_keys', count(*) filter (latitude is null or longitude is null) from places
  union all select 'dim_location_unique_keys', count(*) - count(distinct (latitude, longitude)) from places
  union all select 'fact_time_known', count(*) from w where {time_key('time')} not in (select id from times)
  union all select 'fact_location_known', count(*) from w anti join places using (latitude, longitude))
select "check", bad_rows, bad_rows = 0 as passed from bad""",
    }
    for grain in ("year", "month", "day"):
        for func in ("avg", "max", "min"):
            sql[f"drill_{grain}_{func}"] = _drill(grain, func)
    return sql | _star_sql(sql) | _corrected_sql(sql)


# The latest window of the stored star, and the climatology of the earlier part as its prediction.
SERVED = SPLIT + WS.removeprefix(W) + f""",
latest as (select {FEATURES} from ws order by time desc, latitude, longitude limit 168),
frame as (
  select *, row_number() over (order by time, latitude, longitude) as step, max(time) over () as newest from latest),
served as (select f.*, m.prediction from frame f left join means m using (month, hour)),
summary as (
  select avg(prediction) as avg_temp, min(prediction) as min_temp, max(prediction) as max_temp,
         avg(wind_speed_ms) as avg_wind, sum(precipitation_mm) as total_precip from served)"""


# The star after two loads, of which the second corrects what it holds of the first.
CORRECTED = W.replace("w as (", "w0 as (") + """,
w as (
  select * replace (temperature_c + case when hour % 7 = 0 and time < timestamp '1999-07-01' then 10 else 0 end as temperature_c)
  from w0)"""


def _corrected_sql(sql: dict[str, str]) -> dict[str, str]:
    extreme = "(temperature_c > 35 or temperature_c < -20)"
    stored = "with " + CORRECTED + WS.removeprefix(W)
    shown = f"{time_key('time')} as time_id, time as timestamp, latitude, longitude"
    raised = f"select {shown}, {MEASURES.replace('temperature_c', 'temperature_c + case when hour % 7 = 0 then 10 else 0 end as temperature_c', 1)}"
    factors = ", ".join(f"{_correlation(col)} as {code}" for code, _, col in fv.FACTORS)
    return {
        "fact_correction": f"{stored} select {shown}, {MEASURES} from ws",
        "star_before_correction": f"with {WS} {raised} from ws where time < timestamp '2000-01-01'",
        "profile_kpi": sql["kpi"].replace(W, CORRECTED),
        "profile_trend": sql["yearly_trend"].replace(W, CORRECTED),
        "profile_histogram": sql["temp_histogram"].replace(W, CORRECTED),
        "profile_drill_day": _drill("day", "max", "ws").replace(W, CORRECTED),
        "profile_drill_range": _drill("month", "avg", "ws where year between 1997 and 2000").replace(W, CORRECTED),
        "profile_correlations": f"{stored} select {factors} from ws where year between 1996 and 1999",
        "place_extreme_days": f"""{stored}
select latitude, longitude, year, count(distinct time::date) as extreme_days from ws where {extreme} group by 1, 2, 3""",
        "region_extreme_days": f"""{stored}
select year, count(distinct time::date) as extreme_days from ws
where {extreme} and latitude between 40 and 42 and longitude between 70 and 76 group by 1""",
        "redelivered_days": f"""with {STREAMS}
select distinct strftime(time, '%Y-%m-%d') as day from accum where dayofyear(time) % 50 = 7 and latitude = 40
union
select distinct strftime(time, '%Y-%m-%d') from extreme where dayofyear(time) % 60 = 11 and longitude = 70""",
    }


def _star_sql(sql: dict[str, str]) -> dict[str, str]:
    """The queries over the stored star, and those of the forest."""
    return {
        "late_day_reload": sql["star_load"],
        "agreed_day_ingest": f"with days as (with {G} {AGREES}), loaded as ({sql['star_load']}) "
        "select loaded.* from loaded join days on days.day = loaded.timestamp::date where agrees",
        "waiting_days": f"with days as (with {G} {AGREES}) select strftime(day, '%Y-%m-%d') as day, instant, accum, avg, max from days where not agrees",
        "star_kpi": sql["kpi"],
        "star_trend": sql["yearly_trend"],
        "star_histogram": sql["temp_histogram"],
        "star_correlations": "with " + WS + CORRELATIONS.removeprefix(W).replace(" from w)", " from ws)") + " select * from correlations",
        "star_drill_range": _drill("month", "avg", "ws where year between 1996 and 1999"),
        "star_drill_known_hours": _drill("year", "max", "ws where hour >= 6"),
        "star_features": f"""with {WS}
select {FEATURES} from ws
where year = 1998 and ('0x' || substr(md5(({time_key("time")})::varchar), 1, 8))::bigint % 20 = 0""",
        "star_latest": f"""with {WS}
select {FEATURES} from ws order by time desc, latitude, longitude limit 168""",
        "rf_predictions": f"with {SPLIT} select {AT}, temperature_c, true as within_range from split where is_test",
        "rf_quality": f"""with {SPLIT}
select count(*) as rows, true as all_finite, true as better_than_climatology from split where is_test""",
        "serve_hours": f"""with {SERVED}
select step, newest + to_hours(step::integer) as forecast_time, {rounded("prediction", 6)} as prediction,
       {rounded("prediction + (1.5::double + (step - 1) * 0.05::double)", 6)} as upper,
       {rounded("prediction - (1.5::double + (step - 1) * 0.05::double)", 6)} as lower from served""",
        "rf_serve_quality": f"""with {SERVED}
select step, newest + to_hours(step::integer) as forecast_time, true as within_range,
       {rounded("2 * (1.5::double + (step - 1) * 0.05::double)", 6)} as width from served""",
        "serve_summary": f"""with {SERVED}
select {", ".join(f"{rounded(c, 6)} as {c}" for c in ("avg_temp", "min_temp", "max_temp", "avg_wind", "total_precip"))},
       'Прогноз: ' || round_even(min_temp, 0)::bigint::varchar || '...'
         || round_even(max_temp, 0)::bigint::varchar || '°C' as forecast_text from summary""",
        "serve_advice": sql["recommendations"].replace(SUMMARY, SERVED),
    }
