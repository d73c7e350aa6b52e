"""DuckDB oracle SQL for the checked queries (FIXTURES.md).

Run with ``SET timezone='UTC'``; the views ``events`` etc. are registered by
the caller. Doubles computed by aggregation are rounded to 9 places on both
sides; DuckDB HUGEINT sums are cast to BIGINT and ``hour`` to INTEGER.

Means are exact on both sides (decimal sums): DuckDB's parallel
``avg(double)`` sums in a varying order, and on sf0.01 the same statement gave
25.27 in some runs and 25.28 in others for one peak-hour speed (an exact mean
of 25.275). Engines also round a double just below a half differently (mean
6.449999999999999 of 0.12 and 12.78: Spark 6.4, DuckDB 6.5). With decimal
sums both sides hold the exact mean and agree.

Rounding to 2 (or 1) places is HALF_UP on the decimal value, as Spark's
``round`` does. DuckDB's ``round(double)`` works on the binary value, so an
exact mean of 16.565 (stored as 16.564999...) gives 16.56 there. The oracle
therefore rounds ``cast(x as decimal(38, 9))``, which recovers the decimal.
"""

from __future__ import annotations

PREFIX = """
with readings as (
  select 'J' || (user_id % 5 + 1) as sensor_id, ts as event_time,
         cast(props->>'k' as integer) as vehicle_count, round(value % 60, 2) as avg_speed
  from events),
agg as (
  select time_bucket(interval '5 minutes', event_time) as window_start,
         time_bucket(interval '5 minutes', event_time) + interval '5 minutes' as window_end, sensor_id,
         cast(sum(vehicle_count) as bigint) as total_vehicles, avg(avg_speed::DECIMAL(38,18)) as avg_speed_window,
         sum(vehicle_count) / nullif(avg(avg_speed::DECIMAL(38,18)), 0.0) as congestion_index
  from readings group by 1, 2, 3),
whole as (
  select *, case when avg_speed_window < 15 then 'Critical' when avg_speed_window < 25 then 'Warning'
                 when avg_speed_window is not null then 'Normal' end as status
  from agg),
day as (
  select * from whole where window_start >= timestamp '2024-01-10' and window_start < timestamp '2024-01-11'),
hourly as (
  select cast(window_start as date) as report_date, sensor_id, date_trunc('hour', window_start) as hour,
         cast(sum(total_vehicles) as bigint) as vehicles_hour, avg(avg_speed_window::DECIMAL(38,18)) as avg_speed_hour
  from agg group by 1, 2, 3),
peak as (
  select report_date, sensor_id, hour as peak_hour, vehicles_hour,
         cast(round(cast(avg_speed_hour as decimal(38, 9)), 2) as double) as avg_speed_at_peak,
         case when round(cast(avg_speed_hour as decimal(38, 9)), 2) < 15 then 'YES' else 'NO' end
           as needs_intervention
  from (select *, row_number() over (partition by report_date, sensor_id
                                     order by vehicles_hour desc, hour) as rk from hourly) where rk = 1),
vol as (
  select sensor_id, cast(hour(window_start) as integer) as hour_of_day,
         cast(sum(total_vehicles) as bigint) as total_volume, avg(avg_speed_window::DECIMAL(38,18)) as avg_speed,
         count(*) as sample_count
  from day group by 1, 2),
dim(sensor_id, lat, lon, name) as (values
  ('J1', 6.9271::double, 79.8612::double, 'Colombo City Center'), ('J2', 6.9145, 79.8567, 'Galle Face Junction'),
  ('J3', 6.9021, 79.8625, 'Kollupitiya Junction'), ('J4', 6.8916, 79.8579, 'Bambalapitiya Junction'))
"""

_ALERTS = """
select event_time as detected_at, sensor_id, vehicle_count, avg_speed, 'avg_speed_below_10_kmph' as reason
from readings where avg_speed < 10.0
"""

_WINDOW_AGG = """
select window_start, window_end, sensor_id, total_vehicles, round(avg_speed_window, 9) as avg_speed_window,
       round(congestion_index, 9) as congestion_index from agg
"""

_HEATMAP_COLUMNS = ",\n       ".join(
    f"cast(sum(total_volume) filter (where hour_of_day = {h}) as bigint) as h{h:02d}" for h in range(24))

_PIVOT_COLUMNS = ",\n       ".join(
    f"cast(sum(total_volume) filter (where sensor_id = '{s}') as bigint) as {s}"
    for s in ("J1", "J2", "J3", "J4", "J5"))

STATEMENTS: dict[str, str] = {
    "decode_readings": """
select sensor_id, vehicle_count, avg_speed, event_time from readings
""",
    "congestion_alerts": _ALERTS,
    "congestion_alerts_stream": _ALERTS,
    "window_agg": _WINDOW_AGG,
    "window_agg_stream": _WINDOW_AGG + """
where window_end <= (select date_trunc('milliseconds', max(event_time)) - interval '10 minutes' from readings)
""",
    "hourly_volumes": """
select sensor_id, hour, vehicles_hour, round(avg_speed_hour, 9) as avg_speed_hour
from hourly where report_date = date '2024-01-10'
""",
    "peak_hour_daily": """
select * from peak where report_date = date '2024-01-10'
""",
    "peak_hour_range": """
select * from peak
where report_date between date '2024-01-08' and date '2024-01-31'
""",
    "volume_by_hour": """
select sensor_id, hour_of_day, total_volume, round(avg_speed, 9) as avg_speed, sample_count from vol
""",
    "volume_pivot": f"""
select hour_of_day, {_PIVOT_COLUMNS}
from vol group by 1
""",
    "volume_heatmap": f"""
select sensor_id, {_HEATMAP_COLUMNS}
from vol group by 1
""",
    "city_hourly_volume": """
select hour_of_day, cast(sum(total_volume) as bigint) as total_volume,
       sum(total_volume) between 200 and 300 as in_peak_band from vol group by 1
""",
    "junction_volume_totals": """
select sensor_id, cast(sum(total_volume) as bigint) as total_volume, round(avg(avg_speed::DECIMAL(38,18)), 9) as avg_speed
from vol group by 1
""",
    "daily_summary": """
select cast(sum(total_vehicles) as bigint) as total_vehicles,
       round(avg(congestion_index::DECIMAL(38,18)), 9) as avg_congestion_index, count(*) as window_count from day
""",
    "busiest_junction": """
select sensor_id, vehicles_hour, peak_hour from peak where report_date = date '2024-01-10'
order by vehicles_hour desc, sensor_id limit 1
""",
    "intervention_report": """
select sensor_id, peak_hour, vehicles_hour, avg_speed_at_peak,
       case when needs_intervention = 'YES' then 'REQUIRES police intervention' else 'Monitor only' end as action,
       case when needs_intervention = 'YES' then 'CRITICAL' else 'ACCEPTABLE' end as speed_label,
       case when needs_intervention = 'YES'
            then 'Deploy 2-3 officers during ' || strftime(peak_hour, '%Y-%m-%d %H:%M:%S') end as recommendation
from peak where report_date = date '2024-01-10'
""",
    "junction_status": """
select window_start, sensor_id, total_vehicles, round(avg_speed_window, 9) as avg_speed_window,
       round(congestion_index, 9) as congestion_index, status,
       case when congestion_index < 30 then 'low' when congestion_index < 60 then 'medium'
            when congestion_index is not null then 'high' end as congestion_band,
       round(congestion_index - 30, 9) as delta_from_ref
from whole
""",
    "kpi_summary": """
select cast(sum(total_vehicles) as bigint) as total_vehicles, round(avg(avg_speed_window::DECIMAL(38,18)), 9) as avg_speed,
       count(*) filter (where status = 'Critical') as critical_count,
       round(avg(congestion_index::DECIMAL(38,18)), 9) as congestion_index from whole
""",
    "junction_map": """
select window_start, d.sensor_id, lat, lon, name, split_part(name, ' ', -2) as area, total_vehicles as vehicles,
       round(avg_speed_window, 9) as speed, status, round(congestion_index * 10, 9) as size
from whole d join dim on d.sensor_id = dim.sensor_id
""",
    "status_alerts": """
select window_start as ts, sensor_id as junction, status as severity,
       case when status = 'Critical'
            then 'Speed critically low at '
                 || cast(cast(round(cast(avg_speed_window as decimal(38, 9)), 1) as double) as varchar)
                 || ' km/h'
            else 'Moderate congestion detected' end as message,
       total_vehicles as vehicles, round(avg_speed_window, 9) as speed,
       case when status = 'Critical' then 'Immediate police deployment required'
            else 'Monitor closely' end as recommendation
from whole where status in ('Critical', 'Warning')
""",
}


# End-to-end queries read back what the stream, the daily job and the live
# view wrote; their answers are the same relations as above.
STATEMENTS["daily_peak_report"] = STATEMENTS["peak_hour_daily"]
STATEMENTS["daily_volume_report"] = STATEMENTS["volume_by_hour"]
STATEMENTS["daily_summary_table"] = STATEMENTS["daily_summary"]
STATEMENTS["report_volume_heatmap"] = f"""
select sensor_id, {_HEATMAP_COLUMNS}
from vol where sensor_id in ('J1', 'J2') group by 1
"""
STATEMENTS["report_city_volume"] = STATEMENTS["city_hourly_volume"]
STATEMENTS["peak_hour_all_days"] = """
select * from peak
"""
STATEMENTS["volume_by_hour_all_days"] = """
select sensor_id, cast(hour(window_start) as integer) as hour_of_day,
       cast(sum(total_vehicles) as bigint) as total_volume,
       round(avg(avg_speed_window::DECIMAL(38,18)), 9) as avg_speed, count(*) as sample_count
from agg group by 1, 2
"""
STATEMENTS["live_kpi_last_24h"] = """,
last24 as (
  select *, case when avg_speed_window < 15 then 'Critical' when avg_speed_window < 25 then 'Warning'
                 when avg_speed_window is not null then 'Normal' end as status
  from agg where window_start >= timestamp '2024-01-09 12:00:00' and window_start < timestamp '2024-01-10 12:00:00')
select cast(sum(total_vehicles) as bigint) as total_vehicles, round(avg(avg_speed_window::DECIMAL(38,18)), 9) as avg_speed,
       count(*) filter (where status = 'Critical') as critical_count,
       round(avg(congestion_index::DECIMAL(38,18)), 9) as congestion_index from last24
"""

# The payload as Spark's JSON writer gives it: ISO times in milliseconds, NULL fields left out.
STATEMENTS["alerts_json"] = """
select '{"alert_time":"2024-01-10T12:00:00.000Z"'
       || coalesce(',"detected_at":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"', '')
       || coalesce(',"sensor_id":"' || sensor_id || '"', '')
       || coalesce(',"vehicle_count":' || vehicle_count, '')
       || ',"avg_speed":' || cast(avg_speed as varchar)
       || ',"reason":"avg_speed_below_10_kmph"}' as value
from readings where avg_speed < 10.0
"""
STATEMENTS["mirrored_aggs"] = STATEMENTS["window_agg_stream"]
STATEMENTS["stored_peak_range"] = """
select * from peak where report_date between date '2024-01-09' and date '2024-01-10'
"""
STATEMENTS["weekly_export"] = STATEMENTS["stored_peak_range"]
STATEMENTS["latest_volume_report"] = STATEMENTS["volume_by_hour"]
STATEMENTS["live_kpi_all_time"] = STATEMENTS["kpi_summary"] + """
where window_end <= (select date_trunc('milliseconds', max(event_time)) - interval '10 minutes' from readings)
"""
STATEMENTS["interventions_required"] = STATEMENTS["intervention_report"].rstrip() + " and needs_intervention = 'YES'\n"
STATEMENTS["status_alerts_selected"] = STATEMENTS["status_alerts"].replace(
    "status in ('Critical', 'Warning')", """status = 'Critical' and sensor_id in ('J1', 'J2')
  and window_start >= timestamp '2024-01-03 12:00:00' and window_start < timestamp '2024-01-10 12:00:00'""")

STATEMENTS["fan_out_windows"] = STATEMENTS["fan_out_windows_copy"] = _WINDOW_AGG
STATEMENTS["fan_out_alerts"] = STATEMENTS["fan_out_alerts_copy"] = _ALERTS

# Reports of 24 days from the stored windows (those that the watermark has passed).
_STORED_RANGE = """,
stored as (
  select * from agg where cast(window_start as date) between date '2024-01-08' and date '2024-01-31'
  and window_end <= (select date_trunc('milliseconds', max(event_time)) - interval '10 minutes' from readings))"""
STATEMENTS["rollup_volume"] = _STORED_RANGE + """
select sensor_id, cast(hour(window_start) as integer) as hour_of_day,
       cast(sum(total_vehicles) as bigint) as total_volume,
       round(avg(avg_speed_window::DECIMAL(38,18)), 9) as avg_speed, count(*) as sample_count
from stored group by 1, 2
"""
STATEMENTS["rollup_summary"] = _STORED_RANGE + """
select cast(sum(total_vehicles) as bigint) as total_vehicles,
       round(avg(congestion_index::DECIMAL(38,18)), 9) as avg_congestion_index, count(*) as window_count from stored
"""
STATEMENTS["rollup_peaks"] = _STORED_RANGE + """,
hours as (
  select cast(window_start as date) as report_date, sensor_id, date_trunc('hour', window_start) as hour,
         cast(sum(total_vehicles) as bigint) as vehicles_hour,
         round(cast(avg(avg_speed_window::DECIMAL(38,18)) as decimal(38, 9)), 2) as speed
  from stored group by 1, 2, 3)
select report_date, sensor_id, hour as peak_hour, vehicles_hour, cast(speed as double) as avg_speed_at_peak,
       case when speed < 15 then 'YES' else 'NO' end as needs_intervention
from (select *, row_number() over (partition by report_date, sensor_id order by vehicles_hour desc, hour) as rk from hours)
where rk = 1
"""
STATEMENTS["rollup_odd_speeds"] = """,
odd as (
  select 'J' || (user_id % 5 + 1) as sensor_id, time_bucket(interval '5 minutes', ts) as w,
         cast(props->>'k' as integer) as vehicles, round(value % 60, 2) as speed,
         event_id % 101 = 0 as nan, event_id % 101 <> 0 and event_id % 103 = 0 as inf
  from events),
odd_windows as (
  select w, sensor_id, sum(vehicles) as vehicles, bool_or(nan) as nan, bool_or(inf) as inf,
         avg(speed::DECIMAL(38,18)) as speed from odd group by 1, 2)
select sensor_id, date_trunc('hour', w) as hour, cast(sum(vehicles) as bigint) as vehicles_hour,
       case when bool_or(nan) then 'nan' when bool_or(inf) then 'inf' when count(speed) > 0 then 'finite' end as kind,
       case when not bool_or(nan) and not bool_or(inf) then round(avg(speed::DECIMAL(38,18)), 9) end as avg_speed_hour
from odd_windows group by 1, 2
"""
STATEMENTS["volume_by_hour_positions"] = """
select row_number() over (order by sensor_id, hour_of_day) as position,
       sensor_id, hour_of_day, total_volume, round(avg_speed, 9) as avg_speed, sample_count from vol
"""
STATEMENTS["landed_day"] = """
select sensor_id, vehicle_count, avg_speed, event_time from readings
where event_time >= timestamp '2024-01-10' and event_time < timestamp '2024-01-11'
"""
STATEMENTS["report_lines"] = """
select 'report_date,sensor_id,peak_hour,vehicles_hour,avg_speed_at_peak,needs_intervention' as line
union all
select strftime(report_date, '%Y-%m-%d') || ',' || sensor_id || ',' || strftime(peak_hour, '%Y-%m-%d %H:%M:%S') || ','
       || vehicles_hour || ',' || cast(avg_speed_at_peak as varchar) || ',' || needs_intervention
from peak where report_date = date '2024-01-10'
"""
STATEMENTS["report_lookup"] = """,
before as (
  select count(distinct (sensor_id, hour(window_start))) as n from agg where cast(window_start as date) = date '2024-01-09')
select 'latest' as request, date '2024-01-11' as found_date, 0::bigint as rows
union all select 'rewritten', date '2024-01-10', count(*) from vol where sensor_id in ('J1', 'J2')
union all select 'day before', date '2024-01-09', n from before
union all select 'missing date', null, null
union all select 'unknown kind', null, null
"""
STATEMENTS["catalogued_volume"] = STATEMENTS["volume_by_hour"] + """
where sensor_id in ('J1', 'J2')
"""
STATEMENTS["page_recommendations"] = """
select report_date, sensor_id, peak_hour,
       '**' || sensor_id || ' - Immediate Action Required**' || chr(10)
       || '- Peak hour at ' || strftime(peak_hour, '%Y-%m-%d %H:%M:%S') || ' with ' || vehicles_hour || ' vehicles' || chr(10)
       || '- Average speed critically low at ' || cast(avg_speed_at_peak as varchar) || ' km/h' || chr(10)
       || '- 🚔 Deploy 2-3 traffic officers during peak hours' || chr(10)
       || '- 📍 Consider adjusting traffic signal timings' as text
from peak where needs_intervention = 'YES'
"""

# Six micro-batches of equal stretches of time; every 37th event comes two batches late. In batch b a window is late if it
# ended before the watermark of batch b - 1, which is the latest event time up to batch b - 2 less ten minutes.
_LATE_PREFIX = PREFIX.replace("from events)", "from seen where not late)").replace("with readings as (", """
with cut as (
  select e.*, least(((epoch_us(ts) - lo) * 6) // (hi - lo + 1) + case when event_id % 37 = 0 then 2 else 0 end, 5) as batch,
         time_bucket(interval '5 minutes', ts) + interval '5 minutes' as its_end
  from events e, (select epoch_us(min(ts)) as lo, epoch_us(max(ts)) as hi from events)),
marks as (
  select n.batch, max(date_trunc('milliseconds', c.top)) - interval '10 minutes' as mark
  from range(6) n(batch) join (select batch, max(ts) as top from cut group by 1) c on c.batch <= n.batch - 2 group by 1),
seen as (select cut.*, coalesce(its_end <= mark, false) as late from cut left join marks on cut.batch = marks.batch),
readings as (""")
_LATE = """
select window_start, sensor_id, total_vehicles, round(avg_speed_window, 9) as avg_speed_window,
       (select count(*) from (select distinct batch, its_end, user_id % 5 from seen where late)) as dropped
from agg where window_end <= (select date_trunc('milliseconds', max(ts)) - interval '10 minutes' from events)
"""

_BLOCK_COLUMNS = ",\n       ".join(
    f"cast(sum(total_volume) filter (where col = {k}) as bigint) as c{k}" for k in range(100))
_USER_VOLUME = """,
user_vol as (
  select sensor_id, cast(hour(window_start) as integer) as hour_of_day, cast(sum(total_vehicles) as bigint) as total_volume
  from agg group by 1, 2),
dictionary as (
  select sensor_id, cast((n - 1) // 100 as bigint) as block, cast((n - 1) % 100 as integer) as col
  from (select sensor_id, row_number() over (order by sensor_id) as n from (select distinct sensor_id from user_vol)))
"""

# One sensor per user: the same relations over another sensor name.
USER_STATEMENTS: dict[str, str] = {
    "user_peak_hours": STATEMENTS["peak_hour_all_days"],
    "user_daily_report": STATEMENTS["volume_heatmap"],
    "user_volume_positions": _USER_VOLUME + """
select row_number() over (order by total_volume desc, sensor_id, hour_of_day) as position, sensor_id, hour_of_day, total_volume
from user_vol
""",
    "user_pivot_dictionary": _USER_VOLUME + """
select sensor_id, block, col as "column" from dictionary
""",
    "user_pivot_blocks": _USER_VOLUME + f"""
select block, hour_of_day, {_BLOCK_COLUMNS}
from user_vol join dictionary using (sensor_id) group by 1, 2
""",
}
USER_PREFIX = PREFIX.replace("'J' || (user_id % 5 + 1)", "'U' || user_id")


def oracle_sql() -> dict[str, str]:
    """Full statements (shared prefix + body)."""
    return {name: PREFIX + body for name, body in STATEMENTS.items()} \
        | {name: USER_PREFIX + body for name, body in USER_STATEMENTS.items()} | {"late_windows": _LATE_PREFIX + _LATE}
