"""The same queries as SQL text, for checking against another engine (DuckDB).

Doubles are rounded to six places on both sides; ``+ 0.0`` turns a negative zero into zero.
"""

from __future__ import annotations

import string

# -- views over the events table, inlined as CTEs ------------------------------------------------

_REGION = (
    "case when user_id % 4 = 0 then 'NE' when user_id % 4 = 1 then 'NW' "
    "when user_id % 4 = 2 then 'SE' else 'SW' end"
)
_DIRTY_REGION = (
    f"case when event_id % 97 = 0 then null when event_id % 89 = 0 then 'XX' else {_REGION} end"
)
_K = "cast(json_extract_string(props, '$.k') as int)"

# The five features of a model, by the letter that stands for them.
_FIVE = {"a": "day_of_week", "b": "hour_of_day", "c": "unique_patients", "d": "hour_sin", "e": "hour_cos"}


def _orthogonal() -> dict[str, str]:
    """One view per feature: it is taken out of the features behind it and out of the target."""
    views, before = {}, "centred"
    for i, n in enumerate(_FIVE):
        rest = [*list(_FIVE)[i + 1:], "y"]
        slope = {
            m: f"sum(z_{n} * z_{m}) filter (where not test) over ()"
            f" / sum(z_{n} * z_{n}) filter (where not test) over ()" for m in rest
        }
        out = ", ".join(f"z_{m} - z_{n} * {slope[m]} as z_{m}" for m in rest)
        kept = "day_of_week, hour_of_day, unique_patients, event_count, test"
        views[f"without_{n}"] = (
            f"select {kept}, {out}, fit + z_{n} * {slope['y']} as fit from {before}"
        )
        before = f"without_{n}"
    return views


_VIEWS = {
    "symptoms": f"""
select cast(event_id as varchar) as event_id, 'symptom_report' as event_type,
  ts as event_timestamp,
  case when event_id % 101 = 0 then null else cast(user_id as varchar) end as patient_id,
  {_DIRTY_REGION} as region, event_type as symptoms,
  case when value < 15 then 'mild' when value < 70 then 'moderate' when value < 110 then 'severe'
       when value < 230 then 'critical' else 'unknown' end as severity
from events""",
    "env": f"""
select ts as event_timestamp, {_REGION} as region, value as temperature_f,
  {_K} as humidity_percent, cast((event_id * 7) % 300 as int) as air_quality_index,
  cast((event_id * 3) % 120 as int) as pollen_count,
  case when event_id % 43 = 0 then null else cast(event_id % 12 as int) end as uv_index,
  value / 10 as wind_speed_mph
from events""",
    "dq": f"""
select event_id, ts as event_timestamp,
  case when event_id % 53 = 0 then null when event_id % 59 = 0 then cast('NaN' as double)
       else value end as temperature,
  case when event_id % 61 = 0 then null else cast({_K} as double) * 1.05 end as humidity,
  {_K} - 2 as symptom_count, {_DIRTY_REGION} as region
from events""",
    "raw": """
select cast(event_id as varchar) as event_id,
  case event_type when 'click' then 'symptom_report' when 'view' then 'symptom_report'
    when 'purchase' then 'clinic_visit' when 'error' then 'environmental_conditions'
    else event_type end as event_type,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, ts,
  cast(user_id as varchar) as patient_id, event_type as symptoms,
  case when event_id % 97 = 0 then null when event_id % 89 = 0 then 'XX'
    else case user_id % 4 when 0 then 'NE' when 1 then 'NW' when 2 then 'SE' else 'SW' end end as region
from events""",
    "scored": """
select *, case severity when 'mild' then 1 when 'moderate' then 2 when 'severe' then 3
  when 'critical' then 4 else 0 end as severity_score
from symptoms""",
    "by_region": """
select region, symptoms, count(*) as event_count,
  avg(severity_score) as avg_severity_score
from scored group by region, symptoms""",
    "by_hour": """
select severity, cast(hour(event_timestamp) as int) as hour_of_day, count(*) as event_count
from symptoms group by all""",
    "patterns": """
select cast(dayofweek(event_timestamp) + 1 as int) as day_of_week,
  cast(hour(event_timestamp) as int) as hour_of_day, count(*) as event_count,
  count(distinct patient_id) as unique_patients, count(patient_id) as patient_rows
from symptoms group by 1, 2""",
    "buckets": """
select time_bucket(interval '5 minutes', event_timestamp) as bucket, count(*) as event_count
from symptoms group by 1""",
    "filled": """
select s.bucket, cast(coalesce(b.event_count, 0) as bigint) as event_count
from (select unnest(generate_series(min(bucket), max(bucket), interval '5 minutes')) as bucket
      from buckets) s
left join buckets b on b.bucket = s.bucket""",
    "rolling": """
select bucket, event_count, avg(event_count) over (
  order by bucket rows between 5 preceding and current row) as rolling_30min
from filled""",
    "hourly": """
select date_trunc('hour', event_timestamp) as bucket, count(*) as event_count
from symptoms group by 1""",
    "hourly_region": """
select region, date_trunc('hour', event_timestamp) as bucket, count(*) as event_count
from symptoms group by 1, 2""",
    "hourly_filled": """
select s.region, s.bucket, cast(coalesce(h.event_count, 0) as bigint) as event_count
from (select region, unnest(generate_series(min(bucket), max(bucket), interval '1 hour')) as bucket
      from hourly_region group by region) s
left join hourly_region h
  on h.region is not distinct from s.region and h.bucket = s.bucket""",
    "windows": """
select region, bucket - interval '23 hours' as window_start,
  bucket + interval '1 hour' as window_end,
  cast(sum(event_count) over (partition by region order by bucket
    range between interval '23 hours' preceding and current row) as bigint) as event_count
from hourly_region where region is not null""",
    "covering": """
select region, window_start, window_start + interval '6 hours' as window_end,
  cast(sum(event_count) as bigint) as event_count
from (select region, event_count,
        unnest(generate_series(bucket - interval '5 hours', bucket, interval '1 hour'))
          as window_start
      from hourly_region) t
group by 1, 2""",
    "lagged": """
select day_of_week, hour_of_day, event_count as event_count_true, event_count_pred
from (select *, row_number() over w as n,
        avg(event_count) over (order by day_of_week, hour_of_day
          rows between 3 preceding and 1 preceding) as event_count_pred
      from patterns window w as (order by day_of_week, hour_of_day)) t
where n > 3""",
    "inclusive": """
select day_of_week, hour_of_day, event_count as event_count_true,
  avg(event_count) over (order by day_of_week, hour_of_day
    rows between 4 preceding and current row) as event_count_pred
from patterns""",
    "zhour": """
select bucket, event_count, (event_count - m) / nullif(s, 0) as z_score
from hourly, (select avg(event_count) as m, stddev_pop(event_count) as s from hourly) t""",
    "zregion": """
select region, bucket, event_count,
  (event_count - avg(event_count) over w) / nullif(stddev_pop(event_count) over w, 0) as z_score
from hourly_region window w as (partition by region)""",
    "volume": "select * from windows where event_count >= 100",
    "severe_days": """
select date_trunc('day', event_timestamp) as window_start,
  100.0 * sum(case when severity = 'severe' then 1 else 0 end) / count(*) as percentage
from symptoms group by 1 having percentage >= 16""",
    "hot": "select * from windows where event_count >= 80",
    "hot_stats": """
select window_start, window_end, count(*) as hot_regions, avg(event_count) as m,
  stddev_pop(event_count) as s, (max(event_count) - avg(event_count))
    / nullif(stddev_pop(event_count), 0) as max_z
from hot group by 1, 2""",
    "levels": """
select window_start, window_end, hot_regions, max_z,
  case when max_z >= 1.5 then 'HIGH' when max_z >= 0.5 then 'MEDIUM' else 'LOW' end as level
from hot_stats""",
    "busiest": """
select * from (
  select *, cast(row_number() over (partition by window_end
    order by event_count desc, region) as int) as rank
  from hot) t
where rank <= 2""",
    "mix": """
select window_end, severity, event_count,
  100.0 * event_count / sum(event_count) over (partition by window_end) as percentage
from (
  select severity, bucket + interval '1 hour' as window_end,
    sum(n) over (partition by severity order by bucket
      range between interval '23 hours' preceding and current row) as event_count
  from (select severity, date_trunc('hour', event_timestamp) as bucket, count(*) as n
        from symptoms group by 1, 2) c) t""",
    "flags": """
select *, temperature_null_fail + humidity_null_fail + symptom_count_null_fail + region_null_fail
  + temperature_range_fail + humidity_range_fail + symptom_min_fail + region_allowed_fail as dq_fail
from (
  select event_id, event_timestamp, region,
    case when temperature is null or isnan(temperature) then 1 else 0 end as temperature_null_fail,
    case when humidity is null or isnan(humidity) then 1 else 0 end as humidity_null_fail,
    case when symptom_count is null then 1 else 0 end as symptom_count_null_fail,
    case when region is null then 1 else 0 end as region_null_fail,
    case when temperature < -50 or temperature > 60 then 1 else 0 end as temperature_range_fail,
    case when humidity < 0 or humidity > 100 then 1 else 0 end as humidity_range_fail,
    case when symptom_count < 0 then 1 else 0 end as symptom_min_fail,
    case when region not in ('NE', 'NW', 'SE', 'SW') then 1 else 0 end as region_allowed_fail
  from dq) t""",
    "split": """
select day_of_week, hour_of_day, event_count,
  case when (day_of_week * 24 + hour_of_day) % 5 = 0 then 'test' else 'train' end as part
from patterns""",
    # Least squares on two features by the normal equations of the centred training rows.
    "moments": """
select var_pop(day_of_week) as vd, var_pop(hour_of_day) as vh,
  covar_pop(day_of_week, hour_of_day) as cdh, covar_pop(day_of_week, event_count) as cdy,
  covar_pop(hour_of_day, event_count) as chy, avg(day_of_week) as md, avg(hour_of_day) as mh,
  avg(event_count) as my
from split where part = 'train'""",
    "line": """
select bd, bh, my - bd * md - bh * mh as b0 from (
  select *, (cdy * vh - chy * cdh) / (vd * vh - cdh * cdh) as bd,
    (chy * vd - cdy * cdh) / (vd * vh - cdh * cdh) as bh
  from moments) t""",
    "linear": """
select p.day_of_week, p.hour_of_day, p.unique_patients,
  cast(p.event_count as double) as event_count_true,
  b0 + bd * p.day_of_week + bh * p.hour_of_day as event_count_pred
from patterns p, line
where (p.day_of_week * 24 + p.hour_of_day) % 5 = 0""",
    # Least squares on five features: each centred feature is taken out of those behind it in turn.
    "centred": f"""
select *, {", ".join(f"{x} - avg({x}) filter (where not test) over () as z_{n}" for n, x in _FIVE.items())},
  event_count - avg(event_count) filter (where not test) over () as z_y,
  avg(event_count) filter (where not test) over () as fit
from (select *, (day_of_week * 24 + hour_of_day) % 5 = 0 as test,
  sin(2 * pi() * hour_of_day / 24.0) as hour_sin, cos(2 * pi() * hour_of_day / 24.0) as hour_cos
  from patterns) p""",
    **_orthogonal(),
    "daily_orders": """
select date_trunc('day', o_orderdate) as bucket, count(*) as event_count from orders group by 1""",
    "weekly": """
select cast(floor(epoch(event_timestamp) / 604800) as bigint) as run,
  dayofweek(event_timestamp) + 1 as d, hour(event_timestamp) as h, count(*) as n
from symptoms group by all""",
    "runs": """
select run, 'run_' || run as run_id, model_name, sqrt(avg((n - p) * (n - p))) as rmse,
  avg(abs(n - p)) as mae
from (
  select run, 'lagged_k3' as model_name, n, p from (
    select run, n, row_number() over (partition by run order by d, h) as i,
      avg(n) over (partition by run order by d, h rows between 3 preceding and 1 preceding) as p
    from weekly) a where i > 3
  union all
  select run, 'trailing_inclusive_5', n, avg(n) over (partition by run order by d, h
    rows between 4 preceding and current row)
  from weekly) u
group by run, model_name""",
}

# Views in the order in which they depend on each other; a query gets those it names.
_ORDER = list(_VIEWS)


def _words(sql: str) -> set[str]:
    return set("".join(c if c in string.ascii_letters + "_" else " " for c in sql).split())


def _with_views(sql: str) -> str:
    """Put the views a query needs in front of it as CTEs."""
    needed, seen = [], _words(sql)
    for name in reversed(_ORDER):
        if name in seen:
            needed.append(name)
            seen |= _words(_VIEWS[name])
    ctes = ",\n".join(f"{name} as ({_VIEWS[name]})" for name in reversed(needed))
    sql = sql.strip()
    if not ctes:
        return sql
    if sql.startswith("with recursive "):
        return f"with recursive {ctes},\n{sql[len('with recursive '):]}"
    if sql.startswith("with "):
        return f"with {ctes},\n{sql[len('with '):]}"
    return f"with {ctes}\n{sql}"


def _r(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def _errors(source: str, model: str, where: str = "") -> str:
    error = "(event_count_true - event_count_pred)"
    return (
        f"select '{model}' as model_name, {_r(f'sqrt(avg({error} * {error}))')} as rmse, "
        f"{_r(f'avg(abs({error}))')} as mae from {source} {where}"
    )


def _cooldown(source: str, key: str) -> str:
    """The alerts a greedy walk fires: the next one is the first at least six hours later."""
    return f"""with recursive alarms as (
  select {key} as k, window_end as t from {source}),
fired as (
  select k, min(t) as t from alarms group by k
  union all
  select f.k, (select min(a.t) from alarms a where a.k = f.k and a.t >= f.t + interval '6 hours')
  from fired f where f.t is not null)"""


_FLAG_NAMES = (
    "temperature_null_fail humidity_null_fail symptom_count_null_fail region_null_fail "
    "temperature_range_fail humidity_range_fail symptom_min_fail region_allowed_fail dq_fail"
).split()
_FLAG_SUMS = (
    "count(*) as total_records, "
    + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in _FLAG_NAMES)
    + ", cast(sum(case when dq_fail > 0 then 1 else 0 end) as bigint) as rows_with_any_failure"
)
_FAILURE_RATE = "100.0 * sum(case when dq_fail > 0 then 1 else 0 end) / count(*)"

_BY_REGION = (
    f"select region, symptoms, event_count, {_r('avg_severity_score')} as avg_severity_score "
    "from by_region"
)
_TRAIN_ROWS = "where (day_of_week * 24 + hour_of_day) % 5 <> 0"
_TEST_ROWS = "where (day_of_week * 24 + hour_of_day) % 5 = 0"
_FIRED_REGIONS = _cooldown("volume", "region")
_FIRED_LEVELS = _cooldown("levels", "1")

# Reports and readings of the join in time, and the events that its stream gets behind the watermark.
_REPORTS = """select event_id, event_timestamp, event_timestamp as ts, region, severity from symptoms
  where symptoms in ('click', 'view')"""
_READINGS = f"""select {_REGION} as region, ts as reading_time, value as temperature_f, ts, event_id from events
  where event_type = 'error'"""
_LATE = """(cast(event_id as bigint) % 50 = 7 and epoch_us(ts) < (
  select min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) // 4 from events))"""


def _sessions(wanted: str) -> str:
    """Runs of a region's events at most ten minutes apart (gaps and islands)."""
    return f"""
with times as (
  select region, ts, count(*) as n from (select event_id, region, event_timestamp as ts from symptoms)
  where {wanted} group by 1, 2),
marked as (
  select *, lag(ts) over (partition by region order by ts) as before from times),
numbered as (
  select *, sum(case when before is null or ts > before + interval '10 minutes' then 1 else 0 end)
    over (partition by region order by ts rows unbounded preceding) as run
  from marked)
select region, min(ts) as session_start, max(ts) + interval '10 minutes' as session_end,
  cast(sum(n) as bigint) as event_count
from numbered group by region, run"""


_ENV = {
    "env_avg_temp": f"""
select region, {_r('avg(temperature_f)')} as avg_temperature_f from env group by region""",
    "env_air_quality": f"""
select region, {_r('avg(air_quality_index)')} as avg_air_quality,
  {_r('avg(pollen_count)')} as avg_pollen_count, {_r('avg(uv_index)')} as avg_uv_index
from env group by region""",
    "env_hourly": f"""
select cast(hour(event_timestamp) as int) as hour_of_day,
  {_r('avg(temperature_f)')} as average_temp, {_r('avg(humidity_percent)')} as average_humidity,
  {_r('avg(wind_speed_mph)')} as average_windspeed
from env group by 1""",
}

_QUERIES = {
    # sources and sinks
    "scan_parquet": f"select event_id, ts, {_r('value')} as value from events",
    "load_projection": """
select event_id, region, patient_id from symptoms
where region is not null and patient_id is not null""",
    "decode_json_props": f"select {_K} as k from events",
    "publish_payload": """
select event_id as key,
  '{"event_id":"' || event_id || '","event_type":"' || event_type || '","patient_id":"'
    || patient_id || '","region":' || coalesce('"' || region || '"', 'null') || ',"symptoms":"' || symptoms || '"}' as value,
  case event_type when 'symptom_report' then 'typed.symptom_reports'
    when 'clinic_visit' then 'typed.clinic_visits'
    else 'typed.environmental_conditions' end as topic
from raw where event_type in ('symptom_report', 'clinic_visit', 'environmental_conditions')""",
    "archive_by_type": """
select event_id, event_type, timestamp, symptoms from raw
where event_type in ('symptom_report', 'clinic_visit', 'environmental_conditions')""",
    "snapshot_sink": _BY_REGION,
    "append_sink": """
select cast(b.batch_id as int) as batch_id, count(*) as total_records,
  cast(sum(dq_fail) as bigint) as dq_fail,
  cast(sum(case when dq_fail > 0 then 1 else 0 end) as bigint) as rows_with_any_failure
from flags, (values (0), (1)) b(batch_id) group by 1""",
    # routing and enrichment
    "route_events": """
select event_id, event_type,
  case when event_type in ('symptom_report', 'clinic_visit', 'environmental_conditions')
    then event_type else 'unmatched' end as route
from raw""",
    "enrich_events": """
select event_id, event_type, region, '2024-02-01 12:00:00' as processing_timestamp,
  'gateway' as event_source, 'team-a' as team_id
from raw where event_type in ('symptom_report', 'clinic_visit', 'environmental_conditions')""",
    "parse_event_time": "select event_id, ts as event_timestamp from raw",
    "severity_score": "select event_id, severity, severity_score from scored",
    "symptoms_text": """
select event_id, '["' || symptoms || '","' || severity || '"]' as symptoms,
  unnest([symptoms, severity]) as symptom
from symptoms""",
    # row-wise
    "cyclical_hour": f"""
select event_id, cast(dayofweek(event_timestamp) + 1 as int) as day_of_week,
  cast(hour(event_timestamp) as int) as hour_of_day,
  {_r('sin(2 * pi() * hour(event_timestamp) / 24.0)')} as hour_sin,
  {_r('cos(2 * pi() * hour(event_timestamp) / 24.0)')} as hour_cos
from symptoms""",
    "coerce_numeric": f"""
select event_id, case when event_id % 71 = 0 then null else cast({_K} as double) end as k
from events""",
    "drop_null_keys": """
select event_id, region, patient_id from symptoms
where region is not null and patient_id is not null""",
    # aggregates
    "symptom_by_region": _BY_REGION,
    "severity_by_hour": f"""
select *, {_r('100.0 * event_count / (select sum(event_count) from by_hour)')} as percentage
from by_hour""",
    "severity_share_by_hour": f"""
select *, {_r('100.0 * event_count / sum(event_count) over (partition by hour_of_day)')}
  as percentage
from by_hour""",
    "temporal_patterns": "select * from patterns",
    "env_avg_temp": _ENV["env_avg_temp"],
    "env_air_quality": _ENV["env_air_quality"],
    "env_hourly": _ENV["env_hourly"],
    "lookback_region_events": """
select region, count(*) as event_count from symptoms
where region is not null
  and event_timestamp >= (select max(event_timestamp) from symptoms) - interval '1440 minutes'
group by region""",
    "severity_share": f"""
select severity, count(*) as total_events,
  {_r('100.0 * count(*) / (select count(*) from symptoms)')} as percentage
from symptoms group by severity""",
    "lookback_severity_share": f"""
select severity, count(*) as total_events,
  {_r('100.0 * count(*) / sum(count(*)) over ()')} as percentage
from symptoms
where event_timestamp >= (select max(event_timestamp) from symptoms) - interval '1440 minutes'
group by severity""",
    "severity_hour_pivot": "select severity, "
    + ", ".join(
        f"cast(sum(case when hour_of_day = {h} then event_count else 0 end) as bigint) as h{h}"
        for h in range(24)
    )
    + " from by_hour group by severity",
    "avg_events_by_hour": f"""
select hour_of_day, {_r('avg(event_count)')} as avg_event_count from patterns
group by hour_of_day""",
    "top10_regions": """
select region, cast(sum(event_count) as bigint) as event_count from by_region
where region is not null group by region order by event_count desc, region limit 10""",
    # windows and series
    "bucket_5min_filled": "select bucket, event_count from filled",
    "rolling_30min": f"""
select bucket, event_count, {_r('rolling_30min')} as rolling_30min from rolling""",
    "anomaly_overlay": f"""
select r.bucket, {_r('r.rolling_30min')} as rolling_30min,
  case when a.bucket is not null
    then {_r('(select max(rolling_30min) * 1.05 from rolling)')} end as mark
from rolling r left join (
  select bucket from buckets,
    (select avg(event_count) as m, stddev_pop(event_count) as s from buckets) t
  where abs((event_count - m) / nullif(s, 0)) >= 2.5) a on a.bucket = r.bucket""",
    "tumbling_region_counts": """
select time_bucket(interval '5 minutes', event_timestamp) as window_start,
  time_bucket(interval '5 minutes', event_timestamp) + interval '5 minutes' as window_end,
  region, count(*) as event_count
from symptoms group by 1, 2, 3""",
    "sliding_region_counts": "select * from windows",
    "sliding_every_slide": "select * from covering",
    "rolling_baseline_k3": f"""
select day_of_week, hour_of_day, event_count_true, {_r('event_count_pred')} as event_count_pred
from lagged""",
    "rolling_trailing5": f"""
select day_of_week, hour_of_day, event_count_true, {_r('event_count_pred')} as event_count_pred
from inclusive""",
    "baseline_ratio": f"""
select region, bucket, event_count, {_r('short_mean')} as short_mean, {_r('long_mean')} as long_mean,
  {_r('short_mean / nullif(long_mean, 0)')} as ratio
from (
  select *, avg(event_count) over (partition by region order by bucket
      rows between 5 preceding and current row) as short_mean,
    avg(event_count) over (partition by region order by bucket
      rows between 23 preceding and current row) as long_mean
  from hourly_filled) t""",
    "rolling_24h": """
select region, bucket, event_count,
  cast(sum(event_count) over (partition by region order by bucket
    range between interval '23 hours' preceding and current row) as bigint) as events_24h
from hourly_region""",
    "lag_features": """
select day_of_week, hour_of_day, event_count,
  cast(lag(event_count, 1) over w as double) as event_count_lag_1,
  cast(lag(event_count, 2) over w as double) as event_count_lag_2,
  cast(lag(event_count, 3) over w as double) as event_count_lag_3
from patterns window w as (order by day_of_week, hour_of_day)""",
    "hourly_lag_features": """
select region, bucket, event_count,
  cast(lag(event_count, 1) over w as double) as event_count_lag_1,
  cast(lag(event_count, 2) over w as double) as event_count_lag_2,
  cast(lag(event_count, 3) over w as double) as event_count_lag_3
from hourly_filled window w as (partition by region order by bucket)""",
    "sustained_deviation": """
select region, window_start, window_end, event_count from (
  select *, sum(case when event_count >= 100 then 1 else 0 end) over (
    partition by region order by window_end
    range between interval '2 hours' preceding and current row) as hits
  from windows) t
where hits = 3""",
    "region_timeline": """
select bucket as window_start, bucket + interval '1 hour' as window_end, region, event_count
from hourly_region""",
    # anomalies and alerts
    "zscore_anomalies": f"""
select region, symptoms, event_count, {_r('avg_severity_score')} as avg_severity_score,
  {_r('(event_count - m) / nullif(s, 0)')} as z_score
from by_region, (select avg(event_count) as m, stddev_pop(event_count) as s from by_region) t
where abs((event_count - m) / nullif(s, 0)) >= 1.2""",
    "append_anomalies": f"""
select region, symptoms, event_count, {_r('avg_severity_score')} as avg_severity_score,
  {_r('(event_count - m) / nullif(s, 0)')} as z_score, 'run_a' as run_id
from by_region, (select avg(event_count) as m, stddev_pop(event_count) as s from by_region) t
where abs((event_count - m) / nullif(s, 0)) >= 1.2""",
    "job_basic_alerts": """
select window_end, 'Volume alert: many reports' || chr(10)
  || 'Time: ' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00' || chr(10)
  || 'Threshold: 20 reports in 1440 minutes' || chr(10) || 'Regions:' || chr(10)
  || string_agg('- ' || region || ': ' || n || ' reports in 1440 minutes', chr(10)
       order by n desc, region) as message
from (
  select region, count(*) as n, (select max(event_timestamp) from symptoms) as window_end
  from symptoms where region is not null and event_timestamp
    >= (select max(event_timestamp) from symptoms) - interval '1440 minutes'
  group by region) r
where n >= 20 group by window_end
union all
select window_end, 'Severity alert: many severe reports' || chr(10)
  || 'Time: ' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00' || chr(10)
  || 'Severe: ' || printf('%.1f', percentage) || '% of reports (threshold 5.0%)'
from (
  select (select max(event_timestamp) from symptoms) as window_end,
    100.0 * sum(case when severity = 'severe' then 1 else 0 end) / count(*) as percentage
  from symptoms where event_timestamp
    >= (select max(event_timestamp) from symptoms) - interval '1440 minutes') t
where percentage >= 5""",
    "zscore_hourly": f"""
select bucket, event_count, {_r('z_score')} as z_score from zhour where abs(z_score) >= 2.5""",
    "zscore_by_region": f"""
select region, bucket, event_count, {_r('z_score')} as z_score from zregion
where abs(z_score) >= 2.5""",
    "zscore_history": f"""
select region, bucket, event_count, {_r('m')} as history_mean, {_r('s')} as history_std,
  {_r('(event_count - m) / nullif(s, 0)')} as z_score
from (
  select *, avg(event_count) over w as m, stddev_pop(event_count) over w as s
  from hourly_region window w as (partition by region order by bucket
    range between interval '24 hours' preceding and interval '1 hour' preceding)) t""",
    "alert_volume": "select * from volume",
    "alert_severe_share": f"""
select window_start, window_start + interval '1 day' as window_end,
  {_r('percentage')} as percentage
from severe_days""",
    "alert_level": f"""
select window_start, window_end, hot_regions, {_r('max_z')} as max_z, level from levels""",
    "alert_level_history": f"""
select window_start, window_end, count(*) as hot_regions, {_r('max(z)')} as max_z,
  case when max(z) >= 1.5 then 'HIGH' when max(z) >= 0.5 then 'MEDIUM' else 'LOW' end as level
from (
  select *, (event_count - avg(event_count) over w) / nullif(stddev_pop(event_count) over w, 0) as z
  from windows window w as (partition by region order by window_end
    range between interval '24 hours' preceding and interval '1 hour' preceding)) t
where event_count >= 80
group by 1, 2""",
    "alert_top_regions": "select * from busiest",
    "alert_advanced": f"""
select b.window_start, b.window_end, l.level, l.hot_regions,
  (select cast(count(*) as int) from mix m where m.window_end = b.window_end) as severities,
  b.rank - 1 as place, b.region, b.event_count as events,
  {_r('(b.event_count - s.m) / nullif(s.s, 0)')} as z_score
from busiest b join levels l using (window_end) join hot_stats s using (window_end)""",
    "alert_cooldown": f"""{_FIRED_REGIONS}
select v.* from volume v join fired f on f.k = v.region and f.t = v.window_end""",
    "alert_cooldown_global": f"""{_FIRED_LEVELS}
select l.window_start, l.window_end, l.hot_regions, {_r('l.max_z')} as max_z, l.level
from levels l join fired f on f.t = l.window_end""",
    "alert_messages": f"""{_FIRED_LEVELS},
region_lines as (
  select b.window_end, string_agg('- ' || region || ': ' || event_count || ' events (z='
    || coalesce(printf('%.2f', (event_count - s.m) / nullif(s.s, 0)), 'nan') || ')', chr(10)
    order by rank) as txt
  from busiest b join hot_stats s using (window_end) group by 1),
mix_lines as (
  select window_end, string_agg('- ' || severity || ': ' || printf('%.1f', percentage) || '%',
    chr(10) order by event_count desc, severity) as txt
  from mix group by 1)
select l.window_end, l.level,
  'Symptom alert: more reports than usual' || chr(10)
  || 'Time: ' || strftime(l.window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00' || chr(10)
  || 'Evaluated: 1440 minutes, from 80 reports on' || chr(10)
  || 'Level: ' || l.level || chr(10) || chr(10)
  || 'Regions above the threshold:' || chr(10) || r.txt || chr(10) || chr(10)
  || coalesce('Shares by severity:' || chr(10) || m.txt,
              'Shares by severity: none known.') as message
from levels l join fired f on f.t = l.window_end
join region_lines r using (window_end) left join mix_lines m using (window_end)""",
    "alert_messages_basic": """
select window_end, 'Volume alert: many reports' || chr(10)
  || 'Time: ' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00' || chr(10)
  || 'Threshold: 100 reports in 1440 minutes' || chr(10) || 'Regions:' || chr(10)
  || string_agg('- ' || region || ': ' || event_count || ' reports in 1440 minutes', chr(10)
       order by event_count desc, region) as message
from volume group by window_end
union all
select window_start + interval '1 day', 'Severity alert: many severe reports' || chr(10)
  || 'Time: ' || strftime(window_start + interval '1 day', '%Y-%m-%dT%H:%M:%S') || '+00:00' || chr(10)
  || 'Severe: ' || printf('%.1f', percentage) || '% of reports (threshold 16.0%)'
from severe_days""",
    "alert_multi_metric": f"""
select d.window_start, d.window_end, d.region, d.event_count, {_r('d.z_score')} as z_score,
  {_r('q.rate')} as dq_failure_rate
from (
  select date_trunc('day', event_timestamp) as window_start,
    date_trunc('day', event_timestamp) + interval '1 day' as window_end, region,
    count(*) as event_count,
    (count(*) - avg(count(*)) over w) / nullif(stddev_pop(count(*)) over w, 0) as z_score
  from symptoms group by 1, 2, 3 window w as (partition by region)) d
join (
  select date_trunc('day', event_timestamp) as window_start, region, {_FAILURE_RATE} as rate
  from flags group by 1, 2) q on q.window_start = d.window_start and q.region = d.region
where d.z_score >= 0.5 and d.event_count >= 50 and q.rate >= 25""",
    # data quality
    "dq_row_flags": f"select event_id, {', '.join(_FLAG_NAMES)} from flags",
    "dq_metrics": f"select {_FLAG_SUMS} from flags",
    "dq_metrics_by_day": f"""
select date_trunc('day', event_timestamp) as day, {_FLAG_SUMS}, {_r(_FAILURE_RATE)} as failure_rate
from flags group by 1""",
    "dq_rollup": f"""
select count(*) as total_records, cast(sum(nulls) as bigint) as null_failures,
  cast(sum(ranges) as bigint) as range_failures, cast(sum(unknown) as bigint) as invalid_regions,
  cast(0 as bigint) as invalid_values,
  cast(sum(broken) as bigint) as schema_violations,
  cast(sum(failed) as bigint) as rows_with_any_failure,
  {_r('100.0 * sum(failed) / count(*)')} as failure_rate
from (
  select broken, case when broken = 1 then 4 else temperature_null_fail + humidity_null_fail
      + symptom_count_null_fail + region_null_fail end as nulls,
    case when broken = 1 then 0 else temperature_range_fail + humidity_range_fail
      + symptom_min_fail end as ranges,
    case when broken = 1 then 0 else region_allowed_fail end as unknown,
    case when broken = 1 or dq_fail > 0 then 1 else 0 end as failed
  from (select *, case when event_id % 71 = 0 then 1 else 0 end as broken from flags) f) t""",
    # forecasts
    "forecast_features": f"""
select cast(day_of_week as double) as day_of_week, cast(hour_of_day as double) as hour_of_day,
  cast(unique_patients as double) as unique_patients,
  {_r('sin(2 * pi() * hour_of_day / 24.0)')} as hour_sin,
  {_r('cos(2 * pi() * hour_of_day / 24.0)')} as hour_cos,
  cast(event_count as double) as event_count
from patterns""",
    "forecast_split": "select * from split",
    "forecast_linear2": f"""
select {_r('any_value(bd)')} as coef_day, {_r('any_value(bh)')} as coef_hour,
  {_r('any_value(b0)')} as intercept,
  {_r('sqrt(avg((event_count_true - event_count_pred) * (event_count_true - event_count_pred)))')}
    as rmse,
  {_r('avg(abs(event_count_true - event_count_pred))')} as mae
from linear, line""",
    "forecast_predictions": f"""
select day_of_week, hour_of_day, cast(unique_patients as int) as unique_patients,
  event_count_true, {_r('event_count_pred')} as event_count_pred,
  {_r('sqrt(avg((event_count_true - event_count_pred) * (event_count_true - event_count_pred)) over ())')}
    as rmse,
  {_r('avg(abs(event_count_true - event_count_pred)) over ()')} as mae,
  'run_linear' as run_id, timestamp '2025-01-01 00:00:00' as predicted_at
from linear""",
    "forecast_linear5": f"""
select day_of_week, hour_of_day, cast(unique_patients as int) as unique_patients,
  cast(event_count as double) as event_count_true, {_r('fit')} as event_count_pred,
  {_r('sqrt(avg((event_count - fit) * (event_count - fit)) over ())')} as rmse,
  {_r('avg(abs(event_count - fit)) over ()')} as mae,
  'run_linear' as run_id, timestamp '2025-01-01 00:00:00' as predicted_at
from without_e where test""",
    # What SQL can say of a tree model is which rows it was tried on, not what it predicts.  That a forest
    # beats the mean is an expectation, which held at every size tried; boosting beats it on some sizes of
    # the tables only, so its outcome is no part of the comparison.
    **{
        name: f"""
select day_of_week, hour_of_day, cast(event_count as double) as event_count_true,
  (select count(*) from split where part = 'train') as train_rows,
  (select count(*) from split where part = 'test') as test_rows{outcome}
from split where part = 'test'"""
        for name, outcome in (("forecast_random_forest", ", true as beats_mean"), ("forecast_gbt", ""))
    },
    "forecast_metrics": _errors("lagged", "lagged_k3")
    + " union all " + _errors("inclusive", "trailing_inclusive_5"),
    "model_comparison": "select 'run_1' as run_id, * from ("
    + _errors("lagged", "rolling_avg_k=3", _TEST_ROWS)
    + " union all " + _errors("inclusive", "trailing_inclusive_5", _TEST_ROWS)
    + " union all " + _errors("linear", "linear_regression") + ") t",
    "true_vs_pred": f"""
select day_of_week, hour_of_day, event_count_true, {_r('event_count_pred')} as event_count_pred,
  {_r('greatest(max(event_count_true) over (), max(event_count_pred) over ())')} as diagonal
from lagged""",
    "error_by_hour": f"""
select hour_of_day, {_r('sum(abs(event_count_true - event_count_pred))')} as total_abs_error,
  {_r('avg(abs(event_count_true - event_count_pred))')} as mean_abs_error
from lagged group by hour_of_day""",
    # monitoring
    "model_metric_trend": f"""
select model_name, run_id, {_r('rmse')} as rmse, {_r('mae')} as mae from runs""",
    "model_drift": f"""
select run, run_id, model_name, {_r('rmse')} as rmse,
  {_r('stddev_pop(rmse) over (partition by model_name)')} as rmse_stability,
  {_r('rmse - lag(rmse) over (partition by model_name order by run)')} as rmse_change
from runs""",
    "anomaly_strength": f"""
select date_trunc('day', bucket) as window_start, {_r('avg(abs(z_score))')} as mean_abs_z
from zhour group by 1""",
    "top_anomalous_regions": f"""
select region, {_r('max(abs(z_score))')} as max_abs_z from zregion
where region is not null and z_score is not null
group by region order by max(abs(z_score)) desc, region limit 5""",
    "table_freshness": """
select t.table_name, max(ts) as newest, count(*) as row_count
from events, (values ('symptom_reports'), ('environmental_conditions'), ('dq_events'))
  t(table_name)
group by 1""",
    # the same operators on other tables
    "lineitem_dq_metrics": """
select l_linestatus, count(*) as total_records,
  cast(sum(case when l_quantity is null or isnan(l_quantity) then 1 else 0 end) as bigint)
    as l_quantity_null_fail,
  cast(sum(case when l_discount is null or isnan(l_discount) then 1 else 0 end) as bigint)
    as l_discount_null_fail,
  cast(sum(case when l_returnflag is null then 1 else 0 end) as bigint)
    as l_returnflag_null_fail,
  cast(sum(q) as bigint) as l_quantity_range_fail, cast(sum(d) as bigint) as l_discount_range_fail,
  cast(sum(f) as bigint) as l_returnflag_allowed_fail, cast(sum(q + d + f) as bigint) as dq_fail,
  cast(sum(case when q + d + f > 0 then 1 else 0 end) as bigint) as rows_with_any_failure
from (
  select *, case when l_quantity < 1 or l_quantity > 45 then 1 else 0 end as q,
    case when l_discount > cast(0.09 as double) then 1 else 0 end as d,
    case when l_returnflag not in ('A', 'N') then 1 else 0 end as f
  from lineitem) t
group by l_linestatus""",
    "orders_priority_share": f"""
select o_orderpriority, cast(dayofweek(o_orderdate) + 1 as int) as day_of_week,
  count(*) as orders,
  {_r('100.0 * count(*) / sum(count(*)) over (partition by dayofweek(o_orderdate))')}
    as percentage
from orders group by o_orderpriority, dayofweek(o_orderdate)""",
    "orders_zscore_daily": f"""
select bucket, event_count, {_r('(event_count - m) / nullif(s, 0)')} as z_score
from daily_orders,
  (select avg(event_count) as m, stddev_pop(event_count) as s from daily_orders) t
where abs((event_count - m) / nullif(s, 0)) >= 2.0""",
    "orders_rolling_week": f"""
select o_orderpriority, bucket, event_count,
  {_r("""avg(event_count) over (partition by o_orderpriority order by bucket
    rows between 6 preceding and current row)""")} as rolling_week
from (
  select s.o_orderpriority, s.bucket, cast(count(o.o_orderkey) as bigint) as event_count
  from (select o_orderpriority, unnest(generate_series(
          date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)),
          interval '1 day')) as bucket
        from orders group by o_orderpriority) s
  left join orders o on o.o_orderpriority = s.o_orderpriority
    and date_trunc('day', o.o_orderdate) = s.bucket
  group by 1, 2) t""",
    # streams: the final state of each equals the batch result
    "stream_file_source": """
select event_id, event_type, timestamp, patient_id, symptoms from raw""",
    "stream_symptom_by_region": _BY_REGION,
    "stream_dq": f"select {_FLAG_SUMS} from flags",
    "stream_env_avg_temp": _ENV["env_avg_temp"],
    "stream_env_air_quality": _ENV["env_air_quality"],
    "stream_env_hourly": _ENV["env_hourly"],
    "stream_windowed_counts": """
select bucket as window_start, bucket + interval '1 hour' as window_end, region, event_count
from hourly_region""",
    "stream_sliding_counts": "select * from covering",
    "stream_dedup": "select event_id, event_timestamp, symptoms from symptoms",
    "stream_cooldown": f"""{_FIRED_REGIONS}
select v.region, v.window_end, v.event_count
from volume v join fired f on f.k = v.region and f.t = v.window_end""",
    "alert_lines": """
select window_end, cast(line as int) as line, text from (
  select distinct window_end, unnest([1, 2, 3, 4]) as line,
    unnest(['Volume alert: many reports', 'Time: ' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00',
      'Threshold: 100 reports in 1440 minutes', 'Regions:']) as text
  from volume
  union all
  select window_end, 4 + row_number() over (partition by window_end order by event_count desc, region),
    '- ' || region || ': ' || event_count || ' reports in 1440 minutes'
  from volume)""",
    "freshness_from_footers": """
select 'events' as table_name, max(ts) as newest, count(*) as row_count from events
union all
select 'orders', max(o_orderdate), count(*) from orders""",
    "archive_in_files": """
select event_type, count(*) as row_count, true as few_files from raw
where event_type in ('symptom_report', 'clinic_visit', 'environmental_conditions') group by 1""",
    "zscore_running": f"""
select region, bucket, event_count, {_r('z_score')} as z_score from (
  select *, (event_count - avg(event_count) over w) / nullif(stddev_pop(event_count) over w, 0) as z_score
  from hourly_region where region is not null window w as (partition by region))
where date_trunc('day', bucket) = (select max(date_trunc('day', bucket)) from hourly_region where region is not null)""",
    "models_fit_training": f"""
select model_name, (select count(*) from patterns {_TRAIN_ROWS}) as train_rows, true as fits_training
from (values ('linear_regression'), ('random_forest'), ('gradient_boosting')) m(model_name)""",
    "alert_multi_metric_in_time": f"""
with region_days as (
  select date_trunc('day', event_timestamp) as window_start, region, count(*) as event_count
  from flags where region is not null group by 1, 2),
day_scores as (
  select window_start, window_start + interval '1 day' as window_end, region, event_count,
    (event_count - avg(event_count) over w) / nullif(stddev_pop(event_count) over w, 0) as z_score
  from region_days window w as (partition by region)),
quality_rows as (
  select region, to_timestamp((cast(epoch(event_timestamp) as bigint) // 25200 + 1) * 25200)::timestamp as evaluated_at,
    {_FAILURE_RATE} as rate
  from (select * from flags where region is not null) group by 1, 2)
select s.window_start, s.window_end, s.region, s.event_count, {_r('s.z_score')} as z_score, e.evaluated_at,
  {_r('e.rate')} as dq_failure_rate
from day_scores s asof join quality_rows e on s.region = e.region and s.window_end >= e.evaluated_at
where s.z_score >= 0 and s.event_count >= 20 and e.rate >= 20 and s.window_end - e.evaluated_at <= interval '1 day'""",
    # joins in time, sessions, streams that are resumed
    "range_join": f"""
select s.event_id, s.event_timestamp, s.region, s.severity, r.reading_time, {_r('r.temperature_f')} as temperature_f
from ({_REPORTS}) s left join ({_READINGS}) r
  on r.region = s.region and r.reading_time between s.event_timestamp - interval '30 minutes' and s.event_timestamp""",
    "stream_join": f"""
select s.event_id, s.event_timestamp, s.region, s.severity, r.reading_time, {_r('r.temperature_f')} as temperature_f
from ({_REPORTS} and not {_LATE}) s left join ({_READINGS} and not {_LATE}) r
  on r.region = s.region and r.reading_time between s.event_timestamp - interval '30 minutes' and s.event_timestamp""",
    "session_region_counts": _sessions("true"),
    "stream_sessions": _sessions(f"not {_LATE}"),
    "stream_symptom_rollups": f"""
select 'symptom_by_region' as table_name, region as first_key, symptoms as second_key, event_count,
  {_r('avg_severity_score')} as value
from by_region
union all
select 'severity_distribution', severity, cast(hour(event_timestamp) as varchar), count(*),
  {_r('100.0 * count(*) / sum(count(*)) over ()')}
from symptoms group by 2, 3
union all
select 'temporal_patterns', cast(dayofweek(event_timestamp) + 1 as varchar), cast(hour(event_timestamp) as varchar),
  count(*), cast(count(distinct patient_id) as double)
from symptoms group by 2, 3
union all
select 'data_quality_metrics', rule, null, n, cast(bad as double) from (
  select count(*) as n, sum(case when region is null then 1 else 0 end) as missing,
    sum(case when region is not null and region not in ('NE', 'NW', 'SE', 'SW') then 1 else 0 end) as unknown
  from symptoms) d,
  lateral (values ('region_null_fail', missing), ('region_allowed_fail', unknown), ('dq_fail', missing + unknown),
    ('rows_with_any_failure', missing + unknown)) v(rule, bad)""",
    "stream_environment_rollups": f"""
with readings_by_region as (
  select region, avg(temperature_f) as t, avg(air_quality_index) as a, avg(pollen_count) as p, avg(uv_index) as u
  from env group by 1),
readings_by_hour as (
  select cast(hour(event_timestamp) as varchar) as h, avg(temperature_f) as t, avg(humidity_percent) as m,
    avg(wind_speed_mph) as w
  from env group by 1)
select table_name, first_key, second_key, cast(null as bigint) as event_count, {_r('value + 1e-9')} as value from (
  select 'env_avg_temp' as table_name, region as first_key, 'avg_temperature_f' as second_key, t as value from readings_by_region
  union all select 'env_aqi_distribution', region, 'avg_air_quality', a from readings_by_region
  union all select 'env_aqi_distribution', region, 'avg_pollen_count', p from readings_by_region
  union all select 'env_aqi_distribution', region, 'avg_uv_index', u from readings_by_region
  union all select 'env_hourly_temp', h, 'average_temp', t from readings_by_hour
  union all select 'env_hourly_temp', h, 'average_humidity', m from readings_by_hour
  union all select 'env_hourly_temp', h, 'average_windspeed', w from readings_by_hour)""",
    "stream_cooldown_any_order": f"""{_FIRED_REGIONS}
select v.region, v.window_end, v.event_count
from volume v join fired f on f.k = v.region and f.t = v.window_end""",
    "stream_by_interval": "select event_id, region, severity from symptoms",
    "stamp_as_of": """
select region, symptoms, event_count, timestamp '2024-03-01 12:00:00' as last_updated from by_region""",
}

ORACLES = {name: _with_views(sql) for name, sql in _QUERIES.items()}
