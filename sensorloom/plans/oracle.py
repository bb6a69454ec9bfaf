"""The registered queries as SQL over the same tables."""

_READINGS = """with readings as (
  select event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as "timestamp", event_type as sensor_id,
         cast(value as float) as temperature, cast(json_extract(props, '$.k') as float) as humidity,
         cast(value > 150 as int) as is_anomaly
  from events),
ruled as (
  select *, cast(cast(temperature as double) + cast(humidity as double) / 2 > 170 as int) as prediction
  from readings)
"""

_LINE = """'sensor_measurement,sensor_id=' || regexp_replace(sensor_id, '([,= ])', '\\\\\\1', 'g')
  || ' temperature=' || cast(cast(temperature as double) as varchar)
  || ',humidity=' || cast(cast(humidity as double) as varchar)
  || ' ' || cast(epoch_us(date_trunc('second', ts)) * 1000 as varchar)"""

_MOMENTS = """round(avg(cast(temperature as double)), 6) as temperature_mean,
  round(stddev_samp(cast(temperature as double)), 6) as temperature_std,
  round(avg(cast(humidity as double)), 6) as humidity_mean,
  round(stddev_samp(cast(humidity as double)), 6) as humidity_std"""

_EXTREMES = _MOMENTS + "," + ",".join(
    f" round(cast({m}({v}) as double), 6) as {v}_{m}" for v in ("temperature", "humidity") for m in ("min", "max")
)

_DAMAGED = "(sensor_id in ('error', 'signup', 'purchase') or event_id % 11 in (3, 5))"

_FLOAT = "cast(value as float)"
_DEVICES = f"""with devices as (
  select event_id, ts, user_id as device_id, case event_id % 97 when 1 then null when 2 then cast('nan' as float)
    when 3 then cast('inf' as float) when 4 then cast('-inf' as float)
    else case when user_id % 7 = 0 then cast('nan' as float) else cast(floor({_FLOAT} / 50) as float) end end as temperature
  from events),
judged_ as (
  select *, case when isfinite(temperature) then cast(temperature as double) end as reading from devices),
damaged as (
  select *, coalesce(count(reading) over t = 5 and abs(reading - avg(reading) over t) >= 2, false) as is_spike,
    cast(temperature is distinct from lag(temperature) over w as int) as starts
  from judged_ window w as (partition by device_id order by ts, event_id),
    t as (partition by device_id order by ts, event_id rows between 5 preceding and 1 preceding)),
damaged_runs as (
  select *, sum(starts) over (partition by device_id order by ts, event_id) as run from damaged)
"""

_STUCK = """with marked as (
  select *, cast(event_type is distinct from lag(event_type) over w as int) as starts
  from events window w as (partition by user_id order by ts, event_id)),
numbered as (
  select *, sum(starts) over (partition by user_id order by ts, event_id) as run from marked)
"""

_SCORED = 'select "timestamp", sensor_id, temperature, humidity, prediction as is_anomaly_predicted'

ORACLE: dict[str, str] = {
    "json_encode": """select event_id, cast(to_json({'sensor_id': event_type, 'temperature': value,
  'humidity': cast(json_extract(props, '$.k') as double), 'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%SZ')}) as varchar) as "value"
  from events""",
    "json_parse": _READINGS + 'select event_id, sensor_id, temperature, humidity, "timestamp" from readings',
    "csv_scan": _READINGS + 'select "timestamp", sensor_id, temperature, humidity, is_anomaly from readings',
    "quarantine": _READINGS
    + f"""select event_id, case when sensor_id <> 'error' then sensor_id || case when event_id % 11 = 5 then '\\' else '' end end as sensor_id,
  not ({_DAMAGED}) as valid from readings""",
    "ts_line_protocol": _READINGS + f"select event_id, {_LINE} as line from readings",
    "round_reading": _READINGS
    + """select event_id, round(cast(temperature as double), 2) as temperature,
  round(cast(humidity as double) / 8, 2) as humidity_eighth from readings""",
    "score_projection": _READINGS + _SCORED + ", event_id from ruled",
    "ts_upsert": _READINGS
    + """select sensor_id, "timestamp", arg_max(temperature, event_id) as temperature,
  arg_max(humidity, event_id) as humidity from readings group by sensor_id, "timestamp\"""",
    "chrono_order": _READINGS
    + "select event_id, sensor_id, row_number() over (order by ts, event_id) as chrono_rank from readings",
    "feature_stats": _READINGS + f"select {_MOMENTS} from readings",
    "assemble_features": _READINGS
    + "select event_id, cast(temperature as double) as temperature, cast(humidity as double) as humidity from readings",
    "scale_features": _READINGS
    + """, moments as (
  select avg(cast(temperature as double)) as tm, nullif(stddev_samp(cast(temperature as double)), 0) as ts_,
         avg(cast(humidity as double)) as hm, nullif(stddev_samp(cast(humidity as double)), 0) as hs from readings)
select event_id, round(coalesce((cast(temperature as double) - tm) / ts_, 0), 6) as temperature,
  round(coalesce((cast(humidity as double) - hm) / hs, 0), 6) as humidity from readings, moments""",
    "split_keyed": """select event_id,
  cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 100 < 80 as is_train from events""",
    "split_random": "select event_id, count(*) as parts, true as share_as_asked from events group by event_id",
    "train_counts": """select cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 100 < 80 as is_train,
  cast(value > 150 as int) as is_anomaly, count(*) as readings from events group by 1, 2""",
    "eval_metrics": _READINGS
    + """, labels_ as (
  select is_anomaly as c, count(*) as n, sum(cast(is_anomaly = prediction as int)) as tp from ruled group by 1),
claims as (select prediction as c, count(*) as np from ruled group by 1),
scores as (
  select l.c, n, tp, 2.0 * tp / (n + coalesce(np, 0)) as f1 from labels_ l left join claims p on l.c = p.c)
select cast(sum(n) as bigint) as readings, round(cast(sum(tp) as double) / sum(n), 6) as accuracy, round(sum(n * f1) / sum(n), 6) as f1_weighted,
  round(coalesce(max(case when c = 1 then f1 end), 0), 6) as f1_anomaly from scores""",
    "score_batch": """select event_id, cast(value > 150 as int) as is_anomaly, true as scored, true as good from events
  where cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 100 >= 80""",
    "holdout_quality": """select count(*) as readings, true as accurate, true as finds_anomalies from events
  where cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 100 >= 80""",
    "model_roundtrip": "select event_id, true as same from events",
    "score_stream": _READINGS + 'select event_id, "timestamp", sensor_id, temperature, humidity, true as same from readings',
    "sink_processed": _READINGS + _SCORED + " from ruled",
    "sink_anomalies": _READINGS + _SCORED + " from ruled where prediction = 1",
    "persist_stream": _READINGS + 'select sensor_id, temperature, humidity, "timestamp" from readings',
    "sink_fanout_stream": _READINGS
    + _SCORED
    + ", 'processed_data' as store from ruled union all "
    + _SCORED
    + ", 'anomalies' as store from ruled where prediction = 1",
    "ts_sink_stream": _READINGS + f"select {_LINE} as line from readings",
    "batch_metrics": _READINGS
    + f"""select count(*) as readings, count(*) filter (where {_DAMAGED}) as rejected,
  count(*) filter (where not ({_DAMAGED}) and prediction = 1) as anomalies from ruled""",
    "sensor_baseline": _READINGS + f"select sensor_id, {_MOMENTS}, count(*) as readings from readings group by sensor_id",
    "daily_profile": _READINGS
    + f"""select sensor_id, cast(extract(hour from ts) as int) as "hour", {_MOMENTS}, count(*) as readings
  from readings group by 1, 2""",
    "profile_residual": _READINGS
    + """select event_id, sensor_id, cast(extract(hour from ts) as int) as "hour",
  round(temperature - avg(cast(temperature as double)) over w, 6) as temperature_residual,
  round(humidity - avg(cast(humidity as double)) over w, 6) as humidity_residual
  from readings window w as (partition by sensor_id, extract(hour from ts))""",
    "spike_detect": _READINGS
    + """select event_id, sensor_id, temperature from (
  select *, count(temperature) over w as n, avg(cast(temperature as double)) over w as m from readings
  window w as (partition by sensor_id order by ts, event_id rows between 20 preceding and 1 preceding))
where n = 20 and abs(temperature - m) >= 200""",
    "stuck_runs": _STUCK
    + """select user_id as device_id, min(ts) as start, max(ts) as "end", count(*) as readings,
  any_value(event_type) as state from numbered group by user_id, run having count(*) >= 3""",
    "spikes_damaged": _DEVICES + "select event_id, device_id, temperature from damaged where is_spike",
    "stuck_damaged": _DEVICES
    + """select device_id, min(ts) as start, max(ts) as "end", count(*) as readings, any_value(temperature) as temperature
  from damaged_runs where temperature is not null and not isnan(temperature) group by device_id, run having count(*) >= 3""",
    "labels_damaged": _DEVICES
    + """, both_ as (
  select event_id, device_id, is_spike,
    count(*) over (partition by device_id, run) >= 3 and temperature is not null and not isnan(temperature) as is_stuck from damaged_runs)
select *, cast(is_spike or is_stuck as int) as is_anomaly from both_""",
    "anomaly_labels": _STUCK
    + """, judged as (
  select event_id, user_id, count(*) over (partition by user_id, run) >= 3 as is_stuck,
    count(*) over t = 10 and abs(cast(value as float) - avg(cast(cast(value as float) as double)) over t) >= 150 as is_spike
  from numbered window t as (partition by user_id order by ts, event_id rows between 10 preceding and 1 preceding))
select event_id, user_id as device_id, coalesce(is_spike, false) as is_spike, is_stuck,
  cast(coalesce(is_spike, false) or is_stuck as int) as is_anomaly from judged""",
    "stuck_stream": _STUCK
    + """select user_id as device_id, min(ts) as start, any_value(event_type) as state
  from numbered group by user_id, run having count(*) >= 3""",
    "hourly_rollup": _READINGS
    + f"""select sensor_id, time_bucket(interval '1 hour', ts) as start, time_bucket(interval '1 hour', ts) + interval '1 hour' as "end",
  count(*) as readings, {_EXTREMES} from readings
  group by 1, 2 having "end" <= (select max(ts) from events) - interval '10 minutes'""",
    "dated_store": _READINGS
    + """select sensor_id, temperature, humidity, "timestamp" from readings
  where date_trunc('second', ts) >= timestamp '2024-01-08 12:00:00' and date_trunc('second', ts) < timestamp '2024-01-18 00:00:00'""",
    "distinct_stream": _READINGS
    + """select distinct sensor_id, cast(cast(cast(temperature as double) as decimal(9,2)) as float) as temperature, humidity, "timestamp" from readings""",
    "stuck_unordered": _STUCK
    + """select user_id as device_id, min(ts) as start, any_value(event_type) as state
  from numbered group by user_id, run having count(*) >= 3""",
}
# What a stream keeps up to date is what the batch gives over all its readings.
ORACLE["profile_kept"] = ORACLE["daily_profile"]
ORACLE["baseline_kept"] = ORACLE["sensor_baseline"]
