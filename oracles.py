"""The registered queries in SQL for DuckDB, written from the table definitions."""

from __future__ import annotations


def _readings(time: str) -> str:
    return f"""
all_readings AS (
  SELECT event_id, ts, device_id,
    CASE device_id WHEN 'device-001' THEN 'factory-floor-A' WHEN 'device-002' THEN 'factory-floor-B'
      WHEN 'device-003' THEN 'warehouse-1' WHEN 'device-004' THEN 'warehouse-2'
      WHEN 'device-005' THEN 'rooftop' END AS location,
    CASE WHEN device_id IN ('device-001', 'device-002') THEN 'industrial'
      WHEN device_id IN ('device-003', 'device-004') THEN 'environmental'
      ELSE 'weather' END AS device_type,
    sensor_type, value,
    CASE sensor_type WHEN 'temperature' THEN '°C' WHEN 'humidity' THEN '%'
      WHEN 'pressure' THEN 'hPa' WHEN 'vibration' THEN 'g' END AS unit,
    timestamp,
    CASE WHEN k < 5 THEN 'uncertain' ELSE 'good' END AS quality,
    'sensors/' || sensor_type || '/' || device_id AS mqtt_topic,
    make_timestamp(1709251200000000 + event_id * 1000) AS ingest_time,
    k
  FROM (
    SELECT event_id, ts,
      printf('device-%03d', user_id % 5 + 1) AS device_id,
      CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'humidity'
        WHEN 'purchase' THEN 'pressure' WHEN 'error' THEN 'vibration'
        WHEN 'signup' THEN 'co2' END AS sensor_type,
      CASE WHEN event_type = 'purchase' THEN value + 950 ELSE value END AS value,
      {time} AS timestamp,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
  )
),
ranges(kind, low, high) AS (
  VALUES ('temperature', -40, 125), ('humidity', 0, 100), ('pressure', 800, 1200),
    ('vibration', 0, 50)
),
judged AS (
  SELECT a.*, kind IS NULL AS unknown, value BETWEEN low AND high AS plausible
  FROM all_readings a LEFT JOIN ranges ON kind = sensor_type
),
readings AS (
  SELECT * EXCLUDE (unknown, plausible) FROM judged WHERE quality = 'good' AND plausible
)"""


NATIVE = "WITH " + _readings("ts")
DENSE = "WITH " + _readings(
    "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 360)"
)

_FIELDS = (
    "device_id, location, device_type, sensor_type, value, unit, timestamp, quality, mqtt_topic"
)

_WINDOWS = """
window_stats AS (
  SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS window_start,
    time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS window_end,
    device_id, sensor_type, location,
    round(avg(value), 3) AS avg_value, round(min(value), 3) AS min_value,
    round(max(value), 3) AS max_value, round(stddev_samp(value), 3) AS stddev_value,
    count(*) AS reading_count
  FROM readings GROUP BY ALL
)"""

_ANOMALIES = DENSE + """,
measured AS (
  SELECT device_id, sensor_type, location, value, timestamp,
    avg(value) OVER same_sensor AS centre, stddev_samp(value) OVER same_sensor AS spread
  FROM readings WINDOW same_sensor AS (PARTITION BY device_id, sensor_type)
)
SELECT device_id, sensor_type, location, value, timestamp,
  round(centre, 6) AS mean_val, round(spread, 6) AS std_val,
  round(abs(value - centre) / spread, 6) AS z_score
FROM measured WHERE spread <> 0 AND abs(value - centre) > 2 * spread"""

_CURRENT = """
current_state AS (
  SELECT device_id, sensor_type, location,
    arg_max(value, (timestamp, ingest_time, value)) AS current_value,
    max(timestamp) AS last_seen, max(value) AS max_value, min(value) AS min_value,
    count(*) AS total_readings
  FROM readings GROUP BY device_id, sensor_type, location
)"""

_STEPS = """,
stepped AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-08 00:00:00' AND event_id % 10 = 0 THEN 2
    WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 0 ELSE 1 END AS step
  FROM readings)"""

_LATEST = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY device_id, sensor_type, date_trunc('second', timestamp)
    ORDER BY ingest_time DESC, event_id DESC) AS version_rank
  FROM readings
)"""

_REASON = """CASE
    WHEN quality IS DISTINCT FROM 'good' THEN 'bad_quality'
    WHEN value IS NULL THEN 'null_value'
    WHEN unknown THEN 'unknown_type'
    WHEN NOT plausible THEN 'out_of_range' END"""

_WINDOW_SUMS = """,
window_sums AS (
  SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS window_start,
    time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS window_end,
    device_id, sensor_type, location,
    round(sum(value), 4) AS sum_value, round(min(value), 6) AS min_value,
    round(max(value), 6) AS max_value, round(stddev_samp(value), 6) AS stddev_value,
    count(*) AS reading_count
  FROM readings WHERE time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes'
    <= (SELECT max(timestamp) FROM readings) - INTERVAL '2 minutes'
  GROUP BY ALL)"""

_EPISODES = DENSE + """,
limits(sensor_type, low, high) AS (
  VALUES ('temperature', 10.0, 60.0), ('humidity', 20.0, 70.0), ('pressure', 960.0, 1050.0), ('vibration', 0.0, 25.0)),
said AS (
  SELECT device_id, sensor_type, timestamp, ingest_time, value,
    CASE WHEN value < low THEN 'below' WHEN value > high THEN 'above'
      WHEN value BETWEEN low + (high - low) * 0.1 AND high - (high - low) * 0.1 THEN 'clear' END AS signal
  FROM readings JOIN limits USING (sensor_type)),
changes AS (
  SELECT *, lag(signal) OVER in_order IS DISTINCT FROM signal AS begins FROM said WHERE signal IS NOT NULL
  WINDOW in_order AS (PARTITION BY device_id, sensor_type ORDER BY timestamp, ingest_time, value)),
numbered AS (
  SELECT *, count_if(begins) OVER (
    PARTITION BY device_id, sensor_type ORDER BY timestamp, ingest_time, value ROWS UNBOUNDED PRECEDING) AS run FROM changes),
runs AS (
  SELECT device_id, sensor_type, run, any_value(signal) AS alert, min(timestamp) AS raised_at,
    CASE any_value(signal) WHEN 'above' THEN max(value) ELSE min(value) END AS peak, count(*) AS readings
  FROM numbered GROUP BY ALL),
ended AS (
  SELECT *, lead(raised_at) OVER (PARTITION BY device_id, sensor_type ORDER BY run) AS cleared_at FROM runs)
SELECT device_id, sensor_type, alert, raised_at, cleared_at, peak, readings FROM ended WHERE alert <> 'clear'"""

ORACLES = {
    "scan_readings": NATIVE + f" SELECT {_FIELDS}, ingest_time FROM readings",
    "topic_filter": DENSE + """
SELECT event_id, mqtt_topic AS topic FROM all_readings
WHERE regexp_matches(mqtt_topic, '^sensors/temperature(/.*)?$')""",
    "topic_filter_level": DENSE + """
SELECT event_id, mqtt_topic AS topic FROM all_readings
WHERE regexp_matches(mqtt_topic, '^sensors/[^/]*/device-003$')""",
    "parse_readings": DENSE + f" SELECT event_id, {_FIELDS} FROM all_readings",
    "enrich_topic": DENSE + """
SELECT event_id AS record_id, mqtt_topic, device_id, value, k FROM all_readings
UNION ALL
SELECT conv_id * 1000 + turn, 'sensors/chat', NULL, NULL, NULL FROM conversations
WHERE json_valid(text) AND json_type(text) = 'OBJECT'""",
    "topic_parts": DENSE + """
SELECT event_id, split_part(mqtt_topic, '/', 2) AS topic_sensor,
  split_part(mqtt_topic, '/', 3) AS topic_device,
  split_part(mqtt_topic, '/', 2) = sensor_type AND split_part(mqtt_topic, '/', 3) = device_id
    AS agrees
FROM all_readings""",
    "republish_records": DENSE + """
SELECT mqtt_topic AS key, device_id, value, timestamp, quality, mqtt_topic, k FROM all_readings
UNION ALL
SELECT 'sensors/chat', NULL, NULL, NULL, NULL, 'sensors/chat', NULL FROM conversations
WHERE json_valid(text) AND json_type(text) = 'OBJECT'""",
    "clean_readings": DENSE + f" SELECT event_id, {_FIELDS} FROM readings",
    "clean_by_rules": DENSE + f" SELECT event_id, {_FIELDS} FROM readings",
    "reject_reasons": DENSE + f"""
SELECT 'events' AS origin, event_id AS record_id, sensor_type, value,
  {_REASON} AS reject_reason FROM judged
UNION ALL
SELECT 'conversations', conv_id * 1000 + turn, NULL, NULL,
  CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT' THEN 'bad_quality'
    ELSE 'malformed' END
FROM conversations""",
    "constraint_violations": NATIVE + """
SELECT event_id, device_id, violations FROM (
  SELECT event_id, device_id, concat_ws(',',
    CASE WHEN device_id IS NULL THEN 'device_id:null' END,
    CASE WHEN length(device_id) > 64 THEN 'device_id:length' END,
    CASE WHEN length(location) > 11 THEN 'location:length' END,
    CASE WHEN device_type IS NULL THEN 'device_type:null' END,
    CASE WHEN length(device_type) > 10 THEN 'device_type:length' END,
    CASE WHEN sensor_type IS NULL THEN 'sensor_type:null' END,
    CASE WHEN length(sensor_type) > 64 THEN 'sensor_type:length' END,
    CASE WHEN value IS NULL THEN 'value:null' END,
    CASE WHEN unit IS NULL THEN 'unit:null' END,
    CASE WHEN length(unit) > 2 THEN 'unit:length' END,
    CASE WHEN timestamp IS NULL THEN 'timestamp:null' END,
    CASE WHEN length(quality) > 32 THEN 'quality:length' END,
    CASE WHEN length(mqtt_topic) > 256 THEN 'mqtt_topic:length' END) AS violations
  FROM all_readings)
WHERE violations <> ''""",
    "window_stats_5m": DENSE + "," + _WINDOWS + " SELECT * FROM window_stats",
    "window_stats_closed": DENSE + "," + _WINDOWS + """
SELECT * FROM window_stats
WHERE window_end <= (SELECT max(timestamp) FROM readings) - INTERVAL '2 minutes'""",
    "window_stats_uncleaned": DENSE + """
SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS window_start,
  time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS window_end,
  device_id, sensor_type, location,
  round(avg(known), 3) AS avg_value, round(min(known), 3) AS min_value,
  round(max(known), 3) AS max_value, round(stddev_samp(known), 3) AS stddev_value,
  count(*) AS reading_count
FROM (SELECT *, CASE WHEN event_id % 3 <> 0 THEN value END AS known FROM all_readings) GROUP BY ALL""",
    "window_stats_rollup_1h": DENSE + """
SELECT time_bucket(INTERVAL '1 hour', timestamp) AS window_start,
  time_bucket(INTERVAL '1 hour', timestamp) + INTERVAL '1 hour' AS window_end,
  device_id, sensor_type, location,
  round(avg(value), 6) AS avg_value, round(min(value), 6) AS min_value,
  round(max(value), 6) AS max_value, round(stddev_samp(value), 6) AS stddev_value,
  count(*) AS reading_count
FROM readings GROUP BY ALL""",
    "latest_windows_top20": DENSE + "," + _WINDOWS + """
SELECT * FROM window_stats ORDER BY window_start DESC, device_id, sensor_type, location LIMIT 20""",
    "key_sum_rollup": DENSE + """
SELECT * FROM (
  SELECT device_id, sensor_type, time_bucket(INTERVAL '5 minutes', timestamp) AS window_start,
    min(time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes') AS window_end,
    min(location) AS location,
    count(*) FILTER (WHERE quality = 'uncertain') AS uncertain,
    count(*) FILTER (WHERE value > 150) AS above_150
  FROM all_readings GROUP BY device_id, sensor_type, time_bucket(INTERVAL '5 minutes', timestamp))
WHERE uncertain <> 0 OR above_150 <> 0""",
    "hourly_temperature": NATIVE + """
SELECT time_bucket(INTERVAL '1 hour', timestamp) AS hour_bucket, device_id, location,
  round(avg(value), 6) AS avg_temp, min(value) AS min_temp, max(value) AS max_temp,
  count(*) AS readings
FROM readings
WHERE sensor_type = 'temperature' AND timestamp >= TIMESTAMP '2024-01-23 00:00:00'
GROUP BY ALL""",
    "temperature_readings": NATIVE + """
SELECT device_id, sensor_type, value, timestamp FROM readings
WHERE sensor_type = 'temperature'""",
    "device_sensor_stats": NATIVE + """
SELECT device_id, sensor_type, round(avg(value), 6) AS mean_val,
  round(stddev_samp(value), 6) AS std_val, count(*) AS reading_count
FROM readings GROUP BY device_id, sensor_type""",
    "anomalies": _ANOMALIES,
    "anomalies_view": _ANOMALIES,
    "anomalies_windowed": _ANOMALIES,
    "sensor_type_summary": NATIVE + """
SELECT sensor_type, count(*) AS count, round(avg(value), 6) AS avg
FROM readings GROUP BY sensor_type""",
    "latest_readings_top20": NATIVE + """
SELECT device_id, sensor_type, value, timestamp FROM readings
ORDER BY timestamp DESC, device_id, sensor_type, value LIMIT 20""",
    "device_state_partials": DENSE + """
SELECT event_id // 1000 AS batch_id, device_id, sensor_type, location,
  arg_max(value, (timestamp, ingest_time, value)) AS latest_value, max(timestamp) AS latest_ts,
  max(value) AS max_value, min(value) AS min_value, count(*) AS total_readings
FROM readings GROUP BY ALL""",
    "device_current": DENSE + "," + _CURRENT + " SELECT * FROM current_state",
    "device_current_streamed": DENSE + "," + _CURRENT + " SELECT * FROM current_state",
    "threshold_alerts": DENSE + "," + _CURRENT + """
SELECT * FROM (
  SELECT *, CASE
    WHEN current_value < CASE sensor_type WHEN 'temperature' THEN 10 WHEN 'humidity' THEN 20
      WHEN 'pressure' THEN 960 ELSE 0 END THEN 'below'
    WHEN current_value > CASE sensor_type WHEN 'temperature' THEN 60 WHEN 'humidity' THEN 70
      WHEN 'pressure' THEN 1050 ELSE 25 END THEN 'above' END AS alert
  FROM current_state)
WHERE alert IS NOT NULL""",
    "latest_version_readings": DENSE + "," + _LATEST + """
SELECT event_id, device_id, location, device_type, sensor_type, value, unit,
  date_trunc('second', timestamp) AS timestamp, quality, mqtt_topic, ingest_time
FROM ranked WHERE version_rank = 1""",
    "readings_streamed": DENSE + "," + _LATEST + """
SELECT device_id, location, device_type, sensor_type, value, unit,
  date_trunc('second', timestamp) AS timestamp, quality, mqtt_topic, ingest_time,
  CAST(timestamp AS DATE) AS event_day
FROM ranked WHERE version_rank = 1""",
    "readings_settled": DENSE + f"""
SELECT {_FIELDS}, ingest_time, CAST(timestamp AS DATE) AS event_day
FROM readings QUALIFY row_number() OVER (
  PARTITION BY device_id, sensor_type, timestamp ORDER BY ingest_time DESC) = 1""",
    "clustered_readings": NATIVE + """
SELECT device_id, sensor_type, value, timestamp FROM readings WHERE sensor_type = 'temperature'""",
    "readings_restarted": DENSE + f"""
SELECT {_FIELDS}, ingest_time, CAST(timestamp AS DATE) AS event_day
FROM readings QUALIFY row_number() OVER (
  PARTITION BY device_id, sensor_type, timestamp ORDER BY ingest_time DESC) = 1""",
    "sorted_partitions": NATIVE + """
SELECT DISTINCT CAST(timestamp AS DATE) AS event_day, sensor_type, TRUE AS in_order FROM readings""",
    "ingest_time_filled": NATIVE + """
SELECT event_id % 2 <> 0 AS filled, count(*) AS rows, CASE WHEN event_id % 2 <> 0 THEN 1 END AS times
FROM readings GROUP BY event_id % 2 <> 0""",
    "job_streamed": DENSE + "," + _WINDOWS + """
SELECT 'readings' AS stored, count(*) AS rows FROM readings
UNION ALL SELECT 'rejects', count(*) FROM all_readings WHERE event_id NOT IN (SELECT event_id FROM readings)
UNION ALL SELECT 'window_stats', count(*) FROM window_stats
  WHERE window_end <= (SELECT max(timestamp) FROM readings) - INTERVAL '2 minutes'
UNION ALL SELECT 'device_current', count(DISTINCT (device_id, sensor_type, location)) FROM readings""",
    "sinks_streamed": DENSE + """
SELECT unnest(['readings', 'states', 'external']) AS sink, count(*) AS rows FROM readings GROUP BY sink
UNION ALL
SELECT 'rejects', count(*) FROM all_readings WHERE event_id NOT IN (SELECT event_id FROM readings)""",
    "republish_streamed": DENSE + """
SELECT mqtt_topic AS key, device_id, value, mqtt_topic FROM all_readings
UNION ALL
SELECT 'sensors/chat', NULL, NULL, 'sensors/chat' FROM conversations
WHERE json_valid(text) AND json_type(text) = 'OBJECT'""",
    "republish_rejects_streamed": """
SELECT 'sensors/chat' AS mqtt_topic, text AS payload, 'malformed' AS reject_reason FROM conversations
WHERE NOT CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' ELSE FALSE END""",
    "first_deliveries_streamed": DENSE + """
SELECT DISTINCT device_id, sensor_type, timestamp FROM readings""",
    "late_rows_streamed": DENSE + """,
in_time AS (
  SELECT * FROM readings WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' OR event_id % 10 <> 0)
SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS window_start,
  time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS window_end,
  device_id, sensor_type, location,
  round(sum(value), 4) AS sum_value, round(min(value), 6) AS min_value,
  round(max(value), 6) AS max_value, round(stddev_samp(value), 6) AS stddev_value,
  count(*) AS reading_count
FROM in_time WHERE time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes'
  <= (SELECT max(timestamp) FROM in_time) - INTERVAL '2 minutes'
GROUP BY ALL""",
    "window_stats_backfilled": DENSE + _WINDOW_SUMS + """
SELECT * FROM window_sums""",
    "late_rows_corrected": DENSE + _WINDOW_SUMS + """
SELECT *, unnest([false, true]) AS settled FROM window_sums""",
    "late_readings_routed": DENSE + f"""
SELECT {_FIELDS}, ingest_time FROM readings WHERE ts < TIMESTAMP '2024-01-08 00:00:00' AND event_id % 10 = 0""",
    "anomalies_streamed": DENSE + _STEPS + """,
measured AS (
  SELECT batch, device_id, sensor_type, avg(value) AS centre, stddev_samp(value) AS spread
  FROM (VALUES (0), (1), (2)) batches(batch) JOIN stepped ON step <= batch
  GROUP BY batch, device_id, sensor_type)
SELECT device_id, sensor_type, location, value, timestamp, round(centre, 6) AS mean_val,
  round(spread, 6) AS std_val, round(abs(value - centre) / spread, 6) AS z_score
FROM stepped JOIN measured USING (device_id, sensor_type)
WHERE batch = step AND spread <> 0 AND abs(value - centre) > 2 * spread""",
    "device_current_updated": DENSE + "," + _CURRENT + """
SELECT *, true AS agrees FROM current_state""",
    "batch_reports_streamed": DENSE + _STEPS + """,
every_step AS (
  SELECT CASE WHEN ts < TIMESTAMP '2024-01-08 00:00:00' AND event_id % 10 = 0 THEN 2
    WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 0 ELSE 1 END AS step FROM events),
marks AS (
  SELECT batch, date_trunc('millisecond', max(timestamp)) - INTERVAL '2 minutes' AS watermark
  FROM (VALUES (1), (2)) batches(batch) JOIN stepped ON step < batch GROUP BY batch
  UNION ALL SELECT 0, TIMESTAMP '1970-01-01 00:00:00'),
groups AS (
  SELECT step, device_id, sensor_type, location,
    time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS window_end FROM stepped),
behind AS (
  SELECT batch, lag(watermark, 1, TIMESTAMP '1970-01-01 00:00:00') OVER (ORDER BY batch) AS late FROM marks)
SELECT batch AS batch_id, (SELECT count(*) FROM every_step WHERE step = batch) AS input_rows, watermark,
  (SELECT count(DISTINCT (device_id, sensor_type, location, window_end)) FROM groups
    WHERE step <= batch AND window_end > watermark) AS state_rows,
  (SELECT count(*) > 0 FROM groups WHERE step = batch AND window_end <= late) AS late
FROM marks JOIN behind USING (batch)""",
    "reclustered_readings": NATIVE + """
SELECT device_id, sensor_type, value, timestamp, true AS was_deep, true AS is_flat
FROM readings WHERE sensor_type = 'temperature'""",
    "rejects_replayed": DENSE + """,
anew(sensor_type, lowest, highest) AS (
  VALUES ('temperature', -40, 125), ('humidity', 0, 1000), ('pressure', 0, 5000), ('vibration', 0, 120), ('co2', 0, 5000)),
judged_anew AS (
  SELECT a.*, CASE WHEN ts < TIMESTAMP '2024-01-08 00:00:00' AND event_id % 10 = 0 THEN 1 ELSE 2 END AS attempt,
    CASE WHEN quality <> 'good' THEN 'bad_quality' WHEN NOT value BETWEEN lowest AND highest THEN 'out_of_range' END
      AS reject_reason
  FROM all_readings a JOIN anew USING (sensor_type)),
kept AS (
  SELECT * FROM judged_anew WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY device_id, sensor_type, timestamp ORDER BY ingest_time DESC) = 1)
SELECT device_id, sensor_type, value, timestamp, reject_reason, 0 AS attempt FROM kept
UNION ALL SELECT device_id, sensor_type, value, timestamp, reject_reason, attempt FROM judged_anew
WHERE reject_reason IS NOT NULL""",
    "ingest_time_stamped": DENSE + _STEPS + """
SELECT step AS batch, count(*) AS rows, true AS one_time FROM stepped GROUP BY step""",
    "empty_batches_skipped": DENSE + """,
placed AS (
  SELECT CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 0 WHEN NOT k >= 5 THEN 1 ELSE 2 END AS batch,
    CASE WHEN quality = 'good' AND plausible THEN 'readings' ELSE 'rejects' END AS stored
  FROM judged)
SELECT stored, batch, count(*) AS rows FROM placed GROUP BY ALL""",
    "alert_episodes": _EPISODES,
    "alert_episodes_streamed": _EPISODES,
    "catalog_views": NATIVE + """,
seen AS (
  SELECT batch, r.* FROM (VALUES (0), (1)) batches(batch)
  JOIN readings r ON batch = 1 OR timestamp < TIMESTAMP '2024-01-15 00:00:00'),
hourly AS (
  SELECT batch, time_bucket(INTERVAL '1 hour', timestamp) AS hour_bucket, device_id, location, count(*) AS readings
  FROM seen WHERE sensor_type = 'temperature' AND timestamp >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL '7 days'
  GROUP BY ALL),
measured AS (
  SELECT batch, value, avg(value) OVER same_sensor AS centre, stddev_samp(value) OVER same_sensor AS spread
  FROM seen WINDOW same_sensor AS (PARTITION BY batch, device_id, sensor_type))
SELECT batch, 'readings' AS view, count(*) AS rows, count(*) AS readings FROM seen GROUP BY batch
UNION ALL SELECT b.batch, 'hourly_temperature', count(h.batch), CAST(sum(readings) AS BIGINT)
  FROM (VALUES (0), (1)) b(batch) LEFT JOIN hourly h ON b.batch = h.batch GROUP BY b.batch
UNION ALL SELECT batch, 'anomalies', count(*) FILTER (found), count(*) FILTER (found) FROM (
  SELECT batch, coalesce(spread <> 0 AND abs(value - centre) > 2 * spread, false) AS found FROM measured) GROUP BY batch
UNION ALL SELECT batch, 'device_current', count(DISTINCT (device_id, sensor_type, location)), count(*)
  FROM seen GROUP BY batch""",
    "rejects_streamed": DENSE + f"""
SELECT * FROM (SELECT {_FIELDS}, {_REASON} AS reject_reason FROM judged)
WHERE reject_reason IS NOT NULL""",
    "daily_partitions": NATIVE + """
SELECT CAST(timestamp AS DATE) AS event_day, sensor_type, count(*) AS readings,
  CAST(strftime(timestamp, '%Y%m%d') AS INTEGER) AS day_number
FROM readings GROUP BY ALL""",
    "retention_30d": NATIVE + f"""
SELECT {_FIELDS} FROM readings
WHERE timestamp + INTERVAL '30 days' > TIMESTAMP '2024-02-10 00:00:00'""",
}
ORACLES |= {name: ORACLES["readings_restarted"] for name in ("readings_settled_filtered", "readings_triggered")}
