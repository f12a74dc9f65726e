"""For each registered query, the same question in plain SQL for DuckDB."""

READINGS = """
events_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, (user_id * 7) % 50 AS b
  FROM events
), typed AS (
  SELECT k, event_id AS arrival_seq, CAST(event_id AS VARCHAR) AS event_id,
    printf('MTR-%04d', user_id) AS meter_id,
    CASE user_id % 5 WHEN 0 THEN 'ZONE-NORTH' WHEN 1 THEN 'ZONE-SOUTH' WHEN 2 THEN 'ZONE-EAST'
      WHEN 3 THEN 'ZONE-WEST' ELSE 'ZONE-CENTRAL' END AS zone_id,
    CASE WHEN b < 35 THEN 'residential' WHEN b < 47 THEN 'commercial' ELSE 'industrial' END
      AS customer_type,
    date_trunc('second', ts) AS reading_ts,
    CAST(value / 100 AS DECIMAL(18,4)) AS kwh_dec,
    CASE WHEN b < 35 THEN 120 WHEN b < 47 THEN 240 ELSE 480 END AS nominal,
    CASE WHEN b < 35 THEN 12 WHEN b < 47 THEN 30 ELSE 60 END AS per_hour,
    CASE WHEN b < 35 THEN 300 WHEN b < 47 THEN 120 ELSE 60 END AS interval_s,
    CASE WHEN event_type = 'signup' THEN 'degraded' WHEN event_type = 'error' THEN 'fault'
      WHEN event_type = 'purchase' AND k % 10 = 0 THEN 'silent' ELSE 'normal' END AS meter_state
  FROM events_k
), measured AS (
  SELECT *, CAST(kwh_dec AS DOUBLE) AS kwh_delta,
    round(nominal * (1 + ((k % 41) - 20) / 100.0::DOUBLE), 2) AS voltage,
    round(0.80::DOUBLE + (k % 20) / 100.0::DOUBLE, 2) AS power_factor,
    CAST(round(kwh_dec * per_hour * (80 + k % 20) * 0.01, 3) AS DOUBLE) AS power_kw,
    CAST(60 + ((k % 13) - 6) / 10.0::DOUBLE AS DOUBLE) AS frequency_hz,
    k >= 97 AS is_anomaly, -50 - (k % 41) AS signal_strength_dbm,
    'v3.2.1' AS firmware_version,
    CASE WHEN meter_state <> 'normal' THEN 'alert' ELSE 'reading' END AS event_type,
    reading_ts + to_seconds(k * 10) AS load_ts
  FROM typed
), readings AS (
  SELECT *, round(kwh_delta * per_hour * 1000 / voltage + 1e-9, 3) AS current_amps FROM measured
)"""

ODO = READINGS + """, odo AS (
  SELECT *, CAST(1000 + sum(kwh_dec) OVER (PARTITION BY meter_id ORDER BY reading_ts, arrival_seq
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS kwh_reading
  FROM readings
)"""

ENRICHED = """
  date_trunc('hour', reading_ts) AS reading_hour,
  CAST(date_trunc('day', reading_ts) AS TIMESTAMP) AS reading_date,
  time_bucket(INTERVAL 5 MINUTE, reading_ts) AS window_bucket,
  CAST(hour(reading_ts) AS INTEGER) AS hour_of_day,
  CAST(dayofweek(reading_ts) AS INTEGER) AS day_of_week_num,
  left(dayname(reading_ts), 3) AS day_of_week_name,
  dayofweek(reading_ts) IN (0, 6) AS is_weekend,
  meter_state = 'degraded' AS is_degraded, meter_state = 'fault' AS is_fault,
  meter_state = 'silent' AS is_silent, meter_state = 'normal' AS is_normal,
  power_factor < 0.85 AS is_low_power_factor,
  abs(voltage - nominal) / nominal AS voltage_deviation_pct"""

STG = READINGS + f", stg AS (SELECT *, frequency_hz AS grid_frequency_hz, {ENRICHED} FROM readings)"

# negative energy where k = 4, an unknown zone where k = 5
FAULTY = READINGS + """, faulty AS (
  SELECT * REPLACE (CASE WHEN k = 4 THEN -kwh_delta ELSE kwh_delta END AS kwh_delta,
                    CASE WHEN k = 5 THEN 'ZONE-X' ELSE zone_id END AS zone_id)
  FROM readings
)"""


def rnd(x: str, n: int) -> str:
    return f"round(({x}) + sign({x}) * 1e-9, {n})"


def pct(part: str, whole: str, n: int = 2) -> str:
    return rnd(f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100.0", n)


def kwh(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


MEASURES = f"""
  {kwh('kwh_delta')} AS total_kwh,
  {rnd('avg(power_kw)', 3)} AS avg_power_kw,
  {rnd('greatest(0.0::DOUBLE, max(power_kw))', 3)} AS peak_power_kw,
  {rnd('avg(power_factor)', 3)} AS avg_power_factor,
  {rnd('avg(voltage)', 2)} AS avg_voltage,
  {rnd('avg(frequency_hz)', 3)} AS avg_frequency_hz,
  count(DISTINCT meter_id) AS active_meter_count,
  {n("meter_state = 'degraded'")} AS degraded_count,
  {n("meter_state = 'fault'")} AS fault_count"""

EXPECTED = "expected AS (SELECT zone_id, count(DISTINCT meter_id) AS n FROM readings GROUP BY 1)"


def window_ctes(minutes: int) -> str:
    return READINGS + f""", {EXPECTED}, agg AS (
  SELECT zone_id, time_bucket(INTERVAL {minutes} MINUTE, reading_ts) AS window_start_ts, {MEASURES}
  FROM readings GROUP BY 1, 2
), win AS (
  SELECT agg.*, window_start_ts + INTERVAL {minutes} MINUTE AS window_end_ts,
    greatest(0, n - active_meter_count) AS silent_meter_count
  FROM agg JOIN expected USING (zone_id)
)"""


WINDOW_COLS = """zone_id, window_start_ts, window_end_ts, total_kwh, avg_power_kw, peak_power_kw,
  avg_power_factor, avg_voltage, avg_frequency_hz, active_meter_count, silent_meter_count,
  degraded_count, fault_count"""

WIN = window_ctes(5)
DELTA = rnd("(total_kwh - prev) / prev * 100.0", 2)
PREV = "lag(total_kwh) OVER (PARTITION BY zone_id ORDER BY window_start_ts) AS prev"

# the moving average, reading by reading, from the first one of each meter and hour
EMA = READINGS + """, numbered AS (
  SELECT *, hour(reading_ts) AS h,
    row_number() OVER (PARTITION BY meter_id, hour(reading_ts) ORDER BY reading_ts, arrival_seq) AS i
  FROM readings
), fold AS (
  SELECT meter_id, h, i, event_id, kwh_delta AS base, false AS flag FROM numbered WHERE i = 1
  UNION ALL
  SELECT x.meter_id, x.h, x.i, x.event_id,
    CASE WHEN f.base > 0 AND x.kwh_delta > f.base * 4.0::DOUBLE THEN f.base
      ELSE 0.2::DOUBLE * x.kwh_delta + (1 - 0.2::DOUBLE) * f.base END,
    f.base > 0 AND x.kwh_delta > f.base * 4.0::DOUBLE
  FROM fold f JOIN numbered x ON x.meter_id = f.meter_id AND x.h = f.h AND x.i = f.i + 1
)"""

FULL = EMA + f""", {EXPECTED}, flagged AS (
  SELECT readings.*, flag FROM readings JOIN fold USING (event_id)
), agg AS (
  SELECT zone_id, time_bucket(INTERVAL 5 MINUTE, reading_ts) AS window_start_ts, {MEASURES},
    {n('flag')} AS anomaly_count
  FROM flagged GROUP BY 1, 2
), lagged AS (
  SELECT agg.*, window_start_ts + INTERVAL 5 MINUTE AS window_end_ts,
    greatest(0, n - active_meter_count) AS silent_meter_count, {PREV}
  FROM agg JOIN expected USING (zone_id)
), win AS (
  SELECT {WINDOW_COLS}, anomaly_count,
    CASE WHEN prev > 0 THEN {DELTA} END AS demand_vs_prev_window_pct
  FROM lagged
)"""

HEATMAP = STG + f""", heatmap AS (
  SELECT zone_id, hour_of_day, day_of_week_num, day_of_week_name, is_weekend,
    {rnd('avg(kwh_delta)', 4)} AS avg_kwh, {kwh('kwh_delta')} AS total_kwh,
    count(*) AS reading_count
  FROM stg GROUP BY ALL
)"""

DAILY = STG + f""", daily AS (
  SELECT zone_id, reading_date, {kwh('kwh_delta')} AS total_kwh,
    {rnd('avg(power_kw)', 3)} AS avg_power_kw, round(max(power_kw), 3) AS peak_power_kw,
    count(DISTINCT meter_id) AS active_meter_count,
    count(DISTINCT CASE WHEN is_silent THEN meter_id END) AS silent_meter_count,
    {rnd('count(DISTINCT meter_id) / 100.0::DOUBLE * 100', 2)} AS uptime_pct
  FROM stg GROUP BY 1, 2
)"""

FAULTS = STG + f""", faults AS (
  SELECT zone_id, reading_date, {n('is_degraded')} AS degraded_reading_count,
    {n('is_fault')} AS fault_reading_count, {n('is_silent')} AS silent_reading_count,
    {n('is_degraded OR is_fault OR is_silent')} AS total_fault_readings
  FROM stg GROUP BY 1, 2
)"""

SCENARIO = """scenario_cases AS (
  SELECT *, hour(reading_ts) * 60 + minute(reading_ts) AS m FROM readings
), tagged AS (
  SELECT c.*, s.name AS scenario,
    c.m >= s.h * 60 AND c.m < s.h * 60 + s.minutes AS inside
  FROM scenario_cases c JOIN (VALUES
    ('evening_peak', 18, 90, ['ZONE-NORTH', 'ZONE-WEST']),
    ('heatwave', 13, 180, ['ZONE-NORTH', 'ZONE-SOUTH', 'ZONE-EAST', 'ZONE-WEST', 'ZONE-CENTRAL']),
    ('zone_outage', 2, 45, ['ZONE-SOUTH']),
    ('morning_commercial_ramp', 8, 60, ['ZONE-CENTRAL'])
  ) s(name, h, minutes, zones) ON list_contains(s.zones, c.zone_id)
)"""

BY_METER = "OVER (PARTITION BY meter_id ORDER BY reading_ts, arrival_seq)"
HOUR_PARTS = """CAST(year(reading_ts) AS INTEGER) AS year, CAST(month(reading_ts) AS INTEGER) AS month,
  CAST(day(reading_ts) AS INTEGER) AS day, CAST(hour(reading_ts) AS INTEGER) AS hour"""
ISO = "strftime(reading_ts, '%Y-%m-%dT%H:%M:%SZ')"
PARTITION_NO = """CASE zone_id WHEN 'ZONE-SOUTH' THEN 1 WHEN 'ZONE-EAST' THEN 2
  WHEN 'ZONE-WEST' THEN 3 WHEN 'ZONE-CENTRAL' THEN 4 ELSE 0 END"""
PARSED_COLS = """event_id, meter_id, zone_id, customer_type, reading_ts, kwh_delta, power_kw,
  meter_state, event_type"""


def ask(ctes: str, select: str) -> str:
    head = "WITH RECURSIVE" if "UNION ALL" in ctes else "WITH"
    return f"{head} {ctes}\n{select}"


def _check(name: str, column: str, failed: str) -> str:
    return (f"SELECT '{name}' AS check_name, '{column}' AS column_name, "
            f"{n(failed)} AS failed_rows FROM faulty")


_ZONE_LIST = "('ZONE-NORTH', 'ZONE-SOUTH', 'ZONE-EAST', 'ZONE-WEST', 'ZONE-CENTRAL')"
_STATE_LIST = "('normal', 'degraded', 'fault', 'silent')"
REPORT = " UNION ALL ".join([
    _check("not_null", "meter_id", "meter_id IS NULL"),
    _check("not_null", "zone_id", "zone_id IS NULL"),
    _check("not_null", "kwh_delta", "kwh_delta IS NULL"),
    _check("accepted_values", "zone_id", f"zone_id NOT IN {_ZONE_LIST}"),
    _check("accepted_values", "meter_state", f"meter_state NOT IN {_STATE_LIST}"),
    _check("not_negative", "kwh_delta", "kwh_delta < 0"),
])

PEAK = """(customer_type = 'residential' AND hour_of_day IN (7, 8, 9, 18, 19, 20, 21, 22))
  OR (customer_type = 'commercial' AND hour_of_day BETWEEN 9 AND 18)"""

EMA_FLAGS = ask(EMA, """SELECT f.event_id, f.meter_id, r.reading_ts, f.flag AS is_anomaly_ema
  FROM fold f JOIN readings r USING (event_id)""")
ZONE_WINDOWS = ask(WIN, f"SELECT {WINDOW_COLS} FROM win")
ZONE_DELTA = ask(WIN + f", lagged AS (SELECT *, {PREV} FROM win)", f"""
  SELECT zone_id, window_start_ts, total_kwh,
    CASE WHEN prev > 0 THEN {DELTA} END AS demand_vs_prev_window_pct FROM lagged""")



MART_ROWS = ask(HEATMAP + f""", daily AS (
  SELECT zone_id || '|' || strftime(reading_date, '%Y-%m-%d') AS keys, {kwh('kwh_delta')} AS total_kwh,
    count(DISTINCT meter_id) AS meters, {n('is_degraded OR is_fault OR is_silent')} AS faults
  FROM stg GROUP BY 1)""", f"""
  SELECT 'mart_demand_heatmap' AS mart, concat_ws('|', zone_id, hour_of_day, day_of_week_num) AS keys,
    total_kwh AS measure, reading_count AS readings FROM heatmap
  UNION ALL SELECT 'mart_zone_daily', keys, total_kwh, meters FROM daily
  UNION ALL SELECT 'mart_fault_summary', keys, 0.0, faults FROM daily
  UNION ALL SELECT 'mart_customer_segment', customer_type, {kwh('kwh_delta')}, 0 FROM stg GROUP BY 2""")


def grid_cte(minutes: int) -> str:
    return f"""slots AS (
  SELECT unnest(generate_series(min(window_start_ts), max(window_start_ts), INTERVAL {minutes} MINUTE))
    AS window_start_ts FROM win
), zones AS (
  SELECT unnest([{_ZONE_LIST[1:-1]}]) AS zone_id UNION SELECT zone_id FROM win
), filled AS (
  SELECT zone_id, window_start_ts, coalesce(w.total_kwh, 0.0) AS total_kwh,
    coalesce(w.active_meter_count, 0) AS active_meter_count, w.active_meter_count IS NULL AS is_empty
  FROM slots CROSS JOIN zones LEFT JOIN win w USING (zone_id, window_start_ts)
)"""


def grid(ctes: str, minutes: int, expected: str) -> str:
    return ask(ctes + ", " + grid_cte(minutes), f"""
      SELECT zone_id, window_start_ts, total_kwh, active_meter_count,
        greatest(0, {expected} - active_meter_count) AS silent_meter_count, is_empty FROM filled""")


def outages(minutes: int) -> str:
    ratio = "silent_meter_count / nullif(CAST(silent_meter_count + active_meter_count AS DOUBLE), 0)"
    return ask(window_ctes(minutes) + ", " + grid_cte(minutes) + """, counted AS (
      SELECT zone_id, window_start_ts, active_meter_count,
        greatest(0, coalesce(n, 100) - active_meter_count) AS silent_meter_count
      FROM filled LEFT JOIN expected USING (zone_id))""", f"""
      SELECT *, {rnd(ratio, 4)} AS silent_ratio FROM counted WHERE {ratio} >= 0.7::DOUBLE""")


ORACLES = {
    "src_stream_replay": ask(READINGS, f"SELECT {PARSED_COLS} FROM readings"),
    "src_json_raw": ask(READINGS, f"SELECT event_id, kwh_delta, {HOUR_PARTS} FROM readings"),
    "src_partition_prune": ask(READINGS, """
      SELECT event_id, CAST(day(reading_ts) AS INTEGER) AS day,
        CAST(hour(reading_ts) AS INTEGER) AS hour FROM readings
      WHERE reading_ts >= TIMESTAMP '2024-01-10 06:00:00'
        AND reading_ts < TIMESTAMP '2024-01-12 00:00:00'"""),
    "sink_hour_partitions": ask(READINGS, f"""
      SELECT {HOUR_PARTS}, count(*) AS reading_count FROM readings GROUP BY ALL"""),
    "ready_hours": ask(READINGS, f"SELECT DISTINCT {HOUR_PARTS} FROM readings"),
    "legacy_normalise": ask(READINGS, f"""
      SELECT event_id, meter_id, zone_id, customer_type, reading_ts, kwh_delta, voltage,
        current_amps, power_factor, power_kw, frequency_hz, meter_state, is_anomaly,
        signal_strength_dbm, event_type FROM readings
      UNION ALL
      SELECT sha256(meter_id || '|' || {ISO}), meter_id, zone_id, customer_type, reading_ts,
        kwh_delta, voltage, current_amps, power_factor,
        round(voltage * current_amps * power_factor / 1000 + 1e-9, 3), frequency_hz, meter_state,
        is_anomaly, NULL, event_type FROM readings"""),
    "legacy_load": ask(READINGS, f"""
      SELECT sha256(meter_id || '|' || {ISO}) AS event_id, meter_id, zone_id, customer_type, kwh_delta,
        round(voltage * current_amps * power_factor / 1000 + 1e-9, 3) AS power_kw, frequency_hz, {HOUR_PARTS}
      FROM readings"""),
    "route_alerts": ask(READINGS, f"""
      SELECT event_id, 'meter.readings' AS topic, {PARTITION_NO} AS "partition" FROM readings
      UNION ALL
      SELECT event_id, 'meter.alerts', {PARTITION_NO} FROM readings WHERE event_type = 'alert'"""),
    "route_partition_counts": ask(FAULTY, f"""
      SELECT {PARTITION_NO} AS "partition", count(*) AS reading_count FROM faulty GROUP BY 1"""),
    "push_rows": ask(FULL, """
      SELECT * REPLACE (strftime(window_start_ts, '%Y-%m-%dT%H:%M:%SZ') AS window_start_ts,
        strftime(window_end_ts, '%Y-%m-%dT%H:%M:%SZ') AS window_end_ts,
        coalesce(demand_vs_prev_window_pct, 0.0) AS demand_vs_prev_window_pct) FROM win"""),
    "window_status": ask(WIN, """
      SELECT zone_id, window_start_ts, CASE WHEN silent_meter_count > 3 THEN 'SILENT METERS'
        WHEN fault_count > 0 THEN 'FAULTS' ELSE 'OK' END AS status FROM win"""),
    "stg_readings": ask(ODO, f"""
      SELECT event_id, meter_id, zone_id, customer_type, reading_ts, load_ts, kwh_reading,
        kwh_delta, voltage, current_amps, power_factor, power_kw,
        frequency_hz AS grid_frequency_hz, meter_state, is_anomaly, signal_strength_dbm,
        firmware_version, event_type, {ENRICHED} FROM odo"""),
    "stg_readings_text": ask(ODO, f"""
      SELECT event_id, meter_id, zone_id, customer_type, reading_ts, load_ts, kwh_reading,
        kwh_delta, voltage, current_amps, power_factor, power_kw,
        frequency_hz AS grid_frequency_hz, meter_state, is_anomaly, signal_strength_dbm,
        firmware_version, event_type, {ENRICHED} FROM odo"""),
    "dq_bad_json": ask(READINGS, """
      SELECT arrival_seq,
        left('{"event_id":"' || event_id || '","meter_id":"' || meter_id || '"', 20) AS value
      FROM readings WHERE k = 0"""),
    "dq_missing_keys": ask(READINGS, """
      SELECT arrival_seq, 'power_kw' AS missing FROM readings WHERE k = 1"""),
    "quarantine": ask(READINGS, """
      SELECT arrival_seq, CASE k WHEN 0 THEN 'bad_json' WHEN 1 THEN 'missing_keys'
        WHEN 2 THEN 'null_required' ELSE 'bad_timestamp' END AS reason
      FROM readings WHERE k BETWEEN 0 AND 3"""),
    "filled_defaults": ask(READINGS, """
      SELECT event_id, CASE WHEN k = 0 THEN 0.0 ELSE kwh_delta END AS kwh_delta,
        CASE WHEN k = 0 THEN 0.0 ELSE power_kw END AS power_kw,
        CASE WHEN k = 1 THEN 0.0 ELSE power_factor END AS power_factor,
        CASE WHEN k = 1 THEN 0.0 ELSE voltage END AS voltage,
        CASE WHEN k = 2 THEN 60.0 ELSE frequency_hz END AS frequency_hz,
        CASE WHEN k = 2 THEN 'normal' ELSE meter_state END AS meter_state FROM readings"""),
    "dedup_events": ask(READINGS, """
      SELECT DISTINCT event_id, meter_id, reading_ts, kwh_delta FROM
        (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE k % 25 = 0)"""),
    "dq_negative_kwh": ask(FAULTY, """
      SELECT event_id, meter_id, kwh_delta FROM faulty WHERE kwh_delta < 0"""),
    "voltage_out_of_band": ask(STG, """
      SELECT event_id, meter_id, customer_type, voltage, voltage_deviation_pct FROM stg
      WHERE voltage_deviation_pct > 0.10::DOUBLE"""),
    "frequency_out_of_band": ask(STG, """
      SELECT event_id, meter_id, grid_frequency_hz FROM stg
      WHERE abs(grid_frequency_hz - 60) > 0.5::DOUBLE + 1e-9"""),
    "signal_bands": ask(READINGS, """
      SELECT zone_id, CASE WHEN signal_strength_dbm IS NULL THEN 'unknown'
        WHEN signal_strength_dbm >= -60 THEN 'excellent'
        WHEN signal_strength_dbm >= -70 THEN 'good' WHEN signal_strength_dbm >= -80 THEN 'fair'
        WHEN signal_strength_dbm >= -89 THEN 'poor' ELSE 'very_poor' END AS signal_band,
        count(*) AS reading_count FROM (SELECT zone_id, signal_strength_dbm FROM readings
          UNION ALL SELECT zone_id, NULL FROM readings) GROUP BY 1, 2"""),
    "power_residuals": ask(READINGS, """
      SELECT event_id, meter_id, power_kw, round(abs(power_kw
        - voltage * current_amps * power_factor / 1000.0::DOUBLE) + 1e-9, 6) AS residual_kw
      FROM readings WHERE round(abs(power_kw
        - voltage * current_amps * power_factor / 1000.0::DOUBLE) + 1e-9, 6) > 0.0005::DOUBLE"""),
    "scalar_time_parts": ask(READINGS, f"""
      SELECT event_id, {ISO} AS iso_text, epoch_ms(reading_ts) AS epoch_ms,
        CASE WHEN k = 3 THEN 0 ELSE CAST(hour(reading_ts) AS INTEGER) END AS hour_from_text,
        time_bucket(INTERVAL 5 MINUTE, reading_ts) AS window_5m,
        time_bucket(INTERVAL 6 HOUR, reading_ts) AS window_6h, {HOUR_PARTS},
        CAST(date_diff('second', reading_ts, load_ts) AS BIGINT) AS load_seconds FROM readings"""),
    "dq_report": ask(FAULTY, REPORT),
    "dq_duplicates": ask(READINGS, """
      SELECT event_id, count(*) AS copies FROM
        (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE k % 25 = 0)
      GROUP BY 1 HAVING count(*) > 1"""),
    "hour_completeness": ask(STG + f", {EXPECTED}" + """, slots AS (
      SELECT unnest(generate_series(min(reading_hour), max(reading_hour), INTERVAL 1 HOUR)) AS reading_hour FROM stg
    ), seen AS (
      SELECT zone_id, reading_hour, count(DISTINCT meter_id) AS meters FROM stg GROUP BY 1, 2)""", f"""
      SELECT zone_id, reading_hour, coalesce(meters, 0) AS meters, n AS expected,
        {pct('coalesce(meters, 0)', 'n')} AS complete_pct
      FROM expected CROSS JOIN slots LEFT JOIN seen USING (zone_id, reading_hour)"""),
    "gated_marts": MART_ROWS,
    "hourly_load": MART_ROWS,
    "gate_result": ask(FAULTY + f", report AS ({REPORT})", f"""
      SELECT count(*) AS checks, {n('failed_rows > 0')} AS failed_checks,
        CAST(sum(failed_rows) AS BIGINT) AS failed_rows,
        {n('failed_rows > 0')} = 0 AS marts_built FROM report"""),
    "zone_window_agg": ZONE_WINDOWS,
    "window_upsert": ZONE_WINDOWS,
    "zone_window_agg_6h": ask(window_ctes(360), f"SELECT {WINDOW_COLS} FROM win"),
    "zone_window_full": ask(FULL, "SELECT * FROM win"),
    "zone_window_delta": ZONE_DELTA,
    "zone_window_arrival": ask(READINGS + """, placed AS (
      SELECT *, max(time_bucket(INTERVAL 5 MINUTE, reading_ts)) OVER (PARTITION BY zone_id
        ORDER BY arrival_seq + CASE WHEN k % 10 = 0 THEN 5 ELSE 0 END, arrival_seq
        ROWS UNBOUNDED PRECEDING) AS window_start_ts FROM readings)""", f"""
      SELECT zone_id, window_start_ts, window_start_ts + INTERVAL 5 MINUTE AS window_end_ts,
        {MEASURES} FROM placed GROUP BY 1, 2"""),
    "window_grid_filled": grid(WIN, 5, "100"),
    "window_grid_faulty": grid(FAULTY + f""", win AS (
      SELECT zone_id, time_bucket(INTERVAL 5 MINUTE, reading_ts) AS window_start_ts, {MEASURES}
      FROM faulty GROUP BY 1, 2)""", 5, "100"),
    "zone_outages": outages(60),
    "zone_outages_5m": outages(5),
    "expected_meters": ask(READINGS, """
      SELECT zone_id, t // 5 + CASE WHEN t % 5 > i THEN 1 ELSE 0 END AS n
      FROM (SELECT count(DISTINCT meter_id) AS t FROM readings) CROSS JOIN (VALUES
        ('ZONE-NORTH', 0), ('ZONE-SOUTH', 1), ('ZONE-EAST', 2), ('ZONE-WEST', 3),
        ('ZONE-CENTRAL', 4)) z(zone_id, i)"""),
    "ema_anomaly": EMA_FLAGS,
    "ema_carried": EMA_FLAGS,
    "baseline_lookup": ask(EMA + """, last AS (
      SELECT meter_id, h, arg_max(base, i) AS base FROM fold GROUP BY 1, 2)""", """
      SELECT m.meter_id, CAST(m.h AS INTEGER) AS ema_hour, round(coalesce(base, 0.0) + 1e-9, 6) AS ema_baseline
      FROM (SELECT DISTINCT meter_id, unnest(range(24)) AS h FROM readings) m LEFT JOIN last USING (meter_id, h)"""),
    "ema_baselines": ask(EMA, """
      SELECT meter_id, CAST(h AS INTEGER) AS ema_hour,
        round(arg_max(base, i) + 1e-9, 6) AS ema_baseline FROM fold GROUP BY 1, 2"""),
    "rolling_anomaly": ask(READINGS + """, rolled AS (
      SELECT *, count(*) OVER w AS history, sum(kwh_dec) OVER w AS before FROM readings
      WINDOW w AS (PARTITION BY meter_id ORDER BY reading_ts, arrival_seq
        ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))""", """
      SELECT event_id, meter_id, history,
        coalesce(before <> 0 AND kwh_dec * history > 3 * before, false) AS is_anomaly_rolling
      FROM rolled"""),
    "odometer": ask(ODO, "SELECT event_id, meter_id, kwh_reading FROM odo"),
    "odometer_breaks": ask(ODO + f""", reset AS (
      SELECT *, kwh_reading - 500 * max(CASE WHEN k = 7 THEN 1 ELSE 0 END) OVER
        (PARTITION BY meter_id ORDER BY reading_ts, arrival_seq ROWS UNBOUNDED PRECEDING) AS kr
      FROM odo), lagged AS (SELECT *, lag(kr) {BY_METER} AS previous_kwh FROM reset)""", """
      SELECT event_id, meter_id, reading_ts, previous_kwh, kr AS kwh_reading FROM lagged
      WHERE kr < previous_kwh"""),
    "state_transitions": ask(READINGS + f""", moves AS (
      SELECT lag(meter_state) {BY_METER} AS from_state, meter_state AS to_state FROM readings)""", """
      SELECT from_state, to_state, count(*) AS transitions, from_state = to_state
        OR (from_state || '>' || to_state) IN ('normal>degraded', 'normal>silent',
          'degraded>normal', 'degraded>fault', 'fault>normal', 'silent>normal') AS is_legal
      FROM moves WHERE from_state IS NOT NULL GROUP BY 1, 2"""),
    "fault_episodes": ask(READINGS + """, islands AS (
      SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY reading_ts, arrival_seq)
        - row_number() OVER (PARTITION BY meter_id, meter_state ORDER BY reading_ts, arrival_seq)
        AS island FROM readings)""", """
      SELECT meter_id, meter_state, min(reading_ts) AS started, max(reading_ts) AS ended,
        count(*) AS reading_count, CAST(date_diff('second', min(reading_ts), max(reading_ts))
          AS BIGINT) AS seconds
      FROM islands WHERE meter_state <> 'normal' GROUP BY meter_id, meter_state, island"""),
    "silence_gaps": ask(READINGS + f""", gaps AS (
      SELECT *, lag(reading_ts) {BY_METER} AS silent_from FROM readings)""", """
      SELECT meter_id, zone_id, silent_from, reading_ts AS silent_to,
        CAST(date_diff('second', silent_from, reading_ts) AS BIGINT) AS gap_seconds FROM gaps
      WHERE date_diff('second', silent_from, reading_ts) > 3 * interval_s"""),
    "mart_demand_heatmap": ask(HEATMAP, "SELECT * FROM heatmap"),
    "mart_zone_daily": ask(DAILY, "SELECT * FROM daily"),
    "mart_fault_summary": ask(FAULTS, "SELECT * FROM faults"),
    "mart_customer_segment": ask(STG, f"""
      SELECT customer_type, {kwh('kwh_delta')} AS total_kwh FROM stg GROUP BY 1"""),
    "zone_day_over_day": ask(DAILY + """, lagged AS (
      SELECT *, lag(total_kwh) OVER (PARTITION BY zone_id ORDER BY reading_date) AS prev
      FROM daily)""", f"""
      SELECT zone_id, reading_date, total_kwh,
        CASE WHEN prev > 0 THEN {DELTA} END AS day_over_day_pct FROM lagged"""),
    "meter_health_daily": ask(STG, f"""
      SELECT meter_id, reading_date, count(*) AS reading_count,
        {pct(n('is_fault'), 'count(*)')} AS fault_rate_pct,
        {pct(n('is_silent'), 'count(*)')} AS silent_rate_pct,
        {pct(n('is_anomaly'), 'count(*)')} AS anomaly_rate_pct,
        {pct(n('is_normal'), 'count(*)')} AS health_score FROM stg GROUP BY 1, 2"""),
    "segment_daily": ask(STG, f"""
      SELECT customer_type, reading_date, {kwh('kwh_delta')} AS total_kwh,
        {rnd('avg(power_factor)', 4)} AS avg_power_factor,
        {pct(n('is_fault'), 'count(*)')} AS fault_rate_pct FROM stg GROUP BY 1, 2"""),
    "segment_weekend": ask(STG, f"""
      SELECT customer_type, is_weekend, {kwh('kwh_delta')} AS total_kwh,
        {rnd('avg(kwh_delta)', 4)} AS avg_kwh, count(*) AS reading_count
      FROM stg GROUP BY 1, 2"""),
    "kpi_overview": ask(DAILY, f"""
      SELECT {kwh('total_kwh')} AS total_kwh, {rnd('avg(peak_power_kw)', 3)} AS avg_daily_peak_kw,
        {rnd('avg(uptime_pct)', 2)} AS avg_uptime_pct FROM daily"""),
    "kpi_faults": ask(FAULTS, """
      SELECT CAST(sum(degraded_reading_count) AS BIGINT) AS degraded_events,
        CAST(sum(fault_reading_count) AS BIGINT) AS fault_events,
        CAST(sum(silent_reading_count) AS BIGINT) AS silent_events,
        CAST(sum(total_fault_readings) AS BIGINT) AS all_fault_events FROM faults"""),
    "peak_hour_by_zone": ask(HEATMAP, """
      SELECT zone_id, day_of_week_num, hour_of_day, avg_kwh AS peak_avg_kwh FROM heatmap
      QUALIFY row_number() OVER (PARTITION BY zone_id
        ORDER BY avg_kwh DESC, day_of_week_num, hour_of_day) = 1"""),
    "overnight_trough": ask(HEATMAP, f"""
      SELECT zone_id, {kwh('total_kwh')} AS total_kwh, min(avg_kwh) AS lowest_avg_kwh,
        CAST(sum(reading_count) AS BIGINT) AS reading_count
      FROM heatmap WHERE hour_of_day BETWEEN 0 AND 5 GROUP BY 1"""),
    "heatmap_matrix": ask(STG, "SELECT day_of_week_num, " + ", ".join(
        rnd(f"avg(kwh_delta) FILTER (WHERE hour_of_day = {h})", 4) + f" AS h{h:02d}"
        for h in range(24)) + " FROM stg GROUP BY 1"),
    "trend_14d": ask(DAILY, f"""
      SELECT reading_date, {kwh('total_kwh')} AS total_kwh FROM daily
      WHERE reading_date > (SELECT max(reading_date) FROM daily) - INTERVAL 14 DAY GROUP BY 1"""),
    "zone_30d_totals": ask(DAILY, f"""
      SELECT zone_id, {kwh('total_kwh')} AS total_kwh FROM daily
      WHERE reading_date > (SELECT max(reading_date) FROM daily) - INTERVAL 30 DAY GROUP BY 1"""),
    "most_faulty_zone": ask(FAULTS, """
      SELECT zone_id, CAST(sum(total_fault_readings) AS BIGINT) AS total_fault_readings
      FROM faults GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""),
    "faults_by_zone": ask(FAULTS, """
      SELECT zone_id, CAST(sum(total_fault_readings) AS BIGINT) AS total_fault_readings
      FROM faults GROUP BY 1"""),
    "latest_window_ranked": ask(WIN, """
      SELECT zone_id, window_start_ts, total_kwh,
        row_number() OVER (ORDER BY total_kwh DESC, zone_id) AS demand_rank FROM win
      WHERE window_start_ts = (SELECT max(window_start_ts) FROM win)"""),
    "last_six_windows": ask(WIN, """
      SELECT zone_id, window_start_ts, total_kwh FROM win QUALIFY row_number() OVER
        (PARTITION BY zone_id ORDER BY window_start_ts DESC) <= 6"""),
    "live_kpis": ask(FULL, f"""
      SELECT {kwh('total_kwh')} AS total_demand_kwh,
        {rnd('avg(avg_power_factor)', 3)} AS avg_power_factor,
        {rnd('avg(avg_frequency_hz)', 3)} AS avg_frequency_hz,
        CAST(sum(fault_count) AS BIGINT) AS open_fault_alerts,
        CAST(sum(active_meter_count) AS BIGINT) AS active_meters,
        CAST(sum(silent_meter_count) AS BIGINT) AS silent_meters,
        CAST(sum(anomaly_count) AS BIGINT) AS anomalous_readings,
        arg_min(zone_id, (-total_kwh, zone_id)) AS peak_zone
      FROM win WHERE window_start_ts = (SELECT max(window_start_ts) FROM win)"""),
    "fleet_status_states": ask(STG, f"""
      SELECT meter_state, count(*) AS reading_count,
        {pct('count(*)', 'CAST(sum(count(*)) OVER () AS DOUBLE)', 1)} AS share_pct
      FROM stg GROUP BY 1"""),
    "fleet_status_zone_kwh": ask(STG, f"""
      SELECT zone_id, {kwh('kwh_delta')} AS total_kwh FROM stg GROUP BY 1"""),
    "fleet_status_totals": ask(STG, f"""
      SELECT count(*) AS events, {n('is_anomaly')} AS anomalous_readings,
        {n("event_type = 'alert'")} AS alert_events, {n('is_silent')} AS silent_cycles FROM stg"""),
    "fleet_composition": ask(READINGS, """
      SELECT zone_id,
        count(DISTINCT meter_id) FILTER (WHERE customer_type = 'residential') AS residential,
        count(DISTINCT meter_id) FILTER (WHERE customer_type = 'commercial') AS commercial,
        count(DISTINCT meter_id) FILTER (WHERE customer_type = 'industrial') AS industrial,
        count(DISTINCT meter_id) AS total FROM readings GROUP BY 1"""),
    "dim_meter": ask(READINGS, """
      SELECT meter_id, any_value(zone_id) AS zone_id, any_value(customer_type) AS customer_type,
        any_value(firmware_version) AS firmware_version, min(reading_ts) AS first_seen,
        max(reading_ts) AS last_seen, count(*) AS reading_count FROM readings GROUP BY 1"""),
    "absent_meters": ask(READINGS + """, days AS (
      SELECT unnest(generate_series(date_trunc('day', min(reading_ts)),
        date_trunc('day', max(reading_ts)), INTERVAL 1 DAY)) AS d FROM readings
    ), meters AS (SELECT DISTINCT zone_id, meter_id FROM readings)""", """
      SELECT zone_id, meter_id, CAST(d AS TIMESTAMP) AS reading_date FROM meters CROSS JOIN days
      WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.meter_id = meters.meter_id
        AND date_trunc('day', r.reading_ts) = d)"""),
    "expected_throughput": ask(READINGS + """, meters AS (
      SELECT DISTINCT meter_id, interval_s FROM readings)""", f"""
      SELECT count(*) AS meters, {rnd('sum(60.0::DOUBLE / interval_s)', 4)} AS per_minute,
        {rnd('sum(3600.0::DOUBLE / interval_s)', 4)} AS per_hour,
        {rnd('sum(86400.0::DOUBLE / interval_s)', 4)} AS per_day FROM meters"""),
    "reading_completeness": ask(STG, f"""
      SELECT meter_id, customer_type, reading_date, count(*) AS observed,
        CAST(86400 // any_value(interval_s) AS BIGINT) AS expected,
        {pct('count(*)', '(86400 // any_value(interval_s))', 3)} AS complete_pct
      FROM stg GROUP BY 1, 2, 3"""),
    "scenario_tagged": ask(READINGS + f", {SCENARIO}", """
      SELECT event_id, zone_id, reading_ts, scenario FROM tagged WHERE inside"""),
    "scenario_impact": ask(READINGS + f", {SCENARIO}", f"""
      SELECT scenario, zone_id, {n('inside')} AS readings_inside,
        {rnd('avg(kwh_delta) FILTER (WHERE inside)', 4)} AS avg_kwh_inside,
        {rnd('avg(kwh_delta) FILTER (WHERE NOT inside)', 4)} AS avg_kwh_outside
      FROM tagged GROUP BY 1, 2"""),
    "peak_offpeak": ask(STG + f", p AS (SELECT *, {PEAK} AS is_peak FROM stg)", f"""
      SELECT customer_type, {kwh('CASE WHEN is_peak THEN kwh_delta ELSE 0 END')} AS peak_kwh,
        {kwh('CASE WHEN is_peak THEN 0 ELSE kwh_delta END')} AS offpeak_kwh,
        {n('is_peak')} AS peak_readings, {n('NOT is_peak')} AS offpeak_readings
      FROM p GROUP BY 1"""),
    "load_latency": ask(STG, f"""
      SELECT reading_hour, {rnd("avg(date_diff('second', reading_ts, load_ts))", 3)}
        AS avg_latency_seconds,
        max(date_diff('second', reading_ts, load_ts)) AS max_latency_seconds,
        count(*) AS reading_count FROM stg GROUP BY 1"""),
    "stream_zone_windows": ZONE_WINDOWS,
    "stream_zone_delta": ZONE_DELTA,
    "stream_ema_anomaly": EMA_FLAGS,
    "scenario_calendar": ask(READINGS + """, calendar AS (
      SELECT 'job-' || (arrival_seq % 70) AS scenario, CASE WHEN arrival_seq % 50 = 0 THEN 'ALL' ELSE zone_id END AS zone_id,
        reading_ts AS start_ts, reading_ts + to_minutes(CAST(arrival_seq % 1500 AS INTEGER)) AS end_ts
      FROM readings WHERE arrival_seq % 10 = 0
    ), hits AS (
      SELECT DISTINCT r.event_id, scenario FROM readings r JOIN calendar c
        ON r.reading_ts >= start_ts AND r.reading_ts < end_ts AND c.zone_id IN ('ALL', r.zone_id))""", """
      SELECT event_id, count(scenario) AS n_scenarios, coalesce(string_agg(scenario, ',' ORDER BY scenario), '') AS scenarios
      FROM readings LEFT JOIN hits USING (event_id) GROUP BY 1"""),
    "active_meters_any_range": ask(READINGS, """
      SELECT zone_id, CAST(reading_ts AS DATE) AS day, count(DISTINCT meter_id) AS active_meters, true AS is_near
      FROM readings GROUP BY 1, 2
      UNION SELECT 'ALL', CAST(reading_ts AS DATE), count(DISTINCT meter_id), true FROM readings GROUP BY 2"""),
    "stream_ema_seeded": EMA_FLAGS,
    "stream_silence_alarms": ask(READINGS + f""", gaps AS (
      SELECT *, lead(reading_ts) {BY_METER} AS next_ts, lead(interval_s) {BY_METER} AS next_s FROM readings)""", """
      SELECT meter_id, zone_id, reading_ts AS silent_from FROM gaps
      WHERE date_diff('second', reading_ts, coalesce(next_ts, (SELECT max(reading_ts) FROM readings)))
        > 3 * coalesce(next_s, interval_s)"""),
    "live_redelivered": ask(
        FULL.replace("AS current_amps FROM measured", "AS current_amps FROM measured WHERE k > 3"),
        "SELECT * EXCLUDE (silent_meter_count) FROM win"),
    "live_accounts": ask(READINGS, """
      SELECT CASE WHEN k > 3 THEN zone_id END AS zone_id, 2 * count(*) AS messages, 2 * count(*) FILTER (k <= 3) AS dead,
        count(*) FILTER (k > 3) AS copies, count(*) FILTER (k > 3) AS accepted, 0 AS late FROM readings GROUP BY 1"""),
    "live_closed": ask(WIN + f""", ends AS (SELECT zone_id, max(reading_ts) AS clock FROM readings GROUP BY 1),
      lagged AS (SELECT *, {PREV} FROM win JOIN ends USING (zone_id))""", f"""
      SELECT zone_id, window_start_ts, total_kwh, active_meter_count,
        CASE WHEN prev > 0 THEN {DELTA} END AS demand_vs_prev_window_pct, 0 AS late
      FROM lagged WHERE window_start_ts + INTERVAL 5 MINUTE <= clock"""),
    "live_pipeline": ask(
        FULL.replace("AS current_amps FROM measured", "AS current_amps FROM measured WHERE k > 3"), "SELECT * FROM win"),
    "stream_dead_letters": ask(READINGS, """
      SELECT CASE k WHEN 0 THEN 'bad_json' WHEN 1 THEN 'missing_keys'
        WHEN 2 THEN 'null_required' ELSE 'bad_timestamp' END AS reason, count(*) AS messages
      FROM readings WHERE k BETWEEN 0 AND 3 GROUP BY 1"""),
    "closed_windows": ask(READINGS + f""", agg AS (
      SELECT zone_id, time_bucket(INTERVAL 5 MINUTE, reading_ts) AS window_start_ts, {MEASURES}
      FROM readings GROUP BY 1, 2)""", """
      SELECT *, window_start_ts + INTERVAL 5 MINUTE AS window_end_ts FROM agg
      WHERE window_start_ts + INTERVAL 15 MINUTE <= (SELECT max(reading_ts) FROM readings)"""),
    "stream_zone_full": ask(FULL, "SELECT * FROM win"),
}
