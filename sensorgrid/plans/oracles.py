"""The registered queries in SQL for another engine, written for themselves.

Doubles are rounded half-up on their shortest decimal text, as Spark rounds
them; averages go through decimals on both sides.
"""

from __future__ import annotations

from sensorgrid.fixed_values import STATION_NETWORK

ORACLES: dict[str, str] = {}

AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
SINCE = f"{AS_OF} - INTERVAL 72 HOUR"
RECEIVED = "'2024-01-30T00:00:00.000000'"


def rounded(expr: str, digits: int) -> str:
    text = f"CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


def average(column: str) -> str:
    return f"(CAST(sum(CAST({column} AS DECIMAL(18, 6))) AS DOUBLE) / count({column}))"


def d(number: float) -> str:
    return f"CAST({number} AS DOUBLE)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def truncated(expr: str) -> str:
    return f"CAST(trunc({expr}) AS INTEGER)"


# --- scalar expressions ----------------------------------------------------


def aqi_sql(pm: str) -> str:
    def line(lo: float, hi: float, a: float, b: float) -> str:
        slope = f"(({d(b)} - {d(a)}) / ({d(hi)} - {d(lo)}))"
        return f"WHEN {pm} <= {d(hi)} THEN {rounded(f'{slope} * ({pm} - {d(lo)}) + {d(a)}', 0)}"

    return f"""CAST(CASE
        {line(0.0, 12.0, 0.0, 50.0)}
        {line(12.1, 35.4, 51.0, 100.0)}
        {line(35.5, 55.4, 101.0, 150.0)}
        {line(55.5, 150.4, 151.0, 200.0)}
        {line(150.5, 250.4, 201.0, 300.0)}
        {line(250.5, 500.4, 301.0, 500.0)}
        ELSE 500 END AS INTEGER)"""


def category_sql(aqi: str) -> str:
    return f"""CASE WHEN {aqi} <= 50 THEN 'Bon' WHEN {aqi} <= 100 THEN 'Modéré'
        WHEN {aqi} <= 150 THEN 'Mauvais pour sensibles' WHEN {aqi} <= 200 THEN 'Mauvais'
        WHEN {aqi} <= 300 THEN 'Très mauvais' ELSE 'Dangereux' END"""


def color_sql(aqi: str) -> str:
    return f"""CASE WHEN {aqi} <= 50 THEN '#00E400' WHEN {aqi} <= 100 THEN '#FFFF00'
        WHEN {aqi} <= 150 THEN '#FF7E00' WHEN {aqi} <= 200 THEN '#FF0000'
        WHEN {aqi} <= 300 THEN '#8F3F97' ELSE '#7E0023' END"""


def recommendation_sql(aqi: str) -> str:
    return f"""CASE WHEN {aqi} <= 50 THEN 'Qualité satisfaisante' WHEN {aqi} <= 100 THEN 'Acceptable'
        WHEN {aqi} <= 150 THEN 'Sensibles : limiter efforts'
        WHEN {aqi} <= 200 THEN 'Éviter efforts prolongés'
        WHEN {aqi} <= 300 THEN 'Rester à l''intérieur' ELSE 'Urgence sanitaire' END"""


def percent_sql(aqi: str) -> str:
    formula = f"{d(100)} * ({d(1)} - pow(CAST({aqi} AS DOUBLE) / {d(300)}, {d(0.7)}))"
    return f"""CASE WHEN {aqi} <= 0 THEN {d(100)} WHEN {aqi} >= 300 THEN {d(0)}
        ELSE {rounded(formula, 1)} END"""


def period_sql(hour: str) -> str:
    return f"""CASE WHEN {hour} >= 6 AND {hour} < 12 THEN 'Matin' WHEN {hour} >= 12 AND {hour} < 14 THEN 'Midi'
        WHEN {hour} >= 14 AND {hour} < 18 THEN 'Après-midi'
        WHEN {hour} >= 18 AND {hour} < 22 THEN 'Soir' ELSE 'Nuit' END"""


def time_sql(ts: str) -> str:
    day = f"(isodow({ts}) - 1)"
    return f"""CAST(hour({ts}) AS INTEGER) AS hour,
        CAST({day} AS INTEGER) AS day_of_week,
        CASE {day} WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday'
            WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS day_name,
        CAST(month({ts}) AS INTEGER) AS month,
        CAST(CASE WHEN {day} IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
        {period_sql(f"hour({ts})")} AS period"""


def score_sql(aqi: str = "aqi") -> str:
    return f"""{category_sql(aqi)} AS aqi_category, {color_sql(aqi)} AS aqi_color,
        {recommendation_sql(aqi)} AS aqi_recommendation, {percent_sql(aqi)} AS air_quality_percent,
        {aqi} <= 100 AS sport_ok"""


# --- common tables ---------------------------------------------------------

K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"

EVENTS = f"ev AS (SELECT *, {K} AS k FROM events)"

READINGS = f"""{EVENTS},
    measured AS (
        SELECT CAST(user_id AS VARCHAR) AS sensor_id, event_type AS zone_id, upper(event_type) AS zone_name,
            {d(47.5)} + CAST(user_id % 10 AS DOUBLE) / {d(1000)} AS latitude,
            {d(6.8)} + CAST(user_id % 7 AS DOUBLE) / {d(1000)} AS longitude,
            ts AS datetime, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time,
            {rounded(f"value * {d(0.6)}", 1)} AS pm1_0_atm, {rounded("value", 1)} AS pm2_5_atm,
            {rounded(f"value * {d(1.4)}", 1)} AS pm10_atm,
            k * 30 AS particles_03, k * 9 AS particles_05, k * 3 AS particles_10, k AS particles_25,
            CAST(k // 3 AS INTEGER) AS particles_50, CAST(k // 9 AS INTEGER) AS particles_100,
            ts + to_minutes(k) AS "timestamp", CAST(user_id % 8 AS INTEGER) AS "partition",
            event_id AS "offset"
        FROM ev),
    indexed AS (SELECT *, {aqi_sql("pm2_5_atm")} AS aqi FROM measured),
    readings AS (SELECT *, {score_sql()}, {time_sql("datetime")} FROM indexed)"""

READING_COLUMNS = """sensor_id, zone_id, zone_name, latitude, longitude, datetime, date, time, hour,
    pm1_0_atm, pm2_5_atm, pm10_atm, particles_03, particles_05, particles_10, particles_25,
    particles_50, particles_100, aqi, aqi_category, aqi_color, aqi_recommendation,
    air_quality_percent, day_of_week, day_name, month, is_weekend, period, sport_ok"""

FEED = f'{READINGS}, feed AS (SELECT *, {RECEIVED} AS received_at FROM readings)'
FEED_COLUMNS = f'{READING_COLUMNS}, "timestamp", "partition", "offset", received_at'
ARRIVAL_DESC = '"timestamp" DESC, "partition" DESC, "offset" DESC'

RAW = f"""{EVENTS},
    raw AS (
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time,
            {truncated(f"value * {d(0.6)}")} AS pm10_cf1, {truncated("value")} AS pm25_cf1,
            {truncated(f"value * {d(1.4)}")} AS pm100_cf1, {truncated(f"value * {d(0.6)}")} AS pm10_std,
            {truncated("value")} AS pm25_std, {truncated(f"value * {d(1.4)}")} AS pm100_std,
            k * 30 AS gr03um, k * 9 AS gr05um, k * 3 AS gr10um, k AS gr25um,
            CAST(k // 3 AS INTEGER) AS gr50um, CAST(k // 9 AS INTEGER) AS gr100um,
            ts + to_minutes(k) AS kafka_timestamp, date_trunc('second', ts) AS datetime,
            CAST(hour(ts) AS INTEGER) AS hour, k
        FROM ev),
    ingested AS (
        SELECT *, CAST(pm10_cf1 AS DOUBLE) AS pm1_raw, CAST(pm25_cf1 AS DOUBLE) AS pm25_raw,
            CAST(pm100_cf1 AS DOUBLE) AS pm10_raw
        FROM raw)"""

# Faults of the message feed: k < 10 no JSON, k >= 90 no date, k = 50..59 decimals.
FAULTY = f"""{RAW},
    faulty AS (
        SELECT kafka_timestamp, k, CASE WHEN k BETWEEN 10 AND 89 THEN datetime END AS datetime,
            CASE WHEN k BETWEEN 10 AND 89 THEN date END AS date, CASE WHEN k >= 10 THEN time END AS time,
            CASE WHEN k >= 10 THEN pm25_cf1 END AS pm25_cf1, CASE WHEN k >= 10 THEN gr03um END AS gr03um
        FROM raw)"""

STATION_VALUES = ",\n        ".join(
    f"({text(sid)}, {text(zone_id)}, {text(z['zone_name'])}, {d(lat)}, {d(lon)}, {d(variation)}, "
    f"{d(z['pm_factor'])}, {d(z['variability'])}, {d(z['rush_hour_boost'])}, {d(z['night_reduction'])})"
    for zone_id, z in STATION_NETWORK.items()
    for sid, lat, lon, variation in z["stations"]
)
STATION_COLUMNS = """sensor_id, zone_id, zone_name, latitude, longitude, sensor_variation, pm_factor,
    variability, rush_hour_boost, night_reduction"""

RUSH = "(hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19)"
NIGHT = "(hour >= 22 OR hour <= 5)"
DAYTIME = f"pm_factor * sensor_variation * CASE WHEN {RUSH} THEN rush_hour_boost ELSE {d(1)} END"
TOTAL = f"{DAYTIME} * CASE WHEN {NIGHT} THEN night_reduction ELSE {d(1)} END"


def noise(label: str, seed: int) -> str:
    stamp = "strftime(datetime, '%Y-%m-%d %H:%M:%S')"
    draw = f"CAST('0x' || substr(md5('{seed}|' || sensor_id || '|' || {stamp} || '|{label}'), 1, 13) AS BIGINT)"
    return f"({d(1)} + (CAST({draw} AS DOUBLE) / {d(4503599627370496)} * {d(2)} - {d(1)}) * variability)"


def stations_sql(seed: int | None = None) -> str:
    def scaled(raw: str) -> str:
        factor = TOTAL if seed is None else f"{TOTAL} * {noise('pm', seed)}"
        return rounded(f"{raw} * ({factor})", 1)

    def bin_(raw: str) -> str:
        factor = f"({DAYTIME})"
        return truncated(f"{raw} * {factor}" if seed is None else f"{raw} * {factor} * {noise(raw, seed)}")

    return f"""{RAW},
    stations({STATION_COLUMNS}) AS (VALUES
        {STATION_VALUES}),
    placed AS (SELECT i.*, s.* FROM ingested i, stations s),
    scaled AS (
        SELECT *, {TOTAL} AS total_factor, {scaled("pm1_raw")} AS pm1_0_atm,
            {scaled("pm25_raw")} AS pm2_5_atm, {scaled("pm10_raw")} AS pm10_atm,
            {bin_("gr03um")} AS particles_03, {bin_("gr05um")} AS particles_05,
            {bin_("gr10um")} AS particles_10, {bin_("gr25um")} AS particles_25,
            {bin_("gr50um")} AS particles_50, {bin_("gr100um")} AS particles_100
        FROM placed),
    indexed AS (SELECT * EXCLUDE (hour), {aqi_sql("pm2_5_atm")} AS aqi FROM scaled),
    readings AS (SELECT *, {score_sql()}, {time_sql("datetime")} FROM indexed)"""


STATIONS = stations_sql()


def windows_sql(unit: str) -> str:
    return f"""windows AS (
        SELECT date_trunc('{unit}', datetime) AS window_start,
            date_trunc('{unit}', datetime) + INTERVAL 1 {unit} AS window_end, zone_id, zone_name,
            count(sensor_id) AS active_sensors,
            {rounded(average("latitude"), 4)} AS zone_latitude,
            {rounded(average("longitude"), 4)} AS zone_longitude,
            {rounded(average("pm1_0_atm"), 1)} AS avg_pm1_0, {rounded(average("pm2_5_atm"), 1)} AS avg_pm2_5,
            {rounded(average("pm10_atm"), 1)} AS avg_pm10,
            min(pm2_5_atm) AS min_pm2_5, max(pm2_5_atm) AS max_pm2_5,
            {rounded("CAST(sum(aqi) AS DOUBLE) / count(aqi)", 0)} AS avg_aqi,
            min(aqi) AS min_aqi, max(aqi) AS max_aqi,
            {rounded(average("air_quality_percent"), 1)} AS avg_air_quality_percent,
            coalesce(string_agg(sensor_id, ',' ORDER BY sensor_id), '') AS sensor_ids_str,
            count(DISTINCT sensor_id) AS distinct_sensors
        FROM readings GROUP BY ALL),
    zones AS (
        SELECT *, {category_sql("avg_aqi")} AS zone_aqi_category, {color_sql("avg_aqi")} AS zone_aqi_color,
            {recommendation_sql("avg_aqi")} AS zone_recommendation
        FROM windows)"""


ZONES = f"{READINGS}, {windows_sql('hour')}"
ZONE_COLUMNS = """window_start, window_end, zone_id, zone_name, active_sensors, zone_latitude,
    zone_longitude, avg_pm1_0, avg_pm2_5, avg_pm10, min_pm2_5, max_pm2_5, avg_aqi, min_aqi, max_aqi,
    zone_aqi_category, zone_aqi_color, zone_recommendation, avg_air_quality_percent, sensor_ids_str"""

LATEST = f"""{FEED},
    latest AS (
        SELECT * FROM feed
        QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY {ARRIVAL_DESC}) = 1)"""


def history_sql(n: int) -> str:
    return f"""{FEED},
    history AS (
        SELECT * FROM feed
        QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY {ARRIVAL_DESC}) <= {n})"""


NETWORK = f"""registry AS (
        SELECT s_name || '/' || n AS sensor_id, s_name AS zone_id, upper(s_name) AS zone_name,
            {d(47)} + CAST(s_nationkey AS DOUBLE) / {d(100)} AS latitude,
            {d(6)} + CAST(s_nationkey AS DOUBLE) / {d(100)} AS longitude,
            sensor_variation, {d(0.5)} + CAST(s_nationkey AS DOUBLE) / {d(20)} AS pm_factor,
            {d(0.1)} AS variability, {d(1.3)} AS rush_hour_boost, {d(0.85)} AS night_reduction
        FROM supplier, (VALUES (1, {d(1)}), (2, {d(1.05)}), (3, {d(0.95)})) AS v(n, sensor_variation))"""


def oracle(names: str, tables: str, select: str) -> None:
    for name in names.split():
        ORACLES[name] = f"WITH {tables}\n{select}"


# --- sources ---------------------------------------------------------------

RAW_FIELDS = """date, time, pm10_cf1, pm25_cf1, pm100_cf1, pm10_std, pm25_std, pm100_std,
    gr03um, gr05um, gr10um, gr25um, gr50um, gr100um"""

RAW_JSON = """'{"date":"' || date || '","time":"' || time || '","pm10_cf1":' || pm10_cf1
    || ',"pm25_cf1":' || pm25_cf1 || ',"pm100_cf1":' || pm100_cf1 || ',"pm10_std":' || pm10_std
    || ',"pm25_std":' || pm25_std || ',"pm100_std":' || pm100_std || ',"gr03um":' || gr03um
    || ',"gr05um":' || gr05um || ',"gr10um":' || gr10um || ',"gr25um":' || gr25um
    || ',"gr50um":' || gr50um || ',"gr100um":' || gr100um || '}'"""

MESSAGES = f"""{RAW},
    messages AS (
        SELECT {RAW_JSON} AS value, 'raw' AS topic, CAST(user_id % 8 AS INTEGER) AS "partition",
            raw.event_id AS "offset", kafka_timestamp AS "timestamp"
        FROM raw JOIN events ON raw.event_id = events.event_id)"""

oracle(
    "kafka_source", MESSAGES,
    'SELECT md5(value) AS value_md5, topic, "partition", "offset", "timestamp" FROM messages',
)
oracle("feed_inspect", MESSAGES, 'SELECT md5(value) AS value_md5, "partition", "offset" FROM messages')
oracle(
    "ingest_json", RAW,
    f"SELECT {RAW_FIELDS}, kafka_timestamp, datetime, hour, pm1_raw, pm25_raw, pm10_raw FROM ingested",
)
oracle(
    "ingest_json_strict", FAULTY,
    """SELECT kafka_timestamp, datetime, date, time,
        CAST(CASE WHEN k NOT BETWEEN 50 AND 59 THEN pm25_cf1 END AS VARCHAR) AS pm25_cf1,
        CAST(gr03um AS VARCHAR) AS gr03um FROM faulty""",
)
oracle(
    "ingest_json_lenient", FAULTY,
    """SELECT kafka_timestamp, datetime, date, time, CAST(pm25_cf1 AS VARCHAR) AS pm25_cf1,
        CAST(gr03um AS VARCHAR) AS gr03um FROM faulty""",
)
oracle(
    "csv_scan", "t AS (SELECT * FROM events)",
    "SELECT event_id, ts AS datetime, user_id, event_type, value, props FROM t",
)
oracle(
    "csv_sorted", "t AS (SELECT * FROM events)",
    """SELECT event_id, ts AS datetime, user_id, event_type, value, props,
        row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM t""",
)
oracle(
    "feed_ingest", FEED,
    f"SELECT {FEED_COLUMNS} FROM feed WHERE right(sensor_id, 1) NOT IN ('0', '1', '2')",
)
oracle(
    "key_present_filter", FEED,
    "SELECT sensor_id, zone_id, datetime, received_at FROM feed WHERE right(sensor_id, 1) NOT IN ('0', '1', '2')",
)

# --- projections, filters, checks ------------------------------------------

oracle("event_time", RAW, "SELECT date, time, datetime, hour FROM ingested")
oracle("raw_pm", RAW, "SELECT datetime, pm1_raw, pm25_raw, pm10_raw FROM ingested")
oracle(
    "dq_split_raw", FAULTY,
    """SELECT kafka_timestamp, datetime,
        CASE WHEN k < 10 THEN 'no field parsed' WHEN k >= 90 THEN 'no event time' ELSE '' END AS reasons
        FROM faulty""",
)
oracle(
    "dq_split", READINGS,
    """SELECT CASE WHEN particles_25 > 0 THEN sensor_id END AS sensor_id,
        repeat(zone_name, particles_25) AS zone_name, datetime,
        concat_ws('; ', CASE WHEN particles_25 = 0 THEN 'sensor_id is null' END,
            CASE WHEN length(repeat(zone_name, particles_25)) > 100 THEN 'zone_name longer than 100' END)
            AS reasons
        FROM readings""",
)
oracle(
    "recent_filter", READINGS,
    f"SELECT sensor_id, zone_id, datetime FROM readings WHERE datetime >= {SINCE}",
)
oracle("zone_filter", READINGS, "SELECT sensor_id, zone_id, datetime FROM readings WHERE zone_id = 'view'")
oracle(
    "default_if_missing", READINGS,
    f"""SELECT sensor_id AS zone_id, latitude, longitude,
        CASE WHEN odd THEN zone_name ELSE 'Inconnu' END AS zone_name,
        CASE WHEN odd THEN datetime END AS datetime, CASE WHEN odd THEN aqi ELSE 0 END AS latest_aqi,
        CASE WHEN odd THEN aqi_category ELSE 'Inconnu' END AS latest_category,
        CASE WHEN odd THEN aqi_color ELSE '#888888' END AS latest_color,
        CASE WHEN odd THEN pm2_5_atm ELSE {d(0)} END AS latest_pm2_5,
        CASE WHEN odd THEN pm10_atm ELSE {d(0)} END AS latest_pm10
        FROM (SELECT *, CAST(sensor_id AS BIGINT) % 2 = 1 AS odd FROM readings
            QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY {ARRIVAL_DESC}) = 1)""",
)

# --- registry and fan-out --------------------------------------------------

oracle("registry_flatten", NETWORK, f"SELECT {STATION_COLUMNS} FROM registry")
oracle(
    "registry_summary", NETWORK,
    """SELECT zone_id, zone_name, pm_factor, count(*) AS stations,
        CAST((SELECT count(*) FROM registry) AS BIGINT) AS total_stations,
        (SELECT count(DISTINCT zone_id) FROM registry) AS total_zones
        FROM registry GROUP BY zone_id, zone_name, pm_factor""",
)
oracle("station_fanout", STATIONS, f"SELECT datetime, pm25_raw, {STATION_COLUMNS} FROM placed")
oracle(
    "rush_hour_and_night", RAW,
    f"SELECT datetime, hour, {RUSH} AS is_rush_hour, {NIGHT} AS is_night FROM ingested",
)
oracle("station_factor", STATIONS, "SELECT datetime, sensor_id, total_factor FROM scaled")
oracle("scale_pm", STATIONS, "SELECT datetime, sensor_id, pm1_0_atm, pm2_5_atm, pm10_atm FROM scaled")
oracle(
    "scale_particles", STATIONS,
    """SELECT datetime, sensor_id, particles_03, particles_05, particles_10, particles_25,
        particles_50, particles_100 FROM scaled""",
)
oracle("enrich_readings", STATIONS, f"SELECT {READING_COLUMNS} FROM readings")
oracle(
    "enrich_readings_jittered", stations_sql(seed=7),
    "SELECT sensor_id, datetime, pm2_5_atm, particles_03, aqi FROM readings",
)
oracle(
    "keyed_jitter", "t AS (SELECT * FROM events)",
    f"""SELECT event_id, {d(1)} + (CAST(CAST('0x' || substr(md5('11|' || event_id || '|' || user_id), 1, 13)
        AS BIGINT) AS DOUBLE) / {d(4503599627370496)} * {d(2)} - {d(1)}) * {d(0.25)} AS factor FROM t""",
)

# --- scalar functions ------------------------------------------------------

oracle(
    "aqi_from_pm25",
    f"t AS (SELECT event_id, CASE WHEN value >= 0.5 THEN {rounded(f'value * {d(1.25)}', 1)} END AS pm2_5 FROM events)",
    f"""SELECT event_id, pm2_5, {aqi_sql("pm2_5")} AS aqi,
        CAST(CASE WHEN pm2_5 IS NOT NULL THEN {aqi_sql("pm2_5")} END AS VARCHAR) AS aqi_or_null FROM t""",
)
oracle(
    "aqi_labels", READINGS,
    "SELECT datetime, aqi, aqi_category, aqi_color, aqi_recommendation, sport_ok FROM readings",
)
oracle("air_quality_percent", READINGS, "SELECT datetime, aqi, air_quality_percent FROM readings")
oracle(
    "sql_functions",
    f"t AS (SELECT event_id, CASE WHEN value >= 1 THEN {truncated('value')} END AS aqi FROM events)",
    f"SELECT event_id, CAST(aqi AS VARCHAR) AS aqi, {category_sql('aqi')} AS category, {color_sql('aqi')} AS color FROM t",
)
oracle(
    "time_enrichment", "t AS (SELECT event_id, ts AS datetime FROM events)",
    f"SELECT event_id, datetime, {time_sql('datetime')} FROM t",
)
oracle(
    "iso_timestamps", "t AS (SELECT * FROM events)",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM t",
)

# --- zone windows ----------------------------------------------------------

oracle("zone_window_agg stream_zone_update_keep_last kafka_zones_payload", ZONES, f"SELECT {ZONE_COLUMNS} FROM zones")
oracle(
    "zone_window_agg_minutes stream_zone_of_stations", f"{STATIONS}, {windows_sql('minute')}",
    f"SELECT {ZONE_COLUMNS} FROM zones",
)
oracle(
    "zone_window_agg_days", f"{STATIONS}, {windows_sql('day')}",
    f"SELECT {ZONE_COLUMNS}, distinct_sensors FROM zones",
)
oracle(
    "station_fanout_network", NETWORK,
    f"""SELECT day, value, sensor_id, zone_id, sensor_variation, pm_factor
        FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {rounded(average("value"), 4)} AS value
            FROM events GROUP BY 1) AS days, registry""",
)
oracle(
    "zone_window_sensors", READINGS,
    """SELECT date_trunc('hour', datetime) AS window_start,
        date_trunc('hour', datetime) + INTERVAL 1 hour AS window_end, zone_id, zone_name, sensor_id,
        count(*) AS readings FROM readings GROUP BY ALL""",
)
oracle(
    "zone_label", ZONES,
    "SELECT window_start, zone_id, avg_aqi, zone_aqi_category, zone_aqi_color, zone_recommendation FROM zones",
)
oracle(
    "zone_table_rows", ZONES,
    f"""SELECT * REPLACE (CAST(active_sensors AS INTEGER) AS active_sensors, CAST(avg_aqi AS INTEGER) AS avg_aqi)
        FROM (SELECT {ZONE_COLUMNS} FROM zones)""",
)
DAILY = f"""{ZONES},
    daily AS (
        SELECT zone_id, zone_name, CAST(window_start AS DATE) AS date, count(*) AS readings_count,
            {rounded(average("avg_pm2_5"), 1)} AS daily_avg_pm25, {rounded(average("avg_aqi"), 0)} AS daily_avg_aqi,
            min(min_aqi) AS daily_min_aqi, max(max_aqi) AS daily_max_aqi
        FROM zones GROUP BY ALL)"""
oracle(
    "daily_zone_stats", DAILY,
    """SELECT * REPLACE (CAST(date AS VARCHAR) AS date),
        rank() OVER (ORDER BY date DESC, zone_id) - 1 AS position FROM daily""",
)
SENSOR_VIEW = """sensor_id, zone_id, zone_name, latitude, longitude, datetime, pm1_0_atm, pm2_5_atm,
    pm10_atm, aqi, aqi_category, aqi_color, air_quality_percent, sport_ok"""
ZONE_VIEW = """zone_id, zone_name, window_start, window_end, active_sensors, zone_latitude, zone_longitude,
    avg_pm2_5, avg_aqi, zone_aqi_category, zone_aqi_color, avg_air_quality_percent"""
LAST_SENSOR = 'QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY datetime DESC, "offset" DESC) = 1'
LAST_ZONE = "QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY window_start DESC) = 1"
oracle(
    "sql_views", DAILY,
    f"""SELECT * FROM (
        (SELECT 'sensor' AS level, sensor_id AS id, datetime AS at, CAST(aqi AS DOUBLE) AS aqi
            FROM readings {LAST_SENSOR})
        UNION ALL (SELECT 'zone', zone_id, window_start, avg_aqi FROM zones {LAST_ZONE})
        UNION ALL (SELECT 'day', zone_id, CAST(date AS TIMESTAMP), daily_avg_aqi FROM daily))""",
)

# --- latest and last rows --------------------------------------------------

oracle("latest_sensor_readings", READINGS, f"SELECT {SENSOR_VIEW} FROM readings {LAST_SENSOR}")
oracle("latest_zone_averages", ZONES, f"SELECT {ZONE_VIEW} FROM zones {LAST_ZONE}")
oracle("latest_by_arrival", LATEST, f"SELECT {FEED_COLUMNS} FROM latest")
oracle(
    "latest_measurements", LATEST,
    f"SELECT {FEED_COLUMNS}, rank() OVER (ORDER BY datetime DESC) - 1 AS position FROM latest",
)
HISTORY_COLUMNS = 'zone_id, sensor_id, datetime, aqi, "offset"'
oracle("history_last_n stream_history stream_keyed_history", history_sql(500), f"SELECT {HISTORY_COLUMNS} FROM history")
oracle("history_last_100", history_sql(100), f"SELECT {HISTORY_COLUMNS} FROM history")
oracle("zone_history_size", history_sql(500), "SELECT zone_id, count(*) AS kept FROM history GROUP BY zone_id")

# --- serving ---------------------------------------------------------------

oracle(
    "zones_list", LATEST,
    """SELECT zone_id, zone_name, latitude, longitude, datetime, aqi AS latest_aqi,
        aqi_category AS latest_category, aqi_color AS latest_color, pm2_5_atm AS latest_pm2_5,
        pm10_atm AS latest_pm10 FROM latest""",
)
oracle(
    "map_data", LATEST,
    """SELECT zone_id, zone_name, latitude, longitude, aqi, aqi_category, aqi_color, pm2_5_atm AS pm2_5,
        pm10_atm AS pm10, datetime, aqi_recommendation AS recommendation FROM latest""",
)
oracle(
    "zone_history", history_sql(500),
    f"""SELECT {FEED_COLUMNS}, rank() OVER (ORDER BY datetime DESC) - 1 AS position
        FROM history WHERE zone_id = 'view' AND datetime >= {SINCE}""",
)
oracle(
    "measurements_list", history_sql(100),
    f"SELECT {FEED_COLUMNS} FROM history WHERE datetime >= {SINCE} ORDER BY datetime DESC LIMIT 100",
)
oracle(
    "measurements_list_of_zone", history_sql(500),
    f"SELECT {FEED_COLUMNS} FROM history WHERE zone_id = 'view' ORDER BY datetime DESC LIMIT 100",
)
oracle(
    "recent_stats", history_sql(500),
    f"""SELECT zone_id, zone_name, CAST(sum(aqi) AS DOUBLE) / count(aqi) AS avg_aqi, min(aqi) AS min_aqi,
        max(aqi) AS max_aqi, {average("pm2_5_atm")} AS avg_pm2_5, {average("pm10_atm")} AS avg_pm10
        FROM history WHERE datetime >= {SINCE} GROUP BY zone_id, zone_name""",
)
oracle(
    "all_zone_union", READINGS,
    """SELECT zone_id, sensor_id, datetime, aqi_category FROM readings
        UNION ALL SELECT zone_id, NULL, datetime, NULL FROM readings""",
)

# --- order, CSV, messages --------------------------------------------------

NUMBERED = "t AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events)"
oracle("sort_csv_by_time", NUMBERED, "SELECT row_index, event_id, ts AS datetime, value FROM t")
oracle(
    "csv_replay_payload", NUMBERED,
    """SELECT CAST(row_index AS VARCHAR) AS key, event_id,
        regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$', '') AS datetime,
        user_id, event_type, value FROM t""",
)
oracle("kafka_readings_payload stream_stateless", READINGS, f"SELECT {READING_COLUMNS} FROM readings")

# --- streams ---------------------------------------------------------------

oracle(
    "dual_sink_roundtrip", STATIONS,
    f"""SELECT 'table' AS sink, {READING_COLUMNS} FROM readings
        UNION ALL SELECT 'readings', {READING_COLUMNS} FROM readings""",
)
oracle(
    "committed_batches", READINGS,
    'SELECT sensor_id, zone_id, datetime, aqi, CAST("offset" % 3 AS BIGINT) AS batch_id FROM readings',
)
oracle("changelog_merge", ZONES, f"SELECT * EXCLUDE (sensor_ids_str) FROM (SELECT {ZONE_COLUMNS} FROM zones)")
oracle(
    "stream_distinct_sensors", READINGS,
    "SELECT zone_id, date, count(DISTINCT sensor_id) AS distinct_sensors FROM readings GROUP BY zone_id, date",
)
oracle(
    "stream_dead_letters", f"""{MESSAGES},
    judged AS (SELECT m.*, k FROM messages m JOIN raw ON raw.event_id = m."offset")""",
    """SELECT CASE WHEN k < 10 THEN 'no json' ELSE '{' || substr(value, 22) END AS value,
        topic, "partition", "offset", "timestamp",
        CASE WHEN k < 10 THEN 'no field parsed; malformed text' ELSE 'no event time' END AS reasons
        FROM judged WHERE k < 10 OR k >= 90""",
)
oracle(
    "stream_zone_append", ZONES,
    f"""SELECT * EXCLUDE (sensor_ids_str) FROM (SELECT {ZONE_COLUMNS} FROM zones)
        WHERE window_end <= (SELECT date_trunc('millisecond', max(datetime)) - INTERVAL 30 SECOND FROM readings)""",
)
oracle("stream_latest", LATEST, f"SELECT * EXCLUDE (received_at) FROM (SELECT {FEED_COLUMNS} FROM latest)")
oracle(
    "stream_two_queries", f"{STATIONS}, {windows_sql('hour')}",
    """SELECT zone_id, (SELECT count(*) FROM readings r WHERE r.zone_id = z.zone_id) AS readings,
        count(*) AS windows, CAST(sum(active_sensors) AS BIGINT) AS active_sensors
        FROM zones z GROUP BY zone_id""",
)
