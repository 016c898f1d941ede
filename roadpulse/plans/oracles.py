"""Independent SQL (DuckDB dialect) for the registered queries."""

from __future__ import annotations

_RECORD_COLUMNS = """driverID, carPlateNumber, latitude, longitude, speed, direction, siteName,
  record_time, isRapidlySpeedup, isRapidlySlowdown, isNeutralSlide, isNeutralSlideFinished,
  neutralSlideTime, isOverspeed, isOverspeedFinished, overspeedTime, isFatigueDriving,
  isHthrottleStop, isOilLeak, count_dangerEvent"""

_EVENTS = """
e0 AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
ev AS (
  SELECT event_id,
    'driver' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS driverID,
    'PL' || (event_id % 2) || '-' || user_id AS carPlateNumber,
    22 + k / 128.0::DOUBLE AS latitude,
    113 + k / 64.0::DOUBLE AS longitude,
    nullif(CAST(floor(value) AS INTEGER), 13) AS speed,
    CAST((k * 37) % 360 AS INTEGER) AS direction,
    CASE WHEN k % 4 > 0 THEN 'site' || (k % 4) END AS siteName,
    date_trunc('second', ts) AS record_time,
    event_type = 'click' AS isRapidlySpeedup,
    event_type = 'view' AS isRapidlySlowdown,
    event_type = 'purchase' AS isNeutralSlide,
    event_type = 'purchase' AND k % 2 = 0 AS isNeutralSlideFinished,
    CASE WHEN event_type = 'purchase' THEN k END AS neutralSlideTime,
    value >= 100 AS isOverspeed,
    value >= 100 AND k % 2 = 1 AS isOverspeedFinished,
    CASE WHEN value >= 100 THEN k END AS overspeedTime,
    event_type = 'error' AS isFatigueDriving,
    event_type = 'signup' AS isHthrottleStop,
    k % 10 = 0 AS isOilLeak,
    CASE WHEN k % 3 = 0 THEN k % 7 END AS count_dangerEvent
  FROM e0
)"""

_ORDERS = """
ot AS (
  SELECT *, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS record_time,
    CAST(o_orderpriority[1:1] AS INTEGER) AS prio,
    CAST(floor(o_totalprice / 3000) AS INTEGER) AS speed
  FROM orders
),
rec AS (
  SELECT 'driver' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS driverID,
    CASE WHEN o_orderkey % 3 > 0 THEN 'OR-' || (o_orderkey % 3) END AS carPlateNumber,
    22 + (o_orderkey % 100) / 128.0::DOUBLE AS latitude,
    113 + (o_orderkey % 90) / 64.0::DOUBLE AS longitude,
    speed,
    CAST(o_orderkey % 360 AS INTEGER) AS direction,
    CAST(NULL AS VARCHAR) AS siteName,
    record_time,
    prio = 1 AS isRapidlySpeedup,
    prio = 2 AS isRapidlySlowdown,
    prio = 3 AS isNeutralSlide,
    prio = 3 AND o_orderstatus = 'F' AS isNeutralSlideFinished,
    CASE WHEN prio = 3 THEN CAST(o_orderkey % 240 AS INTEGER) END AS neutralSlideTime,
    speed > 120 AS isOverspeed,
    speed > 120 AND o_orderstatus = 'F' AS isOverspeedFinished,
    CASE WHEN speed > 120 THEN CAST(o_orderkey % 240 AS INTEGER) END AS overspeedTime,
    prio = 4 AS isFatigueDriving,
    prio = 5 AS isHthrottleStop,
    o_orderkey % 50 = 0 AS isOilLeak,
    CAST(NULL AS INTEGER) AS count_dangerEvent
  FROM ot
)"""

_WHOLE = "record_time BETWEEN TIMESTAMP '1990-01-01 00:01:00' AND TIMESTAMP '2100-01-01 00:00:00'"
_JANUARY = "record_time BETWEEN TIMESTAMP '2024-01-03 08:00:00' AND TIMESTAMP '2024-01-20 17:30:00'"
_HALF_YEAR = (
    "record_time BETWEEN TIMESTAMP '1996-10-05 06:00:00' AND TIMESTAMP '1997-03-20 18:30:00'"
)
_ONE_DRIVER = "driverID = 'driver0000013'"


def _summary(source: str, where: str) -> str:
    return f"""
  SELECT driverID, carPlateNumber,
    count(*) FILTER (WHERE isOverspeed) AS count_overspeed,
    CAST(coalesce(sum(overspeedTime), 0) AS BIGINT) AS time_overspeed,
    count(*) FILTER (WHERE isFatigueDriving) AS count_fatigueDriving,
    count(*) FILTER (WHERE isNeutralSlide) AS count_neutralSlide,
    CAST(coalesce(sum(neutralSlideTime), 0) AS BIGINT) AS time_neutralSlide,
    count(*) FILTER (WHERE isRapidlySpeedup) AS count_rapidSpeedUp,
    count(*) FILTER (WHERE isRapidlySlowdown) AS count_rapidSlowDown,
    count(*) FILTER (WHERE isHthrottleStop) AS count_hthrottleStop,
    count(*) FILTER (WHERE isOilLeak) AS count_oilLeak,
    count(*) FILTER (WHERE isOverspeed) + count(*) FILTER (WHERE isFatigueDriving)
      + count(*) FILTER (WHERE isNeutralSlide) + count(*) FILTER (WHERE isRapidlySpeedup)
      + count(*) FILTER (WHERE isRapidlySlowdown) + count(*) FILTER (WHERE isHthrottleStop)
      + count(*) FILTER (WHERE isOilLeak) AS count_dangerEvent
  FROM {source} WHERE {where}
  GROUP BY driverID, carPlateNumber"""


def _indexed(where: str, start: str, seconds: int) -> str:
    return f"""
w AS (
  SELECT *, date_diff('second', TIMESTAMP '{start}', record_time) // {seconds} AS window_index
  FROM ev WHERE {where}
)"""


def _windows(where: str, start: str) -> str:
    return f"""
WITH {_EVENTS}, {_indexed(where, start, 180)},
g AS (
  SELECT driverID, window_index,
    TIMESTAMP '{start}' + to_seconds(180 * window_index) AS window_start,
    TIMESTAMP '{start}' + to_seconds(180 * (window_index + 1)) AS window_end,
    count(*) AS n_points,
    coalesce(max(speed), 0) AS max_speed,
    bool_or(isOverspeed) AS is_overspeed
  FROM w GROUP BY driverID, window_index
)
SELECT *, 'Driver ' || driverID || ' - ' || strftime(window_start, '%Y-%m-%d') || ' - '
    || strftime(window_start, '%I:%M:%S %p') || ' - ' || strftime(window_end, '%I:%M:%S %p') AS title
FROM g"""


# Upload lines of the events, and the values a parser must find in them.
_DAY_FILE = "'detail_record_' || strftime(record_time, '%Y_%m_%d') || '_00_00_00.csv'"


def _line(latitude: str, longitude: str, speed: str, time: str, overspeed_time: str) -> str:
    return f"""concat_ws(',', driverID, carPlateNumber, {latitude}, {longitude}, {speed},
      CAST(direction AS VARCHAR), coalesce(siteName, ''), {time},
      CASE WHEN isRapidlySpeedup THEN '1' ELSE '' END,
      CASE WHEN isRapidlySlowdown THEN '1' ELSE '' END,
      CASE WHEN isNeutralSlide THEN '1' ELSE '' END,
      CASE WHEN isNeutralSlideFinished THEN '1' ELSE '' END,
      coalesce(CAST(neutralSlideTime AS VARCHAR), ''),
      CASE WHEN isOverspeed THEN '1' ELSE '' END,
      CASE WHEN isOverspeedFinished THEN '1' ELSE '' END,
      {overspeed_time},
      CASE WHEN isFatigueDriving THEN '1' ELSE '' END,
      CASE WHEN isHthrottleStop THEN '1' ELSE '' END,
      CASE WHEN isOilLeak THEN '1' ELSE '' END,
      coalesce(CAST(count_dangerEvent AS VARCHAR), ''))"""


_PLAIN = {
    "latitude": "CAST(latitude AS VARCHAR)",
    "longitude": "CAST(longitude AS VARCHAR)",
    "speed": "coalesce(CAST(speed AS VARCHAR), '')",
    "time": "strftime(record_time, '%Y-%m-%d %H:%M:%S')",
    "overspeed_time": "coalesce(CAST(overspeedTime AS VARCHAR), '')",
}

_STORED = """driverID, carPlateNumber, latitude, longitude, speed, direction, siteName, record_time,
  isRapidlySpeedup, isRapidlySlowdown, isNeutralSlide, isNeutralSlideFinished,
  coalesce(neutralSlideTime, 0) AS neutralSlideTime, isOverspeed, isOverspeedFinished,
  coalesce(overspeedTime, 0) AS overspeedTime, isFatigueDriving, isHthrottleStop, isOilLeak,
  count_dangerEvent"""

_READ_BACK = f"WITH {_EVENTS} SELECT {_STORED} FROM ev"

_ORDER_FILES = """
f0 AS (
  SELECT o_orderkey, o_orderstatus, o_orderkey % 9 AS kind,
    '_' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '_'
        || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || '_'
        || lpad(CAST(o_orderkey % 59 AS VARCHAR), 2, '0') AS clock,
    'detail_record_' || strftime(o_orderdate, '%Y_%m_%d') AS stem
  FROM orders
),
files AS (
  SELECT o_orderkey, o_orderstatus, kind,
    CASE kind
      WHEN 1 THEN upper(stem || clock) || '.TXT'
      WHEN 2 THEN stem || clock
      WHEN 3 THEN 'detail_record_' || o_orderkey || '.csv'
      WHEN 4 THEN 'a b' || o_orderkey || '.csv'
      WHEN 5 THEN 'x' || o_orderkey || '.pdf'
      WHEN 7 THEN 'detail_record_1999_99_01' || clock || '.csv'
      WHEN 8 THEN 'é' || o_orderkey || '.csv'
      ELSE stem || clock || '.csv' END AS file_name,
    CASE WHEN kind = 6 THEN 104857601 ELSE 104857600 - o_orderkey END AS file_size
  FROM orders JOIN f0 USING (o_orderkey, o_orderstatus)
)"""

ORACLES: dict[str, str] = {
    "behavior_summary_all": f"WITH {_EVENTS} {_summary('ev', _WHOLE)}",
    "behavior_summary_range": f"WITH {_EVENTS} {_summary('ev', _JANUARY)}",
    "behavior_summary_driver": f"WITH {_EVENTS} {_summary('ev', _WHOLE + ' AND ' + _ONE_DRIVER)}",
    "behavior_summary_display": f"""
WITH {_ORDERS}, s AS ({_summary('rec', 'true')})
SELECT * REPLACE (
  coalesce(nullif(driverID, ''), '-') AS driverID,
  coalesce(nullif(carPlateNumber, ''), '-') AS carPlateNumber)
FROM s""",
    "behavior_summary_json": f"""
WITH {_ORDERS}, s AS ({_summary('rec', 'true')})
SELECT '{{"driverID":"' || driverID || '","carPlateNumber":'
  || coalesce('"' || carPlateNumber || '"', 'null')
  || ',"count_overspeed":' || count_overspeed || ',"time_overspeed":' || time_overspeed
  || ',"count_fatigueDriving":' || count_fatigueDriving
  || ',"count_neutralSlide":' || count_neutralSlide
  || ',"time_neutralSlide":' || time_neutralSlide
  || ',"count_rapidSpeedUp":' || count_rapidSpeedUp
  || ',"count_rapidSlowDown":' || count_rapidSlowDown
  || ',"count_hthrottleStop":' || count_hthrottleStop
  || ',"count_oilLeak":' || count_oilLeak
  || ',"count_dangerEvent":' || count_dangerEvent || '}}' AS json
FROM s""",
    "drivers_active": f"""
WITH {_EVENTS} SELECT DISTINCT driverID FROM ev WHERE {_JANUARY} ORDER BY driverID""",
    "speed_series_all": f"""
WITH {_EVENTS} SELECT driverID, record_time, speed, isOverspeed FROM ev
WHERE {_WHOLE} ORDER BY record_time""",
    "speed_series_driver": f"""
WITH {_EVENTS} SELECT driverID, record_time, speed, isOverspeed FROM ev
WHERE {_JANUARY} AND {_ONE_DRIVER} ORDER BY record_time""",
    "speed_series_as_json": f"""
WITH {_EVENTS}
SELECT '{{"record_time":"' || strftime(record_time, '%Y-%m-%dT%H:%M:%S.000Z') || '"'
  || coalesce(',"speed":' || speed, '') || ',"isOverspeed":' || isOverspeed || '}}' AS json
FROM ev WHERE {_WHOLE} AND {_ONE_DRIVER} ORDER BY record_time""",
    "speed_series_json_all": f"""
WITH {_EVENTS}
SELECT '{{"record_time":"' || strftime(record_time, '%Y-%m-%dT%H:%M:%S.000Z') || '"'
  || coalesce(',"speed":' || speed, '') || ',"isOverspeed":' || isOverspeed || '}}' AS json
FROM ev WHERE {_WHOLE} ORDER BY record_time""",
    "speed_points_clean": f"""
WITH {_EVENTS}
SELECT driverID, record_time, CAST(coalesce(speed, 0) AS DOUBLE) AS speed, isOverspeed,
  strftime(record_time, '%I:%M:%S %p') AS label,
  CASE WHEN isOverspeed THEN '#ff0000' ELSE '#00ff51' END AS colour
FROM ev WHERE {_WHOLE}""",
    "speed_windows_3min": _windows(_WHOLE, "1990-01-01 00:01:00"),
    "speed_windows_driver": _windows(
        f"{_JANUARY} AND {_ONE_DRIVER} AND record_time < TIMESTAMP '2024-01-20 17:30:00'",
        "2024-01-03 08:00:00",
    ),
    "overspeed_window_alerts": f"""
WITH {_EVENTS}, {_indexed(_WHOLE, "1990-01-01 00:01:00", 180)}
SELECT driverID, window_index,
  TIMESTAMP '1990-01-01 00:01:00' + to_seconds(180 * window_index) AS window_start,
  TIMESTAMP '1990-01-01 00:01:00' + to_seconds(180 * (window_index + 1)) AS window_end,
  count(*) FILTER (WHERE isOverspeed) AS n_overspeed,
  'Driver ' || driverID || ' is SPEEDING!' AS alert
FROM w GROUP BY driverID, window_index HAVING bool_or(isOverspeed)""",
    "window_points_3min": f"""
WITH {_EVENTS}, {_indexed(_WHOLE, "1990-01-01 00:01:00", 180)}
SELECT driverID, window_index, record_time, strftime(record_time, '%I:%M:%S %p') AS label,
  CAST(coalesce(speed, 0) AS DOUBLE) AS speed,
  CASE WHEN isOverspeed THEN '#ff0000' ELSE '#00ff51' END AS colour
FROM w ORDER BY driverID, record_time""",
    "window_lists_daily": f"""
WITH {_EVENTS}, {_indexed(_WHOLE, "1990-01-01 00:01:00", 86400)},
p AS (
  SELECT *, strftime(record_time, '%I:%M:%S %p') AS label, coalesce(speed, 0) AS shown,
    CASE WHEN isOverspeed THEN '#ff0000' ELSE '#00ff51' END AS colour
  FROM w
)
SELECT driverID, window_index, CAST(0 AS BIGINT) AS part,
  string_agg(label, ',' ORDER BY record_time, label, shown, colour) AS labels,
  string_agg(CAST(shown AS VARCHAR), ',' ORDER BY record_time, label, shown, colour) AS speeds,
  string_agg(colour, ',' ORDER BY record_time, label, shown, colour) AS colours
FROM p GROUP BY driverID, window_index""",
    "window_lists_parts": f"""
WITH {_EVENTS}, {_indexed(_WHOLE, "1990-01-01 00:01:00", 400 * 86400)},
p AS (
  SELECT driverID, window_index, record_time, strftime(record_time, '%I:%M:%S %p') AS label, coalesce(speed, 0) AS shown,
    isOverspeed, CASE WHEN isOverspeed THEN '#ff0000' ELSE '#00ff51' END AS colour
  FROM w
),
n AS (
  SELECT *, row_number() OVER (PARTITION BY driverID, window_index ORDER BY record_time, shown, isOverspeed) - 1 AS position FROM p
)
SELECT driverID, window_index, position // 16 AS part,
  string_agg(label, ',' ORDER BY position) AS labels,
  string_agg(CAST(shown AS VARCHAR), ',' ORDER BY position) AS speeds,
  string_agg(colour, ',' ORDER BY position) AS colours
FROM n GROUP BY ALL""",
    "month_shards_range": """
WITH spans AS (
  SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS lo,
    date_trunc('month', max(o_orderdate)) AS hi
  FROM orders GROUP BY o_custkey
)
SELECT o_custkey, 'detail_record_' || strftime(m, '%Y_%m') AS shard_table
FROM spans, LATERAL (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m)""",
    "month_row_counts": f"""
WITH {_ORDERS}
SELECT strftime(record_time, '%Y_%m') AS shard, count(*) AS n_rows FROM rec GROUP BY 1""",
    "multi_shard_records": f"WITH {_ORDERS} SELECT {_RECORD_COLUMNS} FROM rec WHERE {_HALF_YEAR}",
    "multi_shard_summary": f"WITH {_ORDERS} {_summary('rec', _HALF_YEAR)}",
    "multi_shard_drivers": f"""
WITH {_ORDERS} SELECT DISTINCT driverID FROM rec WHERE {_HALF_YEAR} ORDER BY driverID""",
    "multi_shard_speed": f"""
WITH {_ORDERS} SELECT driverID, record_time, speed, isOverspeed FROM rec
WHERE {_HALF_YEAR} AND {_ONE_DRIVER} ORDER BY record_time""",
    "shards_with_missing_month": f"""
WITH {_ORDERS} SELECT driverID, record_time, speed, isOverspeed FROM rec
WHERE strftime(record_time, '%Y_%m') IN ('1996_12', '1997_01', '1997_02')""",
    "every_shard_and_missing": f"WITH {_ORDERS} SELECT driverID, record_time, speed, isOverspeed FROM rec",
    "union_missing_columns": f"""
WITH {_EVENTS}, {_ORDERS}
SELECT driverID, record_time, speed, CAST(NULL AS BOOLEAN) AS isOverspeed FROM ev WHERE {_WHOLE}
UNION ALL
SELECT driverID, record_time, NULL, isOverspeed FROM rec""",
    "normalized_times": f"""
WITH {_ORDERS},
r AS (
  SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN strftime(record_time, '%Y-%m-%dT%H:%M')
    WHEN 1 THEN strftime(record_time, '%Y-%m-%dT%H:%M:%S')
    WHEN 2 THEN strftime(record_time, '%Y-%m-%d %H:%M')
    WHEN 3 THEN '' END AS raw_time
  FROM ot
)
SELECT o_orderkey, raw_time,
  CASE WHEN o_orderkey % 5 IN (0, 2) THEN replace(raw_time, 'T', ' ') || ':00'
    ELSE replace(raw_time, 'T', ' ') END AS normal_time
FROM r""",
    "file_admission": f"""
WITH {_ORDER_FILES}
SELECT o_orderkey, file_name, CAST(file_size AS BIGINT) AS file_size,
  CASE kind WHEN 3 THEN 'pattern' WHEN 4 THEN 'characters' WHEN 5 THEN 'extension'
    WHEN 6 THEN 'size' WHEN 7 THEN 'month' WHEN 8 THEN 'characters' END AS reason,
  kind IN (0, 1, 2) AS admitted
FROM files""",
    "new_files_only": f"""
WITH {_ORDER_FILES}
SELECT o_orderkey, file_name, CAST(file_size AS BIGINT) AS file_size FROM files
WHERE o_orderstatus <> 'F'
  AND file_name NOT IN (SELECT file_name FROM files WHERE o_orderstatus = 'F')""",
    "ingest_parse": f"""
WITH {_EVENTS} SELECT {_STORED}, strftime(record_time, '%Y_%m') AS shard FROM ev WHERE {_WHOLE}""",
    "ingest_damaged_good": f"""
WITH {_EVENTS}
SELECT {_STORED}, strftime(record_time, '%Y_%m') AS shard
FROM ev WHERE {_WHOLE} AND direction % 11 IN (0, 7, 10)
UNION ALL
SELECT driverID, NULL, NULL, NULL, NULL, NULL, NULL, NULL, false, false, false, false, 0, false,
  false, 0, false, false, false, NULL, strftime(record_time, '%Y_%m')
FROM ev WHERE {_WHOLE} AND direction % 11 = 5""",
    "ingest_rejects": f"""
WITH {_EVENTS}, r AS (SELECT *, direction % 11 AS kind FROM ev WHERE {_WHOLE})
SELECT {_DAY_FILE} AS file_name, CASE kind
    WHEN 1 THEN {_line(**{**_PLAIN, "latitude": "'22.5d'"})}
    WHEN 2 THEN {_line(**{**_PLAIN, "speed": "'6x'"})}
    WHEN 3 THEN {_line(**{**_PLAIN, "time": "'not-a-time'"})}
    WHEN 6 THEN {_line(**{**_PLAIN, "overspeed_time": "'99999999999'"})}
    WHEN 8 THEN {_line(**{**_PLAIN, "time": "'2024'"})}
    WHEN 9 THEN {_line(**{**_PLAIN, "longitude": "'nan'"})} END AS line,
  CASE kind WHEN 1 THEN 'latitude' WHEN 2 THEN 'speed' WHEN 3 THEN 'record_time'
    WHEN 6 THEN 'overspeedTime' WHEN 8 THEN 'record_time' WHEN 9 THEN 'longitude' END
    AS reject_reasons
FROM r WHERE kind IN (1, 2, 3, 6, 8, 9)""",
    "ingest_counts": f"""
WITH {_EVENTS}
SELECT count(*) FILTER (WHERE direction % 11 <> 4) AS seen,
  count(*) FILTER (WHERE direction % 11 IN (0, 5, 7, 10)) AS good,
  count(*) FILTER (WHERE direction % 11 IN (1, 2, 3, 6, 8, 9)) AS rejected
FROM ev WHERE {_WHOLE}""",
    "folder_load": f"{_READ_BACK} WHERE {_WHOLE}",
    "folded_records": f"WITH {_EVENTS} SELECT {_RECORD_COLUMNS} FROM ev WHERE {_WHOLE}",
    "stream_ingest": f"{_READ_BACK} WHERE {_WHOLE}",
    "load_report_per_file": f"""
WITH {_EVENTS}
SELECT {_DAY_FILE} AS file_name, count(*) FILTER (WHERE direction % 11 <> 4) AS seen,
  count(*) FILTER (WHERE direction % 11 IN (0, 5, 7, 10)) AS good,
  count(*) FILTER (WHERE direction % 11 IN (1, 2, 3, 6, 8, 9)) AS rejected
FROM ev WHERE {_WHOLE} GROUP BY ALL""",
    "refused_uploads": f"""
WITH {_EVENTS}, days AS (SELECT DISTINCT {_DAY_FILE} AS name, dayofmonth(record_time) % 4 AS kind FROM ev WHERE {_WHOLE})
SELECT name AS file_name, 'duplicate' AS reason FROM days
UNION ALL
SELECT CASE kind WHEN 0 THEN name || '.pdf' WHEN 1 THEN 'a b' || name
    WHEN 2 THEN replace(name, '_2024_01_', '_2024_13_') ELSE 'x' || name END,
  CASE kind WHEN 0 THEN 'extension' WHEN 1 THEN 'characters' WHEN 2 THEN 'month' ELSE 'pattern' END
FROM days""",
    "stream_speed_windows": f"""
WITH {_EVENTS}
SELECT driverID, time_bucket(INTERVAL 3 MINUTE, record_time, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 3 MINUTE, record_time, TIMESTAMP '1970-01-01') + INTERVAL 3 MINUTE
    AS window_end,
  count(*) AS n_points, coalesce(max(speed), 0) AS max_speed, bool_or(isOverspeed) AS is_overspeed
FROM ev GROUP BY ALL""",
    "stream_late_windows": f"""
WITH {_EVENTS}
SELECT driverID, time_bucket(INTERVAL 3 MINUTE, record_time, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 3 MINUTE, record_time, TIMESTAMP '1970-01-01') + INTERVAL 3 MINUTE
    AS window_end,
  count(*) AS n_points, count(*) FILTER (WHERE record_time < TIMESTAMP '2024-01-10') AS n_late,
  coalesce(max(speed), 0) AS max_speed, bool_or(isOverspeed) AS is_overspeed
FROM ev GROUP BY ALL""",
    "jdbc_roundtrip": f"""
WITH {_ORDERS} SELECT {_RECORD_COLUMNS} FROM rec
WHERE record_time BETWEEN TIMESTAMP '1996-12-10' AND TIMESTAMP '1997-02-10'
  AND strftime(record_time, '%Y_%m') IN ('1996_12', '1997_01')""",
    "jdbc_append_once": f"WITH {_EVENTS} SELECT {_RECORD_COLUMNS} FROM ev WHERE {_WHOLE}",
}
