"""Independent DuckDB SQL for each registered query (the correctness oracle).

The SQL runs on the raw driver tables; ``MOVEMENTS_CTE`` re-derives the
stand-in movements with DuckDB's own functions so the oracle shares no code
with the Spark path.  Spark and DuckDB differ in a few defaults, handled
here on the DuckDB side: EXTRACT gives BIGINT (cast to INT), DAYOFWEEK
counts Sunday as 0 (add 1), ``100.0`` is written ``100e0`` (DOUBLE) and
ascending NULL order is spelled out.
"""

from __future__ import annotations

# Stand-in messages: one row per event (FIXTURES.md section 6).
MESSAGES_CTE = """
ev AS (
  SELECT event_id, user_id, event_type AS src_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ms
  FROM events
),
msg AS (
  SELECT event_id, ms,
    CASE WHEN src_type = 'signup' THEN '0001' ELSE '0003' END AS msg_type,
    CASE WHEN event_id % 2 = 0 THEN 'ARRIVAL' ELSE 'DEPARTURE' END AS event_type,
    CASE WHEN k % 10 < 5 THEN 'ON TIME' WHEN k % 10 < 8 THEN 'LATE'
         WHEN k % 10 = 8 THEN 'EARLY' ELSE 'OFF ROUTE' END AS variation_status,
    CASE WHEN k % 10 < 5 THEN 0 WHEN k % 10 < 8 THEN 30 * (1 + k)
         WHEN k % 10 = 8 THEN -30 * (1 + k % 7) END AS delay_s,
    CASE WHEN event_id % 1000 = 7 THEN '98'
         ELSE CASE user_id % 10 WHEN 0 THEN '20' WHEN 1 THEN '23' WHEN 2 THEN '28'
              WHEN 3 THEN '29' WHEN 4 THEN '61' WHEN 5 THEN '71' WHEN 6 THEN '80'
              WHEN 7 THEN '88' WHEN 8 THEN '99' END END AS toc_id,
    CASE WHEN k = 99 THEN NULL
         ELSE lpad(CAST((37 * user_id + k) % 2000 AS VARCHAR), 5, '0') END AS loc_stanox,
    'T' || lpad(CAST((31 * user_id + event_id % 30) % 1000 AS VARCHAR), 9, '0') AS train_id,
    CASE WHEN k % 25 = 24 THEN NULL ELSE CAST(k % 4 AS VARCHAR) END AS route
  FROM ev
)"""

# London ISO text of an epoch-ms value whose London offset is ``off_h`` hours.
def _iso(ms: str, off_h: int) -> str:
    sign = "+" if off_h >= 0 else "-"
    return (f"strftime(make_timestamp(({ms} + {off_h} * 3600000) * 1000), '%Y-%m-%dT%H:%M:%S')"
            f" || CASE WHEN {ms} % 1000 = 0 THEN '' ELSE '.' || "
            f"lpad(CAST(({ms} % 1000) * 1000 AS VARCHAR), 6, '0') END"
            f" || '{sign}{abs(off_h):02d}:00'")


_NULL_COLS = ["gbtt_timestamp", "timetable_variation", "delay_monitoring_point",
              "next_report_run_time", "reporting_stanox", "correction_ind", "event_source",
              "train_file_address", "division_code", "train_terminated", "offroute_ind",
              "train_service_code", "auto_expected", "planned_event_type",
              "next_report_stanox", "original_loc_stanox", "original_loc_timestamp",
              "current_train_id", "platform", "direction_ind", "line_ind"]


def movements_cte(shift_days: int = 0, off_h: int = 0,
                  processed_at: str | None = "2024-01-31T00:00:00") -> str:
    """WITH-clause body defining ``movements`` (events shifted by ``shift_days``)."""
    ms = "ms" if not shift_days else f"(ms + {shift_days} * CAST(86400000 AS BIGINT))"
    nulls = ",\n    ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NULL_COLS)
    proc = "CAST(NULL AS VARCHAR)" if processed_at is None else f"'{processed_at}'"
    return MESSAGES_CTE + f""",
movements AS (
  SELECT event_type, toc_id, variation_status,
    {_iso(ms, off_h)} AS uk_datetime,
    {ms} / 1000e0 AS "timestamp",
    {proc} AS processed_at,
    make_timestamp({ms} * 1000) AS actual_timestamp,
    loc_stanox,
    CAST({ms} - 1000 * delay_s AS VARCHAR) AS planned_timestamp,
    train_id, route,
    CAST(make_timestamp(({ms} + {off_h} * 3600000) * 1000) AS DATE) AS uk_date,
    {nulls}
  FROM msg
  WHERE msg_type = '0003' AND toc_id IS NOT NULL
)"""


def with_movements(body: str, **kw) -> str:
    return "WITH " + movements_cte(**kw) + "\n" + body


PCT_ON = "ROUND(COUNT(CASE WHEN variation_status = 'ON TIME' THEN 1 END) * 100e0 / COUNT(*), 2)"
ON = "COUNT(CASE WHEN variation_status = 'ON TIME' THEN 1 END)"
DELAY_MIN = "((epoch_ms(actual_timestamp) - CAST(planned_timestamp AS BIGINT)) / 60000e0)"
COMPANY = ("CASE WHEN toc_id = '20' THEN 'TransPennine Express' "
           "WHEN toc_id = '23' THEN 'Arriva Trains Northern' "
           "WHEN toc_id = '28' THEN 'East Midlands Trains' "
           "WHEN toc_id = '29' THEN 'West Midlands Trains' "
           "WHEN toc_id = '61' THEN 'London North Eastern Railway' "
           "WHEN toc_id = '71' THEN 'Transport for Wales' "
           "WHEN toc_id = '80' THEN 'Southeastern' "
           "WHEN toc_id = '88' THEN 'Govia Thameslink Railway (Thameslink)' "
           "ELSE 'Unknown' END")

ANALYTICS = {
    "basic_stats": """
SELECT COUNT(*) AS total_movements, COUNT(DISTINCT train_id) AS unique_trains,
       COUNT(DISTINCT toc_id) AS unique_tocs,
       COUNT(DISTINCT CAST(actual_timestamp AS DATE)) AS unique_dates,
       MIN(actual_timestamp) AS earliest_movement, MAX(actual_timestamp) AS latest_movement
FROM movements""",
    "movements_by_toc": """
SELECT toc_id, COUNT(*) AS movement_count,
       COUNT(CASE WHEN event_type = 'DEPARTURE' THEN 1 END) AS departures,
       COUNT(CASE WHEN event_type = 'ARRIVAL' THEN 1 END) AS arrivals
FROM movements GROUP BY toc_id
ORDER BY movement_count DESC, toc_id ASC NULLS LAST LIMIT 20""",
    "top_toc": """
SELECT toc_id, COUNT(*) AS movement_count,
       COUNT(CASE WHEN event_type = 'DEPARTURE' THEN 1 END) AS departures,
       COUNT(CASE WHEN event_type = 'ARRIVAL' THEN 1 END) AS arrivals
FROM movements GROUP BY toc_id
ORDER BY movement_count DESC, toc_id ASC NULLS LAST LIMIT 10""",
    "punctuality_share": """
SELECT variation_status, COUNT(*) AS count,
       ROUND(COUNT(*) * 100e0 / SUM(COUNT(*)) OVER (), 2) AS percentage
FROM movements GROUP BY variation_status ORDER BY count DESC""",
    "hourly_patterns": """
SELECT CAST(EXTRACT(HOUR FROM actual_timestamp) AS INTEGER) AS hour_of_day,
       COUNT(*) AS total_movements,
       COUNT(CASE WHEN event_type = 'DEPARTURE' THEN 1 END) AS departures,
       COUNT(CASE WHEN event_type = 'ARRIVAL' THEN 1 END) AS arrivals
FROM movements GROUP BY 1 ORDER BY 1""",
    "recent_movements": f"""
SELECT train_id, event_type, toc_id, variation_status, actual_timestamp, loc_stanox,
       planned_timestamp, ROUND({DELAY_MIN}, 2) AS delay_minutes
FROM movements
WHERE actual_timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR
ORDER BY actual_timestamp DESC, train_id ASC NULLS LAST, event_type ASC NULLS LAST,
         loc_stanox ASC NULLS LAST
LIMIT 50""",
    "event_type_distribution": """
SELECT event_type, COUNT(*) AS count FROM movements GROUP BY event_type""",
    "punctuality_distribution": """
SELECT variation_status, COUNT(*) AS movement_count
FROM movements GROUP BY variation_status ORDER BY movement_count DESC""",
    "toc_ranking": f"""
SELECT toc_id, COUNT(*) AS total_movements, {ON} AS on_time_count,
       {PCT_ON} AS punctuality_percentage
FROM movements GROUP BY toc_id HAVING COUNT(*) > 10
ORDER BY punctuality_percentage DESC, toc_id ASC NULLS LAST LIMIT 20""",
    "toc_status_heatmap": """
SELECT toc_id, variation_status, COUNT(*) AS movement_count
FROM movements GROUP BY toc_id, variation_status ORDER BY toc_id, variation_status""",
    "daily_trends": """
SELECT CAST(actual_timestamp AS DATE) AS date, variation_status, COUNT(*) AS movement_count
FROM movements GROUP BY 1, 2
ORDER BY date DESC, variation_status ASC NULLS LAST LIMIT 30""",
    "weekly_calendar": f"""
SELECT CAST(dayofweek(actual_timestamp) + 1 AS INTEGER) AS day_of_week,
       CAST(EXTRACT(HOUR FROM actual_timestamp) AS INTEGER) AS hour_of_day,
       {PCT_ON} AS punctuality_percentage
FROM movements GROUP BY 1, 2 ORDER BY 1, 2""",
    "top_stations": f"""
SELECT loc_stanox AS station_code, COUNT(*) AS movement_count, {ON} AS on_time_count,
       {PCT_ON} AS punctuality_percentage
FROM movements WHERE loc_stanox IS NOT NULL GROUP BY loc_stanox HAVING COUNT(*) > 5
ORDER BY movement_count DESC, station_code ASC LIMIT 20""",
    "route_performance": """
SELECT toc_id, route, variation_status, COUNT(*) AS movement_count
FROM movements WHERE route IS NOT NULL AND route != '0'
GROUP BY toc_id, route, variation_status ORDER BY toc_id, route""",
    "delay_distribution": f"""
SELECT ROUND({DELAY_MIN}, 0) AS delay_minutes, COUNT(*) AS frequency
FROM movements
WHERE variation_status = 'LATE' AND actual_timestamp IS NOT NULL
  AND planned_timestamp IS NOT NULL
GROUP BY 1 ORDER BY 1""",
    "toc_hour_matrix": f"""
SELECT toc_id, CAST(EXTRACT(HOUR FROM actual_timestamp) AS INTEGER) AS hour_of_day,
       {PCT_ON} AS punctuality_percentage
FROM movements GROUP BY 1, 2 HAVING COUNT(*) > 5 ORDER BY 1, 2""",
    "realtime_gauge": """
SELECT ROUND(COUNT(CASE WHEN variation_status = 'ON TIME' THEN 1 END) * 100e0
             / NULLIF(COUNT(*), 0), 2) AS current_punctuality_percentage
FROM movements WHERE CAST(actual_timestamp AS DATE) = DATE '2024-01-30'""",
    "leaderboard": f"""
SELECT toc_id, COUNT(*) AS total_movements, {PCT_ON} AS punctuality_percentage
FROM movements GROUP BY toc_id HAVING COUNT(*) > 20
ORDER BY punctuality_percentage DESC, toc_id ASC NULLS LAST LIMIT 15""",
    "kpi_scorecard": f"""
SELECT COUNT(*) AS total_movements, COUNT(DISTINCT train_id) AS unique_trains,
       COUNT(DISTINCT toc_id) AS active_tocs, {PCT_ON} AS overall_punctuality_percentage
FROM movements""",
    "network_health": f"""
SELECT {PCT_ON} AS punctuality_score,
       ROUND(COUNT(DISTINCT train_id) * 100e0 / COUNT(*), 2) AS coverage_score,
       ROUND(COUNT(CASE WHEN variation_status != 'LATE' THEN 1 END) * 100e0 / COUNT(*), 2)
         AS reliability_score,
       ROUND(COUNT(DISTINCT toc_id) * 100e0 / 50, 2) AS diversity_score
FROM movements""",
    "journey_flow": f"""
SELECT event_type, COUNT(*) AS movement_count,
       ROUND(AVG(CASE WHEN variation_status = 'LATE' THEN {DELAY_MIN} ELSE 0 END), 2)
         AS avg_delay_minutes
FROM movements GROUP BY event_type""",
    "row_count": "SELECT COUNT(*) AS total_rows FROM movements",
    "sample_rows": """
SELECT event_type, toc_id, variation_status, uk_datetime, "timestamp", processed_at,
       actual_timestamp, gbtt_timestamp, loc_stanox, planned_timestamp, timetable_variation,
       train_id, delay_monitoring_point, next_report_run_time, reporting_stanox,
       correction_ind, event_source, train_file_address, division_code, train_terminated,
       offroute_ind, train_service_code, auto_expected, route, planned_event_type,
       next_report_stanox, original_loc_stanox, original_loc_timestamp, current_train_id,
       platform, direction_ind, line_ind, uk_date
FROM movements
ORDER BY actual_timestamp ASC NULLS LAST, train_id ASC NULLS LAST,
         event_type ASC NULLS LAST, loc_stanox ASC NULLS LAST
LIMIT 5""",
    "run_sql_passthrough": """
SELECT toc_id, COUNT(*) AS movement_count, MAX(actual_timestamp) AS last_movement
FROM movements WHERE variation_status = 'LATE' AND event_type = 'ARRIVAL'
GROUP BY toc_id""",
    "operating_company_performance": f"""
SELECT actual_timestamp, {COMPANY} AS train_operating_company, variation_status
FROM movements""",
    "company_tree": f"""
SELECT train_operating_company, variation_status, COUNT(*) AS movement_count,
       CAST(GROUPING_ID(train_operating_company, variation_status) AS INTEGER) AS level
FROM (SELECT {COMPANY} AS train_operating_company, variation_status FROM movements)
GROUP BY ROLLUP (train_operating_company, variation_status)""",
    "company_ranking": f"""
SELECT {COMPANY} AS train_operating_company, COUNT(*) AS total_movements,
       {ON} AS on_time_count, {PCT_ON} AS punctuality_percentage
FROM movements GROUP BY 1 HAVING COUNT(*) > 10
ORDER BY punctuality_percentage DESC, train_operating_company ASC NULLS LAST LIMIT 20""",
}


TABLE_SELECT = """
SELECT event_type, toc_id, variation_status, uk_datetime, "timestamp", processed_at,
       actual_timestamp, gbtt_timestamp, loc_stanox, planned_timestamp, timetable_variation,
       train_id, delay_monitoring_point, next_report_run_time, reporting_stanox,
       correction_ind, event_source, train_file_address, division_code, train_terminated,
       offroute_ind, train_service_code, auto_expected, route, planned_event_type,
       next_report_stanox, original_loc_stanox, original_loc_timestamp, current_train_id,
       platform, direction_ind, line_ind, uk_date
FROM movements"""

STAGING_SELECT = """
SELECT event_type, gbtt_timestamp, original_loc_stanox, planned_timestamp, timetable_variation,
       original_loc_timestamp, current_train_id, delay_monitoring_point, next_report_run_time,
       reporting_stanox, actual_timestamp, correction_ind, event_source, train_file_address,
       platform, division_code, train_terminated, train_id, offroute_ind, variation_status,
       train_service_code, toc_id, loc_stanox, auto_expected, direction_ind, route,
       planned_event_type, next_report_stanox, line_ind
FROM movements"""

# London wall clock of the (possibly shifted) message time, for lake keys.
def _local(off_h: int, shift_days: int = 0) -> str:
    return f"make_timestamp((ms + {shift_days} * CAST(86400000 AS BIGINT) + {off_h} * 3600000) * 1000)"


def _feed_and_load() -> dict[str, str]:
    q = {}
    q["frames_to_movements"] = with_movements(TABLE_SELECT)
    q["ndjson_roundtrip"] = with_movements(TABLE_SELECT)
    q["parquet_lake_load"] = with_movements(TABLE_SELECT)
    q["topic_lane"] = with_movements(TABLE_SELECT)
    q["load_day_replay"] = with_movements(TABLE_SELECT)
    q["stream_ingest_available_now"] = with_movements(TABLE_SELECT)
    q["stream_late_day_replay"] = with_movements(TABLE_SELECT)
    q["stream_table_append"] = with_movements(TABLE_SELECT)
    q["flatten_complete"] = with_movements(TABLE_SELECT, processed_at=None)
    q["lake_roundtrip_day"] = with_movements(
        TABLE_SELECT + " WHERE uk_date = DATE '2024-01-15'")
    q["stg_movements"] = with_movements(STAGING_SELECT)
    q["uk_datetime_text"] = with_movements(
        'SELECT actual_timestamp, uk_datetime, "timestamp", uk_date FROM movements',
        shift_days=150, off_h=1)
    q["stream_dedup"] = with_movements(
        "SELECT DISTINCT train_id, loc_stanox, event_type, actual_timestamp FROM movements")
    frames = "(SELECT COUNT(DISTINCT event_id // 50) FROM ev)"
    q["rejected_frames"] = "WITH " + MESSAGES_CTE + f"""
SELECT status, messages FROM (
  SELECT 'ok' AS status, COUNT(*) AS messages FROM msg WHERE msg_type = '0003'
  UNION ALL SELECT 'skipped', COUNT(*) FROM msg WHERE msg_type <> '0003'
  UNION ALL SELECT 'bad_element', {frames}
  UNION ALL SELECT 'bad_frame', 1
) WHERE messages > 0"""
    q["ingest_stats"] = "WITH " + MESSAGES_CTE + f"""
SELECT COUNT(CASE WHEN msg_type = '0003' THEN 1 END) AS ok,
       COUNT(CASE WHEN msg_type <> '0003' THEN 1 END) AS skipped,
       0::BIGINT AS bad_time, {frames} AS bad_element, 1::BIGINT AS bad_frame,
       COUNT(*) + {frames} AS elements
FROM msg"""
    q["partition_keys"] = "WITH " + MESSAGES_CTE + f"""
SELECT CAST(year({_local(1, 150)}) AS INTEGER) AS year,
       lpad(CAST(month({_local(1, 150)}) AS VARCHAR), 2, '0') AS month,
       lpad(CAST(day({_local(1, 150)}) AS VARCHAR), 2, '0') AS day,
       COUNT(*) AS movements
FROM msg WHERE msg_type = '0003' GROUP BY 1, 2, 3"""
    name = (f"strftime({_local(0)}, '%Y%m%d-%H%M%S') || '-' || COALESCE(toc_id, 'None') "
            "|| '.json'")
    q["object_names"] = "WITH " + MESSAGES_CTE + f"""
SELECT {name} AS object_name, COUNT(*) AS movements
FROM msg WHERE msg_type = '0003' GROUP BY 1"""
    q["object_key_dedup"] = "WITH " + MESSAGES_CTE + f"""
SELECT object_name, toc_id, train_id, variation_status FROM (
  SELECT {name} AS object_name, toc_id, train_id, variation_status,
         row_number() OVER (PARTITION BY {name} ORDER BY event_id DESC) AS rn
  FROM msg WHERE msg_type = '0003') WHERE rn = 1"""
    day = "CAST(make_timestamp(ms * 1000) AS DATE) = DATE '2024-01-15'"
    q["load_report"] = "WITH " + MESSAGES_CTE + f""",
day AS (SELECT * FROM msg WHERE msg_type = '0003' AND {day}),
alld AS (SELECT COUNT(*) AS n FROM msg WHERE msg_type = '0003' AND toc_id IS NOT NULL)
SELECT '2024-01-15' AS days, 'loaded' AS status, '2024-01-15: loaded' AS day_status,
       0::BIGINT AS invalid_objects, COUNT(*) AS total_rows,
       COUNT(toc_id) AS valid_rows, COUNT(toc_id) AS written, 0::BIGINT AS misfiled,
       COUNT(toc_id) AS deleted, COUNT(toc_id) AS day_rows, (SELECT n FROM alld) AS table_rows,
       COUNT(*) AS non_null_train_id, COUNT(*) AS non_null_actual_timestamp,
       COUNT(toc_id) AS non_null_toc_id, 0::BIGINT AS null_actual_timestamp,
       0::BIGINT AS null_train_id, 0::BIGINT AS null_event_type
FROM day"""
    q["quality_report"] = "WITH " + MESSAGES_CTE + """
SELECT COUNT(*) AS total_rows, COUNT(train_id) AS non_null_train_id,
       COUNT(ms) AS non_null_actual_timestamp, COUNT(toc_id) AS non_null_toc_id,
       COUNT(*) - COUNT(ms) AS null_actual_timestamp, COUNT(*) - COUNT(train_id) AS null_train_id,
       COUNT(*) - COUNT(event_type) AS null_event_type,
       COUNT(CASE WHEN train_id IS NOT NULL AND ms IS NOT NULL AND toc_id IS NOT NULL
                  THEN 1 END) AS valid_rows
FROM msg WHERE msg_type = '0003'"""
    q["td_berth_events"] = """
WITH ev AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ms
  FROM events),
td AS (
  SELECT *, CASE event_id % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'CB' WHEN 2 THEN 'CC'
                 ELSE 'SF' END AS msg_type
  FROM ev)
SELECT strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS uk_time, msg_type,
       'A' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') AS area_id,
       CASE WHEN k % 5 = 0 THEN '' ELSE lpad(CAST(k AS VARCHAR), 4, '0') END AS descr,
       CASE WHEN msg_type IN ('CA', 'CB')
            THEN lpad(CAST((7 * user_id + k) % 10000 AS VARCHAR), 4, '0') ELSE '' END
         AS from_berth,
       CASE WHEN msg_type IN ('CA', 'CC')
            THEN lpad(CAST((11 * user_id + k) % 10000 AS VARCHAR), 4, '0') ELSE '' END
         AS to_berth
FROM td WHERE msg_type IN ('CA', 'CB', 'CC')"""
    for same in ("stream_new_checkpoint", "mixed_lane_lake", "topic_lane_streams"):
        q[same] = with_movements(TABLE_SELECT)
    q["append_table"] = with_movements(TABLE_SELECT.replace(
        " route,", " CASE WHEN event_type = 'ARRIVAL' THEN route END AS route,"))
    q["live_counters"] = "WITH " + MESSAGES_CTE + f"""
SELECT COUNT(CASE WHEN msg_type = '0003' THEN 1 END) AS ok,
       COUNT(CASE WHEN msg_type <> '0003' THEN 1 END) AS skipped,
       0::BIGINT AS bad_time, {frames} AS bad_element, 1::BIGINT AS bad_frame
FROM msg"""
    q["object_overwrite_two_runs"] = q["object_key_dedup"].replace(
        "ORDER BY event_id DESC", "ORDER BY (event_id // 50) % 2 = 0 DESC, event_id DESC")
    q["arrival_order_objects"] = q["object_key_dedup"].replace(
        "ORDER BY event_id DESC", "ORDER BY (event_id // 50) % 3 DESC, event_id DESC")
    q["stream_gauge"] = with_movements(f"""
SELECT CAST(actual_timestamp AS DATE) AS date, COUNT(*) AS movements, {PCT_ON} AS current_punctuality_percentage
FROM movements GROUP BY 1 UNION ALL SELECT DATE '2031-01-01', 0::BIGINT, NULL""")
    q["rollup_scorecards"] = with_movements(f"""
SELECT COUNT(*) AS total_movements, COUNT(DISTINCT train_id) AS unique_trains, COUNT(DISTINCT toc_id) AS unique_tocs,
       COUNT(DISTINCT CAST(actual_timestamp AS DATE)) AS unique_dates, MIN(actual_timestamp) AS earliest_movement,
       MAX(actual_timestamp) AS latest_movement, COUNT(DISTINCT toc_id) AS active_tocs,
       {PCT_ON} AS overall_punctuality_percentage, {PCT_ON} AS punctuality_score,
       ROUND(COUNT(DISTINCT train_id) * 100e0 / COUNT(*), 2) AS coverage_score,
       ROUND(COUNT(CASE WHEN variation_status <> 'LATE' THEN 1 END) * 100e0 / COUNT(*), 2) AS reliability_score,
       ROUND(COUNT(DISTINCT toc_id) * 100e0 / 50, 2) AS diversity_score
FROM movements""")
    q["rollup_charts"] = with_movements(f"""
SELECT * FROM (SELECT 'station' AS chart, loc_stanox AS label, COUNT(*) AS n, {PCT_ON} AS value
  FROM movements WHERE loc_stanox IS NOT NULL GROUP BY 2 HAVING COUNT(*) > 5 ORDER BY n DESC, label LIMIT 20)
UNION ALL SELECT 'delay', NULL, COUNT(*), ROUND({DELAY_MIN}, 0) AS d FROM movements
  WHERE variation_status = 'LATE' AND planned_timestamp IS NOT NULL GROUP BY d
UNION ALL SELECT 'flow', event_type, COUNT(*),
  ROUND(SUM(CASE WHEN variation_status = 'LATE' THEN epoch_ms(actual_timestamp) - CAST(planned_timestamp AS BIGINT) ELSE 0 END)
        / 60000e0 / COUNT(CASE WHEN variation_status <> 'LATE' OR planned_timestamp IS NOT NULL THEN 1 END), 2)
  FROM movements GROUP BY event_type""")
    q["compacted_stream_table"] = with_movements(TABLE_SELECT)
    q["catalog_table_views"] = with_movements(ANALYTICS["operating_company_performance"])
    q["stream_dedup_exact"] = q["stream_dedup"]
    q["stream_progress"] = q["live_counters"]
    q["bad_times"] = "WITH " + MESSAGES_CTE + """,
s AS (SELECT ms, CASE WHEN msg_type <> '0003' THEN 'skipped'
             WHEN event_id % 11 BETWEEN 3 AND 8 THEN 'bad_time' ELSE 'ok' END AS status FROM msg)
SELECT status, COUNT(*) AS messages FROM s GROUP BY status
UNION ALL SELECT 'latest ms', MAX(ms) FROM s WHERE status = 'ok'"""
    # position of a message among its frame's elements
    pos = "event_id - MIN(event_id) OVER (PARTITION BY event_id // 50)"
    q["quarantine_lanes"] = "WITH " + MESSAGES_CTE + f""",
p AS (SELECT *, {pos} AS pos FROM msg),
f AS (SELECT COUNT(*) AS n FROM p GROUP BY event_id // 50),
e AS (SELECT 'accepted' AS reason, NULL AS pos FROM p WHERE msg_type = '0003'
  UNION ALL SELECT 'bad_element', n FROM f
  UNION ALL SELECT 'bad_frame', NULL
  UNION ALL SELECT CASE WHEN event_id % 11 BETWEEN 3 AND 8 THEN 'bad_time' ELSE 'accepted' END,
                   CASE WHEN event_id % 11 BETWEEN 3 AND 8 THEN pos END FROM p WHERE msg_type = '0003')
SELECT reason, COUNT(*) AS elements, CAST(SUM(pos) AS BIGINT) AS positions FROM e GROUP BY reason"""
    q["migrated_table"] = "WITH " + MESSAGES_CTE + f""",
p AS (SELECT *, {pos} AS pos FROM msg),
m AS (SELECT CAST({_local(0)} AS DATE) AS day, toc_id, (event_id // 50 * 50 + pos) % 13 = 5 AS bad FROM p WHERE msg_type = '0003')
SELECT CAST(day AS VARCHAR) AS day, COUNT(*) AS rows, COUNT(CASE WHEN bad THEN 1 END) AS bad_bodies,
       COUNT(CASE WHEN NOT bad AND toc_id IS NULL THEN 1 END) AS incomplete,
       COUNT(CASE WHEN NOT bad THEN toc_id END) AS written
FROM m GROUP BY 1"""
    q["ndjson_bad_lines"] = "WITH " + MESSAGES_CTE + f""",
p AS (SELECT msg_type, {pos} AS pos FROM msg)
SELECT pos % 10 <> 3 AS ok, COUNT(*) AS lines FROM p WHERE msg_type = '0003' GROUP BY 1"""
    q["whole_objects_load"] = "WITH " + MESSAGES_CTE + f""",
p AS (SELECT msg_type, toc_id, {pos} AS pos FROM msg),
m AS (SELECT * FROM p WHERE msg_type = '0003')
SELECT 'loaded' AS status, COUNT(CASE WHEN pos % 10 = 8 THEN 1 END) AS invalid_objects,
       COUNT(CASE WHEN pos % 10 <> 8 THEN 1 END) AS total_rows,
       COUNT(CASE WHEN pos % 10 <> 8 THEN toc_id END) AS valid_rows,
       COUNT(CASE WHEN pos % 10 <> 8 THEN toc_id END) AS written, 0::BIGINT AS deleted,
       COUNT(CASE WHEN pos % 10 <> 8 THEN toc_id END) AS day_rows
FROM m"""
    q["load_report_partial"] = "WITH " + MESSAGES_CTE + f""",
day AS (SELECT * FROM msg WHERE msg_type = '0003' AND {day}),
one AS (SELECT DISTINCT train_id, loc_stanox, event_type, ms FROM day WHERE toc_id IS NOT NULL)
SELECT '2024-01-15,2031-01-01' AS days, 'partly loaded' AS status,
       '2024-01-15: loaded,2031-01-01: aborted: no complete row' AS day_status,
       2 * COUNT(*) AS total_rows, (SELECT COUNT(*) FROM one) AS written, 2 * COUNT(toc_id) AS deleted,
       (SELECT COUNT(*) FROM one) AS day_rows
FROM day"""
    q["full_body_fields"] = _full_body(TABLE_SELECT)
    q["full_body_staging"] = _full_body(STAGING_SELECT)
    q.update(_quality_tests())
    return q


# The variant with every body field: see FULL_* in sources/standin.py; k is the field's place in the view.
_FULL_TEXT = {"gbtt_timestamp": 1, "original_loc_stanox": 2, "timetable_variation": 4, "original_loc_timestamp": 5,
              "current_train_id": 6, "delay_monitoring_point": 7, "reporting_stanox": 9, "event_source": 12,
              "train_file_address": 13, "train_service_code": 20, "loc_stanox": 22, "direction_ind": 24, "route": 25,
              "planned_event_type": 26, "next_report_stanox": 27}
_FULL_BOOLEAN = {"correction_ind": 11, "train_terminated": 16, "offroute_ind": 18, "auto_expected": 23}
_FULL_NUMBER = {"next_report_run_time": 8, "division_code": 15, "line_ind": 28}


def _full_body(select: str) -> str:
    cols = [f"'{c}-' || event_id AS {c}" for c in _FULL_TEXT]
    cols += [f"CASE WHEN (event_id + {k}) % 2 = 0 THEN 'true' ELSE 'false' END AS {c}" for c, k in _FULL_BOOLEAN.items()]
    cols += [f"CAST(event_id * 100 + {k} AS VARCHAR) AS {c}" for c, k in _FULL_NUMBER.items()]
    cols.append("CASE WHEN event_id % 5 <> 0 THEN 'platform-' || event_id END AS platform")
    return "WITH " + MESSAGES_CTE + f""",
movements AS (
  SELECT event_type, toc_id, variation_status, {_iso('ms', 0)} AS uk_datetime, ms / 1000e0 AS "timestamp",
    '2024-01-31T00:00:00' AS processed_at, make_timestamp(ms * 1000) AS actual_timestamp,
    CAST(ms - 1000 * delay_s AS VARCHAR) AS planned_timestamp, train_id,
    CAST(make_timestamp(ms * 1000) AS DATE) AS uk_date, {', '.join(cols)}
  FROM msg WHERE msg_type = '0003' AND toc_id IS NOT NULL AND event_id % 50 <> 0)
{select}"""


# Planted data-quality failures, by the stored epoch ms of each movement.
PLANT = {"pass_event": 97, "cancelled": 89, "null_status": 83, "null_train": 79,
         "null_time": 73, "null_event": 71}


def _planted_cte() -> str:
    p = PLANT
    t = "epoch_ms(actual_timestamp)"
    return f""",
planted AS (
  SELECT
    CASE WHEN {t} % {p['null_event']} = 0 THEN NULL
         WHEN {t} % {p['pass_event']} = 0 THEN 'PASS' ELSE event_type END AS event_type,
    CASE WHEN {t} % {p['null_status']} = 0 THEN NULL
         WHEN {t} % {p['cancelled']} = 0 THEN 'CANCELLED' ELSE variation_status END
      AS variation_status,
    CASE WHEN {t} % {p['null_train']} = 0 THEN NULL ELSE train_id END AS train_id,
    CASE WHEN {t} % {p['null_time']} = 0 THEN NULL ELSE actual_timestamp END AS actual_timestamp,
    toc_id, {COMPANY} AS train_operating_company
  FROM movements
)"""


def _quality_tests() -> dict[str, str]:
    base = "WITH " + movements_cte() + _planted_cte()
    nn = [("stg_movements", "event_type"), ("stg_movements", "variation_status"),
          ("operating_company_performance", "actual_timestamp"),
          ("operating_company_performance", "train_operating_company"),
          ("operating_company_performance", "variation_status"),
          ("stg_movements_keys", "event_type"), ("stg_movements_keys", "actual_timestamp"),
          ("stg_movements_keys", "train_id"), ("stg_movements_keys", "toc_id")]
    parts = [f"SELECT '{m}' AS model, 'not_null' AS test, '{c}' AS column_name, "
             f"COUNT(*) - COUNT({c}) AS failures FROM planted" for m, c in nn]
    acc = [("stg_movements", "event_type", "('ARRIVAL', 'DEPARTURE')"),
           ("stg_movements", "variation_status", "('ON TIME', 'EARLY', 'LATE', 'OFF ROUTE')"),
           ("operating_company_performance", "variation_status",
            "('ON TIME', 'EARLY', 'LATE', 'OFF ROUTE')"),
           ("stg_movements_keys", "event_type", "('ARRIVAL', 'DEPARTURE')")]
    aparts = [f"SELECT '{m}' AS model, '{c}' AS column_name, {c} AS value, "
              f"COUNT(*) AS n_records FROM planted WHERE {c} IS NOT NULL AND {c} NOT IN {v} "
              f"GROUP BY {c}" for m, c, v in acc]
    return {"not_null_failures": base + "\n" + "\nUNION ALL ".join(parts),
            "accepted_value_failures": base + "\n" + "\nUNION ALL ".join(aparts)}


def oracle_sql() -> dict[str, str]:
    out = {k: with_movements(v) for k, v in ANALYTICS.items()}
    out.update(_feed_and_load())
    # the summary path must give exactly the base queries' answers
    from trackside.registry import SUMMARY_QUERIES
    out.update({f"summary_{n}": out[n] for n in SUMMARY_QUERIES})
    out["maintained_summary_toc_ranking"] = out["toc_ranking"]
    return out
