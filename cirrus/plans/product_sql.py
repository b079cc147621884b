"""DuckDB SQL for ``cirrus.plans.product``: the flat readings written from the
field rules, and each analytic over them from its definition."""

from __future__ import annotations

from cirrus.plans import events_sql as S

_R9 = "floor(floor(({x}) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6"
_READINGS = S.NORMALIZED_READINGS.replace("CAST(1020.0 AS DOUBLE) AS pressure_hpa", "CAST(floor(10000 - value * 10) AS BIGINT) / 10.0 AS pressure_hpa")


def _over(value: str, sql: str, where: str = "true", more: str = "") -> str:
    """``sql`` over ``events`` run over the readings instead, as a table of
    that name: key station, time event_time, the value, arrival row_number."""
    return f"""WITH r AS ({_READINGS}), events AS (
      SELECT station AS user_id, event_time AS ts, {value} AS value, row_number AS event_id,
             CASE WHEN temp_valid THEN 'valid' ELSE 'error' END AS event_type {more} FROM r WHERE {where})
    SELECT * FROM ({sql})"""


def _named(sql: str, columns: str) -> str:
    return f"SELECT {columns} FROM ({sql})"


_STORM = S.COMPOSITE_ALERTS.replace("value AS lvl", "level AS lvl").replace("SELECT user_id, ts, value, lag(ts)", "SELECT user_id, ts, value, level, lag(ts)")
_BOOKED = f"""WITH r AS ({_READINGS}), b AS (
  SELECT c_name, CAST(c_custkey AS VARCHAR) AS booking_id, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS resort_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(((c_custkey % 28) + 28) % 28 AS INTEGER)) AS booking_start FROM customer)
SELECT c_name AS user_id, booking_id, resort_id, event_time, 'bad_conditions' AS alert, {_R9.format(x="wind_speed")} AS wind_mps, visibility_m
FROM r JOIN b ON station = resort_id
WHERE wind_speed IS NOT NULL AND visibility_m IS NOT NULL AND event_time BETWEEN booking_start AND booking_start + INTERVAL '1 day'
  AND (wind_speed > 18.0 OR visibility_m < 500)"""

ANALYTICS = {
    "uc01": _named(_over("temp_c", S.INTERVAL_STATS), f"user_id AS station, window_size, window_start, window_end, {_R9.format(x='min_value')} AS min_temp_c, {_R9.format(x='max_value')} AS max_temp_c, avg_value AS avg_temp_c"),
    "uc02": _named(_over("temp_c", S.PREDICATE_COUNT), "user_id AS station, window_start, window_end, bad_count"),
    "uc03": _named(_over("temp_c", S.RATE_CHANGE), "user_id AS station, event_time, change_per_hour AS change_c_per_hour"),
    "uc04": _named(_over("temp_c", S.GAP_STATUS), "user_id AS station, interval_start, interval_end, status"),
    "uc05": _named(_over("temp_c", S.BASELINE_DEVIATION), "user_id AS station, window_start, window_end, deviation AS deviation_c"),
    "uc06": _named(_over("temp_c", S.TOP_EXTREMES), f"user_id AS station, window_start, window_end, list_name, rank_position, {_R9.format(x='value')} AS temp_c"),
    "uc07": _named(_over("CAST(temp_c AS DECIMAL(18, 1))", S.MOVING_TREND), "user_id AS station, window_start, window_end, avg_value AS avg_temp_c, trend_direction"),
    "uc08": _BOOKED,
    "uc09": _named(_over("visibility_m", S.LOW_PERIODS.replace("20.0", "200")), "user_id AS station, period_start, period_end, duration_hours"),
    "uc10": _named(_over("pressure_hpa", _STORM, "wind_valid AND pressure_valid", ", wind_speed * 3.6 AS level"), f"user_id AS station, window_start, window_end, max_drop_per_hour AS pressure_drop_hpa_per_hour, {_R9.format(x='max_level')} AS max_wind_kmh, alert"),
}


def _panel(uc: str, time: str, columns: str, more: str = "") -> str:
    return f"SELECT {columns} FROM ({ANALYTICS[uc]}) WHERE {time} BETWEEN {S.FROM} AND {S.TO} {more}"


_STATION = S._label("station")
PANELS = {
    "s01": _panel("uc01", "window_end", f"window_end AS time, {_STATION} AS station, avg_temp_c, min_temp_c, max_temp_c", "AND window_size = '24h'"),
    "s02": _panel("uc02", "window_end", f"window_end AS time, {_STATION} AS metric, bad_count AS value"),
    "s03": _panel("uc03", "event_time", f"event_time AS time, {_STATION} AS metric, change_c_per_hour AS value"),
    "s04": _panel("uc04", "interval_end", f"interval_end AS time, {_STATION} AS metric, status AS value"),
    "s05": _panel("uc05", "window_end", f"window_end AS time, {_STATION} AS station, deviation_c"),
    "s06": f"""SELECT CAST(rank_position AS VARCHAR) || '. ' || {_STATION} AS label, temp_c FROM ({ANALYTICS['uc06']})
        WHERE list_name = 'hottest' QUALIFY window_end = max(window_end) OVER ()""",
    "s07": _panel("uc07", "window_end", f"window_end AS time, {_STATION} AS metric, trend_direction"),
    "s08": _panel("uc08", "event_time", f'event_time AS time, {S._label("resort_id")} AS resort_station, user_id AS "user", booking_id AS booking_ref, alert AS alert_type, wind_mps, visibility_m'),
    "s09": _panel("uc09", "period_end", f"period_start AS start_time, period_end AS end_time, {_STATION} AS station, duration_hours AS duration_h"),
    "s10": _panel("uc10", "window_end", f"window_end AS alert_time, {_STATION} AS station, alert AS status, pressure_drop_hpa_per_hour, max_wind_kmh"),
}

ORACLE = {f"product_{k}": v for k, v in {**ANALYTICS, **PANELS}.items()} | {f"pane_{uc}": ANALYTICS[uc] for uc in ("uc01", "uc02", "uc05", "uc06", "uc07")}
