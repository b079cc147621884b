"""Oracle SQL (DuckDB dialect) for the ``events`` bindings in
``cirrus.plans.events``: written directly from the operator definitions
(window functions over whole keys, row replication for sliding windows),
not from the Spark plans, so each is an independent check.
"""

from __future__ import annotations

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
FROM, TO = "TIMESTAMP '2024-01-05 00:00:00'", "TIMESTAMP '2024-01-25 00:00:00'"


# Rounding to 6 digits with the same IEEE operations in both engines (see
# cirrus.plans.events._r): first to 9 digits, which absorbs last-bit noise of
# a different summation order, then to 6.


def _label(c: str) -> str:
    return f"(substr(CAST({c} AS VARCHAR), 1, 6) || '-' || substr(CAST({c} AS VARCHAR), 7))"


def _sliding(select_aggs: str, size_us: int, slide_us: int, slide: str, where: str = "value IS NOT NULL", extra: str = "") -> str:
    """Rows replicated into every sliding window holding them."""
    k = size_us // slide_us
    return f"""
    SELECT user_id, make_timestamp(epoch_us(p) - r.k * {slide_us}) AS window_start,
           make_timestamp(epoch_us(p) - r.k * {slide_us} + {size_us}) AS window_end, {select_aggs}
    FROM (SELECT *, time_bucket(INTERVAL '{slide}', ts, {EPOCH}) AS p FROM events WHERE {where}) x,
         range(0, {k}) r(k)
    GROUP BY ALL {extra}"""


H = 3_600_000_000
M10 = 600_000_000
D = 24 * H

INTERVAL_STATS = f"""
SELECT user_id, '1h' AS window_size, time_bucket(INTERVAL '1 hour', ts, {EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 hour', ts, {EPOCH}) + INTERVAL '1 hour' AS window_end,
       min(value) AS min_value, max(value) AS max_value, floor(floor((avg(value)) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS avg_value
FROM events WHERE value IS NOT NULL GROUP BY ALL
UNION ALL
SELECT user_id, '24h', time_bucket(INTERVAL '24 hours', ts, {EPOCH}),
       time_bucket(INTERVAL '24 hours', ts, {EPOCH}) + INTERVAL '24 hours',
       min(value), max(value), floor(floor((avg(value)) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6
FROM events WHERE value IS NOT NULL GROUP BY ALL
"""

PREDICATE_COUNT = f"""
SELECT user_id, window_start, window_end, CAST(bad_count AS BIGINT) AS bad_count FROM (
{_sliding("sum(CASE WHEN coalesce(event_type = 'error', false) THEN 1 ELSE 0 END) AS bad_count", H, M10, "10 minutes", "true")})
"""

RATE_CHANGE = """
SELECT user_id, ts AS event_time,
       floor(floor(((value - pv) * 3600.0 / ((epoch_us(ts) - epoch_us(pts)) / 1000000.0)) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS change_per_hour
FROM (SELECT user_id, ts, value, lag(ts) OVER w AS pts, lag(value) OVER w AS pv
      FROM events WHERE value IS NOT NULL
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE pts IS NOT NULL AND epoch_us(ts) > epoch_us(pts)
"""

GAP_STATUS = """
SELECT user_id, interval_start, interval_end,
       CASE WHEN epoch_us(interval_end) - epoch_us(interval_start) <= 3600000000 THEN 'complete' ELSE 'incomplete' END AS status
FROM (SELECT user_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS interval_start, ts AS interval_end FROM events)
WHERE interval_start IS NOT NULL
"""

_ROLL24 = _sliding("sum(value) AS s, count(value) AS n", D, H, "1 hour")

BASELINE_DEVIATION = f"""
SELECT user_id, window_start, window_end,
       floor(floor((s / n - (2.0 + (((CAST(substr(CAST(user_id AS VARCHAR), 1, 6) AS BIGINT) % 50) + 50) % 50) / 10.0)) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS deviation
FROM ({_ROLL24})
"""

BASELINE_DEVIATION_TABLE = f"""
SELECT w.user_id, window_start, window_end, floor(floor((s / n - b.base) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS deviation
FROM ({_ROLL24}) w
LEFT JOIN (SELECT user_id, avg(value) AS base FROM events WHERE value IS NOT NULL GROUP BY user_id) b ON w.user_id = b.user_id
"""

TOP_EXTREMES = f"""
WITH w AS ({_sliding("max(value) AS hi, min(value) AS lo", D, H, "1 hour")}),
r AS (
  SELECT user_id, window_start, window_end, 'hottest' AS list_name,
         row_number() OVER (PARTITION BY window_start ORDER BY hi DESC, user_id ASC) AS rank_position, hi AS value FROM w
  UNION ALL
  SELECT user_id, window_start, window_end, 'coldest',
         row_number() OVER (PARTITION BY window_start ORDER BY lo ASC, user_id ASC), lo FROM w)
SELECT user_id, window_start, window_end, list_name, CAST(rank_position AS BIGINT) AS rank_position, value
FROM r WHERE rank_position <= 10
"""

MOVING_TREND = f"""
WITH w AS ({_sliding("sum(value) / count(value) AS a", 30 * D, 10 * D, "10 days")}),
t AS (SELECT *, lag(a) OVER (PARTITION BY user_id ORDER BY window_start) AS pa FROM w)
SELECT user_id, window_start, window_end, floor(floor((a) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS avg_value,
       CASE WHEN pa IS NULL THEN 'unknown' WHEN a > pa THEN 'rising' WHEN a < pa THEN 'falling' ELSE 'stable' END AS trend_direction
FROM t
"""

BOOKING_ALERTS = """
WITH b AS (SELECT c_name AS booking_user, c_custkey AS booking_id, c_custkey AS resort_id,
                  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(((c_custkey % 28) + 28) % 28 AS INTEGER)) AS booking_start
           FROM customer)
SELECT b.booking_user AS user_id, b.booking_id, b.resort_id, e.ts AS event_time, 'bad_conditions' AS alert, e.value
FROM events e JOIN b ON e.user_id = b.resort_id
WHERE e.value IS NOT NULL
  AND e.ts BETWEEN b.booking_start AND b.booking_start + INTERVAL '1 day'
  AND (e.value > 60.0 OR e.value < 5.0)
"""

BOOKING_ALERTS_LONG = """
WITH b AS (SELECT c_name AS booking_user, c_custkey AS booking_id, TIMESTAMP '2024-01-01 00:00:00' - to_days(CAST(c_custkey % 4000 AS INTEGER)) AS s,
                  to_minutes(10 * (1 << CAST(c_custkey % 20 AS INTEGER))) AS lasts FROM customer)
SELECT booking_user AS user_id, booking_id, booking_id AS resort_id, e.ts AS event_time, 'bad_conditions' AS alert, e.value
FROM events e JOIN b ON e.user_id = booking_id
WHERE e.value IS NOT NULL AND e.ts >= s AND e.ts <= s + lasts AND (e.value > 60.0 OR e.value < 5.0)
"""

DEPARTURE_WEATHER = """
WITH f AS (SELECT c_custkey AS flight_id, c_custkey % 200 AS user_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey * 7919 % 43200 AS INTEGER)) AS departure FROM customer),
j AS (SELECT f.*, e.ts, e.value FROM f ASOF LEFT JOIN (SELECT * FROM events WHERE value IS NOT NULL) e ON f.user_id = e.user_id AND f.departure > e.ts)
SELECT flight_id, user_id, departure, CASE WHEN ts >= departure - INTERVAL '2 days' THEN ts END AS observed,
       CASE WHEN ts >= departure - INTERVAL '2 days' THEN value END AS value FROM j
"""

YEARLY_DEVIATION = """
WITH b AS (SELECT o_custkey, year(o_orderdate) AS y, avg(o_totalprice) AS a FROM orders GROUP BY ALL),
j AS (SELECT o.*, (SELECT max(y) FROM b WHERE b.o_custkey = o.o_custkey AND b.y < year(o.o_orderdate)) AS y FROM orders o)
SELECT j.o_orderkey, j.o_custkey, CAST(j.y AS INTEGER) AS baseline_year, floor(floor((b.a) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS baseline,
       floor(floor((j.o_totalprice - b.a) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS deviation
FROM j LEFT JOIN b ON b.o_custkey = j.o_custkey AND b.y = j.y
"""

_R6 = "floor(floor(({x}) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6"

YEARLY_PERCENTILES = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, {", ".join(f"{_R6.format(x=f'quantile_cont(o_totalprice, {f})')} AS p{round(100 * f)}" for f in (0.05, 0.5, 0.95))}
FROM orders GROUP BY ALL
"""

DAILY_SLOPES = f"""
WITH x AS (SELECT user_id, value, ts, make_timestamp(epoch_us(time_bucket(INTERVAL '12 hours', ts, {EPOCH})) - k * {12 * H}) AS window_start
           FROM events, range(0, 4) r(k) WHERE value IS NOT NULL),
h AS (SELECT *, (epoch_us(ts) - epoch_us(window_start)) / 3600e6 AS t FROM x),
w AS (SELECT user_id, window_start, count(*) AS n, regr_slope(value, t) AS b, regr_r2(value, t) AS r2, regr_intercept(value, t) AS a, regr_syy(value, t) AS syy FROM h GROUP BY ALL HAVING count(*) >= 3 AND min(t) < max(t))
SELECT user_id, window_start, window_start + INTERVAL '48 hours' AS window_end, n, {_R6.format(x="b")} AS slope_per_hour,
       CASE WHEN syy > 0 THEN {_R6.format(x="r2")} END AS r2, {_R6.format(x="a + 54 * b")} AS forecast FROM w
"""

# Closing rows (first reading >= threshold after a low one); the period starts
# at the first low reading after the last non-low reading before it.
LOW_PERIODS = """
WITH x AS (
  SELECT user_id, ts, event_id, value < 20.0 AS low,
         lag(value < 20.0) OVER w AS prev_low,
         max(CASE WHEN NOT (value < 20.0) THEN ts END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_high
  FROM events WHERE value IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT user_id, ts AS period_end, last_high FROM x WHERE NOT low AND prev_low)
SELECT c.user_id, min(x.ts) AS period_start, c.period_end,
       CAST(floor((epoch_us(c.period_end) - epoch_us(min(x.ts))) / 3600000000) AS BIGINT) AS duration_hours
FROM c JOIN x ON x.user_id = c.user_id AND x.low AND x.ts < c.period_end
             AND (c.last_high IS NULL OR x.ts > c.last_high)
GROUP BY c.user_id, c.period_end
"""

_DROPS = """
SELECT user_id, ts, (pv - value) * 3600.0 / ((epoch_us(ts) - epoch_us(pts)) / 1000000.0) AS dr, value AS lvl
FROM (SELECT user_id, ts, value, lag(ts) OVER w AS pts, lag(value) OVER w AS pv
      FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE pts IS NOT NULL AND epoch_us(ts) > epoch_us(pts)
"""

COMPOSITE_ALERTS = f"""
WITH d AS ({_DROPS}),
w AS (SELECT user_id, make_timestamp(epoch_us(p) - r.k * {M10}) AS window_start,
             make_timestamp(epoch_us(p) - r.k * {M10} + {H}) AS window_end, max(dr) AS md, max(lvl) AS ml
      FROM (SELECT *, time_bucket(INTERVAL '10 minutes', ts, {EPOCH}) AS p FROM d) x, range(0, 6) r(k)
      GROUP BY ALL)
SELECT user_id, window_start, window_end, floor(floor((md) * 1e9 + 0.5) / 1e9 * 1e6 + 0.5) / 1e6 AS max_drop_per_hour, ml AS max_level, 'storm_event' AS alert
FROM w WHERE md > 5.0 AND ml > 80.0
"""

NORMALIZED_READINGS = """
SELECT lpad(CAST(user_id AS VARCHAR), 11, '0') AS station,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date,
       date_trunc('second', ts) AS event_time,
       '4' AS source,
       CAST(event_id % 90 AS DOUBLE) AS latitude,
       CAST(23.45 AS DOUBLE) AS longitude,
       CASE WHEN event_type = 'view' THEN NULL ELSE CAST(5.0 AS DOUBLE) END AS elevation,
       'USER ' || CAST(user_id AS VARCHAR) || ', ' || upper(event_type) AS name,
       270 AS wind_angle,
       CASE WHEN (CAST(floor(value * 10) AS BIGINT) % 10000) = 9999 THEN NULL
            ELSE (CAST(floor(value * 10) AS BIGINT) % 10000) / 10.0 END AS wind_speed,
       (CAST(floor(value * 10) AS BIGINT) % 10000) <> 9999 AND event_type <> 'purchase' AS wind_valid,
       CAST(NULL AS INTEGER) AS ceiling_m,
       false AS ceiling_valid,
       CASE WHEN (CAST(floor(value * 100) AS BIGINT) % 1000000) = 999999 THEN NULL
            ELSE CAST(CAST(floor(value * 100) AS BIGINT) % 1000000 AS INTEGER) END AS visibility_m,
       (CAST(floor(value * 100) AS BIGINT) % 1000000) <> 999999 AS visibility_valid,
       CASE WHEN (CAST(floor(abs(value) * 10) AS BIGINT) % 10000) = 9999 AND value >= 0 THEN NULL
            WHEN (CAST(floor(abs(value) * 10) AS BIGINT) % 10000) = 9999 AND value < 0 THEN NULL
            ELSE (CASE WHEN value >= 0 THEN 1 ELSE -1 END) * (CAST(floor(abs(value) * 10) AS BIGINT) % 10000) / 10.0 END AS temp_c,
       (CAST(floor(abs(value) * 10) AS BIGINT) % 10000) <> 9999 AS temp_valid,
       CAST(NULL AS DOUBLE) AS dew_c,
       false AS dew_valid,
       CAST(1020.0 AS DOUBLE) AS pressure_hpa,
       true AS pressure_valid,
       16 AS n_columns,
       event_id + 2 AS row_number
FROM events WHERE event_type <> 'error'
"""

_RAW_LINE = """
'"' || lpad(CAST(user_id AS VARCHAR), 11, '0') || '","","4","' || CAST(event_id % 90 AS VARCHAR) || '","23.45","'
|| CASE WHEN event_type = 'view' THEN '9999' ELSE '5.0' END || '","USER ' || CAST(user_id AS VARCHAR) || ', '
|| upper(event_type) || '","FM-12","99999","V020","270,1,N,'
|| lpad(CAST(CAST(floor(value * 10) AS BIGINT) % 10000 AS VARCHAR), 4, '0') || ','
|| CASE WHEN event_type = 'purchase' THEN '3' ELSE '1' END || '","99999,9,9,N","'
|| lpad(CAST(CAST(floor(value * 100) AS BIGINT) % 1000000 AS VARCHAR), 6, '0') || ',1,N,9","'
|| CASE WHEN value >= 0 THEN '+' ELSE '-' END
|| lpad(CAST(CAST(floor(abs(value) * 10) AS BIGINT) % 10000 AS VARCHAR), 4, '0') || ',1","+9999,9","10200,1","08,99,1"'
"""

NORMALIZE_DEAD_LETTERS = f"""
SELECT 'DATE is missing or not yyyy-MM-ddTHH:mm:ss' AS error, {_RAW_LINE} AS raw_message,
       'events.parquet' AS source_file, event_id + 2 AS row_number
FROM events WHERE event_type = 'error'
"""


def _in_range(c: str) -> str:
    return f"{c} BETWEEN {FROM} AND {TO}"


SERVE = {
    "serve_stats": f"""SELECT window_end AS time, {_label('user_id')} AS station, avg_value, min_value, max_value
        FROM ({INTERVAL_STATS}) WHERE {_in_range('window_end')} AND window_size = '24h' ORDER BY window_end""",
    "serve_quality": f"""SELECT window_end AS time, {_label('user_id')} AS metric, bad_count AS value
        FROM ({PREDICATE_COUNT}) WHERE {_in_range('window_end')} ORDER BY window_end""",
    "serve_change": f"""SELECT event_time AS time, {_label('user_id')} AS metric, change_per_hour AS value
        FROM ({RATE_CHANGE}) WHERE {_in_range('event_time')} ORDER BY event_time""",
    "serve_gaps": f"""SELECT interval_end AS time, {_label('user_id')} AS metric, status AS value
        FROM ({GAP_STATUS}) WHERE {_in_range('interval_end')} ORDER BY interval_end""",
    "serve_deviation": f"""SELECT window_end AS time, {_label('user_id')} AS station, deviation
        FROM ({BASELINE_DEVIATION}) WHERE {_in_range('window_end')} ORDER BY window_end""",
    "serve_ranking": f"""WITH r AS ({TOP_EXTREMES})
        SELECT CAST(rank_position AS VARCHAR) || '. ' || {_label('user_id')} AS label, value, rank_position
        FROM r WHERE list_name = 'hottest' AND window_end = (SELECT max(window_end) FROM r) ORDER BY rank_position""",
    "serve_trend": f"""SELECT window_end AS time, {_label('user_id')} AS metric, trend_direction
        FROM ({MOVING_TREND}) WHERE {_in_range('window_end')} ORDER BY window_end""",
    "serve_notifications": f"""SELECT event_time AS time, {_label('resort_id')} AS resort_station, user_id AS "user",
        booking_id AS booking_ref, alert AS alert_type, value AS reading
        FROM ({BOOKING_ALERTS}) WHERE {_in_range('event_time')} ORDER BY event_time DESC""",
    "serve_periods": f"""SELECT period_start AS start_time, period_end AS end_time, {_label('user_id')} AS station,
        duration_hours AS duration_h FROM ({LOW_PERIODS}) WHERE {_in_range('period_end')} ORDER BY duration_hours DESC""",
    "serve_alerts": f"""SELECT window_end AS alert_time, {_label('user_id')} AS station, alert AS status,
        max_drop_per_hour AS drop_per_hour, max_level FROM ({COMPOSITE_ALERTS}) WHERE {_in_range('window_end')}
        ORDER BY window_end DESC""",
}

_BROKEN = "CASE event_type WHEN 'error' THEN 'not json ' || event_id WHEN 'signup' THEN '{\"row_number\": ' || event_id || '}'"

RAW_EVENT_DEAD_LETTERS = f"""
SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'not a raw event' ELSE 'empty line' END AS error,
       {_BROKEN} ELSE '{{"source_file":"f","row_number":' || event_id || ',"raw_line":""}}' END AS message
FROM events WHERE event_type IN ('error', 'signup', 'view')
"""

READING_DEAD_LETTERS = f"""
SELECT CASE event_type WHEN 'error' THEN 'not a reading' ELSE 'date is missing or not yyyy-MM-ddTHH:mm:ss' END AS error,
       {_BROKEN} ELSE '{{"station": "' || user_id || '", "date": "yesterday"}}' END AS message
FROM events WHERE event_type IN ('error', 'signup', 'view')
"""

ORACLE = {
    "interval_stats": INTERVAL_STATS,
    "predicate_count": PREDICATE_COUNT,
    "predicate_count_expand": PREDICATE_COUNT,
    "predicate_count_panes": PREDICATE_COUNT,
    "rate_change": RATE_CHANGE,
    "gap_status": GAP_STATUS,
    "baseline_deviation": BASELINE_DEVIATION,
    "baseline_deviation_table": BASELINE_DEVIATION_TABLE,
    "baseline_deviation_panes": BASELINE_DEVIATION,
    "top_extremes": TOP_EXTREMES,
    "moving_trend": MOVING_TREND,
    "booking_alerts": BOOKING_ALERTS,
    "booking_alerts_long": BOOKING_ALERTS_LONG,
    "departure_weather": DEPARTURE_WEATHER,
    "yearly_deviation": YEARLY_DEVIATION,
    "yearly_percentiles": YEARLY_PERCENTILES,
    "daily_slopes": DAILY_SLOPES,
    "low_periods": LOW_PERIODS,
    "composite_alerts": COMPOSITE_ALERTS,
    "rate_change_carried": RATE_CHANGE,
    "gap_status_carried": GAP_STATUS,
    "low_periods_carried": LOW_PERIODS,
    "rate_change_split": RATE_CHANGE,
    "low_periods_split": LOW_PERIODS,
    "composite_alerts_split": COMPOSITE_ALERTS,
    "normalized_readings": NORMALIZED_READINGS,
    "normalize_dead_letters": NORMALIZE_DEAD_LETTERS,
    "raw_event_dead_letters": RAW_EVENT_DEAD_LETTERS,
    "reading_dead_letters": READING_DEAD_LETTERS,
    **SERVE,
}
