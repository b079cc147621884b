"""Serving queries (S01-S10): Spark SQL over the result tables, one per
dashboard panel.  Each takes the time range of the panel; S01 and S06 also
take their template variable (window size, ranking list).

``register_results`` exposes result DataFrames (batch results or keyed
tables read with ``cirrus.sources.sinks.read_table``) as temporary views
under the result-table names of ``cirrus.schema.SINKS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.schema import SINKS
from cirrus.sources.levels import LevelledTable


def _label(c: str) -> str:
    return f"substr({c}, 1, 6) || '-' || substr({c}, 7)"


def _range(c: str) -> str:
    return f"{c} BETWEEN timestamp(:t_from) AND timestamp(:t_to)"


SERVING_SQL = {
    "s01": f"""SELECT window_end AS time, {_label('station')} AS station, avg_temp_c, min_temp_c, max_temp_c
        FROM temperature_stats WHERE {_range('window_end')} AND window_size = :window_size ORDER BY window_end ASC""",
    "s02": f"""SELECT window_end AS time, {_label('station')} AS metric, bad_count AS value
        FROM data_quality WHERE {_range('window_end')} ORDER BY window_end ASC""",
    "s03": f"""SELECT event_time AS time, {_label('station')} AS metric, change_c_per_hour AS value
        FROM temperature_change WHERE {_range('event_time')} ORDER BY event_time ASC""",
    "s04": f"""SELECT interval_end AS time, {_label('station')} AS metric, status AS value
        FROM data_gaps WHERE {_range('interval_end')} ORDER BY interval_end ASC""",
    "s05": f"""SELECT window_end AS time, {_label('station')} AS station, deviation_c
        FROM temperature_deviation WHERE {_range('window_end')} ORDER BY window_end ASC""",
    "s06": f"""SELECT CAST(rank_position AS STRING) || '. ' || {_label('station')} AS label, temp_c
        FROM temperature_rankings
        WHERE list_name = :list_name AND window_end = (SELECT max(window_end) FROM temperature_rankings)
        ORDER BY rank_position ASC""",
    "s07": f"""SELECT window_end AS time, {_label('station')} AS metric, trend_direction
        FROM climate_trend WHERE {_range('window_end')} ORDER BY window_end ASC""",
    "s08": f"""SELECT event_time AS time, {_label('resort_id')} AS resort_station, user_id AS user,
        booking_id AS booking_ref, alert AS alert_type, wind_mps, visibility_m
        FROM user_notifications WHERE {_range('event_time')} ORDER BY event_time DESC""",
    "s09": f"""SELECT period_start AS start_time, period_end AS end_time, {_label('station')} AS station,
        duration_hours AS duration_h FROM low_visibility WHERE {_range('period_end')} ORDER BY duration_hours DESC""",
    "s10": f"""SELECT window_end AS alert_time, {_label('station')} AS station, alert AS status,
        pressure_drop_hpa_per_hour AS pressure_drop_hpa_per_hour, max_wind_kmh
        FROM storm_warning WHERE {_range('window_end')} ORDER BY window_end DESC""",
}

# Display bands of the panels (column, ascending thresholds).
BANDS = {"s02": ("value", (0, 1, 5)), "s03": ("value", (-2, 0, 2)), "s10": ("max_wind_kmh", (100,))}


def register_results(spark: SparkSession, results: dict[str, DataFrame]) -> None:
    """``results`` maps use-case ids (uc01..uc10) to result DataFrames."""
    for uc, df in results.items():
        df.createOrReplaceTempView(SINKS[uc].name)


def serve_stored(spark: SparkSession, root: str, query: str, t_from: str, t_to: str, window_size: str = "24h", list_name: str = "hottest", bands: bool = False) -> DataFrame:
    """Serving query over the stored table under ``root``: only the files of
    the days that the panel shows are read, of S06 those of the last day."""
    uc = f"uc{query[1:]}"
    spec = SINKS[uc]
    table = LevelledTable(spark, spec, f"{root.rstrip('/')}/{spec.name}")
    since, until = t_from[:10], t_to[:10]
    if query == "s06":
        since = until = max(table.days(), default=None)
    if spec.day == "period_start":  # filed under the start, shown by the end
        since = None
    register_results(spark, {uc: table.read(since, until)})
    return serve(spark, query, t_from, t_to, window_size, list_name, bands)


def serve(
    spark: SparkSession, query: str, t_from: str, t_to: str, window_size: str = "24h", list_name: str = "hottest", bands: bool = False
) -> DataFrame:
    """Run serving query ``query``; with ``bands`` the panels that colour by
    threshold get a ``band`` column: the number of thresholds the value reaches."""
    sql = SERVING_SQL[query]
    args = {"t_from": t_from, "t_to": t_to, "window_size": window_size, "list_name": list_name}
    used = {k: v for k, v in args.items() if f":{k}" in sql}
    df = spark.sql(sql, args=used)
    if bands and query in BANDS:
        col, steps = BANDS[query]
        band = sum((F.when(F.col(col) >= F.lit(t), 1).otherwise(0) for t in steps), F.lit(0))
        df = df.withColumn("band", band)
    return df
