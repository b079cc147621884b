"""Schemas: the nested reading, dead letters and the ten result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, D, I, L, B, T = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType(), TimestampType()


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


WIND = _struct(("direction_angle", I), ("direction_quality", S), ("type", S), ("speed_rate", D), ("speed_quality", S), ("speed_is_valid", B))
CEILING = _struct(("height_meters", I), ("quality", S), ("determination", S), ("cavok", S), ("is_valid", B))
VISIBILITY = _struct(("distance_meters", I), ("quality", S), ("variability", S), ("variability_quality", S), ("is_valid", B))
TEMPERATURE = _struct(("value_celsius", D), ("quality", S), ("is_valid", B))
PRESSURE = _struct(("value_hpa", D), ("quality", S), ("is_valid", B))

# The reading document as it travels between jobs (JSON, one per line).
READING = _struct(
    ("station", S), ("date", S), ("source", S), ("latitude", D), ("longitude", D), ("elevation", D),
    ("name", S), ("report_type", S), ("call_sign", S), ("quality_control", S),
    ("wind", WIND), ("ceiling", CEILING), ("visibility", VISIBILITY),
    ("temperature", TEMPERATURE), ("dew_point", TEMPERATURE), ("sea_level_pressure", PRESSURE),
)
# Normaliser output also carries the raw columns and the arrival position.
NORMALIZED = StructType(
    READING.fields
    + [
        StructField("columns", MapType(S, S), True),
        StructField("source_file", S, True),
        StructField("row_number", L, True),
    ]
)
RAW_EVENT = _struct(("source_file", S), ("row_number", L), ("raw_line", S))
DEAD_LETTER = _struct(("error", S), ("raw_message", S), ("source_file", S), ("row_number", L))


@dataclass(frozen=True)
class SinkSpec:
    """A result table: name, columns (which of them may be null), primary key
    (rows with an equal key are upserts of each other) and the time whose day
    its rows are filed under (determined by the key)."""

    name: str
    schema: StructType
    primary_key: tuple[str, ...]
    day: str


def _sink(name: str, cols: list[tuple[str, DataType]], pk: list[str], day: str = "window_end", may_be_null: tuple[str, ...] = ()) -> SinkSpec:
    return SinkSpec(name, StructType([StructField(n, t, n in may_be_null) for n, t in cols]), tuple(pk), day)


SINKS = {
    "uc01": _sink("temperature_stats", [("station", S), ("window_size", S), ("window_start", T), ("window_end", T), ("min_temp_c", D), ("max_temp_c", D), ("avg_temp_c", D)], ["station", "window_size", "window_start"], may_be_null=("min_temp_c", "max_temp_c", "avg_temp_c")),
    "uc02": _sink("data_quality", [("station", S), ("window_start", T), ("window_end", T), ("bad_count", L)], ["station", "window_start"]),
    "uc03": _sink("temperature_change", [("station", S), ("event_time", T), ("change_c_per_hour", D)], ["station", "event_time"], "event_time"),
    "uc04": _sink("data_gaps", [("station", S), ("interval_start", T), ("interval_end", T), ("status", S)], ["station", "interval_end"], "interval_end"),
    "uc05": _sink("temperature_deviation", [("station", S), ("window_start", T), ("window_end", T), ("deviation_c", D)], ["station", "window_start"]),
    "uc06": _sink("temperature_rankings", [("station", S), ("window_start", T), ("window_end", T), ("list_name", S), ("rank_position", L), ("temp_c", D)], ["window_start", "list_name", "rank_position"]),
    "uc07": _sink("climate_trend", [("station", S), ("window_start", T), ("window_end", T), ("avg_temp_c", D), ("trend_direction", S)], ["station", "window_start"]),
    "uc08": _sink("user_notifications", [("user_id", S), ("booking_id", S), ("resort_id", S), ("event_time", T), ("alert", S), ("wind_mps", D), ("visibility_m", I)], ["user_id", "booking_id", "event_time"], "event_time", ("wind_mps", "visibility_m")),
    "uc09": _sink("low_visibility", [("station", S), ("period_start", T), ("period_end", T), ("duration_hours", L)], ["station", "period_start"], "period_start"),
    "uc10": _sink("storm_warning", [("station", S), ("window_start", T), ("window_end", T), ("pressure_drop_hpa_per_hour", D), ("max_wind_kmh", D), ("alert", S)], ["station", "window_start"]),
}
