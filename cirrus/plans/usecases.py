"""The ten analytics over weather readings (batch).

Input: readings with ``event_time`` (see ``cirrus.sources.readings``);
output: the columns of the matching result table in ``cirrus.schema.SINKS``.
Each is a thin binding of the generic operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.functions.baseline import formula_baseline
from cirrus.operators.asof import since_baseline
from cirrus.operators.composite import composite_event
from cirrus.operators.join import interval_join
from cirrus.functions.timeops import duration_seconds
from cirrus.operators.rank import top_n_both_ends, top_n_sliding
from cirrus.operators.sequence import exact, gap_status, rate_of_change, threshold_periods, trend
from cirrus.operators.windows import sliding_agg, tumbling_stats
from cirrus.sources.readings import arrival_order

K, T = "station", "event_time"


def _temp():
    return F.col("temperature.value_celsius")


# Fixed thresholds of the alerts.
VISIBILITY_THRESHOLD_M = 200
WIND_ALERT_MPS, VISIBILITY_ALERT_M = 18.0, 500
PRESSURE_DROP_HPA_PER_HOUR, WIND_THRESHOLD_KMH = 5.0, 80.0
MPS_TO_KMH = 3.6


def bad_temperature():
    return ~F.coalesce(F.col("temperature.is_valid"), F.lit(False))


def _temps(readings: DataFrame) -> DataFrame:
    """Readings with a temperature value (no validity test, as in the
    reference's use of the value)."""
    return readings.where(_temp().isNotNull()).select(K, T, *arrival_order(readings), _temp().alias("temp_c"))


def temperature_stats(readings: DataFrame, sizes=(("1h", "1 hour"), ("24h", "24 hours"))) -> DataFrame:
    """UC01: min / max / avg temperature per station and tumbling window."""
    return tumbling_stats(_temps(readings), K, T, "temp_c", sizes, ("min_temp_c", "max_temp_c", "avg_temp_c"))


def data_quality(readings: DataFrame, size: str = "1 hour", slide: str = "10 minutes", bad=None, strategy: str = "auto") -> DataFrame:
    """UC02: readings without a valid temperature per sliding window (zero
    counts kept)."""
    bad = bad if bad is not None else bad_temperature()
    x = readings.select(K, T, F.when(bad, 1).otherwise(0).alias("_bad"))
    out = sliding_agg(x, K, T, size, slide, [("bad_count", "sum", "_bad")], strategy)
    return out.withColumn("bad_count", F.col("bad_count").cast("bigint"))


def temperature_change(readings: DataFrame, per_seconds: float = 3600.0) -> DataFrame:
    """UC03: change of temperature per hour between consecutive readings."""
    x = _temps(readings)
    out = rate_of_change(x, K, T, "temp_c", arrival_order(x), "change_c_per_hour", per_seconds)
    return out.select(K, T, "change_c_per_hour")


def data_gaps(readings: DataFrame, max_gap: str = "1 hour") -> DataFrame:
    """UC04: every consecutive pair of readings, complete or incomplete."""
    return gap_status(readings.select(K, T, *arrival_order(readings)), K, T, arrival_order(readings), max_gap)


def temperature_deviation(readings: DataFrame, size: str = "24 hours", slide: str = "1 hour", baseline: DataFrame | None = None, strategy: str = "auto") -> DataFrame:
    """UC05: rolling average minus the station's historical baseline: the
    built-in formula, a table (station, baseline) joined in, or one of
    ``asof.yearly_baselines``, of which each window takes the last that was
    known when it began."""
    w = sliding_agg(_temps(readings), K, T, size, slide, [("avg_temp_c", "avg", "temp_c")], strategy)
    if baseline is None:
        return w.select(K, "window_start", "window_end", (F.col("avg_temp_c") - formula_baseline(F.col(K))).alias("deviation_c"))
    if "known_from" in baseline.columns:
        known = since_baseline(w, baseline, K, "window_start", F.col("avg_temp_c"), bucket="365 days")
        return known.select(K, "window_start", "window_end", F.col("deviation").alias("deviation_c"))
    b = baseline.select(K, F.col(baseline.columns[1]).alias("_base"))
    return w.join(b, K, "left").select(K, "window_start", "window_end", (F.col("avg_temp_c") - F.col("_base")).alias("deviation_c"))


def temperature_rankings(readings: DataFrame, n: int = 10, size: str = "24 hours", slide: str = "1 hour", strategy: str = "candidates") -> DataFrame:
    """UC06: per window, the n hottest stations (by max) and the n coldest
    (by min), ties by station.  ``candidates`` merges the lists of a window's
    panes (``top_n_sliding``); the others rank every (station, window)
    aggregate."""
    x = _temps(readings)
    if strategy == "candidates":
        if duration_seconds(size) % duration_seconds(slide):
            raise ValueError(f"candidates need a size that is a multiple of the slide, not {size} by {slide}")
        return top_n_sliding(x, K, T, "temp_c", size, slide, n, "temp_c")
    w = sliding_agg(x, K, T, size, slide, [("_hi", "max", "temp_c"), ("_lo", "min", "temp_c")], strategy)
    return top_n_both_ends(w, K, "_hi", "_lo", n, "temp_c")


def climate_trend(readings: DataFrame, size: str = "30 days", slide: str = "10 days", strategy: str = "auto") -> DataFrame:
    """UC07: moving average and its direction against the previous window
    (averages summed exactly, see ``exact``)."""
    x = _temps(readings).withColumn("temp_c", exact(F.col("temp_c")))
    w = sliding_agg(x, K, T, size, slide, [("avg_temp_c", "avg", "temp_c")], strategy)
    w = w.withColumn("avg_temp_c", F.col("avg_temp_c").cast("double"))
    return trend(w, K, "window_start", "avg_temp_c").select(K, "window_start", "window_end", "avg_temp_c", "trend_direction")


def user_notifications(readings: DataFrame, bookings: DataFrame) -> DataFrame:
    """UC08: bad conditions at a booked resort during the booking."""
    weather = readings.where(F.col("wind.speed_rate").isNotNull() & F.col("visibility.distance_meters").isNotNull()).select(
        K, T, F.col("wind.speed_rate").alias("wind_mps"), F.col("visibility.distance_meters").alias("visibility_m")
    )
    j = interval_join(weather, bookings, K, "resort_id", T, "booking_start", "booking_end")
    return j.where((F.col("wind_mps") > WIND_ALERT_MPS) | (F.col("visibility_m") < VISIBILITY_ALERT_M)).select(
        "user_id", "booking_id", "resort_id", T, F.lit("bad_conditions").alias("alert"), "wind_mps", "visibility_m"
    )


def low_visibility(readings: DataFrame, threshold: float = VISIBILITY_THRESHOLD_M) -> DataFrame:
    """UC09: closed periods of visibility below the threshold."""
    x = readings.where(F.col("visibility.distance_meters").isNotNull()).select(
        K, T, *arrival_order(readings), F.col("visibility.distance_meters").alias("visibility_m")
    )
    return threshold_periods(x, K, T, "visibility_m", threshold, arrival_order(x))


def storm_readings(readings: DataFrame) -> DataFrame:
    """Readings with valid pressure and wind speed (UC10 input)."""
    ok = (
        F.coalesce(F.col("sea_level_pressure.is_valid"), F.lit(False))
        & F.coalesce(F.col("wind.speed_is_valid"), F.lit(False))
        & F.col("sea_level_pressure.value_hpa").isNotNull()
        & F.col("wind.speed_rate").isNotNull()
    )
    return readings.where(ok).select(
        K, T, *arrival_order(readings),
        F.col("sea_level_pressure.value_hpa").alias("pressure_hpa"),
        (F.col("wind.speed_rate") * F.lit(MPS_TO_KMH)).alias("wind_kmh"),
    )


def storm_warning(readings: DataFrame, size: str = "60 minutes", slide: str = "10 minutes", strategy: str = "auto") -> DataFrame:
    """UC10: falling pressure and strong wind within one sliding window."""
    x = storm_readings(readings)
    out = composite_event(
        x, K, T, F.col("pressure_hpa"), F.col("wind_kmh"), PRESSURE_DROP_HPA_PER_HOUR, WIND_THRESHOLD_KMH, size, slide,
        "storm_event", arrival_order(x), ("pressure_drop_hpa_per_hour", "max_wind_kmh"), strategy,
    )
    return out.select(K, "window_start", "window_end", "pressure_drop_hpa_per_hour", "max_wind_kmh", "alert")


ANALYTICS = {
    "uc01": temperature_stats,
    "uc02": data_quality,
    "uc03": temperature_change,
    "uc04": data_gaps,
    "uc05": temperature_deviation,
    "uc06": temperature_rankings,
    "uc07": climate_trend,
    "uc09": low_visibility,
    "uc10": storm_warning,
}
