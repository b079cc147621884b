"""The windowed analytics (UC01, 02, 05, 06, 07) and temperature slopes over
stored panes of readings: see ``cirrus.sources.panes``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.functions.baseline import formula_baseline
from cirrus.operators.rank import top_n_both_ends
from cirrus.operators.sequence import exact, trend
from cirrus.sources.panes import PaneStore
from cirrus.plans.usecases import K, T, bad_temperature

PANE = "10 minutes"


def reading_panes(spark: SparkSession, path: str) -> PaneStore:
    """Per station and ten minutes: least, highest, exact sum and number of
    temperatures, and the readings without a valid one."""
    temp = F.col("temperature.value_celsius")
    aggs = [("low", "min", temp), ("high", "max", temp), ("mean", "avg", exact(temp)), ("bad_count", "sum", F.when(bad_temperature(), 1).otherwise(0))]
    return PaneStore(spark, path, K, T, PANE, aggs)


def temperature_stats(store: PaneStore, sizes=(("1h", "1 hour"), ("24h", "24 hours")), **days) -> DataFrame:
    out = None
    for label, size in sizes:
        w = store.windows(size, size, ["low", "high", "mean"], only="mean", **days).select(
            K, F.lit(label).alias("window_size"), "window_start", "window_end", F.col("low").alias("min_temp_c"), F.col("high").alias("max_temp_c"), F.col("mean").cast("double").alias("avg_temp_c")
        )
        out = w if out is None else out.unionByName(w)
    return out


def data_quality(store: PaneStore, size: str = "1 hour", slide: str = "10 minutes", **days) -> DataFrame:
    return store.windows(size, slide, ["bad_count"], **days)


def temperature_deviation(store: PaneStore, size: str = "24 hours", slide: str = "1 hour", **days) -> DataFrame:
    w = store.windows(size, slide, ["mean"], only="mean", **days)
    return w.select(K, "window_start", "window_end", (F.col("mean").cast("double") - formula_baseline(F.col(K))).alias("deviation_c"))


def temperature_rankings(store: PaneStore, n: int = 10, size: str = "24 hours", slide: str = "1 hour", **days) -> DataFrame:
    return top_n_both_ends(store.windows(size, slide, ["low", "high"], only="mean", **days), K, "high", "low", n, "temp_c", many_keys=True)


def climate_trend(store: PaneStore, size: str = "30 days", slide: str = "10 days", **days) -> DataFrame:
    w = store.windows(size, slide, ["mean"], only="mean", **days).withColumn("avg_temp_c", F.col("mean").cast("double"))
    return trend(w, K, "window_start", "avg_temp_c").select(K, "window_start", "window_end", "avg_temp_c", "trend_direction")


ANALYTICS = {"uc01": temperature_stats, "uc02": data_quality, "uc05": temperature_deviation, "uc06": temperature_rankings, "uc07": climate_trend}
