"""Composite event (UC10): a per-key sequential rate feeding a sliding window
with a post-aggregate predicate.

1. K5 - for each reading whose predecessor is strictly earlier:
   drop = (previous falling-value - falling-value) * 3600 / seconds, with the
   *current* reading's level; the key's first reading emits nothing.
2. G6 - sliding windows over those drop rows: max(drop), max(level)
   (independent maxima, not taken from one row).
3. G7 - keep windows with max drop > drop_threshold and max level >
   level_threshold (both strict).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.functions.timeops import seconds_between
from cirrus.operators.sequence import DEFAULT_BUCKET, DEFAULT_MAX_ROWS_PER_BUCKET, previous_row
from cirrus.operators.windows import sliding_agg


def drop_rows(
    df: DataFrame,
    key: str,
    time: str,
    falling: Column,
    level: Column,
    tiebreak: Sequence[str] = (),
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Every reading with its drop per hour and level, both null for those
    whose predecessor (a key's first one's: that in ``initial``) isn't
    strictly earlier."""
    x = df.select(key, time, *tiebreak, falling.alias("_f"), level.alias("_lvl"))
    x = previous_row(x, key, time, ["_f"], tiebreak, "_prev", bucket, max_rows_per_bucket, initial)
    sec = seconds_between(F.col("_prev").getField(time), F.col(time))
    drop = (F.col("_prev").getField("_f") - F.col("_f")) * F.lit(3600.0) / sec
    return x.select(key, time, F.when(sec > 0, drop).alias("drop_per_hour"), F.when(sec > 0, F.col("_lvl")).alias("level"))


def rate_drops(df: DataFrame, key: str, time: str, falling: Column, level: Column, *args, **kwargs) -> DataFrame:
    return drop_rows(df, key, time, falling, level, *args, **kwargs).where(F.col("drop_per_hour").isNotNull())


def composite_event(
    df: DataFrame,
    key: str,
    time: str,
    falling: Column,
    level: Column,
    drop_threshold: float = 5.0,
    level_threshold: float = 80.0,
    size: str = "60 minutes",
    slide: str = "10 minutes",
    alert: str = "storm_event",
    tiebreak: Sequence[str] = (),
    names: tuple[str, str] = ("max_drop_per_hour", "max_level"),
    strategy: str = "auto",
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
) -> DataFrame:
    drops = rate_drops(df, key, time, falling, level, tiebreak, bucket, max_rows_per_bucket)
    d, lv = names
    w = sliding_agg(drops, key, time, size, slide, [(d, "max", "drop_per_hour"), (lv, "max", "level")], strategy)
    return w.where((F.col(d) > F.lit(drop_threshold)) & (F.col(lv) > F.lit(level_threshold))).withColumn(
        "alert", F.lit(alert)
    )
