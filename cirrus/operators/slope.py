"""Slopes of a reading over sliding windows, and forecasts from them.

Least squares over a window needs the count, the means and the centred second
moments of time and value.  They are kept per pane and merged (the pairwise
update of means and centred moments), so readings are passed once whatever
the windows, and no large sums cancel.  A window of blocks is the merge of
the panes of the end of one block and of the beginning of the next, see
``cirrus.operators.windows``; here a window's panes, at most size / slide
rows, are merged in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.functions.timeops import MICROS_PER_SECOND, duration_seconds, floor_time


def pane_moments(df: DataFrame, key: str, time: str, value: str, every: str) -> DataFrame:
    """(key, _pane, n, mt, mv, stt, stv, svv): count, means (time in hours
    since the pane's start) and centred sums of squares and products."""
    x = df.where(F.col(value).isNotNull()).select(key, floor_time(time, every).alias("_pane"), F.col(time).alias("_at"), F.col(value).cast("double").alias("_v"))
    hours = F.timestamp_diff("MICROSECOND", F.col("_pane"), F.col("_at")) / F.lit(3600.0 * MICROS_PER_SECOND)
    return x.groupBy(key, "_pane").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(hours).alias("mt"),
        F.avg("_v").alias("mv"),
        F.regr_sxx(F.col("_v"), hours).alias("stt"),
        F.regr_sxy(F.col("_v"), hours).alias("stv"),
        F.regr_syy(F.col("_v"), hours).alias("svv"),
    )


def _merged(a: Column, b: Column) -> Column:
    """Moments of two sets together; b may be shifted in time beforehand."""
    n = a["n"] + b["n"]
    dt, dv, share = b["mt"] - a["mt"], b["mv"] - a["mv"], a["n"] * b["n"] / n
    mean = lambda m, d: (a[m] + d * b["n"] / n).alias(m)
    both = lambda m, d: (a[m] + b[m] + d * share).alias(m)
    return F.struct(n.alias("n"), mean("mt", dt), mean("mv", dv), both("stt", dt * dt), both("stv", dt * dv), both("svv", dv * dv))


def sliding_slope(df: DataFrame, key: str, time: str, value: str, size: str, slide: str, ahead: str = "1 hour") -> DataFrame:
    """(key, window_start, window_end, n, slope_per_hour, r2, forecast): least
    squares of ``value`` over time in every sliding window with two different
    times, and its value ``ahead`` of the window's end.  Null values don't
    count.  ``size`` is a multiple of ``slide``."""
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    if size_s % slide_s:
        raise ValueError(f"panes need a size that is a multiple of the slide, not {size} by {slide}")
    panes = pane_moments(df, key, time, value, slide)
    back = F.make_dt_interval(secs=(F.col("_i") * F.lit(slide_s)).cast("decimal(18,6)"))
    copies = panes.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1)))).withColumn("window_start", F.col("_pane") - back)
    # times since the window's start
    one = F.struct("_i", F.col("n").cast("double").alias("n"), (F.col("mt") + F.col("_i") * F.lit(slide_s / 3600.0)).alias("mt"), "mv", "stt", "stv", "svv")
    windows = copies.groupBy(key, "window_start").agg(F.array_sort(F.collect_list(one)).alias("_panes"))
    bare = lambda x: F.struct(*[x[c].alias(c) for c in ("n", "mt", "mv", "stt", "stv", "svv")])
    windows = windows.withColumn("_w", F.aggregate(F.slice("_panes", 2, 1 << 30), bare(F.col("_panes")[0]), lambda a, b: _merged(a, bare(b))))
    slope = F.col("_w.stv") / F.col("_w.stt")
    then = F.lit((size_s + duration_seconds(ahead)) / 3600.0)
    out = windows.where(F.col("_w.stt") > 0).select(
        key,
        "window_start",
        (F.col("window_start") + F.make_dt_interval(secs=F.lit(size_s).cast("decimal(18,6)"))).alias("window_end"),
        F.col("_w.n").cast("long").alias("n"),
        slope.alias("slope_per_hour"),
        F.when(F.col("_w.svv") > 0, slope * F.col("_w.stv") / F.col("_w.svv")).alias("r2"),
        (F.col("_w.mv") + slope * (then - F.col("_w.mt"))).alias("forecast"),
    )
    return out
