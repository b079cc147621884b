"""Stored panes: mergeable partial aggregates per (key, pane), kept on disk by
day, so that windows over years are made without reading readings again and a
run adds the days that are new.

A pane store is a folder ``day=<date>/`` of Parquet files with one row per
(key, pane): what :func:`cirrus.operators.windows.pane_aggregate` gives for
the store's aggregates, and how many rows there were.  Days are replaced as a whole, so a run that is
repeated, or a day that is refreshed because late readings came, leaves the
same store.  Windows of any size and slide that panes fit into are merged
from panes (``merge_blocks``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.functions.timeops import duration_seconds, floor_time
from cirrus.operators.windows import AggSpec, _running, merge_blocks, pane_aggregate, pane_parts
from cirrus.sources import files


class PaneStore:
    """``aggs``: (name, sum | count | min | max | avg, column or expression),
    as for :func:`cirrus.operators.windows.sliding_agg`; ``every``: length of
    a pane, a divisor of a day."""

    def __init__(self, spark: SparkSession, path: str, key: str, time: str, every: str, aggs: Sequence[AggSpec]):
        if 86_400 % duration_seconds(every):
            raise ValueError(f"panes of {every} don't fit a day")
        self.spark, self.path, self.key, self.time, self.every = spark, path.rstrip("/"), key, time, every
        self.aggs = [*aggs, ("_rows", "count", F.lit(1))]

    def days(self) -> list[str]:
        return sorted(n.removeprefix("day=") for n in files.names_in(self.spark, self.path) if n.startswith("day="))

    def add(self, readings: DataFrame, available: Sequence[str], refresh: Sequence[str] = ()) -> list[str]:
        """Adds the days in ``available`` that the store lacks, and those in
        ``refresh`` again, from ``readings`` with a partition column ``day``
        (yyyy-MM-dd): the files of other days are not read.  Returns them."""
        new = sorted((set(available) - set(self.days())) | set(refresh))
        if new:
            day = F.col("day").cast("string")
            rows = readings.where(F.col("day").isin(new) if dict(readings.dtypes)["day"] == "string" else F.col("day").isin([F.lit(d).cast("date") for d in new]))
            panes = pane_aggregate(rows.withColumn("day", day), [self.key, "day"], self.time, self.every, self.aggs)
            writer = panes.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("day").parquet(self.path)
        return new

    def panes(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """(key, _pane, partial columns), of the days ``since`` .. ``until``."""
        out = self.spark.read.parquet(self.path)
        if since:
            out = out.where(F.col("day") >= F.lit(since).cast("date"))
        if until:
            out = out.where(F.col("day") <= F.lit(until).cast("date"))
        return out.drop("day")

    def windows(self, size: str, slide: str, names: Sequence[str], only: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """(key, window_start, window_end, aggregates ``names``): the windows
        that have a row, or a value counted by the avg or count ``only``.  With ``since`` / ``until``
        the windows that end on these days at midnight or later, and start on
        them or earlier, are complete."""
        if duration_seconds(slide) % duration_seconds(self.every):
            raise ValueError(f"a slide of {slide} isn't made of panes of {self.every}")
        aggs = [a for a in self.aggs if a[0] in names]
        panes = self.panes(earlier(since, size), until)
        if only:
            kind = next(k for n, k, _ in self.aggs if n == only)
            panes = panes.where(F.col(f"{only}_n" if kind == "avg" else f"{only}_p") > 0)
        panes = panes.select(self.key, "_pane", *pane_parts(aggs))
        if duration_seconds(slide) > duration_seconds(self.every):  # panes as long as the slide
            merged = [fn(c).alias(c) for c, fn in _running(aggs)]
            panes = panes.groupBy(self.key, floor_time("_pane", slide).alias("_at")).agg(*merged).withColumnRenamed("_at", "_pane")
        return merge_blocks(panes, self.key, "_pane", size, slide, aggs).select(self.key, "window_start", "window_end", *names)


def earlier(day: str | None, size: str) -> str | None:
    """The day on which a window that ends on ``day`` may begin."""
    return str(date.fromisoformat(day) - timedelta(seconds=duration_seconds(size) + 86_399)) if day else None
