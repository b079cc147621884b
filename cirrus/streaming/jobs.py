"""Streaming forms of the ten analytics.

Input: a streaming readings DataFrame with ``event_time`` (see
``cirrus.sources.readings.read_readings(stream=True)`` or ``parse_readings``
over a message stream).  Each builder returns ``(stream, then)``: ``stream``
is what Spark computes continuously, ``then`` (optional) what happens to each
of its micro-batches before the upsert: a function of the batch (ranking,
which Spark does not allow on a stream), or :class:`Carried`, a step that also
has the keys' state.

* Windows: native event-time windows in append mode, emitted once when the
  watermark (event time - 5 minutes) passes the window end.  Watermarks
  start at 1970-01-01, so event times are shifted forward by a whole number
  of the job's slides (``epoch_shift``) before the watermark and back
  afterwards; without it, readings from before 1970 would all be late.
* Sequential operators (K1-K4): the batch operator on each micro-batch, going
  on from the state that the keys carry (``cirrus.streaming.carry``).  Rows of
  a key are ordered by time inside a batch, by arrival across batches; late
  rows are processed, not dropped, and become the state, as in the reference.
* K5 feeds a window: two queries in a row, the first with the state, which
  no watermark touches, the second with the windows, which drop late rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.functions.baseline import formula_baseline
from cirrus.functions.timeops import epoch_shift
from cirrus.operators.composite import drop_rows
from cirrus.operators.rank import top_n_both_ends
from cirrus.operators.sequence import closed_periods, exact, gap_status, last_rows, open_periods, periods, rate_of_change, trend
from cirrus.operators.windows import sliding_agg
from cirrus.plans import usecases as U
from cirrus.schema import SINKS, SinkSpec
from cirrus.session import checkpoint_path
from cirrus.sources.readings import MAX_FILE_AGE, WATERMARK, arrival_order
from cirrus.sources.sinks import names_in, next_run, truncate, upsert_writer
from cirrus.streaming.carry import Carry, Step, stepped

K, T = "station", "event_time"


def watermarked(readings: DataFrame, delay: str, *slides: str) -> DataFrame:
    """Event time shifted past 1970 with a bounded-lateness watermark."""
    return readings.withColumn(T, F.col(T) + epoch_shift(*slides)).withWatermark(T, delay)


def _unshift(df: DataFrame, *slides: str) -> DataFrame:
    for c in ("window_start", "window_end"):
        df = df.withColumn(c, F.col(c) - epoch_shift(*slides))
    return df


@dataclass(frozen=True)
class Carried:
    """What happens to a micro-batch of a job with keyed state."""

    step: Step


def _window_stats(x: DataFrame, size: str, slide: str, aggs) -> DataFrame:
    return sliding_agg(x, K, T, size, slide, aggs, strategy="expand")


# --------------------------------------------------------------------- windows
def temperature_stats(readings: DataFrame, sizes=(("1h", "1 hour"), ("24h", "24 hours")), watermark: str = WATERMARK):
    slides = [size for _, size in sizes]
    x = U._temps(watermarked(readings, watermark, *slides)).select(K, T, "temp_c")
    parts = []
    for label, size in sizes:
        a = _window_stats(x, size, size, [("min_temp_c", "min", "temp_c"), ("max_temp_c", "max", "temp_c"), ("avg_temp_c", "avg", "temp_c")])
        parts.append(a.select(K, F.lit(label).alias("window_size"), "window_start", "window_end", "min_temp_c", "max_temp_c", "avg_temp_c"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _unshift(out, *slides), None


def data_quality(readings: DataFrame, size="1 hour", slide="10 minutes", watermark: str = WATERMARK):
    out = U.data_quality(watermarked(readings, watermark, slide), size, slide, strategy="expand")
    return _unshift(out, slide), None


def temperature_deviation(readings: DataFrame, size="24 hours", slide="1 hour", baseline: DataFrame | None = None, watermark: str = WATERMARK):
    """Rolling average minus the formula baseline, or minus a static baseline
    table (station, baseline) joined to the closed windows (stream-static)."""
    w = _window_stats(U._temps(watermarked(readings, watermark, slide)).select(K, T, "temp_c"), size, slide, [("avg_temp_c", "avg", "temp_c")])
    if baseline is None:
        out = w.select(K, "window_start", "window_end", (F.col("avg_temp_c") - formula_baseline(F.col(K))).alias("deviation_c"))
    else:
        b = baseline.select(K, F.col(baseline.columns[1]).alias("_base"))
        out = w.join(b, K, "left").select(K, "window_start", "window_end", (F.col("avg_temp_c") - F.col("_base")).alias("deviation_c"))
    return _unshift(out, slide), None


def temperature_rankings(readings: DataFrame, n: int = 10, size="24 hours", slide="1 hour", watermark: str = WATERMARK):
    """Per (window, station) maxima and minima are aggregated in the stream;
    all stations of a window close in the same micro-batch, where the top n
    of each end are ranked (batch window functions, partial group limit)."""
    w = _window_stats(U._temps(watermarked(readings, watermark, slide)).select(K, T, "temp_c"), size, slide, [("_hi", "max", "temp_c"), ("_lo", "min", "temp_c")])
    w = _unshift(w, slide)
    return w, lambda batch: top_n_both_ends(batch, K, "_hi", "_lo", n, "temp_c")


def climate_trend(readings: DataFrame, size="30 days", slide="10 days", watermark: str = WATERMARK):
    x = U._temps(watermarked(readings, watermark, slide)).select(K, T, exact(F.col("temp_c")).alias("temp_c"))
    w = _window_stats(x, size, slide, [("avg", "avg", "temp_c")])
    w = _unshift(w, slide).select(K, "window_start", "window_end", F.col("avg").cast("double").alias("avg_temp_c"))

    def step(batch, state):
        return trend(batch, K, "window_start", "avg_temp_c", initial=state), last_rows(batch, K, "window_start", ["avg_temp_c"])

    return w, Carried(step)


# ----------------------------------------------------------------- sequential
def temperature_change(readings: DataFrame, per_seconds: float = 3600.0):
    x = U._temps(readings)
    order = arrival_order(x)

    def step(batch, state):
        rates = rate_of_change(batch, K, T, "temp_c", order, "change_c_per_hour", per_seconds, initial=state)
        return rates, last_rows(batch, K, T, ["temp_c"], order)

    return x, Carried(step)


def data_gaps(readings: DataFrame, max_gap: str = "1 hour"):
    order = arrival_order(readings)
    return readings.select(K, T, *order), Carried(lambda batch, state: (gap_status(batch, K, T, order, max_gap, initial=state), last_rows(batch, K, T, [], order)))


def low_visibility(readings: DataFrame, threshold: float = U.VISIBILITY_THRESHOLD_M):
    order = arrival_order(readings)
    vis = F.col("visibility.distance_meters")
    x = readings.where(vis.isNotNull()).select(K, T, *order, vis.alias("visibility_m"))

    def step(batch, state):
        runs = periods(batch, K, T, "visibility_m", threshold, order, opened=state)
        return closed_periods(runs, K), open_periods(runs, K)

    return x, Carried(step)


def pressure_drops(readings: DataFrame):
    """First half of the storm warning: (station, time, drop per hour, wind)
    of every storm reading, drop and wind null for those without an earlier
    one, which only move the second half's watermark."""
    x = U.storm_readings(readings)
    order = arrival_order(x)

    def step(batch, state):
        drops = drop_rows(batch, K, T, F.col("pressure_hpa"), F.col("wind_kmh"), order, initial=state)
        before = batch.select(K, T, *order, F.col("pressure_hpa").alias("_f"))
        return drops, last_rows(before, K, T, ["_f"], order)

    return x, Carried(step)


def storm_warning(drops: DataFrame, size="60 minutes", slide="10 minutes", watermark: str = WATERMARK):
    """Second half: windows over a stream of :func:`pressure_drops`' rows."""
    x = watermarked(drops, watermark, slide)
    w = _window_stats(x, size, slide, [("pressure_drop_hpa_per_hour", "max", "drop_per_hour"), ("max_wind_kmh", "max", "level")])
    out = w.where(
        (F.col("pressure_drop_hpa_per_hour") > U.PRESSURE_DROP_HPA_PER_HOUR) & (F.col("max_wind_kmh") > U.WIND_THRESHOLD_KMH)
    ).withColumn("alert", F.lit("storm_event"))
    return _unshift(out, slide), None


# ----------------------------------------------------------------------- join
def user_notifications(readings: DataFrame, bookings: DataFrame):
    """Stream-static join: no join state is kept."""
    return U.user_notifications(readings, bookings), None


#: uc10 is a chain of two, see ``start``.
STREAM_JOBS = {
    "uc01": temperature_stats,
    "uc02": data_quality,
    "uc03": temperature_change,
    "uc04": data_gaps,
    "uc05": temperature_deviation,
    "uc06": temperature_rankings,
    "uc07": climate_trend,
    "uc08": user_notifications,
    "uc09": low_visibility,
}


def run_of(spark: SparkSession, checkpoint: str, spec: SinkSpec, table_path: str) -> int:
    """The run number of a job: kept beside its checkpoint, for a new
    checkpoint the one after those in the table."""
    path = f"{checkpoint.rstrip('/')}-run"
    if names_in(spark, path):
        return spark.read.schema("run long").parquet(path).first()["run"]
    run = next_run(spark, spec, table_path)
    spark.range(1).select(F.lit(run).cast("bigint").alias("run")).coalesce(1).write.mode("overwrite").parquet(path)
    return run


def start(spark: SparkSession, uc: str, readings: DataFrame, table_path: str, name: str | None = None, trigger: dict | None = None, fresh: bool = False, **kwargs):
    """Start the streaming job ``uc`` appending to the keyed result table at
    ``table_path``; its checkpoint lives under ``spark.checkpoint.dir``.
    ``fresh`` empties the table and forgets the checkpoint first.  State, and
    for ``uc10`` the rows between its two queries, lie beside the checkpoint."""
    checkpoint = checkpoint_path(spark, name or f"stream-{uc}")
    if fresh:
        for path in (table_path, checkpoint, *(f"{checkpoint}-{x}" for x in ("run", "carry", "drops", "drops-checkpoint"))):
            truncate(spark, path)
    run = run_of(spark, checkpoint, SINKS[uc], table_path)
    if uc != "uc10":
        stream, then = STREAM_JOBS[uc](readings, **kwargs)
        return _started(spark, stream, then, upsert_writer(SINKS[uc], table_path, run=run), checkpoint, trigger)
    path = f"{checkpoint}-drops"
    rows, state = pressure_drops(readings)
    schema = f"{K} string, {T} timestamp, drop_per_hour double, level double"
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/batch_id=-1")  # the folder is there before its reader
    put = lambda out, n: out.write.mode("overwrite").parquet(f"{path}/batch_id={n}")
    first = _started(spark, rows, state, put, f"{checkpoint}-drops-checkpoint", trigger)
    # a batch that is run again replaces its files: maxima don't mind rows that come twice
    drops = spark.readStream.schema(f"{schema}, batch_id long").option("maxFileAge", MAX_FILE_AGE).option("ignoreMissingFiles", "true").option("cleanSource", "delete").parquet(path)
    stream, _ = storm_warning(drops.drop("batch_id"), **kwargs)
    goes_on = {k: v for k, v in (trigger or {}).items() if k not in ("availableNow", "once")}
    second = _started(spark, stream, None, upsert_writer(SINKS[uc], table_path, run=run), checkpoint, goes_on)
    return Chained(first, second)


def _started(spark: SparkSession, stream: DataFrame, then, write, checkpoint: str, trigger: dict | None):
    if isinstance(then, Carried):
        each = stepped(Carry(spark, f"{checkpoint}-carry", K), then.step, write)
    else:
        each = lambda batch, n: write(then(batch) if then else batch, n)
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(**trigger) if trigger else writer).start()


class Chained:
    """Two streaming queries, the second reading what the first writes, as one."""

    def __init__(self, first, second):
        self.first, self.second = first, second

    @property
    def isActive(self) -> bool:
        return self.first.isActive and self.second.isActive

    def processAllAvailable(self) -> None:
        self.first.processAllAvailable()
        self.second.processAllAvailable()

    def awaitTermination(self, timeout: float | None = None) -> bool:
        end = None if timeout is None else time.monotonic() + timeout
        while self.isActive:
            if end is not None and time.monotonic() > end:
                return False
            self.first.awaitTermination(1)
        if self.second.isActive:  # the first has read all there was
            self.second.processAllAvailable()
        self.stop()
        if failed := self.exception():
            raise failed
        return True

    def stop(self) -> None:
        self.first.stop()
        self.second.stop()

    def exception(self):
        return self.first.exception() or self.second.exception()


# ----------------------------------------------------------------- normaliser
def start_normalizer(spark: SparkSession, raw_events: DataFrame, out: str, name: str = "normalizer", trigger: dict | None = None):
    """Stateless normalisation of a raw-event stream (source_file, row_number,
    raw_line) into parquet partitioned by ``kind`` (readings / dead letters);
    the file sink commits each micro-batch exactly once."""
    from cirrus.plans.normalize import normalize_tagged

    writer = (
        normalize_tagged(raw_events)
        .writeStream.format("parquet")
        .partitionBy("kind")
        .option("path", out)
        .option("checkpointLocation", checkpoint_path(spark, name))
        .outputMode("append")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_dead_letters(spark: SparkSession, dead: DataFrame, out: str, name: str = "dead-letters", trigger: dict | None = None):
    """Messages that are no reading, with their text, into parquet at ``out``
    (the second half of ``read_readings_split`` / ``parse_readings_split``)."""
    writer = dead.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint_path(spark, name)).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_all(spark: SparkSession, readings: DataFrame, results_root: str, bookings: DataFrame, prefix: str = "stream", trigger: dict | None = None, fresh: bool = False):
    """All ten jobs as concurrent streaming queries of one application, each
    appending to ``<results_root>/<table>``; returns the started queries."""
    queries = []
    for uc, spec in SINKS.items():
        kwargs = {"bookings": bookings} if uc == "uc08" else {}
        path = f"{results_root.rstrip('/')}/{spec.name}"
        queries.append(start(spark, uc, readings, path, name=f"{prefix}-{uc}", trigger=trigger, fresh=fresh, **kwargs))
    return queries
