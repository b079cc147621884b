"""The analytics bound to the driver's tables.

``events(event_id, ts, user_id, event_type, value, props)`` plays the part of
the readings stream: key = ``user_id``, time = ``ts`` (timestamp_ntz, kept as
is), reading = ``value``, arrival-order tie-break = ``event_id``.  Bookings
for the interval join are derived from ``customer``.  Float outputs are
rounded to 6 digits so engines with a different summation order agree.

Every function takes (spark, sf_dir) and returns a DataFrame over the whole
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.functions.baseline import formula_baseline
from cirrus.functions.labels import station_label
from cirrus.functions.timeops import duration_seconds
from cirrus.operators.asof import asof_join, since_baseline, yearly_baselines
from cirrus.operators.composite import composite_event
from cirrus.operators.join import interval_join
from cirrus.operators.quantile import percentiles
from cirrus.operators.rank import top_n_both_ends, top_n_sliding
from cirrus.operators.sequence import closed_periods, exact, gap_status, last_rows, open_periods, periods, rate_of_change, threshold_periods, trend
from cirrus.operators.slope import sliding_slope
from cirrus.operators.windows import sliding_agg, tumbling_stats
from cirrus.plans import normalize as norm
from cirrus.session import scratch_path, use_utc
from cirrus.streaming.carry import Carry

KEY, TIME, VALUE, TIEBREAK = "user_id", "ts", "value", ("event_id",)

# Fixed parameters of the bindings (chosen so every result is non-empty).
BAD_EVENT_TYPE = "error"
HIGH_LEVEL, LOW_LEVEL = 60.0, 5.0
PERIOD_THRESHOLD = 20.0
DROP_THRESHOLD, LEVEL_THRESHOLD = 5.0, 80.0
SERVE_FROM, SERVE_TO = "2024-01-05 00:00:00", "2024-01-25 00:00:00"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _r(c) -> F.Column:
    """Round half up to 6 digits, through 9 digits.

    Averages of 2-decimal values over 2^k rows end in an exact 5 at the 7th
    digit, where last-bit noise of a different summation order would decide
    the direction; rounding first to 9 digits absorbs that noise.  Written as
    floor(x * 10^d + 0.5) / 10^d so that any engine doing the same IEEE
    operations gets the same bits (``round`` differs between engines at ties).
    """
    x = F.col(c) if isinstance(c, str) else c
    x9 = F.floor(x * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9)
    return F.floor(x9 * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def _panel_events(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    """The events of all windows of ``size`` that end in the panel's range, by
    a filter on time that reaches the scan."""
    first = F.to_timestamp_ntz(F.lit(SERVE_FROM)) - F.make_dt_interval(secs=F.lit(duration_seconds(size)).cast("decimal(18,6)"))
    return _events(spark, sf_dir).where((F.col(TIME) >= first) & (F.col(TIME) < F.to_timestamp_ntz(F.lit(SERVE_TO))))


def interval_stats(spark, sf_dir, ev: DataFrame | None = None):
    ev = ev or _events(spark, sf_dir)
    out = tumbling_stats(ev, KEY, TIME, VALUE)
    return out.withColumn("avg_value", _r("avg_value"))


def predicate_count(spark, sf_dir, strategy: str = "auto", ev: DataFrame | None = None):
    ev = ev or _events(spark, sf_dir)
    bad = F.when(F.coalesce(F.col("event_type") == BAD_EVENT_TYPE, F.lit(False)), 1).otherwise(0)
    return sliding_agg(ev.withColumn("_bad", bad), KEY, TIME, "1 hour", "10 minutes", [("bad_count", "sum", "_bad")], strategy).withColumn(
        "bad_count", F.col("bad_count").cast("bigint")
    )


def predicate_count_expand(spark, sf_dir):
    """The same query, always on the window expansion path."""
    return predicate_count(spark, sf_dir, strategy="expand")


def predicate_count_panes(spark, sf_dir):
    """The same query on the pane pre-aggregation path."""
    return predicate_count(spark, sf_dir, strategy="panes")


def baseline_deviation_panes(spark, sf_dir):
    """UC05 (24 h / 1 h) on the pane pre-aggregation path."""
    ev = _events(spark, sf_dir)
    w = _rolling_avg(ev, "24 hours", "1 hour", strategy="panes")
    base = formula_baseline(F.col(KEY).cast("string"))
    return w.select(KEY, "window_start", "window_end", _r(F.col("avg_value") - base).alias("deviation"))


#: Buckets and limit by which most groups of the ``*_split`` queries are
#: oversized, at every size of ``events``.
SPLIT = {"bucket": "30 days", "max_rows_per_bucket": 20}


def rate_change(spark, sf_dir, **split):
    ev = _events(spark, sf_dir)
    out = rate_of_change(ev, KEY, TIME, VALUE, TIEBREAK, **split)
    return out.select(KEY, F.col(TIME).alias("event_time"), _r("change_per_hour").alias("change_per_hour"))


def gaps(spark, sf_dir):
    return gap_status(_events(spark, sf_dir), KEY, TIME, TIEBREAK, "1 hour")


def _rolling_avg(ev: DataFrame, size: str, slide: str, strategy: str = "auto") -> DataFrame:
    return sliding_agg(ev.where(F.col(VALUE).isNotNull()), KEY, TIME, size, slide, [("avg_value", "avg", VALUE)], strategy)


def baseline_deviation(spark, sf_dir, ev: DataFrame | None = None):
    ev = ev or _events(spark, sf_dir)
    w = _rolling_avg(ev, "24 hours", "1 hour")
    base = formula_baseline(F.col(KEY).cast("string"))
    return w.select(KEY, "window_start", "window_end", _r(F.col("avg_value") - base).alias("deviation"))


def baseline_deviation_table(spark, sf_dir):
    """UC05 with a stored baseline table (the documented intent): here the
    baseline is each key's mean over the whole table, derived by Spark."""
    ev = _events(spark, sf_dir)
    w = _rolling_avg(ev, "24 hours", "1 hour")
    base = ev.where(F.col(VALUE).isNotNull()).groupBy(KEY).agg(F.avg(VALUE).alias("_base"))
    # a row a key to look up, in place of sorting all windows by key
    return w.join(base.hint("shuffle_hash"), KEY, "left").select(
        KEY, "window_start", "window_end", _r(F.col("avg_value") - F.col("_base")).alias("deviation")
    )


def top_extremes(spark, sf_dir):
    """UC06: the top 10 of a window's panes merged, see ``top_n_sliding``."""
    ev = _events(spark, sf_dir).where(F.col(VALUE).isNotNull())
    return top_n_sliding(ev, KEY, TIME, VALUE, "24 hours", "1 hour", 10, "value")


def moving_trend(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn(VALUE, exact(F.col(VALUE)))
    w = _rolling_avg(ev, "30 days", "10 days").withColumn("avg_value", F.col("avg_value").cast("double"))
    t = trend(w, KEY, "window_start", "avg_value")
    return t.select(KEY, "window_start", "window_end", _r("avg_value").alias("avg_value"), "trend_direction")


def bookings(spark, sf_dir) -> DataFrame:
    """One booking per customer: key c_custkey, 1 day from 2024-01-01 + (c_custkey mod 28) days."""
    cu = spark.read.parquet(f"{sf_dir}/customer.parquet")
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(days=F.pmod(F.col("c_custkey"), F.lit(28)).cast("int"))
    return cu.select(
        F.col("c_name").alias("booking_user"),
        F.col("c_custkey").alias("booking_id"),
        F.col("c_custkey").alias("resort_id"),
        start.alias("booking_start"),
        (start + F.make_dt_interval(days=F.lit(1))).alias("booking_end"),
    )


def long_bookings(spark, sf_dir) -> DataFrame:
    """One booking per customer from 2024-01-01 minus (c_custkey mod 4000)
    days on, of 10 minutes times 2^(c_custkey mod 20): up to ten years."""
    b = bookings(spark, sf_dir)
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) - F.make_dt_interval(days=F.pmod(F.col("booking_id"), F.lit(4000)).cast("int"))
    lasts = F.make_dt_interval(mins=(F.lit(10) * F.expr("shiftleft(1, cast(pmod(booking_id, 20) as int))")).cast("int"))
    return b.withColumn("booking_start", start).withColumn("booking_end", start + lasts)


def booking_alerts_long(spark, sf_dir):
    """UC08 with bookings of minutes to years."""
    return booking_alerts(spark, sf_dir, long_bookings(spark, sf_dir))


def departure_weather(spark, sf_dir):
    """Every flight with the last reading before its departure, of two days
    at most: a flight per customer from station c_custkey mod 200."""
    b = bookings(spark, sf_dir)
    at = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(mins=F.pmod(F.col("booking_id") * 7919, F.lit(43_200)).cast("int"))
    flights = b.select(F.col("booking_id").alias("flight_id"), F.pmod("booking_id", F.lit(200)).alias(KEY), at.alias("departure"))
    ev = _events(spark, sf_dir).where(F.col(VALUE).isNotNull())
    out = asof_join(flights, ev, KEY, "departure", TIME, [VALUE], TIEBREAK, inclusive=False, max_age="2 days", out="reading")
    return out.select("flight_id", KEY, "departure", F.col("reading").getField(TIME).alias("observed"), F.col("reading").getField(VALUE).alias(VALUE))


def yearly_deviation(spark, sf_dir):
    """deviation of each order's price from its customer's yearly average
    that was known then (the last complete year with orders)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("ordered"), "o_totalprice")
    base = yearly_baselines(orders, "o_custkey", "ordered", "o_totalprice")
    out = since_baseline(orders, base, "o_custkey", "ordered", F.col("o_totalprice"), bucket="365 days")
    return out.select("o_orderkey", "o_custkey", "baseline_year", _r("baseline").alias("baseline"), _r("deviation").alias("deviation"))


def yearly_percentiles(spark, sf_dir):
    """Median and tails of the order prices of every year and priority."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.year("o_orderdate").alias("year"), "o_orderpriority", "o_totalprice")
    out = percentiles(orders, ["year", "o_orderpriority"], "o_totalprice", [0.05, 0.5, 0.95], few=200)
    return out.select("year", "o_orderpriority", *[_r(c).alias(c) for c in ("p5", "p50", "p95")])


def daily_slopes(spark, sf_dir):
    """Slope of each key's readings over two days, every twelve hours, and
    what it says for six hours after."""
    out = sliding_slope(_events(spark, sf_dir), KEY, TIME, VALUE, "48 hours", "12 hours", "6 hours")
    tight = F.col("n") >= 3  # two readings may be microseconds apart
    return out.where(tight).select(KEY, "window_start", "window_end", "n", *[_r(c).alias(c) for c in ("slope_per_hour", "r2", "forecast")])


def booking_alerts(spark, sf_dir, booked: DataFrame | None = None):
    ev = _events(spark, sf_dir).where(F.col(VALUE).isNotNull()).select(KEY, TIME, VALUE)
    j = interval_join(ev, booked or bookings(spark, sf_dir), KEY, "resort_id", TIME, "booking_start", "booking_end")
    return j.where((F.col(VALUE) > HIGH_LEVEL) | (F.col(VALUE) < LOW_LEVEL)).select(
        F.col("booking_user").alias("user_id"),
        "booking_id",
        "resort_id",
        F.col(TIME).alias("event_time"),
        F.lit("bad_conditions").alias("alert"),
        VALUE,
    )


def rate_change_split(spark, sf_dir):
    """K1 with oversized groups split."""
    return rate_change(spark, sf_dir, **SPLIT)


def low_periods(spark, sf_dir, **split):
    return threshold_periods(_events(spark, sf_dir), KEY, TIME, VALUE, PERIOD_THRESHOLD, TIEBREAK, **split)


def low_periods_split(spark, sf_dir):
    """K4 with oversized groups split."""
    return low_periods(spark, sf_dir, **SPLIT)


def composite_alerts_split(spark, sf_dir):
    """K5 and its windows with oversized groups split."""
    return composite_alerts(spark, sf_dir, **SPLIT)


def composite_alerts(spark, sf_dir, strategy: str = "auto", **split):
    ev = _events(spark, sf_dir).where(F.col(VALUE).isNotNull())
    out = composite_event(
        ev, KEY, TIME, F.col(VALUE), F.col(VALUE), DROP_THRESHOLD, LEVEL_THRESHOLD, "60 minutes", "10 minutes",
        tiebreak=TIEBREAK, strategy=strategy, **split,
    )
    return out.select(KEY, "window_start", "window_end", _r("max_drop_per_hour").alias("max_drop_per_hour"), "max_level", "alert")


# ------------------------------------------------------------ carried state
#: Batches that the ``*_carried`` queries cut the events into, by time.
BATCHES = 4


def _carried(spark, sf_dir, name: str, ev: DataFrame, step) -> DataFrame:
    """``step`` batch by batch, as a stream runs it, each going on from the
    state that the keys carry from those before."""
    ends = ev.agg(F.min(TIME).alias("a"), F.max(TIME).alias("b")).first()
    carry = Carry(spark, scratch_path(spark, f"carry-{name}"), KEY)
    out = None
    for n in range(BATCHES):
        a, b = (ends["a"] + (ends["b"] - ends["a"]) * (n + k) / BATCHES for k in (0, 1)) if ends["a"] else (None, None)
        rows = ev.where((F.col(TIME) >= F.lit(a).cast("timestamp_ntz")) & (F.col(TIME) < F.lit(b).cast("timestamp_ntz") if n < BATCHES - 1 else F.lit(True)))
        found, changed = step(rows, carry.before(n))
        carry.put(n, changed)
        out = found if out is None else out.unionByName(found)
    return out


def rate_change_carried(spark, sf_dir):
    """K1 with stored state."""
    ev = _events(spark, sf_dir).where(F.col(VALUE).isNotNull())

    def step(rows, state):
        return rate_of_change(rows, KEY, TIME, VALUE, TIEBREAK, initial=state), last_rows(rows, KEY, TIME, [VALUE], TIEBREAK)

    out = _carried(spark, sf_dir, "rate", ev, step)
    return out.select(KEY, F.col(TIME).alias("event_time"), _r("change_per_hour").alias("change_per_hour"))


def gap_status_carried(spark, sf_dir):
    """K2 with stored state."""
    step = lambda rows, state: (gap_status(rows, KEY, TIME, TIEBREAK, "1 hour", initial=state), last_rows(rows, KEY, TIME, [], TIEBREAK))
    return _carried(spark, sf_dir, "gaps", _events(spark, sf_dir), step)


def low_periods_carried(spark, sf_dir):
    """K4 with stored state: periods may be open over several batches."""

    def step(rows, state):
        runs = periods(rows, KEY, TIME, VALUE, PERIOD_THRESHOLD, TIEBREAK, opened=state)
        return closed_periods(runs, KEY), open_periods(runs, KEY)

    return _carried(spark, sf_dir, "periods", _events(spark, sf_dir), step)


# ---------------------------------------------------------------- normaliser
def normalized_readings(spark, sf_dir):
    lines = norm.events_as_raw_lines(_events(spark, sf_dir))
    readings, _ = norm.normalize(lines)
    return norm.flatten_for_check(readings)


def normalize_dead_letters(spark, sf_dir):
    lines = norm.events_as_raw_lines(_events(spark, sf_dir))
    _, dead = norm.normalize(lines)
    return dead


def _messages(ev: DataFrame, document) -> DataFrame:
    """Messages built from events: 'error' events are no JSON, 'signup' ones
    a JSON object without what the reader needs, the others ``document``."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    broken = F.concat(F.lit("not json "), number)
    lacking = F.concat(F.lit('{"row_number": '), number, F.lit("}"))
    return ev.select(F.when(kind == "error", broken).when(kind == "signup", lacking).otherwise(document).alias("value"))


def raw_event_dead_letters(spark, sf_dir):
    """Raw events that can't be decoded, or without a usable line, with
    their message."""
    from cirrus.sources.kafka import raw_events

    lines = norm.events_as_raw_lines(_events(spark, sf_dir).withColumn("event_type", F.when(F.col("event_type") == "view", "error").otherwise(F.col("event_type"))))
    ev = _events(spark, sf_dir).join(lines.select((F.col("row_number") - 2).alias("event_id"), "raw_line"), "event_id")
    document = F.to_json(F.struct(F.lit("f").alias("source_file"), F.col("event_id").alias("row_number"), F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("raw_line")).alias("raw_line")))
    _, dead = norm.normalize(raw_events(_messages(ev, document)))
    return dead.select("error", F.col("raw_message").alias("message"))


def reading_dead_letters(spark, sf_dir):
    """Messages that are no reading, or one without an event time."""
    from cirrus.sources.readings import parse_readings_split

    date = F.when(F.col("event_type") == "view", F.lit("yesterday")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    document = F.concat(F.lit('{"station": "'), F.col("user_id").cast("string"), F.lit('", "date": "'), date, F.lit('"}'))
    _, dead = parse_readings_split(_messages(_events(spark, sf_dir), document))
    return dead.select("error", F.col("raw_message").alias("message"))


# ---------------------------------------------------------------- serving
def _between(c: str):
    return F.col(c).between(F.to_timestamp_ntz(F.lit(SERVE_FROM)), F.to_timestamp_ntz(F.lit(SERVE_TO)))


def _label(c: str):
    return station_label(F.col(c).cast("string"))


def serve_stats(spark, sf_dir, window_size: str = "24h"):
    s = interval_stats(spark, sf_dir, _panel_events(spark, sf_dir, "24 hours"))
    return (
        s.where(_between("window_end") & (F.col("window_size") == window_size))
        .select(F.col("window_end").alias("time"), _label(KEY).alias("station"), "avg_value", "min_value", "max_value")
        .orderBy("time")
    )


def serve_quality(spark, sf_dir):
    s = predicate_count(spark, sf_dir, ev=_panel_events(spark, sf_dir, "1 hour"))
    return s.where(_between("window_end")).select(
        F.col("window_end").alias("time"), _label(KEY).alias("metric"), F.col("bad_count").alias("value")
    ).orderBy("time")


def serve_change(spark, sf_dir):
    s = rate_change(spark, sf_dir)
    return s.where(_between("event_time")).select(
        F.col("event_time").alias("time"), _label(KEY).alias("metric"), F.col("change_per_hour").alias("value")
    ).orderBy("time")


def serve_gaps(spark, sf_dir):
    s = gaps(spark, sf_dir)
    return s.where(_between("interval_end")).select(
        F.col("interval_end").alias("time"), _label(KEY).alias("metric"), F.col("status").alias("value")
    ).orderBy("time")


def serve_deviation(spark, sf_dir):
    s = baseline_deviation(spark, sf_dir, _panel_events(spark, sf_dir, "24 hours"))
    return s.where(_between("window_end")).select(
        F.col("window_end").alias("time"), _label(KEY).alias("station"), "deviation"
    ).orderBy("time")


def serve_ranking(spark, sf_dir, list_name: str = "hottest"):
    """S06 (the ranking of the latest window).  The window with the latest
    end starts at the pane (slide) of the last reading, and its ranking
    depends only on readings inside it: that start is a scalar subquery
    evaluated first and applied at the scan, so only the last pane's rows are
    aggregated and ranked."""
    from cirrus.functions.timeops import floor_time_expr

    ev = _events(spark, sf_dir).where(F.col(VALUE).isNotNull())
    start = ev.select(floor_time_expr(F.max(TIME), "1 hour").alias("s")).scalar()
    recent = ev.where(F.col(TIME) >= start)
    w = sliding_agg(recent, KEY, TIME, "24 hours", "1 hour", [("_hi", "max", VALUE), ("_lo", "min", VALUE)])
    s = top_n_both_ends(w.where(F.col("window_start") == start), KEY, "_hi", "_lo", 10, "value")
    return (
        s.where(F.col("list_name") == list_name)
        .select(
            F.concat(F.col("rank_position").cast("string"), F.lit(". "), _label(KEY)).alias("label"),
            "value",
            "rank_position",
        )
        .orderBy("rank_position")
    )


def serve_trend(spark, sf_dir):
    s = moving_trend(spark, sf_dir)
    return s.where(_between("window_end")).select(
        F.col("window_end").alias("time"), _label(KEY).alias("metric"), "trend_direction"
    ).orderBy("time")


def serve_notifications(spark, sf_dir):
    s = booking_alerts(spark, sf_dir)
    return s.where(_between("event_time")).select(
        F.col("event_time").alias("time"),
        _label("resort_id").alias("resort_station"),
        F.col("user_id").alias("user"),
        F.col("booking_id").alias("booking_ref"),
        F.col("alert").alias("alert_type"),
        F.col(VALUE).alias("reading"),
    ).orderBy(F.col("time").desc())


def serve_periods(spark, sf_dir):
    s = low_periods(spark, sf_dir)
    return s.where(_between("period_end")).select(
        F.col("period_start").alias("start_time"),
        F.col("period_end").alias("end_time"),
        _label(KEY).alias("station"),
        F.col("duration_hours").alias("duration_h"),
    ).orderBy(F.col("duration_h").desc())


def serve_alerts(spark, sf_dir):
    s = composite_alerts(spark, sf_dir)
    return s.where(_between("window_end")).select(
        F.col("window_end").alias("alert_time"),
        _label(KEY).alias("station"),
        F.col("alert").alias("status"),
        F.col("max_drop_per_hour").alias("drop_per_hour"),
        F.col("max_level").alias("max_level"),
    ).orderBy(F.col("alert_time").desc())


QUERIES = {
    "interval_stats": interval_stats,
    "predicate_count": predicate_count,
    "predicate_count_expand": predicate_count_expand,
    "predicate_count_panes": predicate_count_panes,
    "rate_change": rate_change,
    "gap_status": gaps,
    "baseline_deviation": baseline_deviation,
    "baseline_deviation_table": baseline_deviation_table,
    "baseline_deviation_panes": baseline_deviation_panes,
    "top_extremes": top_extremes,
    "moving_trend": moving_trend,
    "booking_alerts": booking_alerts,
    "booking_alerts_long": booking_alerts_long,
    "departure_weather": departure_weather,
    "yearly_deviation": yearly_deviation,
    "yearly_percentiles": yearly_percentiles,
    "daily_slopes": daily_slopes,
    "low_periods": low_periods,
    "composite_alerts": composite_alerts,
    "rate_change_carried": rate_change_carried,
    "gap_status_carried": gap_status_carried,
    "low_periods_carried": low_periods_carried,
    "rate_change_split": rate_change_split,
    "low_periods_split": low_periods_split,
    "composite_alerts_split": composite_alerts_split,
    "normalized_readings": normalized_readings,
    "normalize_dead_letters": normalize_dead_letters,
    "raw_event_dead_letters": raw_event_dead_letters,
    "reading_dead_letters": reading_dead_letters,
    "serve_stats": serve_stats,
    "serve_quality": serve_quality,
    "serve_change": serve_change,
    "serve_gaps": serve_gaps,
    "serve_deviation": serve_deviation,
    "serve_ranking": serve_ranking,
    "serve_trend": serve_trend,
    "serve_notifications": serve_notifications,
    "serve_periods": serve_periods,
    "serve_alerts": serve_alerts,
}
