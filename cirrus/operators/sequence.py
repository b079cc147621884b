"""Sequential (per-key, time-ordered) operators, batch form.

The reference walks each station's readings in arrival order with keyed
state (K1-K5).  In batch we express the same thing declaratively, but never
with ``Window.partitionBy(key)`` over raw rows: one key may hold a large
share of all rows, and that window would put all of them in one task.

Instead every "look back" is a *prior aggregate*: for each row, an
associative aggregate (max or sum) over all earlier rows of its key.

1. Rows are hash-partitioned by (key, time bucket) and the aggregate is taken
   inside each bucket with a running window frame.
2. A per-(key, bucket) summary (one row per bucket, so its size is bounded by
   key count x time span / bucket width, not by row count) gets a running
   aggregate over the key's earlier buckets: the *carry*.
3. Carry and in-bucket value are combined.
4. A (key, bucket) group that is itself oversized (a burst) is first split
   into ordered sub-buckets by range-partitioning its rows only, on (key,
   time, tiebreak).  Where the ranges end is up to a sample of the rows, so
   the split rows are checkpointed with their sub-bucket numbers, and the row
   branch and the summary branch both read them from there.

The previous row is the prior max of ``struct(time, tiebreak..., fields...)``.
Per-task work is bounded by the rows of one key inside one (sub-)bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.functions.timeops import MICROS_PER_HOUR, floor_time, micros_between, seconds_between
from cirrus.session import checkpoint_root

BUCKET_COL = "_seq_bucket"
SUB_COL = "_seq_sub"
DEFAULT_BUCKET = "1 day"
# A (key, bucket) group above this many rows is split into ordered
# sub-buckets of about this size.
DEFAULT_MAX_ROWS_PER_BUCKET = 4_000_000


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared checkpoint folder.  Sessions with
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` (as ``build_session``
    sets it) remove the files when nothing refers to them any more."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def _bucket_summaries(base: DataFrame, keys: list[str], time: str, tiebreak: Sequence[str], agg, max_rows: int | None):
    """(rows with SUB_COL, per-(key, bucket, sub) summary with ``_seq_b``).

    With a size limit, the per-(key, bucket) summary (row count and aggregate)
    is computed once, map-side combined, and checkpointed; the same table
    answers the plan-time question "is any group above ``max_rows``?" and
    supplies the carry, so the input is read only once more, by the row
    branch.  Groups above the limit are re-summarised per sub-bucket from
    their (range-split, checkpointed) rows only."""
    per_bucket = base.groupBy(*keys, BUCKET_COL).agg(F.count(F.lit(1)).alias("_seq_cnt"), agg("_seq_v").alias("_seq_b"))
    if not max_rows:
        return base.withColumn(SUB_COL, F.lit(0).cast("long")), per_bucket.withColumn(SUB_COL, F.lit(0).cast("long"))
    per_bucket = checkpointed(per_bucket)
    oversized = per_bucket.where(F.col("_seq_cnt") > F.lit(max_rows))
    stats = oversized.agg(F.count(F.lit(1)).alias("groups"), F.sum("_seq_cnt").alias("rows")).first()
    if not stats or not stats["groups"]:
        return base.withColumn(SUB_COL, F.lit(0).cast("long")), per_bucket.withColumn(SUB_COL, F.lit(0).cast("long"))
    hot = oversized.select(*keys, BUCKET_COL, F.lit(True).alias("_seq_hot"))
    flagged = base.join(hot, [*keys, BUCKET_COL], "left")
    cold = flagged.where(F.col("_seq_hot").isNull()).drop("_seq_hot").withColumn(SUB_COL, F.lit(0).cast("long"))
    # as many ranges as there are tasks for, each cut into sub-buckets in order:
    # a row's number holds its range above its place (33 bits) in it
    width = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2, min(-(-int(stats["rows"]) // max_rows), 4 * width))
    order = [*keys, time, *tiebreak]
    split = flagged.where(F.col("_seq_hot")).drop("_seq_hot").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    split = split.withColumn("_seq_at", F.monotonically_increasing_id())
    in_range = F.col("_seq_at").bitwiseAND(F.lit((1 << 33) - 1))
    sub = F.col("_seq_at") - in_range + F.floor(in_range / F.lit(max_rows)) + F.lit(1)
    split = checkpointed(split.withColumn(SUB_COL, sub.cast("long")).drop("_seq_at"))
    group = [*keys, BUCKET_COL, SUB_COL]
    cold_summary = per_bucket.join(hot, [*keys, BUCKET_COL], "left_anti").withColumn(SUB_COL, F.lit(0).cast("long"))
    hot_summary = split.groupBy(*group).agg(F.count(F.lit(1)).alias("_seq_cnt"), agg("_seq_v").alias("_seq_b"))
    return cold.unionByName(split), cold_summary.unionByName(hot_summary)


def prior_agg(
    df: DataFrame,
    key: str | Sequence[str],
    time: str,
    tiebreak: Sequence[str],
    value: Column,
    out: str,
    how: str = "max",
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add ``out`` = aggregate of ``value`` over the strictly earlier rows of
    the same key in (time, *tiebreak) order; ``how`` is ``max`` or ``sum``.
    ``initial`` (key, one more column): what a key begins with, as if from a
    row before all others; it stands for ``max`` until the key has a row, and
    is added for ``sum``.

    Plan: the rows are shuffled once, on (key, bucket), for the in-bucket
    running window.  The per-bucket summary is a partial aggregate taken
    map-side over the (column-pruned) input, so only one row per (key, bucket,
    map task) is shuffled for it; its running aggregate over a key's buckets
    touches one row per bucket.  The carry is joined back on (key, bucket):
    Spark broadcasts it when the estimate is small, otherwise the join reuses
    the rows' (key, bucket) partitioning and only the carry is shuffled.
    Oversized (key, bucket) groups are split first (``_bucket_summaries``);
    ``max_rows_per_bucket=None`` skips that check.
    """
    keys = _keys(key)
    agg = {"max": F.max, "sum": F.sum}[how]
    order = [F.col(time), *[F.col(c) for c in tiebreak]]
    base = df.withColumn(BUCKET_COL, floor_time(time, bucket)).withColumn("_seq_v", value)
    base, summary = _bucket_summaries(base, keys, time, tiebreak, agg, max_rows_per_bucket)
    group = [*keys, BUCKET_COL, SUB_COL]
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("_seq_in", agg("_seq_v").over(before))
    earlier_buckets = Window.partitionBy(*keys).orderBy(BUCKET_COL, SUB_COL).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*group, agg("_seq_b").over(earlier_buckets).alias("_seq_carry"))
    if initial is not None:  # one row a key, met by the few summaries of its buckets
        first = initial.select(*keys, F.col(next(c for c in initial.columns if c not in keys)).alias("_seq_initial"))
        carried = F.coalesce("_seq_carry", "_seq_initial") if how == "max" else F.coalesce("_seq_carry", F.lit(0)) + F.coalesce("_seq_initial", F.lit(0))
        carry = carry.join(first, keys, "left").select(*group, carried.alias("_seq_carry"))
    joined = rows.join(carry, group, "left")
    if how == "max":
        combined = F.coalesce(F.col("_seq_in"), F.col("_seq_carry"))
    else:
        combined = F.coalesce(F.col("_seq_in"), F.lit(0)) + F.coalesce(F.col("_seq_carry"), F.lit(0))
    return joined.withColumn(out, combined).drop("_seq_v", "_seq_in", "_seq_carry", BUCKET_COL, SUB_COL)


def previous_row(
    df: DataFrame,
    key: str | Sequence[str],
    time: str,
    fields: Sequence[str],
    tiebreak: Sequence[str] = (),
    out: str = "prev",
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: struct(time, *tiebreak, *fields) of the previous row of the
    key; of its first row, the one in ``initial`` (see :func:`last_rows`)."""
    value = _row(time, fields, tiebreak)
    return prior_agg(df, key, time, tiebreak, value, out, "max", bucket, max_rows_per_bucket, initial)


def _row(time: str, fields: Sequence[str], tiebreak: Sequence[str]) -> Column:
    names = [time, *tiebreak, *[f for f in fields if f not in (time, *tiebreak)]]
    return F.struct(*[F.col(n).alias(n) for n in names])


def last_rows(df: DataFrame, key: str, time: str, fields: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """(key, last): struct(time, *tiebreak, *fields) of each key's last row."""
    return df.groupBy(key).agg(F.max(_row(time, fields, tiebreak)).alias("last"))


def rate_of_change(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    tiebreak: Sequence[str] = (),
    out: str = "change_per_hour",
    per_seconds: float = 3600.0,
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
    initial: DataFrame | None = None,
) -> DataFrame:
    """K1: (value - previous value) * per_seconds / elapsed seconds, for rows
    whose predecessor is strictly earlier; the first row of a key emits
    nothing, unless ``initial`` has the one before.  Rows with a null value
    are ignored (not state-updating)."""
    x = df.where(F.col(value).isNotNull()).select(key, time, *tiebreak, value)
    x = previous_row(x, key, time, [value], tiebreak, "_prev", bucket, max_rows_per_bucket, initial)
    sec = seconds_between(F.col("_prev").getField(time), F.col(time))
    return x.where(sec > 0).select(
        key,
        time,
        ((F.col(value) - F.col("_prev").getField(value)) * F.lit(per_seconds) / sec).alias(out),
    )


def gap_status(
    df: DataFrame,
    key: str,
    time: str,
    tiebreak: Sequence[str] = (),
    max_gap: str = "1 hour",
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
    initial: DataFrame | None = None,
) -> DataFrame:
    """K2: one row per consecutive pair of readings of a key (its first one
    with that in ``initial``): (interval_start, interval_end, 'complete' if
    the gap <= max_gap else 'incomplete')."""
    from cirrus.functions.timeops import duration_seconds

    limit = duration_seconds(max_gap) * 1_000_000
    x = df.select(key, time, *tiebreak)
    x = previous_row(x, key, time, [], tiebreak, "_prev", bucket, max_rows_per_bucket, initial)
    start = F.col("_prev").getField(time)
    return x.where(F.col("_prev").isNotNull()).select(
        key,
        start.alias("interval_start"),
        F.col(time).alias("interval_end"),
        F.when(micros_between(start, F.col(time)) <= limit, F.lit("complete"))
        .otherwise(F.lit("incomplete"))
        .alias("status"),
    )


def threshold_periods(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    threshold: float,
    tiebreak: Sequence[str] = (),
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
) -> DataFrame:
    """K4: periods where ``value < threshold``.  A period opens at the first
    low reading and closes at the next reading >= threshold; its duration is
    floor(hours).  A period still open at the end is not emitted."""
    return closed_periods(periods(df, key, time, value, threshold, tiebreak, bucket, max_rows_per_bucket), key)


def periods(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    threshold: float,
    tiebreak: Sequence[str] = (),
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
    opened: DataFrame | None = None,
) -> DataFrame:
    """(key, _g, period_start, period_end): every run of low readings with the
    reading that closes it, numbered along the key; either end may be missing.

    Islands without a per-key window: g = number of non-low readings strictly
    before a row (a prior *sum*).  Group (key, g) holds one run of low rows and
    the non-low row that closes it; the group-by is partially aggregated.
    ``opened`` (key, opened): when a period that is open before the first row
    began; it is the start of the key's group 0."""
    low = F.col(value) < F.lit(threshold)
    x = df.where(F.col(value).isNotNull()).select(key, time, *tiebreak, low.alias("_low"))
    x = prior_agg(x, key, time, tiebreak, F.when(F.col("_low"), 0).otherwise(1), "_g", "sum", bucket, max_rows_per_bucket)
    out = x.groupBy(key, "_g").agg(
        F.min(F.when(F.col("_low"), F.col(time))).alias("period_start"),
        F.min(F.when(~F.col("_low"), F.col(time))).alias("period_end"),
    )
    if opened is None:
        return out
    before = opened.where("opened IS NOT NULL").select(F.col(key).alias("_key"), F.lit(0).cast("long").alias("_first"), "opened")
    out = out.join(before, (F.col(key) == F.col("_key")) & (F.col("_g") == F.col("_first")), "left")
    return out.select(key, "_g", F.coalesce("opened", "period_start").alias("period_start"), "period_end")


def closed_periods(runs: DataFrame, key: str) -> DataFrame:
    return runs.where(F.col("period_start").isNotNull() & F.col("period_end").isNotNull()).select(
        key,
        "period_start",
        "period_end",
        F.floor(micros_between("period_start", "period_end") / F.lit(float(MICROS_PER_HOUR))).alias("duration_hours"),
    )


def open_periods(runs: DataFrame, key: str) -> DataFrame:
    """(key, opened): when the period that is open after a key's last row
    began; null if none is."""
    last = runs.groupBy(key).agg(F.max_by(F.struct("period_start", "period_end"), "_g").alias("_last"))
    return last.select(key, F.when(F.col("_last.period_end").isNull(), F.col("_last.period_start")).alias("opened"))


EXACT_MEAN_TYPE = "decimal(38,12)"


def exact(value: Column) -> Column:
    """A reading as a decimal: sums of decimals are exact and independent of
    the order in which distributed partial sums are merged, so windows with
    the same readings get the same average, bit for bit (what an
    order-sensitive comparison such as ``trend`` needs)."""
    return value.cast(EXACT_MEAN_TYPE)


def trend(
    windows: DataFrame,
    key: str,
    order: str,
    value: str,
    out: str = "trend_direction",
    initial: DataFrame | None = None,
) -> DataFrame:
    """K3: compare each window's value with the key's previous window (its
    first one with that in ``initial``, see :func:`last_rows`): unknown /
    rising / falling / stable.  Runs on window aggregates, whose count per key
    is bounded by time span / slide, so a per-key window is safe."""
    prev = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    if initial is not None:
        before = initial.select(F.col(key).alias("_key"), F.col("last").getField(value).alias("_before"))
        named = windows.join(before, F.col(key) == F.col("_key"), "left").withColumn("_prev", F.coalesce(prev, "_before"))
        windows, prev = named.select(*windows.columns, "_prev"), F.col("_prev")
    compared = windows.withColumn(
        out,
        F.when(prev.isNull(), F.lit("unknown"))
        .when(F.col(value) > prev, F.lit("rising"))
        .when(F.col(value) < prev, F.lit("falling"))
        .otherwise(F.lit("stable")),
    )
    return compared.drop("_prev")
