"""Sequential operators: bucketed prior aggregates equal whole-key windows,
also when one key holds most rows and buckets are much smaller than gaps."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cirrus.operators.composite import rate_drops
from cirrus.operators.sequence import gap_status, previous_row, prior_agg, rate_of_change, threshold_periods
from tests.conftest import SF_SMALL


def _events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # make user 0 hot: a third of all rows
    hot = ev.where(F.pmod("event_id", F.lit(3)) == 0).withColumn("user_id", F.lit(0).cast("bigint"))
    return ev.where(F.pmod("event_id", F.lit(3)) != 0).unionByName(hot)


def test_previous_row_matches_lag(spark):
    ev = _events(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = {r.event_id: r.p for r in ev.select("event_id", F.lag("event_id").over(w).alias("p")).collect()}
    for bucket in ("1 hour", "1 day", "7 days"):
        got = previous_row(ev, "user_id", "ts", ["value"], ["event_id"], "prev", bucket)
        res = {r.event_id: (r.prev.event_id if r.prev else None) for r in got.select("event_id", "prev").collect()}
        assert res == want, bucket


def test_prior_sum_matches_running_sum(spark):
    ev = _events(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = {r.event_id: (r.s or 0) for r in ev.select("event_id", F.sum(F.when(F.col("value") > 20, 1).otherwise(0)).over(w).alias("s")).collect()}
    got = prior_agg(ev, "user_id", "ts", ["event_id"], F.when(F.col("value") > 20, 1).otherwise(0), "s", "sum", "2 hours")
    assert {r.event_id: r.s for r in got.select("event_id", "s").collect()} == want


def test_periods_independent_of_bucket(spark):
    ev = _events(spark)
    base = sorted(threshold_periods(ev, "user_id", "ts", "value", 20.0, ["event_id"], "30 days").collect())
    small = sorted(threshold_periods(ev, "user_id", "ts", "value", 20.0, ["event_id"], "1 hour").collect())
    assert base == small and len(base) > 0


def test_oversized_buckets_are_split_and_exact(spark):
    """A hot key whose day buckets exceed the limit: the oversized groups are
    range-split (ties in time included) and results stay exact."""
    ev = _events(spark)
    # also put many rows of the hot key on one identical timestamp
    same = ev.where(F.col("user_id") == 0).limit(40).withColumn("ts", F.to_timestamp_ntz(F.lit("2024-01-10 12:00:00")))
    ev = ev.unionByName(same.withColumn("event_id", F.col("event_id") + F.lit(1_000_000)))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = {r.event_id: r.p for r in ev.select("event_id", F.lag("event_id").over(w).alias("p")).collect()}
    got = previous_row(ev, "user_id", "ts", ["value"], ["event_id"], "prev", "1 day", max_rows_per_bucket=5)
    res = {r.event_id: (r.prev.event_id if r.prev else None) for r in got.select("event_id", "prev").collect()}
    assert res == want
    base = sorted(threshold_periods(ev, "user_id", "ts", "value", 20.0, ["event_id"], "1 day", None).collect())
    split = sorted(threshold_periods(ev, "user_id", "ts", "value", 20.0, ["event_id"], "1 day", 5).collect())
    assert base == split


def test_large_oversized_group_equals_whole_key_windows(spark):
    """400,000 rows of one key in one day, limit 50,000: more rows than a range
    partitioner samples, so sub-bucket numbers taken twice would differ."""
    n = 400_000
    at = F.to_timestamp_ntz(F.lit("2024-01-10 00:00:00")) + F.make_dt_interval(secs=(F.col("id") / F.lit(5)).cast("decimal(18,6)"))
    value = F.pmod(F.xxhash64("id"), F.lit(1000)) / F.lit(10.0)
    rows = spark.range(0, n, numPartitions=8).select(F.lit("k").alias("key"), at.alias("ts"), value.alias("value"))
    limit = 50_000
    w = Window.partitionBy("key").orderBy("ts")
    prev = rows.select("*", F.lag("ts").over(w).alias("pt"), F.lag("value").over(w).alias("pv")).where("pt IS NOT NULL")

    def same(got, want):
        assert got.count() == want.count()
        assert got.exceptAll(want).isEmpty()

    seconds = F.lit(0.2)
    rate = lambda a, b: F.round((a - b) * 3600 / seconds, 6).alias("r")
    got = rate_of_change(rows, "key", "ts", "value", max_rows_per_bucket=limit)
    same(got.select("ts", F.round("change_per_hour", 6).alias("r")), prev.select("ts", rate(F.col("value"), F.col("pv"))))
    got = rate_drops(rows, "key", "ts", F.col("value"), F.col("value"), max_rows_per_bucket=limit)
    same(got.select("ts", F.round("drop_per_hour", 6).alias("r"), "level"), prev.select("ts", rate(F.col("pv"), F.col("value")), F.col("value").alias("level")))
    got = gap_status(rows, "key", "ts", max_gap="1 second", max_rows_per_bucket=limit)
    same(got, prev.select("key", F.col("pt").alias("interval_start"), F.col("ts").alias("interval_end"), F.lit("complete").alias("status")))
    same(threshold_periods(rows, "key", "ts", "value", 20.0, max_rows_per_bucket=limit), threshold_periods(rows, "key", "ts", "value", 20.0, max_rows_per_bucket=None))
