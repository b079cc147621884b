"""What a task holds when windows are many: panes are sorted, windows aren't
held, and rankings sort only the rows within reach of a list."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cirrus.operators.rank import top_n_both_ends, within_reach
from cirrus.operators.windows import sliding_agg

START = dt.datetime(1969, 12, 25)


def _readings(spark, n=600):
    rnd = random.Random(3)
    time = lambda: START + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 12)) if rnd.random() > 0.02 else None
    rows = [(rnd.choice([1, 2, 3, None]), time(), rnd.choice([None, rnd.uniform(-50, 50), rnd.uniform(-50, 50)])) for _ in range(n)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v double")
    return df.select("k", "t", "v", F.col("v").cast("decimal(18,6)").alias("d"), F.col("v").cast("decimal(38,12)").alias("w"))


@pytest.mark.parametrize("size,slide", [("6 hours", "1 hour"), ("1 hour", "1 hour"), ("2 hours", "1 hour"), ("24 hours", "10 minutes")])
def test_runs_of_windows_are_the_windows(spark, size, slide):
    df = _readings(spark)
    aggs = [("s", "sum", "d"), ("m", "avg", "w"), ("lo", "min", "v"), ("hi", "max", "d"), ("n", "count", "v")]
    blocks, panes = (sliding_agg(df, "k", "t", size, slide, aggs, how) for how in ("blocks", "panes"))
    assert blocks.dtypes == panes.dtypes
    assert sorted(map(repr, blocks.collect())) == sorted(map(repr, panes.collect()))


def test_windows_are_not_aggregated_again(spark):
    w = sliding_agg(_readings(spark), "k", "t", "24 hours", "1 hour", [("m", "avg", "v")], "blocks")
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate(") == 2  # the panes, before and behind their shuffle


def test_stored_baseline_sorts_no_windows(spark, tmp_path):
    from cirrus.plans.events import baseline_deviation_table

    rows = [(i, START + dt.timedelta(hours=i % 50), i % 7, "view", float(i % 13), "{}") for i in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # keys too many to broadcast
    try:
        plan = baseline_deviation_table(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_within_reach_rank_as_all(spark):
    rnd = random.Random(5)
    rows = []
    for w, keys in enumerate((400, 400, 5, 60)):
        for k in range(keys):
            tied = rnd.choice([1.0, 2.0, 3.0]) if w == 1 else rnd.uniform(-9, 9)
            odd = rnd.choice([None, float("nan"), tied]) if w == 3 else tied
            rows.append((f"k{k}" if k else None, w, w + 1, odd, odd))
    df = spark.createDataFrame(rows * 2, "k string, window_start int, window_end int, hi double, lo double")
    plain, reach = (top_n_both_ends(df, "k", "hi", "lo", 4, many_keys=many) for many in (False, True))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, reach.collect()))
    left = within_reach(df.where("window_start = 0"), "k", "hi", "lo", 4, ("window_start", "window_end")).count()
    assert 2 * 4 <= left < 60  # of 800 rows
