"""Interval join and point-in-time join against brute force, yearly baselines,
stored panes, and reading the first records only."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirrus.operators.asof import asof_join, since_baseline, yearly_baselines
from cirrus.operators.join import TOP_LEVEL, dyadic_ranges, interval_join
from cirrus.operators.windows import sliding_agg
from cirrus.sources import panes
from cirrus.sources.panes import PaneStore
from cirrus.sources.raw import read_first, read_raw

T0 = datetime(1968, 1, 1)


def test_dyadic_ranges_cover_each_bucket_once(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(a + n)) for a, n in zip(rng.integers(-9000, 9000, 200), [*range(60), *rng.integers(0, 9000, 140)])]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("r", dyadic_ranges(F.col("a"), F.col("b")))
    for row in df.collect():
        covered = [i for level, n in row.r for i in range(n << level, (n + 1) << level)]
        assert sorted(covered) == list(range(row.a, row.b + 1))
        assert len(row.r) <= 2 * TOP_LEVEL + 2 + (row.b - row.a >> TOP_LEVEL)
    ten_years = spark.range(1).select(dyadic_ranges(F.lit(1001).cast("long"), F.lit(1001 + 3650).cast("long")).alias("r")).first().r
    assert len(ten_years) < 25


def test_interval_join_of_minutes_to_years(spark):
    rng = np.random.default_rng(2)
    left = [(f"k{int(rng.integers(3))}", T0 + timedelta(minutes=int(m)), i) for i, m in enumerate(rng.integers(0, 60 * 24 * 365 * 6, 400))]
    left += [("k0", None, 900), (None, T0, 901)]
    right = []
    for j in range(60):
        start = T0 + timedelta(minutes=int(rng.integers(0, 60 * 24 * 365 * 5)))
        right.append((f"k{int(rng.integers(3))}", start, start + timedelta(minutes=int(10 * 2 ** rng.integers(0, 18))), j))
    right += [("k0", left[0][1], left[0][1], 70), ("k1", T0, None, 71), ("k1", T0 + timedelta(days=1), T0, 72), ("k0", T0, T0 + timedelta(days=365 * 12), 73)]
    l = spark.createDataFrame(left, "k string, t timestamp, i int")
    r = spark.createDataFrame(right, "rk string, s timestamp, e timestamp, j int")
    got = {(x.i, x.j) for x in interval_join(l, r, "k", "rk", "t", "s", "e").collect()}
    want = {(i, j) for k, t, i in left for rk, s, e, j in right if k == rk and t and e and s <= t <= e}
    assert got == want and interval_join(l, r, "k", "rk", "t", "s", "e").count() == len(want) > 500


@pytest.mark.parametrize("inclusive,max_age", [(True, None), (False, None), (True, "2 days"), (False, "3 hours")])
def test_asof_join(spark, inclusive, max_age):
    rng = np.random.default_rng(3)
    hours = lambda n: [T0 + timedelta(hours=int(h)) for h in rng.integers(0, 24 * 20, n)]
    right = [(f"k{i % 3}", t, i, float(i)) for i, t in enumerate(hours(150))] + [(None, T0, 1, 0.0), ("k1", None, 2, 0.0)]
    left = [(f"k{i % 4}", t, i) for i, t in enumerate(hours(200))] + [("k0", None, 500), (None, T0, 501), ("k0", T0 + timedelta(days=1), 502), ("k0", T0 + timedelta(days=1), 502)]
    l = spark.createDataFrame(left, "k string, t timestamp, i int")
    r = spark.createDataFrame(right, "k string, u timestamp, j int, v double")
    age = timedelta(days=2) if max_age == "2 days" else timedelta(hours=3) if max_age else None
    want = []
    for k, t, i in left:
        known = [(u, j) for rk, u, j, _ in right if rk == k and k is not None and u is not None and t is not None and (u <= t if inclusive else u < t)]
        best = max(known, default=None)
        want.append((i, best[1] if best and (age is None or t - best[0] <= age) else None))
    for limit in (None, 10):  # with a limit, hot buckets are split
        got = asof_join(l, r, "k", "t", "u", ["v"], ["j"], inclusive, max_age, max_rows_per_bucket=limit, bucket="30 days").collect()
        assert sorted(map(str, [(x.i, int(x.known.v) if x.known else None) for x in got])) == sorted(map(str, want))


def test_yearly_baseline_known_before_each_reading(spark):
    rows = [("A", datetime(y, m, 5), float(10 * y % 100 + m)) for y in (1901, 1902, 1904) for m in range(1, 13)] + [("B", datetime(1903, 1, 1), 7.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    base = yearly_baselines(df, "k", "t", "v")
    got = {(r.k, r.t.year, r.t.month): (r.baseline_year, r.baseline) for r in since_baseline(df, base, "k", "t", F.col("v"), bucket="365 days").collect()}
    mean = lambda y: sum(v for k, t, v in rows if k == "A" and t.year == y) / 12
    assert got["A", 1901, 6] == (None, None) and got["B", 1903, 1] == (None, None)
    assert got["A", 1902, 1] == (1901, mean(1901)) and got["A", 1904, 12] == (1902, mean(1902))


def test_pane_store_adds_only_new_days(spark, tmp_path, monkeypatch):
    exact = F.col("v").cast("decimal(20,3)")
    aggs = [("lo", "min", "v"), ("hi", "max", "v"), ("s", "sum", exact), ("mean", "avg", exact)]
    rng = np.random.default_rng(4)
    rows = [(f"k{i % 3}", T0 + timedelta(minutes=int(m)), None if i % 9 == 0 else float(i % 13)) for i, m in enumerate(rng.integers(0, 60 * 24 * 12, 500))]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    df.withColumn("day", F.date_format("t", "yyyy-MM-dd")).write.partitionBy("day").parquet(str(tmp_path / "in"))
    readings = spark.read.parquet(str(tmp_path / "in"))
    days = sorted(str(r.day) for r in readings.select("day").distinct().collect())
    store = PaneStore(spark, str(tmp_path / "panes"), "k", "t", "10 minutes", aggs)
    assert store.add(readings, days[:-1]) == days[:-1] and store.days() == days[:-1]
    kept = {f: (tmp_path / "panes" / f).stat().st_mtime_ns for f in (f"day={d}" for d in days[:-1])}
    # the second run's scan is given the new day's partition only
    seen, real = [], panes.pane_aggregate
    monkeypatch.setattr(panes, "pane_aggregate", lambda rows, *a: seen.append(rows) or real(rows, *a))
    assert store.add(readings, days) == days[-1:] and store.days() == days
    scan = next(line for line in seen[0]._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line)
    assert f"cast(day#" in scan.split("PartitionFilters")[1] or days[-1] in scan.split("PartitionFilters")[1]
    assert {f: (tmp_path / "panes" / f).stat().st_mtime_ns for f in kept} == kept  # the others weren't written
    full = PaneStore(spark, str(tmp_path / "full"), "k", "t", "10 minutes", aggs)
    full.add(readings, days)
    text = lambda df: sorted(map(str, df.collect()))
    assert text(store.panes()) == text(full.panes())
    for size, slide in (("1 hour", "10 minutes"), ("24 hours", "1 hour"), ("5 days", "1 day"), ("1 hour", "1 hour")):
        got = store.windows(size, slide, ["lo", "hi", "s", "mean"], only="mean")
        want = sliding_agg(df.where("v IS NOT NULL"), "k", "t", size, slide, aggs, "expand")
        norm = lambda df: sorted((r.k, r.window_start, r.window_end, r.lo, r.hi, r.s, round(float(r.mean), 4)) for r in df.collect())
        assert norm(got) == norm(want)
    # windows of some days need these days' panes only
    some = store.windows("24 hours", "1 hour", ["hi"], since=days[5], until=days[6])
    scan = next(line for line in some._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line)
    assert f"<= {days[6]})" in scan and panes.earlier(days[5], "24 hours") == days[4]
    whole = {(r.k, r.window_start): r.hi for r in store.windows("24 hours", "1 hour", ["hi"]).collect()}
    mine = {(r.k, r.window_start): r.hi for r in some.collect() if days[5] <= str(r.window_end)[:10] <= days[6]}
    assert mine and all(whole[k] == v for k, v in mine.items())
    # a refreshed day replaces its panes
    assert store.add(readings, days, refresh=days[:1]) == days[:1] and text(store.panes()) == text(full.panes())


def test_first_records_read_only_needed_files(spark, tmp_path):
    for y in range(1901, 1905):
        (tmp_path / str(y)).mkdir()
        for s in range(4):
            n = 0 if s == 1 else 10 * s + 3
            (tmp_path / str(y) / f"s{s}.csv").write_text("header\n" + "".join(f"{y}-{s}-{i}\n" for i in range(n)))
    (tmp_path / "1902" / "s2.csv").write_text("")
    whole = [(r.source_file, r.row_number, r.raw_line) for r in read_raw(spark, str(tmp_path)).orderBy("source_file", "row_number").collect()]
    for n in (1, 3, 4, 30, 61, 62, 1000):
        got = read_first(spark, str(tmp_path), None, None, n)
        assert sorted((r.source_file, r.row_number, r.raw_line) for r in got.collect()) == sorted(whole[:n])
        assert {f.rsplit("/", 2)[1] for f in got.inputFiles()} == {x[0].rsplit("/", 2)[1] for x in whole[:n]}
