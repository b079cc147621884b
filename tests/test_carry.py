"""Keyed state as a stored carry: one hot key in one batch without Python,
replays, merging of versions, and late rows in the storm job."""

import time

from pyspark.sql import functions as F

from cirrus.operators.sequence import closed_periods, last_rows, open_periods, periods, rate_of_change
from cirrus.schema import SINKS
from cirrus.sources.readings import read_readings
from cirrus.sources.sinks import read_table
from cirrus.streaming import carry as C
from cirrus.streaming.jobs import start
from tests.documents import drop_file, reading
from tests.streaming_util import SENTINEL


def _rates(rows, state):
    return rate_of_change(rows, "k", "t", "v", ["id"], initial=state), last_rows(rows, "k", "t", ["v"], ["id"])


def _rows(spark, n, first=0, keys=1):
    return spark.range(first, first + n).select("id", F.concat(F.lit("k"), F.pmod("id", F.lit(keys)).cast("string")).alias("k"), F.expr("timestamp'1901-01-01' + make_dt_interval(0, 0, 0, id * 7)").alias("t"), F.pmod(F.col("id") * 31, F.lit(101)).cast("double").alias("v"))


def test_a_million_rows_of_one_key_in_one_batch(spark, tmp_path):
    carry = C.Carry(spark, str(tmp_path / "c"), "k")
    carry.put(0, _rates(_rows(spark, 10), None)[1])
    out, changed = _rates(_rows(spark, 1_000_000, 10), carry.before(1))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "hashpartitioning(k#" in plan and "_seq_bucket" in plan
    assert out.count() == 1_000_000  # the first one's predecessor is in the carry
    carry.put(1, changed)
    assert [(r.k, r["last"].id) for r in carry.before(2).collect()] == [("k0", 1_000_009)]


def test_batches_run_again_leave_the_same_table(spark, tmp_path, monkeypatch):
    """Every batch twice, with merged versions on the way: results and state
    are those of one pass over all rows."""
    monkeypatch.setattr(C, "MERGE", 3)
    carry, found = C.Carry(spark, str(tmp_path / "c"), "k"), {}
    for n in range(9):
        keys = 5 if n % 2 else 3  # some keys have no rows in a batch
        for _ in range(2):
            out, changed = _rates(_rows(spark, 40, 40 * n, keys), carry.before(n))
            found[n] = sorted(map(str, out.collect()))
            carry.put(n, changed)
    bases, deltas = carry.versions()
    assert bases and len(deltas) < 9
    whole = None
    for n in range(9):
        rows = _rows(spark, 40, 40 * n, 5 if n % 2 else 3)
        whole = rows if whole is None else whole.unionByName(rows)
    out, state = _rates(whole, None)
    assert sorted(r for rs in found.values() for r in rs) == sorted(map(str, out.collect()))
    assert sorted(map(str, carry.before(9).collect())) == sorted(map(str, state.collect()))


def test_periods_open_over_batches(spark, tmp_path):
    carry = C.Carry(spark, str(tmp_path / "c"), "k")
    values = {"a": [5, 1, 1, 1, 9, 1, 9], "b": [1, 1, 1, 1, 1, 1, 1], "c": [9, 9, 1, 9, 9, 1, 1]}
    rows = [(i, k, float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "id long, k string, v double").withColumn("t", F.expr("timestamp'1901-01-01' + make_dt_interval(0, cast(id as int))"))
    got = []
    for n in range(7):
        runs = periods(df.where(F.col("id") == n), "k", "t", "v", 2.0, ["id"], opened=carry.before(n))
        got += closed_periods(runs, "k").collect()
        carry.put(n, open_periods(runs, "k"))
    want = closed_periods(periods(df, "k", "t", "v", 2.0, ["id"]), "k").collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) == 3
    assert {r.k: str(r.opened)[11:13] for r in carry.before(7).collect() if r.opened} == {"b": "00", "c": "05"}


def test_late_row_becomes_the_storm_jobs_state(spark, tmp_path):
    """A late reading emits nothing but is what the next one is compared
    with; windows that are closed stay as they are."""
    at = lambda hm, pressure, wind=30.0: reading("02950099999", f"1901-01-01T{hm}:00", 5.0, wind=wind, visibility=1000, pressure=pressure)
    batches = [
        [at("00:00", 1015.0), at("02:00", 1010.0)],
        [at("00:30", 1003.0)],  # 85 minutes behind the watermark
        [at("02:10", 1002.0)],  # 8 hPa below 02:00, but 1 below the late one: 0.6 per hour
        [at("02:20", 1000.0)],  # 12 hPa per hour below 02:10
        [reading(SENTINEL, "2199-01-01T00:00:00", 0.0)],
        [reading(SENTINEL, "2199-06-01T00:00:00", 0.0)],
    ]
    src, table = tmp_path / "src", str(tmp_path / "table")
    src.mkdir()
    q = start(spark, "uc10", read_readings(spark, str(src), stream=True, max_files_per_trigger=1), table, name=f"late-storm-{time.time_ns()}")
    try:
        for i, records in enumerate(batches):
            drop_file(src, f"part-{i}.json", records, 1_000_000 + i)
            q.processAllAvailable()
    finally:
        q.stop()
    got = {str(r.window_start)[11:16]: r.pressure_drop_hpa_per_hour for r in read_table(spark, SINKS["uc10"], table).collect() if r.station != SENTINEL}
    assert got == {w: 12.0 for w in ("01:30", "01:40", "01:50", "02:00", "02:10", "02:20")}
