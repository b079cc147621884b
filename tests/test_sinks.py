"""Keyed result tables: upsert by primary key, replays, days, levels, and
merging beside a writer."""

import threading

from pyspark.sql import functions as F

from cirrus.plans.serving import serve_stored
from cirrus.schema import SINKS
from cirrus.sources import files
from cirrus.sources.levels import LevelledTable
from cirrus.sources.sinks import append_batch, compact, is_table, next_run, read_table, truncate, upsert_latest, write_table

GAP = "station string, interval_start string, interval_end string, status string"


def test_upsert_and_replay(spark, tmp_path):
    spec = SINKS["uc04"]
    path = str(tmp_path / "gaps")
    b0 = spark.createDataFrame(
        [("A", "1901-01-01 00:00:00", "1901-01-01 01:00:00", "complete"), ("B", "1901-01-01 00:00:00", "1901-01-01 03:00:00", "incomplete")],
        "station string, interval_start string, interval_end string, status string",
    )
    b1 = spark.createDataFrame(
        [("A", "1901-01-01 00:30:00", "1901-01-01 01:00:00", "incomplete")],
        "station string, interval_start string, interval_end string, status string",
    )
    append_batch(b0, spec, path, 0)
    append_batch(b1, spec, path, 1)
    append_batch(b1, spec, path, 1)  # replay after a failure
    rows = {(r.station, str(r.interval_end)): r.status for r in read_table(spark, spec, path).collect()}
    assert rows == {("A", "1901-01-01 01:00:00"): "incomplete", ("B", "1901-01-01 03:00:00"): "incomplete"}


def test_upsert_latest(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "k string, o int, v string")
    assert sorted((r.k, r.v) for r in upsert_latest(df, ["k"], ["o"]).collect()) == [("j", "c"), ("k", "b")]


def test_empty_replay_runs_and_compaction(spark, tmp_path):
    spec, path = SINKS["uc04"], str(tmp_path / "gaps")
    row = lambda k, status: spark.createDataFrame([(k, "1901-01-01 00:00:00", "1901-01-01 01:00:00", status)], GAP)
    status = lambda: {r.station: r.status for r in read_table(spark, spec, path).collect()}
    assert not is_table(spark, path) and next_run(spark, spec, path) == 0
    append_batch(row("A", "complete"), spec, path, 7)
    append_batch(row("B", "complete"), spec, path, 8)
    append_batch(row("B", "complete").where("false"), spec, path, 8)  # a replay without rows
    assert status() == {"A": "complete"}
    append_batch(row("A", "incomplete"), spec, path, 0, run=next_run(spark, spec, path))  # a later run's first batch
    assert status() == {"A": "incomplete"} and is_table(spark, path)
    compact(spark, spec, path)
    assert status() == {"A": "incomplete"} and next_run(spark, spec, path) == 2
    write_table(row("C", "complete"), spec, path)  # a full refresh
    assert status() == {"C": "complete"}
    truncate(spark, path)
    assert not is_table(spark, path)


def _gaps(spark, batch):
    """Five keys of ten days; every batch rewrites some keys of the one before."""
    rows = spark.range(50).select(
        F.concat(F.lit("S"), F.pmod("id", F.lit(5)).cast("string")).alias("station"),
        F.lit("1901-01-01 00:00:00").alias("interval_start"),
        F.date_format(F.expr(f"timestamp'1901-01-01 06:00:00' + make_dt_interval(cast(id / 5 as int) + {batch} % 3)"), "yyyy-MM-dd HH:mm:ss").alias("interval_end"),
        F.lit(f"b{batch:02d}").alias("status"),
    )
    return rows


def test_writer_and_merger_together_lose_nothing(spark, tmp_path):
    """Batches, some of them twice, while another thread merges all the time:
    the table is what the batches make in order."""
    spec, path = SINKS["uc04"], str(tmp_path / "gaps")
    table, stop, merged, failed = LevelledTable(spark, spec, path), threading.Event(), [], []

    def merger():
        try:
            while not stop.is_set():
                merged.append(LevelledTable(spark, spec, path).merge(2))
        except Exception as e:  # noqa: BLE001  told to the test
            failed.append(e)

    thread = threading.Thread(target=merger)
    thread.start()
    want = {}
    try:
        for n in range(9):
            for _ in range(2 if n % 4 == 3 else 1):
                table.append(_gaps(spark, n), n)
            want |= {(r.station, r.interval_end): r.status for r in _gaps(spark, n).collect()}
            got = {(r.station, str(r.interval_end)): r.status for r in table.read().collect()}
            assert got == want
    finally:
        stop.set()
        thread.join()
    assert not failed and sum(merged) >= 3
    compact(spark, spec, path)
    assert {(r.station, str(r.interval_end)): r.status for r in table.read().collect()} == want
    parts = table.version()[1]
    assert len({p["level"] for p in parts}) == len(parts) and max(p["level"] for p in parts) >= 2
    assert sorted(b for p in parts for b in p["batches"]) == [[0, n, n] for n in range(9)]
    table.append(_gaps(spark, 0), 0)  # run again although merged: nothing changes
    assert table.version()[1] == parts
    assert table.vacuum(0) > 5 and {(r.station, str(r.interval_end)): r.status for r in table.read().collect()} == want


def test_panel_reads_only_its_days(spark, tmp_path):
    spec, root = SINKS["uc01"], str(tmp_path)
    rows = spark.range(40).select(
        F.lit("02907099999").alias("station"), F.lit("24h").alias("window_size"), F.expr("date_add(date'1901-01-01', cast(id as int))").cast("timestamp").alias("window_start"),
        F.expr("date_add(date'1901-01-02', cast(id as int))").cast("timestamp").alias("window_end"), *[F.col("id").cast("double").alias(c) for c in ("min_temp_c", "max_temp_c", "avg_temp_c")]
    )
    write_table(rows, spec, f"{root}/{spec.name}")
    out = serve_stored(spark, root, "s01", "1901-01-10 00:00:00", "1901-01-12 23:00:00")
    assert [str(r.time) for r in out.collect()] == [f"1901-01-{d} 00:00:00" for d in (10, 11, 12)]
    table = LevelledTable(spark, spec, f"{root}/{spec.name}")
    read = table.read("1901-01-10", "1901-01-12").inputFiles()
    assert {f.split("day=")[1][:10] for f in read} == {"1901-01-10", "1901-01-11", "1901-01-12"} and len(table.days()) == 40


def test_rows_without_a_required_value_are_set_aside(spark, tmp_path):
    spec, path = SINKS["uc05"], str(tmp_path / "deviation")
    schema = "station string, window_start string, window_end string, deviation_c double"
    good = ("02907099999", "1901-01-01 00:00:00", "1901-01-02 00:00:00", 1.5)
    bad = [("~none", "1901-01-01 00:00:00", "1901-01-02 00:00:00", None), (None, "1901-01-01 00:00:00", "1901-01-02 00:00:00", 2.0)]
    for n in range(3):
        append_batch(spark.createDataFrame([good, *bad], schema), spec, path, n)
    table = LevelledTable(spark, spec, path)
    assert [r.deviation_c for r in table.read().collect()] == [1.5] and table.rejected().count() == 6
    table.merge(2)
    assert [r.deviation_c for r in table.read().collect()] == [1.5] and table.rejected().count() == 6
    assert not spec.schema["deviation_c"].nullable and SINKS["uc01"].schema["avg_temp_c"].nullable


def test_one_of_two_writers_puts_a_version(spark, tmp_path):
    path = str(tmp_path / "m" / "v1")
    assert files.put_new(spark, path, "first") and not files.put_new(spark, path, "second")
    assert files.text_of(spark, path) == "first" and files.names_in(spark, str(tmp_path / "m")) == ["v1"]
