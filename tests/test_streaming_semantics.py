"""Late data and restart semantics of the streaming jobs."""

import time

from cirrus.schema import SINKS
from cirrus.sources.readings import read_readings
from cirrus.sources.sinks import read_table
from cirrus.streaming.jobs import start
from tests.documents import drop_file, reading
from tests.streaming_util import SENTINEL


def _feed(spark, tmp_path, uc, batches, name):
    """Each element of ``batches`` becomes one file, processed in order."""
    src, table = tmp_path / f"src-{uc}", str(tmp_path / f"table-{uc}")
    src.mkdir(parents=True, exist_ok=True)
    q = start(spark, uc, read_readings(spark, str(src), stream=True, max_files_per_trigger=1), table, name=name)
    try:
        for i, records in enumerate(batches):
            drop_file(src, f"part-{i}.json", records, 1_000_000 + i)
            q.processAllAvailable()
    finally:
        q.stop()
    return [r for r in read_table(spark, SINKS[uc], table).collect() if r[0] != SENTINEL]


def test_late_row_dropped_by_window_kept_by_state(spark, tmp_path):
    early = [reading("A", "1901-01-01T00:10:00", 1.0), reading("A", "1901-01-01T05:00:00", 2.0)]
    late = [reading("A", "1901-01-01T00:20:00", 100.0)]  # 4 h 40 min behind the watermark
    flush = [[reading(SENTINEL, "2199-01-01T00:00:00", 0.0)], [reading(SENTINEL, "2199-06-01T00:00:00", 0.0)]]
    stats = _feed(spark, tmp_path, "uc01", [early, late, *flush], f"late-uc01-{time.time_ns()}")
    first = [r for r in stats if r.window_size == "1h" and str(r.window_start) == "1901-01-01 00:00:00"]
    assert [(r.min_temp_c, r.max_temp_c) for r in first] == [(1.0, 1.0)]  # the late 100.0 was dropped
    rates = _feed(spark, tmp_path, "uc03", [early, late], f"late-uc03-{time.time_ns()}")
    got = {str(r.event_time): r.change_c_per_hour for r in rates}
    # the late row is processed in arrival order: previous = 05:00, so its gap is negative and nothing is emitted for it
    assert set(got) == {"1901-01-01 05:00:00"}
    assert len(rates) == 1


def test_restart_from_checkpoint_is_idempotent(spark, tmp_path):
    src, table = tmp_path / "src-restart", str(tmp_path / "table-restart")
    name = f"restart-{time.time_ns()}"
    rows = [reading("A", f"1901-01-01T0{h}:00:00", float(h)) for h in range(4)]
    drop_file(src, "part-0.json", rows[:2], 1_000_000)
    q = start(spark, "uc04", read_readings(spark, str(src), stream=True), table, name=name)
    q.processAllAvailable()
    q.stop()
    drop_file(src, "part-1.json", rows[2:], 2_000_000)
    q = start(spark, "uc04", read_readings(spark, str(src), stream=True), table, name=name)  # same checkpoint
    q.processAllAvailable()
    q.stop()
    got = sorted((str(r.interval_start), str(r.interval_end)) for r in read_table(spark, SINKS["uc04"], table).collect())
    assert got == [("1901-01-01 00:00:00", "1901-01-01 01:00:00"), ("1901-01-01 01:00:00", "1901-01-01 02:00:00"),
                   ("1901-01-01 02:00:00", "1901-01-01 03:00:00")]


def test_all_jobs_in_one_application(spark, tmp_path):
    from cirrus.__main__ import load_results
    from cirrus.sources.bookings import bookings_frame
    from cirrus.streaming.jobs import start_all

    src = tmp_path / "src-all"
    recs = [
        reading("02950099999", "1901-01-01T00:00:00", 5.0, wind=5.0, visibility=100, pressure=1015.0),
        reading("02950099999", "1901-01-01T00:30:00", 7.0, wind=25.0, visibility=150, pressure=1011.0),
        reading("02950099999", "1901-01-01T02:00:00", 6.0, wind=5.0, visibility=800, pressure=1010.0, temp_quality="3"),
        reading("02950099999", "1901-01-20T00:00:00", 9.0, wind=5.0, visibility=800, pressure=1010.0),
    ]
    drop_file(src, "part-0.json", recs, 1_000_000)
    qs = start_all(spark, read_readings(spark, str(src), stream=True), str(tmp_path / "results"), bookings_frame(spark), prefix=f"all-{time.time_ns()}")
    try:
        for q in qs:
            q.processAllAvailable()
        for i, day in enumerate(("2199-01-01T00:00:00", "2199-06-01T00:00:00")):
            drop_file(src, f"part-{i + 1}.json", [reading(SENTINEL, day, 0.0)], 2_000_000 + i)
            for q in qs:
                q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    tables = load_results(spark, str(tmp_path / "results"))
    assert sorted(tables) == sorted(SINKS)
    for uc, df in tables.items():
        assert df.count() > 0, uc


def test_backfilled_files_are_read(spark, tmp_path):
    """A file stamped decades before those already read is not left out."""
    src, table = tmp_path / "src-backfill", str(tmp_path / "table-backfill")
    drop_file(src, "new.json", [reading("A", "1901-01-01T00:00:00", 1.0), reading("A", "1901-01-01T01:00:00", 2.0)], int(time.time()))
    q = start(spark, "uc03", read_readings(spark, str(src), stream=True), table, name=f"backfill-{time.time_ns()}")
    try:
        q.processAllAvailable()
        drop_file(src, "old.json", [reading("B", "1901-01-01T00:00:00", 1.0), reading("B", "1901-01-01T01:00:00", 5.0)], 1_000)
        q.processAllAvailable()
    finally:
        q.stop()
    assert {r.station: r.change_c_per_hour for r in read_table(spark, SINKS["uc03"], table).collect()} == {"A": 1.0, "B": 4.0}


def test_new_checkpoint_over_an_old_table(spark, tmp_path):
    """A new run's rows win over an old run's later batches; a fresh run holds
    its own rows only."""
    table = str(tmp_path / "table-runs")

    def feed(name, batches, fresh=False):
        src = tmp_path / name
        q = None
        for i, records in enumerate(batches):
            drop_file(src, f"part-{i}.json", records, 1_000_000 + i)
            if q is None:
                q = start(spark, "uc04", read_readings(spark, str(src), stream=True, max_files_per_trigger=1), table, name=f"{name}-{time.time_ns()}", fresh=fresh)
            q.processAllAvailable()
        q.stop()
        return {(r.station, str(r.interval_end)): r.status for r in read_table(spark, SINKS["uc04"], table).collect()}

    at = lambda s, h: reading(s, f"1901-01-01T0{h}:00:00", 1.0)
    feed("first", [[at("A", 0)], [at("B", 0)], [at("A", 3)]])
    second = feed("second", [[at("A", 2), at("A", 3)]])
    assert second == {("A", "1901-01-01 03:00:00"): "complete"}
    assert feed("third", [[at("C", 0), at("C", 1)]], fresh=True) == {("C", "1901-01-01 01:00:00"): "complete"}


def test_dead_letters_of_a_stream(spark, tmp_path):
    """Lines that are no reading, or have no time, are kept with their text."""
    from cirrus.sources.readings import read_readings_split
    from cirrus.streaming.jobs import start_dead_letters

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('not json\n\n{"station": "A"}\n{"station": "A", "date": "1901-01-01T00:00:00"}\n')
    readings, dead = read_readings_split(spark, str(tmp_path / "in"), stream=True)
    q = start_dead_letters(spark, dead, str(tmp_path / "dead"), name=f"dead-{time.time_ns()}")
    q.processAllAvailable()
    q.stop()
    got = {(r.error, r.raw_message) for r in spark.read.parquet(str(tmp_path / "dead")).collect()}
    assert got == {("not a reading", "not json"), ("date is missing or not yyyy-MM-ddTHH:mm:ss", '{"station": "A"}')}
    assert read_readings_split(spark, str(tmp_path / "in"))[0].count() == 1
