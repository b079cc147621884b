"""Normalisation jobs: one-pass batch run over raw files and the streaming
form over raw-event documents give the same readings and dead letters."""

import json
import time

from cirrus.plans.normalize import normalize, read_normalized, run_normalizer
from cirrus.schema import RAW_EVENT
from cirrus.sources.raw import read_raw, supported_raw_line
from cirrus.streaming.jobs import start_normalizer
from tests.test_raw_source import _write


def _flat(df):
    return sorted((r.station, r.date, r.temperature.value_celsius, r.row_number) for r in df.collect())


def test_batch_job_and_stream_agree(spark, tmp_path):
    _write(tmp_path, "1901", "A", 40)
    d = tmp_path / "data" / "1901" / "BAD.csv"
    d.write_text('"STATION","DATE"\n\n"X","not a date"\n"X","1901-01-01T00:00:00","4"\n')
    out = str(tmp_path / "norm")
    run_normalizer(spark, str(tmp_path / "data"), out)
    readings, dead = read_normalized(spark, out)
    assert readings.count() == 41
    assert sorted(r.error for r in dead.collect()) == ["DATE is missing or not yyyy-MM-ddTHH:mm:ss", "empty line"]

    # the same lines as raw-event documents on a stream
    raw = supported_raw_line(read_raw(spark, str(tmp_path / "data"))).collect()
    src = tmp_path / "raw_events"
    src.mkdir()
    (src / "part-0.json").write_text("\n".join(json.dumps(r.asDict()) for r in raw))
    stream = spark.readStream.schema(RAW_EVENT).json(str(src))
    sout = str(tmp_path / "norm_stream")
    q = start_normalizer(spark, stream, sout, name=f"norm-{time.time_ns()}")
    q.processAllAvailable()
    q.stop()
    s_readings, s_dead = read_normalized(spark, sout)
    assert _flat(s_readings) == _flat(readings)
    assert s_dead.count() == 2
    b_readings, _ = normalize(supported_raw_line(read_raw(spark, str(tmp_path / "data"))))
    assert _flat(b_readings) == _flat(readings)


def test_message_values_round_trip(spark):
    """Readings -> JSON message values (sink side) -> parsed readings (source side)."""
    from cirrus.plans.normalize import to_json_lines
    from cirrus.sources.readings import parse_readings
    from tests.test_normalize import LINE

    raw = spark.createDataFrame([(LINE,), ("",)], "raw_line string")
    readings, _ = normalize(raw)
    values = to_json_lines(readings)
    back = parse_readings(values).collect()
    assert len(back) == 1
    r = back[0]
    assert r.station == "02907099999" and r.temperature.value_celsius == -7.8 and r.wind.speed_rate == 15.9
    assert str(r.event_time) == "1901-01-01 06:00:00"
    bad = spark.createDataFrame([("{not json",), ('{"station": "X"}',)], "value string")
    assert parse_readings(bad).count() == 0  # no parsable date: not a reading


def test_streaming_chain_raw_to_results(spark, tmp_path):
    """raw events -> streaming normaliser -> readings stream -> keyed job -> result table."""
    from cirrus.schema import SINKS
    from cirrus.sources.readings import read_normalized_stream
    from cirrus.sources.sinks import read_table
    from cirrus.streaming.jobs import start

    _write(tmp_path, "1901", "02907099999", 6)
    raw = supported_raw_line(read_raw(spark, str(tmp_path / "data"))).collect()
    src = tmp_path / "raw_events"
    src.mkdir()
    (src / "part-0.json").write_text("\n".join(json.dumps(r.asDict()) for r in raw))
    norm_out, table = str(tmp_path / "norm"), str(tmp_path / "gaps")
    q1 = start_normalizer(spark, spark.readStream.schema(RAW_EVENT).json(str(src)), norm_out, name=f"chain-n-{time.time_ns()}")
    q1.processAllAvailable()
    q2 = start(spark, "uc04", read_normalized_stream(spark, norm_out), table, name=f"chain-g-{time.time_ns()}")
    q2.processAllAvailable()
    q1.stop()
    q2.stop()
    rows = read_table(spark, SINKS["uc04"], table).collect()
    assert len(rows) == 5 and {r.status for r in rows} == {"complete"}
