"""State across micro-batches: the events-derived readings, split into
time-ordered files and fed one file per trigger, give the batch results."""

import glob
import json
import time

import pytest

from cirrus.plans import usecases as U
from cirrus.schema import SINKS
from cirrus.sources.readings import read_readings
from cirrus.sources.sinks import read_table
from cirrus.streaming.jobs import start
from tests.documents import drop_file, reading
from tests.streaming_util import SENTINEL
from tests.test_batch_equals_stream import _norm, events_as_readings  # noqa: F401  (fixture)


@pytest.mark.parametrize("uc", ["uc01", "uc02", "uc03", "uc04", "uc05", "uc06", "uc07", "uc09", "uc10"])
def test_multi_batch_equals_batch(spark, tmp_path, events_as_readings, uc):  # noqa: F811
    want = U.ANALYTICS[uc](read_readings(spark, events_as_readings)).collect()
    records = [json.loads(line) for p in glob.glob(events_as_readings + "/*.txt") for line in open(p)]
    records.sort(key=lambda r: r["date"])
    src, table = tmp_path / "src", str(tmp_path / "table")
    src.mkdir()
    q = start(spark, uc, read_readings(spark, str(src), stream=True, max_files_per_trigger=1), table, name=f"mb-{uc}-{time.time_ns()}")
    try:
        chunks = [records[k * len(records) // 4:(k + 1) * len(records) // 4] for k in range(4)]
        chunks += [[reading(SENTINEL, "2199-01-01T00:00:00", 0.0)], [reading(SENTINEL, "2199-06-01T00:00:00", 0.0)]]
        for i, chunk in enumerate(chunks):
            drop_file(src, f"part-{i}.json", chunk, 1_000_000 + i)
            q.processAllAvailable()
    finally:
        q.stop()
    got = [r for r in read_table(spark, SINKS[uc], table).collect() if r["station"] != SENTINEL]
    cols = U.ANALYTICS[uc](read_readings(spark, events_as_readings)).columns
    assert _norm(got, cols) == _norm(want, cols)
