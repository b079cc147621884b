import itertools
import time

from cirrus.schema import SINKS
from cirrus.sources.readings import read_readings
from cirrus.sources.sinks import read_table
from cirrus.streaming.jobs import start
from tests.documents import drop_file, reading

SENTINEL = "~sentinel"
_ids = itertools.count()


def run_stream(spark, tmp_path, uc, records, flush=True, **kwargs):
    """Stream ``records`` through job ``uc`` into its keyed table; a reading
    of a reserved station far in the future then moves the watermark past
    every window (end of input does not close windows)."""
    n = next(_ids)
    src = tmp_path / f"src{n}"
    drop_file(src, "part-0.json", records, 1_000_000)
    table = str(tmp_path / f"table{n}")
    q = start(spark, uc, read_readings(spark, str(src), stream=True), table, name=f"{uc}-{n}-{time.time_ns()}", **kwargs)
    try:
        q.processAllAvailable()
        if flush:
            for i, day in enumerate(("2199-01-01T00:00:00", "2199-06-01T00:00:00")):
                drop_file(src, f"part-{i + 1}.json", [reading(SENTINEL, day, 0.0)], 2_000_000 + i)
                q.processAllAvailable()
    finally:
        q.stop()
    try:
        df = read_table(spark, SINKS[uc], table)
    except Exception:  # nothing was ever written
        return []
    key = "resort_id" if uc == "uc08" else "station"
    return [r for r in df.collect() if r[key] != SENTINEL]
