"""The analytics' vectors streamed into keyed result tables (data of 1901:
needs the epoch shift)."""

import pytest

from tests.documents import reading
from tests.streaming_util import run_stream
from tests.test_reference_vectors import documents, shown
from tests.vectors import RESULTS


@pytest.mark.parametrize("uc", ["uc03", "uc04", "uc06", "uc07", "uc09", "uc10"])
def test_streamed_vector(spark, tmp_path, uc):
    windowed = uc in ("uc06", "uc07", "uc10")
    assert shown(uc, run_stream(spark, tmp_path, uc, documents(uc), flush=windowed)) == RESULTS[uc][2]


def test_streamed_deviation_from_a_baseline_table(spark, tmp_path):
    base = spark.createDataFrame([("S", 1.5)], "station string, baseline double")
    rows = run_stream(spark, tmp_path, "uc05", [reading("S", "1901-01-01T00:00:00", 5.0), reading("S", "1901-01-01T12:00:00", 7.0)], baseline=base)
    assert {str(r.window_start): r.deviation_c for r in rows}["1901-01-01 00:00:00"] == 4.5
