"""The ten analytics on their vectors, in batch."""

import pytest

from cirrus.plans import usecases as U
from cirrus.sources.bookings import bookings_frame
from tests.documents import reading
from tests.vectors import READINGS, RESULTS


def documents(uc):
    return [reading(station, f"1901-01-{day:02d}T{time}:00", temp, **more) for station, day, time, temp, more in READINGS[uc]]


def shown(uc, rows):
    """The rows the vector looks at, as it writes them."""
    at, columns, _ = RESULTS[uc]
    text = lambda v: v.strftime("%d %H:%M") if hasattr(v, "strftime") else round(v, 9) if isinstance(v, float) else v
    return {tuple(text(r[c]) for c in columns) for r in rows if at is None or text(r["window_start"]) == at and r["window_start"].month == 1}


@pytest.mark.parametrize("uc", sorted(READINGS))
def test_vector(spark, readings_of, uc):
    readings = readings_of(documents(uc))
    out = U.user_notifications(readings, bookings_frame(spark)) if uc == "uc08" else U.ANALYTICS[uc](readings)
    assert shown(uc, out.collect()) == RESULTS[uc][2]


def test_deviation_from_a_baseline_table(spark, readings_of):
    base = spark.createDataFrame([("S", 1.5)], "station string, baseline double")
    out = U.temperature_deviation(readings_of([reading("S", "1901-01-01T00:00:00", 5.0)]), baseline=base)
    assert {r.deviation_c for r in out.collect()} == {3.5}
