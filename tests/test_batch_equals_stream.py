"""Batch and streaming forms of each analytic agree on readings derived
from the driver's events table (sf0.001, whole table)."""

import math

import pytest
from pyspark.sql import functions as F

from cirrus.plans import usecases as U
from cirrus.sources.bookings import bookings_frame
from cirrus.sources.readings import read_readings
from tests.conftest import SF_SMALL
from tests.streaming_util import run_stream


@pytest.fixture(scope="module")
def events_as_readings(spark, tmp_path_factory):
    """One reading document per event: station = user id, temperature =
    value (invalid for 'error' events), wind = value / 10, visibility =
    value * 20, pressure falling with value."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ok = F.col("event_type") != "error"
    doc = F.struct(
        F.col("user_id").cast("string").alias("station"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.struct(F.lit(270).alias("direction_angle"), F.lit("1").alias("direction_quality"), F.lit("N").alias("type"),
                 (F.col("value") / 10).alias("speed_rate"), F.lit("1").alias("speed_quality"), F.lit(True).alias("speed_is_valid")).alias("wind"),
        F.struct((F.col("value") * 20).cast("int").alias("distance_meters"), F.lit("1").alias("quality"),
                 F.lit(True).alias("is_valid")).alias("visibility"),
        F.struct(F.col("value").alias("value_celsius"), F.when(ok, "1").otherwise("3").alias("quality"),
                 ok.alias("is_valid")).alias("temperature"),
        F.struct((F.lit(1050.0) - F.col("value") / 4).alias("value_hpa"), F.lit("1").alias("quality"),
                 F.lit(True).alias("is_valid")).alias("sea_level_pressure"),
    )
    out = tmp_path_factory.mktemp("events_readings")
    ev.select(F.to_json(doc).alias("value")).coalesce(1).write.mode("overwrite").text(str(out / "data"))
    return str(out / "data")


def _norm(rows, cols):
    def v(x):
        if isinstance(x, float):
            return round(x, 6) + 0.0 if not math.isnan(x) else "nan"
        return str(x)
    return sorted(tuple(v(r[c]) for c in cols) for r in rows)


@pytest.mark.parametrize("uc", ["uc01", "uc02", "uc03", "uc04", "uc05", "uc06", "uc07", "uc08", "uc09", "uc10"])
def test_batch_equals_stream(spark, tmp_path, events_as_readings, uc):
    batch_readings = read_readings(spark, events_as_readings)
    if uc == "uc08":
        rows = [(f"u{i}", f"b{i}", str(i), "2024-01-05 00:00:00", "2024-01-20 00:00:00") for i in range(15)]
        bookings = bookings_frame(spark, rows)
        batch = U.user_notifications(batch_readings, bookings)
        kwargs = {"bookings": bookings}
    else:
        batch = U.ANALYTICS[uc](batch_readings)
        kwargs = {}
    want = batch.collect()
    assert want, "empty batch result"
    import json
    records = [json.loads(line) for p in __import__("glob").glob(events_as_readings + "/*.txt") for line in open(p)]
    got = run_stream(spark, tmp_path, uc, records, flush=uc not in ("uc03", "uc04", "uc08", "uc09"), **kwargs)
    cols = batch.columns
    assert _norm(got, cols) == _norm(want, cols)
