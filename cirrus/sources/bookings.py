"""Literal bookings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns and types of a bookings table.
BOOKING = {"user_id": "string", "booking_id": "string", "resort_id": "string", "booking_start": "timestamp", "booking_end": "timestamp"}

# The built-in bookings (user, booking, resort station, start, end).
DEFAULT_BOOKINGS = [
    ("u-001", "b-001", "02907099999", "1901-01-01 00:00:00", "1901-01-02 00:00:00"),
    ("u-002", "b-002", "02950099999", "1901-01-01 00:00:00", "1901-01-02 00:00:00"),
    ("u-003", "b-003", "22707099999", "1901-01-01 00:00:00", "1901-01-02 00:00:00"),
]


def bookings_frame(spark: SparkSession, rows=None) -> DataFrame:
    """Rows of texts (the built-in ones by default) as a bookings table."""
    texts = spark.createDataFrame(DEFAULT_BOOKINGS if rows is None else rows, ", ".join(f"{c} string" for c in BOOKING))
    return texts.select(*[F.col(c).cast(t).alias(c) for c, t in BOOKING.items()])
