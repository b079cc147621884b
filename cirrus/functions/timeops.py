"""Time helpers.

Operators accept ``timestamp`` or ``timestamp_ntz`` time columns and keep the
type they are given; durations are taken with ``timestamp_diff`` in
microseconds, which is exact and zone-independent for both types.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND

# Streaming watermarks start at 1970-01-01, so earlier event times would all be
# late: streams shift them by this many days at least (readings from 1697 on).
EPOCH_SHIFT_DAYS = 100_000

_UNIT_SECONDS = {
    "second": 1, "seconds": 1, "minute": 60, "minutes": 60,
    "hour": 3_600, "hours": 3_600, "day": 86_400, "days": 86_400,
}


def duration_seconds(text: str) -> int:
    """'10 minutes' -> 600.  Only fixed-length units (no months)."""
    amount, unit = text.strip().split()
    return int(amount) * _UNIT_SECONDS[unit.lower()]


def epoch_shift(*slides: str) -> Column:
    """The shift of a stream whose windows move by ``slides``: a whole number
    of each, so that window boundaries stay where they are."""
    unit = math.lcm(*(duration_seconds(s) for s in slides))
    seconds = -(-EPOCH_SHIFT_DAYS * 86_400 // unit) * unit
    return F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS_PER_SECOND))


def floor_time(time: Column | str, every: str | Column) -> Column:
    """Start of the epoch-aligned bucket of length ``every`` holding ``time``
    (same type as ``time``).

    A fixed length uses Spark's tumbling ``window()`` (fastest; one per
    projection, rows with a null time are dropped by it).  A per-row length
    (Column of seconds) uses ``floor_time_expr``."""
    if isinstance(every, str):
        return F.window(_c(time), every).start
    return floor_time_expr(time, every)


def floor_time_expr(time: Column | str, every: str | Column) -> Column:
    """``floor_time`` as plain arithmetic: usable several times in one
    projection, on aggregate results, or with a per-row length in seconds.
    A timestamp_ntz value is read as UTC wall-clock time."""
    step_us = F.lit(duration_seconds(every) * MICROS_PER_SECOND) if isinstance(every, str) else every.cast("bigint") * F.lit(MICROS_PER_SECOND)
    rem = F.pmod(F.unix_micros(_c(time).cast("timestamp")), step_us)
    return _c(time) - F.lit(timedelta(microseconds=1)) * rem


def to_event_time(date: Column | str) -> Column:
    """``TO_TIMESTAMP(REPLACE(date, 'T', ' '))``; strict, null when unparsable."""
    return F.try_to_timestamp(F.replace(_c(date), F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm:ss"))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
