"""The historical baseline a rolling average is compared with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the built-in baseline formula:
# null station -> 4.0; else 2.0 + (integer of the first 6 characters mod 50) / 10.
NULL_STATION_BASELINE = 4.0
BASE_OFFSET = 2.0
PREFIX_LENGTH = 6
MODULUS = 50
DIVISOR = 10.0


def formula_baseline(station: Column) -> Column:
    """Native form of the per-station baseline formula.  ``pmod`` keeps the
    non-negative remainder of a positive modulus; a non-numeric prefix gives
    null (where a per-row function would fail)."""
    prefix = F.substring(station, 1, PREFIX_LENGTH).try_cast("bigint")
    value = F.lit(BASE_OFFSET) + F.pmod(prefix, F.lit(MODULUS)) / F.lit(DIVISOR)
    return F.when(station.isNull(), F.lit(NULL_STATION_BASELINE)).otherwise(value)
