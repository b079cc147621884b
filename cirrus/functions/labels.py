"""Display label of a station id, ``substr(s, 1, 6) || '-' || substr(s, 7)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REST = 2_147_483_647  # substring to the end


def station_label(station: Column) -> Column:
    return F.concat(F.substring(station, 1, 6), F.lit("-"), F.substring(station, 7, REST))
