"""Point-in-time join: every left row with the last right row of its key that
was known by then.

No row is paired with more than one other.  Both sides are put in one time
line per key, and the last right row travels along it as a prior maximum
(:func:`cirrus.operators.sequence.prior_agg`): a key that holds most rows is
spread over its time buckets, and neither side is broadcast or sorted whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.functions.timeops import duration_seconds, micros_between
from cirrus.operators.sequence import DEFAULT_BUCKET, DEFAULT_MAX_ROWS_PER_BUCKET, prior_agg


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    fields: Sequence[str],
    tiebreak: Sequence[str] = (),
    inclusive: bool = True,
    max_age: str | None = None,
    out: str = "known",
    bucket: str = DEFAULT_BUCKET,
    max_rows_per_bucket: int | None = DEFAULT_MAX_ROWS_PER_BUCKET,
) -> DataFrame:
    """``left`` with ``out``: struct(``right_time``, ``fields``) of the right row of the
    same ``key`` with the latest ``right_time`` that isn't after ``left_time``
    (is before it, if not ``inclusive``); null if there is none, or none of
    ``max_age`` at most.  Of right rows of one time the highest by
    ``tiebreak``, then by ``fields``, is taken.

    Right rows without key or time are never known; left rows without them
    are kept, with null.  Repeated left rows stay repeated.
    """
    names = [right_time, *tiebreak, *[f for f in fields if f not in (right_time, *tiebreak)]]
    known = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    time = left.schema[left_time].dataType
    r = known.select(F.col(key).alias("_key"), F.col(right_time).cast(time).alias("_t"), F.struct(*[F.col(n).alias(n) for n in names]).alias("_right"))
    on_line = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    whole = F.struct(*[F.col(c).alias(c) for c in left.columns]).alias("_left")
    line = left.where(on_line).select(F.col(key).alias("_key"), F.col(left_time).alias("_t"), whole).unionByName(r, allowMissingColumns=True)
    # at one time, known rows come before those that ask, or after
    side = F.when(F.col("_left").isNotNull(), 1 if inclusive else 0).otherwise(0 if inclusive else 1)
    line = prior_agg(line.withColumn("_side", side), "_key", "_t", ["_side"], F.col("_right"), "_last", "max", bucket, max_rows_per_bucket)
    last = F.col("_last")
    if max_age:
        last = F.when(micros_between(last.getField(right_time).cast(time), F.col("_t")) <= duration_seconds(max_age) * 1_000_000, last)
    kept = F.when(last.isNotNull(), F.struct(*[last.getField(n).alias(n) for n in dict.fromkeys([right_time, *fields])]))
    found = line.where(F.col("_left").isNotNull()).select("_left.*", kept.alias(out))
    return found.unionByName(left.where(~on_line).withColumn(out, F.lit(None).cast(found.schema[out].dataType)))


def yearly_baselines(readings: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """(key, year, baseline, known_from): the average of ``value`` per key and
    calendar year, known from the first instant of the next."""
    year = F.year(time)
    out = readings.where(F.col(value).isNotNull() & F.col(time).isNotNull()).groupBy(key, year.alias("year")).agg(F.avg(value).alias("baseline"))
    return out.withColumn("known_from", F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).cast(readings.schema[time].dataType))


def since_baseline(readings: DataFrame, baselines: DataFrame, key: str, time: str, value: Column, **how) -> DataFrame:
    """``readings`` with ``baseline`` and ``baseline_year``, the last that was
    known at each one's time, and ``deviation`` of ``value`` from it."""
    out = asof_join(readings, baselines, key, time, "known_from", ["year", "baseline"], **how)
    base = F.col("known").getField("baseline")
    return out.withColumn("baseline_year", F.col("known").getField("year")).withColumn("baseline", base).withColumn("deviation", value - base).drop("known")
