"""Interval join (J1): readings x bookings on key equality with the reading's
time inside the booking's [start, end] (both ends inclusive).

A plain equi-join on the key alone would pair every reading of a station
with every booking of that station before the time filter.  Instead both
sides also join on a dyadic time range.  Time is cut into buckets; ranges of
1, 2, 4, 8, ... buckets, aligned to their length, cover it on levels 0, 1, 2,
3, ...  A booking becomes the fewest such ranges that together are its buckets
(at most two a level, so a booking of ten years has some 20 rows, not 3,650);
they don't overlap, so a reading meets a booking once at most.  A reading
looks itself up once on each level that bookings use, which are few.

Only readings and bookings that share a range are ever paired.  A hot station
is spread over its ranges, and a long range, which all readings of a station
in some years would meet in, over its buckets: ranges of more than
2^TOP_LEVEL buckets aren't used, a booking takes several of these instead.

No broadcast hint: Spark broadcasts the booking side when its estimated size
is under ``spark.sql.autoBroadcastJoinThreshold`` (always true for literal
tables) and AQE re-checks the real size at run time; above it the join is a
sort-merge join on (key, level, range) with AQE skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.functions.timeops import MICROS_PER_SECOND, duration_seconds

DEFAULT_BUCKET = "1 day"
#: Levels at most: a range of 2^11 days is 5.6 years of one station.
TOP_LEVEL = 11


def bucket_number(time: str, bucket: str) -> Column:
    """Number of the epoch-aligned bucket that ``time`` falls in."""
    us, step = f"unix_micros(cast(`{time}` as timestamp))", f"{duration_seconds(bucket) * MICROS_PER_SECOND}L"
    return F.expr(f"div({us} - pmod({us}, {step}), {step})")


def dyadic_ranges(first: Column, last: Column, top: int = TOP_LEVEL) -> Column:
    """The fewest aligned ranges of 2^level buckets, level up to ``top``, that
    make up the buckets first .. last, as an array of (level, range).

    On a level, the buckets not covered by lower ones run from a to b - 1 in
    that level's ranges; an odd a, and an odd b, are ends that the next level
    can't cover.  On the top level all that is left is taken."""
    out = []
    for level in range(top + 1):
        down = lambda n: F.shiftright(n, level)  # noqa: B023, E731
        a, b = down(first + F.lit((1 << level) - 1)), down(last + F.lit(1))
        one = lambda n: F.struct(F.lit(level).alias("level"), n.alias("range"))  # noqa: B023, E731
        none = F.array().cast("array<struct<level:int,range:bigint>>")
        if level == top:
            out.append(F.when(a < b, F.transform(F.sequence(a, b - 1), one)).otherwise(none))
        else:
            out.append(F.when((a < b) & (F.pmod(a, F.lit(2)) == 1), F.array(one(a))).otherwise(none))
            out.append(F.when((a < b) & (F.pmod(b, F.lit(2)) == 1), F.array(one(b - 1))).otherwise(none))
    return F.concat(*out)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    time: str,
    start: str,
    end: str,
    bucket: str = DEFAULT_BUCKET,
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` of the same key whose
    [start, end] holds their time; the columns of both, without those of
    ``right`` that ``left`` has too.  Null keys and times match nothing.  A
    stream looks itself up on all levels, as its bookings may change."""
    ranged = right.where(F.col(start) <= F.col(end)).withColumn("_js", bucket_number(start, bucket)).withColumn("_je", bucket_number(end, bucket))
    r = ranged.withColumn("_j", F.explode(dyadic_ranges(F.col("_js"), F.col("_je")))).drop("_js", "_je").alias("_r")
    at = lambda level: F.struct(F.lit(level).alias("level"), F.expr(f"shiftright(_jb, {level})").alias("range"))
    l = left.withColumn("_jb", bucket_number(time, bucket))
    l = l.withColumn("_j", F.explode(F.array(*[at(level) for level in (range(TOP_LEVEL + 1) if left.isStreaming else levels_of(ranged))]))).drop("_jb").alias("_l")
    cond: Column = (
        (F.col(f"_l.{left_key}") == F.col(f"_r.{right_key}"))
        & (F.col("_l._j.level") == F.col("_r._j.level"))
        & (F.col("_l._j.range") == F.col("_r._j.range"))
        & F.col(f"_l.{time}").between(F.col(f"_r.{start}"), F.col(f"_r.{end}"))
    )
    joined = l.join(r, cond, "inner")
    cols = [F.col(f"_l.{c}") for c in left.columns] + [F.col(f"_r.{c}") for c in right.columns if c not in left.columns]
    return joined.select(*cols)


def levels_of(ranged: DataFrame) -> list[int]:
    """The levels that bookings with buckets ``_js`` .. ``_je`` can use: up to
    the length of the longest one, by one aggregate over them."""
    longest = ranged.agg(F.max(F.col("_je") - F.col("_js") + 1)).first()[0] or 1
    return list(range(min(TOP_LEVEL, longest.bit_length() - 1) + 1))
