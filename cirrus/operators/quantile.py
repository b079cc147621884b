"""Exact percentiles per group, for groups of any size.

A percentile of n sorted values is interpolated between those of two ranks.
Each wanted rank is searched by values, all groups and ranks at once: a range
of values that holds it is cut into ``PARTS`` equal parts, the group's values
in the range are counted per part, and what lies in the part that holds the
rank, from its least to its highest value, is the next range.  A round reads
the values once and shuffles at most PARTS counts for each rank and task; a
group is never sorted or gathered.  Once few values are left in a range, or
only equal ones, they are counted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.operators.sequence import checkpointed

#: Parts of a range; values of a range that are counted one by one.
PARTS, FEW = 256, 100_000


def percentiles(df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float], few: int = FEW) -> DataFrame:
    """(keys, one column ``p<percent>`` for each of ``fractions``): percentiles
    of each group's finite values, interpolated between the two nearest ranks.
    Groups without any are left out; null keys are a group."""
    keys = list(keys)
    v = F.col(value).cast("double")
    x = df.select(*[F.col(k).alias(k) for k in keys], v.alias("_v")).where(F.abs("_v") < float("inf"))
    x = checkpointed(x)
    sizes = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = sizes.withColumn("_f", F.explode(F.array(*[F.lit(float(f)) for f in fractions]))).withColumn("_at", F.col("_f") * (F.col("_n") - 1))
    # of every rank: the range that holds it, the values in it and below it
    rank = F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_r")
    ranks = checkpointed(wanted.select(*keys, rank, "_lo", "_hi", F.col("_n").alias("_in"), F.lit(0).cast("long").alias("_below")).distinct())
    done = None
    while True:
        small = (F.col("_lo") == F.col("_hi")) | (F.col("_in") <= few)
        done = ranks.where(small) if done is None else done.unionByName(ranks.where(small))
        ranks = ranks.where(~small)
        if ranks.isEmpty():
            break
        ranks = checkpointed(_narrowed(x, ranks, keys))
    found = checkpointed(_counted(x, done, keys))
    low, high = (found.select(*[F.col(k).alias(f"_{s}{k}") for k in keys], F.col("_r").alias(f"_{s}r"), F.col("_v").alias(f"_{s}v")) for s in ("l", "h"))
    both = wanted.join(low, _same(keys, "_l") & (F.floor("_at") == F.col("_lr"))).join(high, _same(keys, "_h") & (F.ceil("_at") == F.col("_hr")))
    between = F.col("_lv") + (F.col("_hv") - F.col("_lv")) * (F.col("_at") - F.floor("_at"))
    columns = [F.max(F.when(F.col("_f") == F.lit(float(f)), between)).alias(f"p{f * 100:g}".replace(".", "_")) for f in fractions]
    return both.groupBy(*keys).agg(*columns)


def _same(keys: list[str], prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return out


def _inside(x: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Every value with the ranks whose ranges it lies in."""
    own = ranks.select(*[F.col(k).alias(f"_k{k}") for k in keys], "_r", "_lo", "_hi", "_below")
    return x.join(own, _same(keys, "_k") & F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _holding(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of each rank's counts ``_c`` in ``order`` the one that it falls in."""
    along = Window.partitionBy(*[f"_k{k}" for k in keys], "_r").orderBy(order)
    summed = counts.withColumn("_upto", F.col("_below") + F.sum("_c").over(along))
    return summed.where((F.col("_r") < F.col("_upto")) & (F.col("_r") >= F.col("_upto") - F.col("_c")))


def _narrowed(x: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    # halves, as the difference of two doubles may be none; it rises with the value
    share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
    part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1).cast("long")).alias("_part")
    group = [*[f"_k{k}" for k in keys], "_r", "_below"]
    counts = _inside(x, ranks, keys).groupBy(*group, part).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    held = _holding(counts, keys, "_part")
    return held.select(*[F.col(f"_k{k}").alias(k) for k in keys], "_r", "_lo", "_hi", F.col("_c").alias("_in"), (F.col("_upto") - F.col("_c")).alias("_below"))


def _counted(x: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _r, _v): the value of each rank, equal values counted together."""
    group = [*[f"_k{k}" for k in keys], "_r", "_below"]
    counts = _inside(x, ranks, keys).groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return _holding(counts, keys, "_v").select(*[F.col(f"_k{k}").alias(k) for k in keys], "_r", "_v")
