"""Top-N per window.

``row_number() <= n`` lets Spark insert a partial ``WindowGroupLimit`` before
the shuffle, so each map task forwards at most n rows per window: the final
ranking task never sees more than n x (map tasks) rows of a window, however
many keys there are.  A map task sorts all its rows for that, so where keys
are many, rows that can't be ranked are left out before (``within_reach``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.functions.timeops import duration_seconds, floor_time

#: Parts of the keys, for each place of a list, by which ``within_reach``
#: finds its bound: with eight the bound is hardly beyond the n-th place.
REACH = 8


def top_n(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int, rank_col: str = "rank_position") -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked.where(F.col(rank_col) <= n).withColumn(rank_col, F.col(rank_col).cast("bigint"))


def top_n_both_ends(
    windows: DataFrame,
    key: str,
    high: str,
    low: str,
    n: int = 10,
    out_value: str = "value",
    names: tuple[str, str] = ("hottest", "coldest"),
    window_cols: Sequence[str] = ("window_start", "window_end"),
    many_keys: bool = False,
) -> DataFrame:
    """Per window: the n keys with the highest ``high`` (ties by key ascending)
    and the n keys with the lowest ``low``; tagged ``list_name``.

    One pass for both lists: each window row is tagged once per list and
    ranked by a single ascending sort key (the negated ``high`` for the top
    list; the output carries the value itself, never the negation).
    ``many_keys``: only rows within reach of a list are sorted; ``windows`` is
    computed twice."""
    if many_keys:
        windows = within_reach(windows, key, high, low, n, window_cols)
    tagged = windows.select(key, *window_cols, high, low, F.explode(F.array(F.lit(names[0]), F.lit(names[1]))).alias("list_name"))
    top = F.col("list_name") == F.lit(names[0])
    tagged = tagged.withColumn("_ord", F.when(top, -F.col(high)).otherwise(F.col(low)))
    ranked = top_n(tagged, [*window_cols, "list_name"], [F.col("_ord").asc(), F.col(key).asc()], n)
    return ranked.select(
        key, *window_cols, "list_name", "rank_position", F.when(top, F.col(high)).otherwise(F.col(low)).alias(out_value)
    )


def within_reach(windows: DataFrame, key: str, high: str, low: str, n: int, window_cols: Sequence[str]) -> DataFrame:
    """The rows of ``windows`` that may be among a window's n first of either
    list of ``top_n_both_ends``: those as good as a bound that n keys reach.

    Keys are dealt into REACH x n parts; of the best values of a window's
    parts the n-th best is one that n rows have or surpass.  So only n rows,
    a few more, and ties of the bound are left, of any number of keys.  Rows
    without a value, which come first, stay, and so do windows of less parts
    than n."""
    part = F.pmod(F.xxhash64(key), F.lit(REACH * n)).alias("_part")
    # nulls and NaN are put in order as the ranking's sort does
    best = windows.groupBy(*window_cols, part).agg(F.min(-F.col(high)).alias("_top"), F.min(low).alias("_low"))
    nth = [F.get(F.array_sort(F.collect_list(c)), F.lit(n - 1)).alias(c) for c in ("_top", "_low")]
    bounds = best.groupBy(*window_cols).agg(*nth)
    missed = [F.coalesce(v > F.col(c), F.lit(False)) for v, c in ((-F.col(high), "_top"), (F.col(low), "_low"))]
    return windows.join(F.broadcast(bounds), list(window_cols), "left").where(~(missed[0] & missed[1])).select(*windows.columns)


def top_n_sliding(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    size: str,
    slide: str,
    n: int = 10,
    out_value: str = "value",
    names: tuple[str, str] = ("hottest", "coldest"),
) -> DataFrame:
    """Per sliding window (size a multiple of slide): the n keys with the
    highest max of ``value`` and the n with the lowest min, ties by key;
    the output of ``top_n_both_ends`` over per-(key, window) maxima / minima,
    from the lists of n keys of each pane (slide) alone.

    A key in a window's top n reaches its window value in some pane; every key
    ranked above it in that pane is also above it in the window, so it is in
    that pane's list, with that value.  All others have at most their own
    value in the lists, and rank behind.  So a window's lists are those of its
    panes merged: n x size/slide rows a window, whatever the number of keys;
    the input is read and aggregated once."""
    slide_s = duration_seconds(slide)
    k = duration_seconds(size) // slide_s
    top = F.col("list_name") == F.lit(names[0])
    order = [F.when(top, -F.col("_v")).otherwise(F.col("_v")).asc(), F.col(key).asc()]
    panes = df.groupBy(key, floor_time(time, slide).alias("_pane")).agg(F.max(value).alias("_hi"), F.min(value).alias("_lo"))
    ends = F.explode(F.array(*[F.struct(F.lit(name).alias("list_name"), F.col(c).alias("_v")) for name, c in zip(names, ("_hi", "_lo"))]))
    lists = top_n(panes.select(key, "_pane", ends.alias("_e")).select(key, "_pane", "_e.*"), ["_pane", "list_name"], order, n).drop("rank_position")
    shift = F.make_dt_interval(secs=(F.col("_i") * F.lit(slide_s)).cast("decimal(18,6)"))
    windows = lists.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("window_start", F.col("_pane") - shift)
    values = windows.groupBy(key, "list_name", "window_start").agg(F.max("_v").alias("_max"), F.min("_v").alias("_min"))
    values = values.select(key, "list_name", "window_start", F.when(top, F.col("_max")).otherwise(F.col("_min")).alias("_v"))
    ranked = top_n(values, ["window_start", "list_name"], order, n)
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(k * slide_s).cast("decimal(18,6)"))
    return ranked.select(key, "window_start", end.alias("window_end"), "list_name", "rank_position", F.col("_v").alias(out_value))
