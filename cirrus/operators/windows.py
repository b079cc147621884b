"""Event-time window aggregation.

Windows are half-open ``[start, end)``, aligned to the epoch, and only
windows holding at least one row exist.

Sliding windows have three physical strategies:

* ``blocks``: aggregate once into slide-long tumbling panes (partial aggregate
  before the shuffle); cut the time line into blocks as long as a window, so
  that a window is the end of one block and the beginning of the next.  A
  running aggregate over a block's panes gives all its beginnings, one
  backwards all its ends, and every window is the combination of two of them.
  Each pane crosses the shuffle twice, whatever size / slide is; windows are
  spelled out behind it, as runs of equal ones, and not aggregated again.
  Needs size to be a multiple of slide.
* ``expand``: Spark's own ``window(time, size, slide)``; every row is copied
  size/slide times before the (partial) aggregate.
* ``panes``: panes as above, but each pane is copied size/slide times and
  shuffled again.
* ``auto`` (default): ``blocks`` where size is a multiple of slide, else
  ``expand``; the same at every size of the data and of the window.

All aggregates used here are decomposable (sum, count, min, max, avg as
sum/count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from cirrus.functions.timeops import MICROS_PER_SECOND, duration_seconds, floor_time

# aggregate spec: (output name, kind, input column or expression)
AggSpec = tuple[str, str, "Column | str"]

_PANE = {
    "sum": lambda c: [F.sum(c)],
    "count": lambda c: [F.count(c)],
    "min": lambda c: [F.min(c)],
    "max": lambda c: [F.max(c)],
    "avg": lambda c: [F.sum(c), F.count(c)],
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _partials(aggs: Sequence[AggSpec]) -> list[Column]:
    out = []
    for name, kind, c in aggs:
        parts = _PANE[kind](_col(c))
        suffixes = ["_s", "_n"] if kind == "avg" else ["_p"]
        out += [p.alias(f"{name}{s}") for p, s in zip(parts, suffixes)]
    return out


def _merge(aggs: Sequence[AggSpec]) -> list[Column]:
    out = []
    for name, kind, _ in aggs:
        if kind == "avg":
            out.append(F.try_divide(F.sum(f"{name}_s"), F.sum(f"{name}_n")).alias(name))
        elif kind in ("sum", "count"):
            out.append(F.sum(f"{name}_p").alias(name))
        else:
            out.append(getattr(F, kind)(f"{name}_p").alias(name))
    return out


def pane_parts(aggs: Sequence[AggSpec]) -> list[str]:
    """Names of the partial columns of ``aggs``."""
    return [c for c, _ in _running(aggs)]


def _running(aggs: Sequence[AggSpec]):
    """Partial columns and what merges them."""
    for name, kind, _ in aggs:
        if kind == "avg":
            yield from ((f"{name}_s", F.sum), (f"{name}_n", F.sum))
        else:
            yield f"{name}_p", {"min": F.min, "max": F.max}.get(kind, F.sum)


def _native(aggs: Sequence[AggSpec]) -> list[Column]:
    fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}
    return [fn[kind](_col(c)).alias(name) for name, kind, c in aggs]


def pane_aggregate(df: DataFrame, key, time: str, every: str, aggs: Sequence[AggSpec], pane: str = "_pane") -> DataFrame:
    """Partial aggregates per (key, tumbling pane of length ``every``)."""
    return df.groupBy(*_keys(key), floor_time(time, every).alias(pane)).agg(*_partials(aggs))


def merge_panes(panes: DataFrame, key, pane: str, size: str, slide: str, aggs: Sequence[AggSpec]) -> DataFrame:
    """Windows of ``size`` sliding by ``slide`` from panes of length ``slide``."""
    keys = _keys(key)
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    copies = size_s // slide_s
    if copies == 1:
        grouped = panes.withColumnRenamed(pane, "window_start")
        merged = grouped.groupBy(*keys, "window_start").agg(*_merge(aggs))
    else:
        expanded = panes.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
            "window_start", F.col(pane) - F.make_dt_interval(secs=(F.col("_k") * F.lit(slide_s)).cast("decimal(18,6)"))
        )
        merged = expanded.groupBy(*keys, "window_start").agg(*_merge(aggs))
    return merged.withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(size_s).cast("decimal(18,6)")))


def _both(kind, a: Column, b: Column, of: DataType) -> Column:
    """What the aggregate ``kind`` makes of two partial results of type
    ``of``, either of which may be null."""
    if kind is F.min or kind is F.max:
        return (F.least if kind is F.min else F.greatest)(a, b)
    if isinstance(of, DecimalType):  # all digits are kept, and the type is that of a sum
        narrow = DecimalType(min(of.precision, 37), of.scale)
        a, b = a.cast(narrow), b.cast(narrow)
        return F.coalesce(a + b, a, b).cast(DecimalType(min(of.precision + 10, 38), of.scale))
    return F.coalesce(a + b, a, b)


def merge_blocks(panes: DataFrame, key, pane: str, size: str, slide: str, aggs: Sequence[AggSpec]) -> DataFrame:
    """Windows of ``size`` sliding by ``slide`` from partial aggregates per
    (key, pane), one row for each (see ``blocks``).

    With panes numbered and k = size / slide to a block, window s (its first
    pane) of block b takes the panes s .. of b and those below s + k of b + 1.
    So a pane p of b is left by the window p + 1, and a pane p of b + 1 is met
    by the window p - k + 1; between two such places of a block all windows
    hold the same.  A row of the shuffle gives the run of windows before its
    place, the last one of a block also the run from there on.  Windows are
    spelled out last and nothing holds them: a task sorts its share of the
    panes, and a block of a key is 2 x size / slide rows at most."""
    keys = _keys(key)
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    k = size_s // slide_s
    parts = [c for c in panes.columns if c not in (*keys, pane)]
    kind = panes.schema[pane].dataType
    number = F.expr(f"div(unix_micros(cast(`{pane}` as timestamp)) - pmod(unix_micros(cast(`{pane}` as timestamp)), {slide_s * MICROS_PER_SECOND}L), {slide_s * MICROS_PER_SECOND}L)")
    x = panes.select(*keys, *parts, number.alias("_p")).withColumn("_b", F.expr(f"div(_p - pmod(_p, {k}L), {k}L)"))
    both = x.withColumn("_end", F.explode(F.array(F.lit(True), F.lit(False))))
    both = both.where(F.col("_end") | (F.expr(f"pmod(_p, {k}L)") < k - 1))  # no window of b meets the last pane of b + 1
    place = F.when(F.col("_end"), F.col("_p") + 1).otherwise(F.col("_p") - (k - 1))
    block = F.when(F.col("_end"), F.col("_b")).otherwise(F.col("_b") - 1)
    dealt = both.select(*keys, *parts, "_end", place.alias("_c"), block.alias("_b")).repartition(*[F.col(c) for c in (*keys, "_b")])
    of_block = Window.partitionBy(*keys, "_b")
    still = of_block.orderBy(F.col("_c").desc()).rangeBetween(Window.unboundedPreceding, 0)
    line = of_block.orderBy("_c")
    met, met_here = line.rangeBetween(Window.unboundedPreceding, -1), line.rangeBetween(Window.unboundedPreceding, 0)
    merged = [*_running(aggs), ("_any", F.sum)]
    rows = dealt.withColumn("_any", F.lit(1))
    rows = rows.select("*", *[fn(F.when(F.col("_end"), F.col(c))).over(still).alias(f"{c}_e") for c, fn in merged])
    new = lambda c, fn, over: fn(F.when(~F.col("_end"), F.col(c))).over(over)
    rows = rows.select(
        *keys, "_b", "_c", F.lag("_c").over(line).alias("_from"), F.lead("_c").over(line).isNull().alias("_last"), *[f"{c}_e" for c, _ in merged],
        *[new(c, fn, met).alias(f"{c}_m") for c, fn in merged], *[new(c, fn, met_here).alias(f"{c}_h") for c, fn in merged],
    )
    of = {c: rows.schema[f"{c}_e"].dataType for c, _ in merged}
    how = dict(merged)

    def result(name: str, agg: str, of_part) -> Column:
        return (F.try_divide(of_part(f"{name}_s"), of_part(f"{name}_n")) if agg == "avg" else of_part(f"{name}_p")).alias(name)

    before = lambda c: _both(how[c], F.col(f"{c}_e"), F.col(f"{c}_m"), of[c])
    behind = lambda c: _both(how[c], F.lit(None).cast(of[c]), F.col(f"{c}_h"), of[c])
    first, end = F.col("_b") * k, F.col("_b") * k + k
    low = F.when(F.col("_any_e").isNotNull() | F.col("_any_m").isNotNull(), F.coalesce("_from", first)).otherwise(F.col("_c"))
    high = F.when(F.col("_last") & F.col("_any_h").isNotNull(), end).otherwise(F.col("_c"))
    runs = rows.select(
        *keys, "_c", low.alias("_low"), high.alias("_high"),
        F.struct(*[result(n, a, before) for n, a, _ in aggs]).alias("_before"), F.struct(*[result(n, a, behind) for n, a, _ in aggs]).alias("_behind"),
    )
    spelled = F.when(F.col("_low") < F.col("_high"), F.sequence(F.col("_low"), F.col("_high") - 1))
    windows = runs.select(*keys, "_c", "_before", "_behind", F.explode(spelled).alias("_s"))
    at = lambda n: F.timestamp_micros(n * (slide_s * MICROS_PER_SECOND)).cast(kind)
    values = [F.when(F.col("_s") < F.col("_c"), F.col("_before").getField(a[0])).otherwise(F.col("_behind").getField(a[0])).alias(a[0]) for a in aggs]
    return windows.select(*keys, at(F.col("_s")).alias("window_start"), at(F.col("_s") + k).alias("window_end"), *values)


def sliding_agg(
    df: DataFrame,
    key,
    time: str,
    size: str,
    slide: str,
    aggs: Sequence[AggSpec],
    strategy: str = "auto",
) -> DataFrame:
    """Aggregate per (key, sliding window).  Output: key columns, window_start,
    window_end, one column per aggregate."""
    keys = _keys(key)
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    if strategy == "auto":
        strategy = "expand" if size_s % slide_s else "blocks"
    if strategy in ("panes", "blocks"):
        if size_s % slide_s:
            raise ValueError(f"{strategy} need a size that is a multiple of the slide, not {size} by {slide}")
        panes = pane_aggregate(df, keys, time, slide, aggs)
        out = (merge_blocks if strategy == "blocks" else merge_panes)(panes, keys, "_pane", size, slide, aggs)
    else:
        w = F.window(time, size, slide) if size_s != slide_s else F.window(time, size)
        out = (
            df.groupBy(*keys, w.alias("_w"))
            .agg(*_native(aggs))
            .withColumn("window_start", F.col("_w.start"))
            .withColumn("window_end", F.col("_w.end"))
            .drop("_w")
        )
    return out.select(*keys, "window_start", "window_end", *[a[0] for a in aggs])


def tumbling_stats(
    df: DataFrame,
    key,
    time: str,
    value: str,
    sizes: Sequence[tuple[str, str]] = (("1h", "1 hour"), ("24h", "24 hours")),
    names: tuple[str, str, str] = ("min_value", "max_value", "avg_value"),
) -> DataFrame:
    """G1 + U1: min / max / avg of the non-null ``value`` per key and tumbling
    window, for several window sizes, as one table tagged by ``window_size``.

    One scan and one shuffle for all sizes: each row is expanded once per size
    (as grouping sets are) and partially aggregated map-side, so only one
    partial row per (key, size, window, map task) crosses the shuffle."""
    keys = _keys(key)
    mn, mx, av = names
    per_size = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(duration_seconds(size)).cast("bigint").alias("secs")) for label, size in sizes])
    x = df.where(F.col(value).isNotNull()).select(*keys, time, value, F.explode(per_size).alias("_sz"))
    agg = x.groupBy(
        *keys,
        F.col("_sz.label").alias("window_size"),
        F.col("_sz.secs").alias("_secs"),
        floor_time(time, F.col("_sz.secs")).alias("window_start"),
    ).agg(F.min(value).alias(mn), F.max(value).alias(mx), F.avg(value).alias(av))
    return agg.select(
        *keys,
        "window_size",
        "window_start",
        (F.col("window_start") + F.make_dt_interval(secs=F.col("_secs").cast("decimal(18,6)"))).alias("window_end"),
        mn,
        mx,
        av,
    )
