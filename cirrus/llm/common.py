"""Shared helpers: intermediate tables in the shared checkpoint folder,
bounded Arrow batches, running sums over salted buckets, word rules."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cirrus.session import checkpoint_root, ship_package

#: Fixed value: the white space that separates words in every word rule here.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Rows of one Arrow batch handed to Python, so that a batch of long texts
#: stays within a worker's memory; batches of short texts are only smaller.
BATCH_ROWS = 2000
BATCH_BYTES = 32 << 20

_WRITTEN: list[tuple[SparkSession, str]] = []


def bounded_batches(spark: SparkSession) -> None:
    """Before Python runs on the executors: they get this package, and the
    session's Arrow batches stay within BATCH_ROWS rows and BATCH_BYTES bytes."""
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        try:
            now = int(spark.conf.get(name))
        except Exception:  # noqa: BLE001  an older Spark without this setting
            continue
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def give_back() -> None:
    """Called in a Python process when it has done a task: what it freed goes
    back to the system, as the process waits beside the executor's heap for
    tasks of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: computed once, lineage cut, and not lost with an executor.  The
    files are removed when the application ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if (passing := _PASSING.get()) is not None:
        passing.append((out, spark, path))
    return out


#: Tables stored in the innermost :func:`passing_tables`.
_PASSING: contextvars.ContextVar[list[tuple[DataFrame, SparkSession, str]] | None] = contextvars.ContextVar("passing", default=None)


@contextlib.contextmanager
def passing_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """The files of all tables that are stored in here go at its end, but for
    tables that were given to the function that it yields, which returns them.
    Nothing that reads the others may be left."""
    outer, mine, kept = _PASSING.get(), [], []
    token = _PASSING.set(mine)
    try:
        yield lambda table: kept.append(table) or table
    finally:
        _PASSING.reset(token)
        for table, spark, path in mine:
            if not any(table is k for k in kept):
                _remove(spark, path)
                _WRITTEN.remove((spark, path))
            elif outer is not None:
                outer.append((table, spark, path))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint folder, removed when
    the application ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/cirrus-llm/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_remove_written)
    _WRITTEN.append((spark, path))
    return path


def _remove_written() -> None:
    for spark, path in _WRITTEN:
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the session is gone: nothing to remove with
            return


def _remove(spark: SparkSession, path: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words (runs free of ASCII white space); null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def columns_of(spark: SparkSession, sf_dir: str, table: str, *names: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*names)


def running_sum(df: DataFrame, keys: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """Exact sum of ``value`` over the rows before each row, per ``keys``.

    A key may hold most rows, and rows may tie in ``order``, so no task sees a
    whole key: all rows are range-partitioned by keys, order and, so that ties
    part too, their place in ``df``; they are summed inside their (range, key),
    and only the totals of these (a key's ranges, and one for each key in a
    range) are summed along the key.  Adds column ``out`` (sum of all earlier
    rows) and keeps the others.  ``df`` is read several times: pass a stored table.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [f"_k{i}" for i in range(len(keys))]
    rows = df.select("*", *[F.col(k).alias(a) for k, a in zip(keys, by)], F.monotonically_increasing_id().alias("_tie"))
    along = [*[F.col(b) for b in by], *order, F.col("_tie")]
    ranged = rows.repartitionByRange(width, *along).sortWithinPartitions(*along).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_range", F.shiftright("_at", 33)), "ranges")
    totals = ranged.groupBy(*by, "_range").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(*[F.col(b).alias(f"{b}t") for b in by], F.col("_range").alias("_rt"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy("_range", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("_range") == F.col("_rt")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"{b}t"))
    return summed.join(earlier, same, "left").select(*df.columns, (F.col("_inside") + F.col("_earlier")).alias(out))


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with ``out``: 0, 1, ... in ``order``, as a stored table.

    Rows are range-partitioned by ``order`` and numbered inside their
    partitions; a partition's base is the prefix sum of the partitions' sizes,
    so no task sees more than its range.  ``order`` should tell rows apart:
    rows that tie stay in one partition.  ``df`` is read twice: pass a stored
    table."""
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the number that Spark gives holds the partition above its lower 33 bits
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("_numbered_at", F.monotonically_increasing_id())
    ranged = stored(ranged, "numbered")
    part, at = F.shiftright("_numbered_at", 33), F.col("_numbered_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("_numbered_part")).agg(F.count(F.lit(1)).alias("_numbered_size"))
    bases = sizes.select("_numbered_part", (F.sum("_numbered_size").over(Window.orderBy("_numbered_part")) - F.col("_numbered_size")).alias("_numbered_base"))
    return ranged.join(bases, part == F.col("_numbered_part")).select(*df.columns, (F.col("_numbered_base") + at).alias(out))
