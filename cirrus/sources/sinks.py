"""Result tables (A9-A12, T7): keyed upsert into levelled tables, full
refreshes of them, and JDBC options.

A streamed table has one part per micro-batch, merged as they become many
(``cirrus.sources.levels``).  A job's run number stays with its checkpoint; a
new checkpoint over an old table is a new run, whose rows win over all before.
Batch jobs replace a table's rows as a whole (the analogue of truncating
before a run).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cirrus.schema import SinkSpec
from cirrus.sources import files
from cirrus.sources.files import names_in as names_in
from cirrus.sources.levels import LevelledTable, conform


def upsert_latest(df: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per primary key: the last in ``order``.  Groups are rows that
    share a full primary key (duplicates), so they stay small."""
    w = Window.partitionBy(*pk).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_up_rn", F.row_number().over(w)).where(F.col("_up_rn") == 1).drop("_up_rn")


def write_table(df: DataFrame, spec: SinkSpec, path: str) -> None:
    """Full refresh of a result table from a batch result."""
    LevelledTable(df.sparkSession, spec, path).replace(df)


def append_batch(df: DataFrame, spec: SinkSpec, path: str, batch_id: int, run: int = 0) -> None:
    LevelledTable(df.sparkSession, spec, path).append(df, batch_id, run)


def read_table(spark: SparkSession, spec: SinkSpec, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Per key its latest row; only the files of the days ``since`` ..
    ``until`` (yyyy-MM-dd) are read."""
    return LevelledTable(spark, spec, path).read(since, until)


def compact(spark: SparkSession, spec: SinkSpec, path: str, fanout: int = 2) -> None:
    """Merges until no level has ``fanout`` parts, and removes what is no
    longer used.  A stream may go on writing."""
    table = LevelledTable(spark, spec, path)
    while table.merge(fanout):
        pass
    table.vacuum()


def truncate(spark: SparkSession, path: str) -> None:
    """Remove a table's rows, as before a fresh run."""
    files.delete(spark, path)


def next_run(spark: SparkSession, spec: SinkSpec, path: str) -> int:
    return LevelledTable(spark, spec, path).next_run()


def is_table(spark: SparkSession, path: str) -> bool:
    return "manifest" in files.names_in(spark, path)


def upsert_writer(spec: SinkSpec, path: str, transform=None, run: int = 0):
    """``foreachBatch`` function appending each micro-batch to a keyed table,
    and merging its parts when they are many; ``transform`` (optional) runs
    batch-only logic on the micro-batch first."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        table = LevelledTable(batch.sparkSession, spec, path)
        table.append(out, batch_id, run)
        table.merge()

    return _write


def jdbc_options(url: str, table: str, user: str, password: str, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    """Options for a JDBC result table (driver jar must be on the classpath)."""
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def write_jdbc(df: DataFrame, spec: SinkSpec, options: dict[str, str], mode: str = "append") -> None:
    """Write a (deduplicated) result to a JDBC table."""
    conform(df, spec).write.format("jdbc").options(**options).mode(mode).save()
