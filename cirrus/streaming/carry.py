"""Keyed state as a stored table: what each key carries from one micro-batch
to the next.

A sequential job (K1-K4) is a batch operator over the micro-batch's rows that
begins where the carry left off, and a new carry for the keys that had rows.
No key's rows are gathered in one task and none pass through Python: the
operators spread a key over its time buckets, and the carry has one small row
a key.

The table is a folder of versions by batch number:

* ``delta=n``: the state after batch n of the keys that had rows in it;
* ``base=n``: the state of all keys after batch n, written every ``MERGE``
  batches, so that a read merges that many deltas at most.

Batch n reads the versions before n only and overwrites its own, so a batch
that is run again, whole or in part, finds and leaves what it did the first
time.  Versions older than the base before the last are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.sources.sinks import names_in, truncate

MERGE = 16

#: (rows of a batch, state or None) -> (result rows, new state of their keys)
Step = Callable[[DataFrame, "DataFrame | None"], tuple[DataFrame, DataFrame]]


class Carry:
    """The state (key, one or more columns) of one job, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def versions(self) -> tuple[list[int], list[int]]:
        found: dict[str, list[int]] = {"base": [], "delta": []}
        for name in names_in(self.spark, self.path):
            kind, _, n = name.partition("=")
            if kind in found and names_in(self.spark, f"{self.path}/{name}").count("_SUCCESS"):
                found[kind].append(int(n))
        return sorted(found["base"]), sorted(found["delta"])

    def before(self, batch: int) -> DataFrame | None:
        """Each key's state before ``batch``; None if there is none yet."""
        bases, deltas = self.versions()
        base = max((n for n in bases if n < batch), default=None)
        parts = [(n, f"delta={n}") for n in deltas if n < batch and (base is None or n > base)]
        if base is not None:
            parts.append((base, f"base={base}"))
        if not parts:
            return None
        out = None
        for n, name in parts:
            some = self.spark.read.parquet(f"{self.path}/{name}").withColumn("_version", F.lit(n))
            out = some if out is None else out.unionByName(some)
        columns = [c for c in out.columns if c not in (self.key, "_version")]
        latest = out.groupBy(self.key).agg(F.max_by(F.struct(*columns), "_version").alias("_state"))
        return latest.select(self.key, "_state.*")

    def put(self, batch: int, changed: DataFrame) -> None:
        """The state after ``batch`` of the keys that it changed."""
        changed.write.mode("overwrite").parquet(f"{self.path}/delta={batch}")
        bases, deltas = self.versions()
        if len([n for n in deltas if n > max((b for b in bases if b < batch), default=-1)]) >= MERGE:
            self.before(batch + 1).write.mode("overwrite").parquet(f"{self.path}/base={batch}")
            for kind, ns in (("base", bases), ("delta", deltas)):
                for n in ns:
                    if n < max((b for b in bases if b < batch), default=-1):
                        truncate(self.spark, f"{self.path}/{kind}={n}")


def stepped(carry: Carry, step: Step, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the batch's rows and the state before it
    through ``step``, its result to ``write``, then its state to the carry."""

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()  # read by the operator's summary, its rows, and the state
        try:
            out, changed = step(batch, carry.before(number))
            write(out, number)
            carry.put(number, changed)
        finally:
            batch.unpersist()

    return run
