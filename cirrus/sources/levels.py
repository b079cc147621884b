"""Levelled result tables: keyed rows by day, upserted batch by batch.

A table is a folder of immutable parts and a manifest:

* ``parts/<name>/day=<date>/``: rows of one batch (level 0) or of several
  merged ones (higher levels), partitioned by the day that panels ask for;
* ``manifest/v<n>``: which parts make up the table, with their levels, days
  and batches.  A version is put in place whole, and only if nobody else has
  put that number: a writer that comes second edits the newer version.

So a batch is visible at once or not at all, a reader sees one version, and
merging runs beside a writing stream without either losing rows.  ``merge``
takes the parts of a level once there are FANOUT of them and makes one of the
next: a row is rewritten once a level, and a read merges at most FANOUT parts
a level.  Rows with an equal primary key replace each other, the latest (run,
batch, place in the batch) wins; as that day is part of or determined by the
key, only parts of that day are looked at.

A batch that is run again replaces its part, or changes nothing if that has
been merged, as the same rows were.  Parts that no version names any more
are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cirrus.schema import SinkSpec
from cirrus.sources import files

FANOUT = 8
#: Versions kept besides the present one.
OLD_VERSIONS = 20
#: Where rows without a value that the table requires are put.
REJECTED = "rejected"
#: What orders the rows of a key.
_PLACE = ("_run", "_batch", "_seq")

_ONE_WRITER = threading.Lock()


class LevelledTable:
    def __init__(self, spark: SparkSession, spec: SinkSpec, path: str):
        self.spark, self.spec, self.path = spark, spec, path.rstrip("/")

    # ---------------------------------------------------------------- manifest
    def version(self) -> tuple[int, list[dict]]:
        """Number and parts of the present version; (0, []) without one."""
        for _ in range(10):
            n = max((int(v[1:]) for v in files.names_in(self.spark, f"{self.path}/manifest") if v.startswith("v")), default=0)
            if not n:
                return 0, []
            try:
                return n, json.loads(files.text_of(self.spark, self._manifest(n)))
            except Exception:  # noqa: BLE001  twenty newer versions came while it was read
                time.sleep(0.1)
        raise OSError(f"no readable version of {self.path}")

    def _manifest(self, n: int) -> str:
        return f"{self.path}/manifest/v{n:012d}"

    def _commit(self, edit: Callable[[list[dict]], list[dict] | None]) -> bool:
        """Puts the next version; ``edit`` says what it holds, None for no
        change, and is asked again if somebody else put one meanwhile."""
        while True:
            with _ONE_WRITER:
                n, parts = self.version()
                after = edit(parts)
                if after is None:
                    return False
                done = files.put_new(self.spark, self._manifest(n + 1), json.dumps(after))
            if done:
                old = self._manifest(n - OLD_VERSIONS)
                if n > OLD_VERSIONS:
                    files.delete(self.spark, old)
                return True

    # ------------------------------------------------------------------ writing
    def append(self, df: DataFrame, batch: int, run: int = 0) -> None:
        """Rows of batch ``batch`` of run ``run`` (a checkpoint's life; a later
        one has a higher number)."""
        part = self._part(self._rows(df, run, batch), 0, [[run, batch, batch]])

        def edit(parts: list[dict]) -> list[dict] | None:
            mine = [p for p in parts if any(r == run and a <= batch <= b for r, a, b in p["batches"])]
            if any(p["level"] for p in mine) or not mine and not part["days"]:
                return None
            return [p for p in parts if p not in mine] + ([part] if part["days"] else [])

        self._commit(edit)

    def replace(self, df: DataFrame) -> None:
        """A full refresh: from one version to the next the table has the rows
        of ``df`` instead of its own."""
        run = self.next_run()
        part = self._part(self._rows(df, run, 0), 0, [[run, 0, 0]])
        self._commit(lambda parts: [part])

    def _rows(self, df: DataFrame, run: int, batch: int) -> DataFrame:
        out = conform(df, self.spec).withColumn("_seq", F.monotonically_increasing_id())
        return out.withColumn("_run", F.lit(run).cast("long")).withColumn("_batch", F.lit(batch).cast("long"))

    def _part(self, rows: DataFrame, level: int, batches: list[list[int]]) -> dict:
        name = f"l{level}-{uuid.uuid4().hex}"
        lacking = F.lit(False)
        for f in self.spec.schema.fields:
            if not f.nullable:
                lacking = lacking | F.col(f.name).isNull()
        day = F.when(lacking, F.lit(REJECTED)).otherwise(F.date_format(F.col(self.spec.day), "yyyy-MM-dd"))
        # a day's rows in few files, a day with most rows in several
        rows.withColumn("day", day).hint("rebalance", "day").write.partitionBy("day").parquet(f"{self.path}/parts/{name}")
        days = sorted(n.removeprefix("day=") for n in files.names_in(self.spark, f"{self.path}/parts/{name}") if n.startswith("day="))
        return {"name": name, "level": level, "days": days, "batches": batches}

    # ------------------------------------------------------------------ reading
    def read(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """Per key its latest row, of the days ``since`` .. ``until``
        (yyyy-MM-dd, both included; all by default)."""
        rows = self._log(self.version()[1], since, until)
        names = [f.name for f in self.spec.schema.fields]
        rest = [c for c in names if c not in self.spec.primary_key]
        row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(True)
        latest = rows.groupBy(*self.spec.primary_key).agg(F.max_by(row, F.struct(*_PLACE)).alias("_row"))
        return latest.select(*[F.col(c) if c in self.spec.primary_key else F.col("_row").getField(c).alias(c) for c in names])

    def rejected(self) -> DataFrame:
        """Rows that lack a value the table requires."""
        return self._log(self.version()[1], REJECTED, REJECTED).drop(*_PLACE)

    def days(self) -> list[str]:
        return sorted({d for p in self.version()[1] for d in p["days"]} - {REJECTED})

    def _log(self, parts: list[dict], since: str | None, until: str | None) -> DataFrame:
        wanted = lambda d: (since or "") <= d <= (until or "~") and (d != REJECTED or since == REJECTED)
        leaves = [f"{self.path}/parts/{p['name']}/day={d}" for p in parts for d in p["days"] if wanted(d)]
        fields = [StructField(f.name, f.dataType) for f in self.spec.schema.fields]
        schema = StructType([*fields, *(StructField(c, LongType()) for c in ("_seq", "_run", "_batch"))])
        if not leaves:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*leaves)

    # ------------------------------------------------------------------ upkeep
    def merge(self, fanout: int = FANOUT) -> bool:
        """Merges the parts of the lowest level that has ``fanout`` of them
        into one of the next; false if there is none.  Writers needn't stop."""
        parts = self.version()[1]
        full = [n for n in sorted({p["level"] for p in parts}) if sum(p["level"] == n for p in parts) >= fanout]
        if not full:
            return False
        old = [p for p in parts if p["level"] == full[0]]
        names = {p["name"] for p in old}
        rows = self._log(old, None, None)
        rest = [c for c in rows.columns if c not in self.spec.primary_key]
        latest = rows.groupBy(*self.spec.primary_key).agg(F.max_by(F.struct(*rest), F.struct(*_PLACE)).alias("_row"))
        latest = latest.select(*self.spec.primary_key, "_row.*").unionByName(self._log(old, REJECTED, REJECTED))
        part = self._part(latest, full[0] + 1, sorted(b for p in old for b in p["batches"]))

        def edit(now: list[dict]) -> list[dict] | None:
            if not names <= {p["name"] for p in now}:
                return None  # merged, replaced or refreshed meanwhile
            return [p for p in now if p["name"] not in names] + [part]

        return self._commit(edit)

    def vacuum(self, older_than_seconds: int = 86_400) -> int:
        """Removes parts that no present version names and that are older:
        merged ones, and those of writers that didn't finish."""
        named = {p["name"] for p in self.version()[1]}
        limit = (time.time() - older_than_seconds) * 1000
        gone = [n for n, t in files.ages_in(self.spark, f"{self.path}/parts").items() if n not in named and t < limit]
        for name in gone:
            files.delete(self.spark, f"{self.path}/parts/{name}")
        return len(gone)

    def next_run(self) -> int:
        return max((r for p in self.version()[1] for r, _, _ in p["batches"]), default=-1) + 1


def conform(df: DataFrame, spec: SinkSpec) -> DataFrame:
    """The table's columns in order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
