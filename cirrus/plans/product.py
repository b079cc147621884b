"""The product end to end on the driver's tables: raw station lines built from
``events`` are normalised into readings filed by day, the ten analytics run on
them, and the ten panels' SQL runs on the stored result tables.

As in production, normalising and storing results happen once (per application
and version of ``events``): a ``product_uc..`` query is one analytic over the
stored readings, a ``product_s..`` query one panel over a stored table, of
which it reads the panel's days.  ``pane_..`` queries make windows from stored
panes, added in two runs.

Times leave as timestamp_ntz and floats rounded as in ``cirrus.plans.events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from cirrus.plans import events as E
from cirrus.plans import normalize as norm
from cirrus.plans import panes as P
from cirrus.plans import usecases as U
from cirrus.plans.serving import serve_stored
from cirrus.schema import SINKS
from cirrus.session import scratch_path
from cirrus.sources import files
from cirrus.sources.readings import with_event_time
from cirrus.sources.sinks import write_table

_MADE: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """The folder that ``make`` fills, once for an application and version of
    the events table."""
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    where, fs = files.at(spark, table)
    changed = max([fs.getFileStatus(where).getModificationTime(), *files.ages_in(spark, table).values()])
    known = (spark.sparkContext.applicationId, sf_dir, changed, name)
    if known not in _MADE:
        path = scratch_path(spark, name)
        make(path)
        _MADE[known] = path
    return _MADE[known]


def normalized(spark: SparkSession, sf_dir: str) -> str:
    """Readings of all events, filed by day: station by user, temperature,
    wind, visibility and (falling as the value rises) pressure by value."""
    tenths = F.lpad(F.floor(F.lit(10_000) - F.col("value") * 10).cast("bigint").cast("string"), 5, "0")

    def make(path: str) -> None:
        norm.write_normalized(norm.events_as_raw_lines(E._events(spark, sf_dir), F.concat(tenths, F.lit(",1"))), path, by_day=True)

    return _once(spark, sf_dir, "readings", make)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(norm.read_normalized(spark, normalized(spark, sf_dir))[0])


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = E.bookings(spark, sf_dir)
    return b.select(
        F.col("booking_user").alias("user_id"),
        F.col("booking_id").cast("string").alias("booking_id"),
        F.lpad(F.col("resort_id").cast("string"), 11, "0").alias("resort_id"),
        F.col("booking_start").cast("timestamp").alias("booking_start"),
        F.col("booking_end").cast("timestamp").alias("booking_end"),
    )


def result(spark: SparkSession, sf_dir: str, uc: str) -> DataFrame:
    x = readings(spark, sf_dir)
    return U.user_notifications(x, bookings(spark, sf_dir)) if uc == "uc08" else U.ANALYTICS[uc](x)


def _comparable(df: DataFrame) -> DataFrame:
    def one(f):
        if isinstance(f.dataType, TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return E._r(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def _analytic(uc: str):
    return lambda spark, sf_dir: _comparable(result(spark, sf_dir, uc))


def _panel(uc: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = SINKS[uc]
        root = _once(spark, sf_dir, f"results-{uc}", lambda path: write_table(result(spark, sf_dir, uc), spec, f"{path}/{spec.name}"))
        return _comparable(serve_stored(spark, root, f"s{uc[2:]}", E.SERVE_FROM, E.SERVE_TO))

    return run


def _from_panes(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        E._events(spark, sf_dir)  # the session reads times as UTC

        def make(path: str) -> None:
            days = norm.days_in(spark, normalized(spark, sf_dir))
            for known in (days[: len(days) // 2], days):  # a second run adds what is new
                P.reading_panes(spark, path).add(readings(spark, sf_dir), known)

        return _comparable(P.ANALYTICS[name](P.reading_panes(spark, _once(spark, sf_dir, "panes", make))))

    return run


QUERIES = {f"product_{uc}": _analytic(uc) for uc in SINKS} | {f"product_s{uc[2:]}": _panel(uc) for uc in SINKS} | {f"pane_{name}": _from_panes(name) for name in P.ANALYTICS}
