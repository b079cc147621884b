"""Readings sources (A6, A7) and the event-time column.

The schema is declared, never inferred; unknown fields (e.g. ``columns``)
are ignored and a bad field becomes null.  A document that is no JSON object,
or has no event time, is a dead letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cirrus.functions.timeops import to_event_time
from cirrus.schema import READING

WATERMARK = "5 minutes"
ARRIVAL = ("source_file", "row_number")


NOT_A_READING = "not a reading"
NO_EVENT_TIME = "date is missing or not yyyy-MM-ddTHH:mm:ss"

# Files are read whatever their time stamps: backfilled ones are older than
# those already read.  (Spark's default drops files a week older.)
MAX_FILE_AGE = "36500d"
# Files a micro-batch takes at most, so that a backlog comes in portions.
MAX_FILES = 256


def with_event_time(readings: DataFrame) -> DataFrame:
    """Add ``event_time`` = TO_TIMESTAMP(REPLACE(date, 'T', ' ')) to readings
    that have one; for those without, see :func:`split_decoded`."""
    return readings.withColumn("event_time", to_event_time(F.col("date"))).where(F.col("event_time").isNotNull())


def arrival_order(readings: DataFrame) -> tuple[str, ...]:
    """Tie-break columns for equal event times: the line's position in its
    source, when the readings carry it."""
    return ARRIVAL if all(c in readings.columns for c in ARRIVAL) else ()


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages (JSON strings) as readings with ``event_time``, and the
    message (``_raw``) and whether it is a JSON object (``_decoded``)."""
    schema = StructType([*READING.fields, StructField("_corrupt", StringType(), True)])
    text = F.col(value).cast("string")
    doc: Column = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = messages.select(text.alias("_raw"), doc.alias("_r")).select("_r.*", "_raw")
    whole = F.col("_raw").isNotNull() & F.col("_corrupt").isNull()
    return out.withColumn("_decoded", whole).drop("_corrupt").withColumn("event_time", to_event_time(F.col("date")))


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings, dead letters) of :func:`decode`: a message that is no JSON
    object, or whose reading has no event time, is a dead letter with its text."""
    readings = decoded.where(F.col("event_time").isNotNull()).drop("_raw", "_decoded")
    error = F.when(F.col("_decoded"), F.lit(NO_EVENT_TIME)).otherwise(F.lit(NOT_A_READING))
    none = F.lit(None)
    dead = decoded.where(F.col("event_time").isNull())
    return readings, dead.select(error.alias("error"), F.col("_raw").alias("raw_message"), none.cast("string").alias("source_file"), none.cast("bigint").alias("row_number"))


def _lines(spark: SparkSession, path: str, stream: bool, max_files_per_trigger: int | None) -> DataFrame:
    """Non-empty lines of the files."""
    if stream:
        reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger or MAX_FILES).option("maxFileAge", MAX_FILE_AGE)
        lines = reader.text(path)
    else:
        lines = spark.read.text(path)
    return lines.where(F.trim("value") != "")


def read_readings(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines readings (one document per line) from files."""
    return read_readings_split(spark, path, stream, max_files_per_trigger)[0]


def read_readings_split(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(readings, dead letters) of JSON-lines files."""
    return split_decoded(decode(_lines(spark, path, stream, max_files_per_trigger)))


def read_normalized_stream(spark: SparkSession, out: str, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """Stream the readings half of a normalisation output (parquet written by
    ``run_normalizer`` or ``start_normalizer``), with ``event_time``."""
    from cirrus.schema import NORMALIZED

    reader = spark.readStream.schema(NORMALIZED).option("maxFilesPerTrigger", max_files_per_trigger).option("maxFileAge", MAX_FILE_AGE)
    return with_event_time(reader.parquet(f"{out.rstrip('/')}/kind=reading"))


def parse_readings(messages: DataFrame, value: str = "value") -> DataFrame:
    """Readings from message values (JSON strings), e.g. a Kafka topic."""
    return split_decoded(decode(messages, value))[0]


def parse_readings_split(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(readings, dead letters) of message values."""
    return split_decoded(decode(messages, value))
