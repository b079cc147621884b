"""Message-bus adapters (A4, A5).  They need the Kafka connector on the
classpath, which this environment does not ship, so they are option
builders around the standard ``kafka`` source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default topic names of the raw-line and readings streams.
RAW_TOPIC = "noaa.raw"
READINGS_TOPIC = "weather.readings"


# Messages a micro-batch takes at most.
MAX_OFFSETS = 1_000_000


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", group: str = "cirrus", max_offsets: int = MAX_OFFSETS
) -> DataFrame:
    """Value-only string stream from the earliest offset."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("groupIdPrefix", group)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def write_topic(values: DataFrame, servers: str, topic: str, checkpoint: str):
    """Value-only sink; ``values`` has one string column ``value``."""
    return (
        values.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def raw_events(messages: DataFrame) -> DataFrame:
    """Raw-event documents {source_file, row_number, raw_line} from values."""
    doc = F.from_json("value", "source_file STRING, row_number BIGINT, raw_line STRING")
    return messages.select(doc.alias("_e"), F.col("value").alias("_raw")).select("_e.*", "_raw")
