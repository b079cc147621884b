"""Normalisation job (N1-N13): raw station lines -> nested readings.

One projection of native expressions; no Python per row.  Output is split
into readings and dead letters (empty lines, lines without a parsable date).

Empty versus missing fields: the CSV reader returns null for both, but the
format distinguishes them ('' when the field is present but empty, null
when the line ends before it).  A line whose 16th field has text holds all of
them; otherwise the number of fields present is the number of commas outside
quoted text plus one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.functions import rawformat as fmt
from cirrus.functions.timeops import to_event_time
from cirrus.sources import files

_CSV_SCHEMA = ", ".join(f"`{c}` STRING" for c in fmt.RAW_COLUMNS)
_CSV_OPTIONS = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}
# a quoted field, with doubled quotes inside; possessive, so that its length
# costs no stack
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'

EMPTY_LINE = "empty line"
NOT_RAW_EVENT = "not a raw event"
BAD_DATE = "DATE is missing or not yyyy-MM-ddTHH:mm:ss"


def parse_fields(df: DataFrame, line: str = "raw_line") -> DataFrame:
    """Add one column ``_f_<NAME>`` per raw field ('' when present but empty,
    null when the line ends before it) and ``_n`` (fields present).  The CSV
    parse runs once per line, in a projection of its own."""
    text = F.coalesce(F.col(line), F.lit(""))
    bare = F.regexp_replace(text, _QUOTED, "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    last = F.col("_csv").getField(fmt.RAW_COLUMNS[-1])
    n = F.when(last.isNotNull(), F.lit(len(fmt.RAW_COLUMNS))).otherwise(commas + F.lit(1))
    parsed = df.select("*", F.from_csv(text, _CSV_SCHEMA, _CSV_OPTIONS).alias("_csv")).select("*", n.alias("_n"))
    fields = [
        F.when(F.lit(i) < F.col("_n"), F.coalesce(F.col("_csv").getField(c), F.lit(""))).alias(f"_f_{c}")
        for i, c in enumerate(fmt.RAW_COLUMNS)
    ]
    # event time straight from the parsed DATE (missing and empty both give
    # null), so a filter on it pushed below this projection needs no comma count
    et = to_event_time(F.col("_csv").getField("DATE")).alias("_et")
    return parsed.select("*", *fields, et).drop("_csv")


def normalize_tagged(raw: DataFrame, line: str = "raw_line") -> DataFrame:
    """raw (raw_line [, source_file, row_number]) -> one row per line with the
    reading columns, ``kind`` ('reading' | 'dead_letter') and, for dead
    letters, ``error`` and ``raw_message``.  A job writes this once,
    partitioned by ``kind``, so each line is parsed once.  A column ``_raw``
    (the message that a raw event came in) is the text of its dead letter; a
    message without a line is no raw event."""
    raw = raw if "_raw" in raw.columns else raw.withColumn("_raw", F.col(line))
    for c, t in (("source_file", "string"), ("row_number", "bigint")):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast(t))
    x = parse_fields(raw, line)
    f = lambda c: F.col(f"_f_{c}")
    # split each compound field once; the structs below read the arrays
    x = x.select("*", *[fmt.parts(f(layout.column)).alias(f"_p_{name}") for name, layout in fmt.LAYOUTS.items()])
    n = F.least(F.col("_n"), F.lit(len(fmt.RAW_COLUMNS)))
    names = F.array(*[F.lit(c.lower()) for c in fmt.RAW_COLUMNS])
    values = F.array(*[f(c) for c in fmt.RAW_COLUMNS])
    reading = x.select(
        F.col(line).alias("_line"),
        "_raw",
        f("STATION").alias("station"),
        f("DATE").alias("date"),
        f("SOURCE").alias("source"),
        fmt.number(F.coalesce(f("LATITUDE"), F.lit(""))).alias("latitude"),
        fmt.number(F.coalesce(f("LONGITUDE"), F.lit(""))).alias("longitude"),
        fmt.number(F.coalesce(f("ELEVATION"), F.lit(""))).alias("elevation"),
        f("NAME").alias("name"),
        f("REPORT_TYPE").alias("report_type"),
        f("CALL_SIGN").alias("call_sign"),
        f("QUALITY_CONTROL").alias("quality_control"),
        *[fmt.compound(layout, F.col(f"_p_{name}")).alias(name) for name, layout in fmt.LAYOUTS.items()],
        # The columns present on the line (the first n), lower-cased name -> raw text
        F.map_from_arrays(F.slice(names, 1, n), F.slice(values, 1, n)).alias("columns"),
        "source_file",
        F.col("row_number").cast("bigint").alias("row_number"),
        "_et",
    )
    empty = F.coalesce(F.col("_line"), F.lit("")) == ""
    bad = empty | F.col("_et").isNull()
    return reading.select(
        *[c for c in reading.columns if c not in ("_line", "_raw", "_et")],
        F.when(bad, F.lit(DEAD)).otherwise(F.lit(READING)).alias("kind"),
        F.when(F.col("_line").isNull() & F.col("_raw").isNotNull(), F.lit(NOT_RAW_EVENT)).when(empty, F.lit(EMPTY_LINE)).when(bad, F.lit(BAD_DATE)).alias("error"),
        F.when(bad, F.coalesce("_raw", "_line")).alias("raw_message"),
    )


READING, DEAD = "reading", "dead_letter"
DEAD_COLUMNS = ["error", "raw_message", "source_file", "row_number"]


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    readings = tagged.where(F.col("kind") == READING).drop("kind", "error", "raw_message")
    dead = tagged.where(F.col("kind") == DEAD).select(*DEAD_COLUMNS)
    return readings, dead


def normalize(raw: DataFrame, line: str = "raw_line") -> tuple[DataFrame, DataFrame]:
    """raw (raw_line [, source_file, row_number]) -> (readings, dead letters)."""
    return split_tagged(normalize_tagged(raw, line))


def run_normalizer(spark, data_dir: str, out: str, year=None, station=None, max_records=None, by_day: bool = False) -> None:
    """Batch normalisation job: raw files -> readings and dead letters, one
    pass (each line parsed once), see :func:`write_normalized`.
    Fields past the 16th are ignored by the parse, so lines are not cut to 16
    columns first; a dead letter keeps its whole original line."""
    from cirrus.sources.raw import read_first, read_raw

    raw = read_first(spark, data_dir, year, station, max_records) if max_records else read_raw(spark, data_dir, year, station)
    write_normalized(raw, out, by_day)


def write_normalized(raw: DataFrame, out: str, by_day: bool = False) -> None:
    """Raw lines normalised into parquet partitioned by ``kind``; with
    ``by_day`` also by the reading's day, for analytics that read some days
    only (one shuffle, so that a day has few files)."""
    tagged = normalize_tagged(raw)
    if not by_day:
        tagged.write.mode("overwrite").partitionBy("kind").parquet(out)
        return
    day = F.when(F.col("kind") == READING, F.substring("date", 1, 10))
    tagged.withColumn("day", day).hint("rebalance", "kind", "day").write.mode("overwrite").partitionBy("kind", "day").parquet(out)


def read_normalized(spark, out: str) -> tuple[DataFrame, DataFrame]:
    """(readings, dead letters) of a normalisation output; the ``kind``
    partition filter prunes the other half.  Readings filed by day have the
    partition column ``day``."""
    return split_tagged(spark.read.parquet(out))


def days_in(spark, out: str) -> list[str]:
    """The days of a normalisation output filed by day."""
    names = files.names_in(spark, f"{out.rstrip('/')}/kind={READING}")
    return sorted(n.removeprefix("day=") for n in names if n.startswith("day="))


def to_json_lines(readings: DataFrame) -> DataFrame:
    """A5: one JSON document per reading (value column for a message sink)."""
    return readings.select(F.to_json(F.struct(*[c for c in readings.columns])).alias("value"))


# ------------------------------------------------------------ events binding
def _tenths_text(v, width: int, modulus: int):
    return F.lpad(F.pmod(F.floor(v).cast("bigint"), F.lit(modulus)).cast("string"), width, "0")


def events_as_raw_lines(events: DataFrame, slp: Column | None = None) -> DataFrame:
    """Raw station lines built from ``events`` (whole table): station from
    user_id, DATE from ts (empty for 'error' events, which become dead
    letters), TMP / WND / VIS from value, a quoted NAME holding a comma, a
    surplus 17th column.  ``slp``: the text of SLP, else a constant."""
    v = F.col("value")
    q = lambda *cs: F.concat(F.lit('"'), *cs, F.lit('"'))
    date = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    tmp_sign = F.when(v >= 0, F.lit("+")).otherwise(F.lit("-"))
    line = F.concat_ws(
        ",",
        q(F.lpad(F.col("user_id").cast("string"), 11, "0")),
        q(date),
        q(F.lit("4")),
        q(F.pmod(F.col("event_id"), F.lit(90)).cast("string")),
        q(F.lit("23.45")),
        q(F.when(F.col("event_type") == "view", F.lit("9999")).otherwise(F.lit("5.0"))),
        q(F.lit("USER "), F.col("user_id").cast("string"), F.lit(", "), F.upper(F.col("event_type"))),
        q(F.lit("FM-12")),
        q(F.lit("99999")),
        q(F.lit("V020")),
        q(F.lit("270,1,N,"), _tenths_text(v * 10, 4, 10000), F.lit(","), F.when(F.col("event_type") == "purchase", F.lit("3")).otherwise(F.lit("1"))),
        q(F.lit("99999,9,9,N")),
        q(_tenths_text(v * 100, 6, 1000000), F.lit(",1,N,9")),
        q(tmp_sign, _tenths_text(F.abs(v) * 10, 4, 10000), F.lit(",1")),
        q(F.lit("+9999,9")),
        q(F.lit("10200,1") if slp is None else slp),
        q(F.lit("08,99,1")),
    )
    return events.select(
        F.lit("events.parquet").alias("source_file"),
        (F.col("event_id") + F.lit(2)).alias("row_number"),
        line.alias("raw_line"),
    )


def flatten_for_check(readings: DataFrame) -> DataFrame:
    """Flat view of normalised readings (for comparisons with an oracle)."""
    return readings.select(
        "station", "date",
        to_event_time(F.col("date")).cast("timestamp_ntz").alias("event_time"),
        "source", "latitude", "longitude", "elevation", "name",
        F.col("wind.direction_angle").alias("wind_angle"),
        F.col("wind.speed_rate").alias("wind_speed"),
        F.col("wind.speed_is_valid").alias("wind_valid"),
        F.col("ceiling.height_meters").alias("ceiling_m"),
        F.col("ceiling.is_valid").alias("ceiling_valid"),
        F.col("visibility.distance_meters").alias("visibility_m"),
        F.col("visibility.is_valid").alias("visibility_valid"),
        F.col("temperature.value_celsius").alias("temp_c"),
        F.col("temperature.is_valid").alias("temp_valid"),
        F.col("dew_point.value_celsius").alias("dew_c"),
        F.col("dew_point.is_valid").alias("dew_valid"),
        F.col("sea_level_pressure.value_hpa").alias("pressure_hpa"),
        F.col("sea_level_pressure.is_valid").alias("pressure_valid"),
        F.size("columns").alias("n_columns"),
        "row_number",
    )
