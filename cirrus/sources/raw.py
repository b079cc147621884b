"""Raw station files (A1-A3): ``<data_dir>/<year>/<station>.csv``, one header
line per file, one reading per physical line.

``read_raw`` yields (source_file, row_number, raw_line) with the header
dropped and file line numbers (the first data line is 2), without shuffling
the lines:

* each line's position inside its file split is counted in scan order, per
  scan partition (``mapInPandas`` over Arrow batches, right on the scan: the
  lines of a split arrive contiguous and in file order);
* a file read as one split (the usual case: station-year files are a few MB,
  and files below ``min(maxPartitionBytes, openCostInBytes)`` are never split)
  needs nothing more: line number = position + 1;
* only lines of files spanning several splits need the number of lines in
  the earlier splits: a count per split of those files (a second scan pruned
  to large files by ``_metadata.file_size``, partially aggregated), a running
  sum over a file's splits, joined back to those lines only.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cirrus.functions import rawformat as fmt
from cirrus.session import ship_package
from cirrus.sources import files

_SCAN_SCHEMA = "source_file string, _split bigint, _len bigint, _size bigint, raw_line string, _pos bigint"


def raw_glob(data_dir: str, year: str | None = None, station: str | None = None) -> str:
    y = year or "*"
    s = station if station else "*.csv"
    if station and not station.endswith(".csv"):
        s = f"{station}.csv"
    return f"{data_dir.rstrip('/')}/{y}/{s}"


def _positions_in_split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """0-based position of each line inside its (file, split), for one scan
    partition; a split may continue across Arrow batches."""
    last = None  # (file, split) of the previous batch's last line
    carry = 0  # lines of that split already seen
    for pdf in batches:
        if pdf.empty:
            continue
        f, sp = pdf["source_file"], pdf["_split"]
        starts = (f != f.shift()) | (sp != sp.shift())
        continues = last == (f.iloc[0], int(sp.iloc[0]))
        starts.iloc[0] = not continues
        run = starts.cumsum()
        pos = pdf.groupby(run).cumcount().astype("int64")
        if continues:
            pos[run == 0] += carry
        last, carry = (f.iloc[-1], int(sp.iloc[-1])), int(pos.iloc[-1]) + 1
        yield pdf.assign(_pos=pos)


_LINES_SCHEMA = "source_file string, _split bigint, _len bigint, _size bigint, raw_line string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file and split; a year or station that does not exist
    reads as no lines (the file scan skips missing files)."""
    try:
        text = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], _LINES_SCHEMA)
    return text.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.col("_metadata.file_block_length").alias("_len"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("value").alias("raw_line"),
    )


def read_raw(spark: SparkSession, data_dir: str, year: str | None = None, station: str | None = None) -> DataFrame:
    return _numbered(spark, raw_glob(data_dir, year, station))


def _numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their numbers in their files, without the headers."""
    ship_package(spark)
    # files never split: at most min(maxPartitionBytes, openCostInBytes) bytes
    never_split = min(
        _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")),
        _bytes(spark.conf.get("spark.sql.files.openCostInBytes", "4m")),
    )
    one, several = F.col("_len") >= F.col("_size"), (F.col("_size") > F.lit(never_split)) & (F.col("_len") < F.col("_size"))
    # filtered before Python, so that each line passes it once
    numbered = lambda which: _lines(spark, path).where(which).mapInPandas(_positions_in_split, _SCAN_SCHEMA)
    whole = numbered(one).select("source_file", (F.col("_pos") + F.lit(1)).alias("row_number"), "raw_line")
    earlier = Window.partitionBy("source_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        _lines(spark, path)
        .where(several)
        .groupBy("source_file", "_split")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("source_file", "_split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    split = (
        numbered(several)
        .join(offsets, ["source_file", "_split"])
        .select("source_file", (F.col("_before") + F.col("_pos") + F.lit(1)).alias("row_number"), "raw_line")
    )
    out = whole.unionByName(split)
    return out.where(F.col("row_number") > 1).select(
        "source_file", F.col("row_number").cast("bigint").alias("row_number"), F.regexp_replace("raw_line", "\r$", "").alias("raw_line")
    )


def _bytes(text: str) -> int:
    t = str(text).strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(t[:-1]) * mult[t[-1]]) if t and t[-1] in mult else int(t)


def supported_raw_line(raw: DataFrame, line: str = "raw_line") -> DataFrame:
    """A2: keep the first 16 columns of each line (fewer if the line has
    fewer), written back with minimal quoting: a field is quoted only when it
    holds a comma, a quote or a line break, quotes doubled inside."""
    from cirrus.plans.normalize import parse_fields

    x = parse_fields(raw, line)
    quoted = [
        F.when(F.col(f"_f_{c}").rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(F.col(f"_f_{c}"), F.lit('"'), F.lit('""')), F.lit('"')))
        .otherwise(F.col(f"_f_{c}"))
        for c in fmt.RAW_COLUMNS
    ]
    n = F.least(F.col("_n"), F.lit(len(fmt.RAW_COLUMNS)))
    text = F.when(F.coalesce(F.col(line), F.lit("")) == "", F.col(line)).otherwise(F.array_join(F.slice(F.array(*quoted), 1, n), ","))
    helper = ["_n", "_et", *[f"_f_{c}" for c in fmt.RAW_COLUMNS]]
    return x.withColumn(line, text).drop(*helper)


def read_first(spark: SparkSession, data_dir: str, year: str | None, station: str | None, max_records: int) -> DataFrame:
    """A3: :func:`read_raw`'s first ``max_records`` lines in (file, line)
    order, without sorting lines.  Files are counted in order of their names,
    1, 2, 4, ... at a time, until they add up to the cut; those behind are
    never read, and of the last one the lines behind the cut are left out."""
    paths = _listed(spark, raw_glob(data_dir, year, station))
    needed, total, at, some = [], 0, 0, 1
    while at < len(paths) and total < max_records:
        chunk = paths[at : at + some]
        lines = _lines(spark, chunk).groupBy("source_file").agg((F.count(F.lit(1)) - 1).alias("n"))
        counts = {_plain(r["source_file"]): r["n"] for r in lines.collect()}
        for path in chunk:
            if total < max_records and counts.get(_plain(path), 0) > 0:
                needed.append(path)
                before, total = total, total + counts[_plain(path)]
        at, some = at + len(chunk), some * 2
    if not needed:
        return read_raw(spark, data_dir, year, station).limit(0)
    last = F.col("source_file") == _last_of(spark, needed)
    return _numbered(spark, needed).where(~last | (F.col("row_number") <= max_records - before + 1))


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of a glob, in order."""
    where, fs = files.at(spark, path)
    return sorted(x.getPath().toString() for x in fs.globStatus(where) or [] if x.isFile())


def _plain(path: str) -> str:
    """The path without scheme and escapes, which listings and scans differ in."""
    return unquote(urlsplit(path).path if "://" in path else path.partition(":")[2] or path)


def _last_of(spark: SparkSession, paths: list[str]):
    return F.lit(_lines(spark, paths[-1]).select("source_file").first()["source_file"])


def first_records(raw: DataFrame, max_records: int | None) -> DataFrame:
    """A3: the first n lines in (file, line) order; 0 or None means all."""
    if not max_records:
        return raw
    return raw.orderBy("source_file", "row_number").limit(max_records)
