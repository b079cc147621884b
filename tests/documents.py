"""Reading documents for tests, built from the READING schema: every field
null, then the defaults, then what a test changes; and files dropped whole."""

import json
import os
import tempfile

from pyspark.sql.types import StructType

from cirrus.functions.rawformat import BAD_QUALITY
from cirrus.schema import READING

#: What a document holds unless a test says otherwise.
DEFAULTS = {
    "source": "4", "latitude": 60.0, "longitude": 25.0, "elevation": 5.0, "report_type": "FM-12", "call_sign": "99999", "quality_control": "V020",
    "wind.direction_angle": 270, "wind.direction_quality": "1", "wind.type": "N", "wind.speed_rate": 5.0,
    "ceiling.quality": "9", "ceiling.determination": "9", "ceiling.cavok": "N",
    "visibility.distance_meters": 10000, "visibility.variability": "N", "visibility.variability_quality": "1",
    "dew_point.value_celsius": 0.0, "sea_level_pressure.value_hpa": 1010.0,
}
#: Measured values: the name tests use, the field, its quality and validity.
MEASURED = {
    "temp": ("temperature.value_celsius", "temperature.quality", "temperature.is_valid"),
    "dew": ("dew_point.value_celsius", "dew_point.quality", "dew_point.is_valid"),
    "wind": ("wind.speed_rate", "wind.speed_quality", "wind.speed_is_valid"),
    "visibility": ("visibility.distance_meters", "visibility.quality", "visibility.is_valid"),
    "pressure": ("sea_level_pressure.value_hpa", "sea_level_pressure.quality", "sea_level_pressure.is_valid"),
    "height": ("ceiling.height_meters", "ceiling.quality", "ceiling.is_valid"),
}


def _paths(schema, at=""):
    for f in schema.fields:
        yield from _paths(f.dataType, f"{at}{f.name}.") if isinstance(f.dataType, StructType) else [at + f.name]


def reading(station, date, temp, **changes):
    """``changes``: a measured value by its name, its quality as name_quality."""
    flat = dict.fromkeys(_paths(READING)) | DEFAULTS | {"station": station, "name": station, "date": date}
    for name, (value, quality, valid) in MEASURED.items():
        measured = {"temp": temp, **changes}.get(name, flat[value])
        graded = changes.get(f"{name}_quality") or flat[quality] or ("9" if measured is None else "1")
        flat |= {value: measured, quality: graded, valid: measured is not None and graded not in BAD_QUALITY}
    doc = {}
    for path, v in flat.items():
        *parents, leaf = path.split(".")
        at = doc
        for p in parents:
            at = at.setdefault(p, {})
        at[leaf] = v
    return doc


def write_jsonl(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf-8")
    return str(path)


def drop_file(folder, name, records, stamp):
    """A file that appears in ``folder`` whole, with its time stamp: a stream
    that lists the folder meanwhile sees neither a part nor another stamp."""
    folder.mkdir(parents=True, exist_ok=True)
    with tempfile.TemporaryDirectory(dir=folder.parent) as aside:
        at = os.path.join(aside, name)
        with open(at, "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r) + "\n" for r in records)
        os.utime(at, (stamp, stamp))
        os.rename(at, folder / name)
