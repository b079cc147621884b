"""Normaliser: a table of field rules, and properties on random lines - the
``columns`` map gives back what was written, and what is made of a field
depends on that field alone."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cirrus.functions.rawformat import RAW_COLUMNS
from cirrus.plans.normalize import normalize

DATE = "1901-01-01T06:00:00"
#: Fixed values (FIXTURES.md, section 3): raw column, text, output field, what it is.
RULES = [
    *(("TMP", t, "temperature", (None, q, False)) for t, q in (("+9999,9", "9"), ("9999,1", "1"), ("-9999,1", "1"), ("", None))),
    ("TMP", "-0078", "temperature", (-7.8, None, False)),
    ("TMP", "-0078,", "temperature", (-7.8, "", True)),
    ("TMP", "-0078,9", "temperature", (-7.8, "9", True)),
    *(("TMP", f"-0078,{q}", "temperature", (-7.8, q, False)) for q in "2367"),
    ("TMP", "7.8,1", "temperature", (None, "1", False)),
    ("DEW", "+0012,1", "dew_point", (1.2, "1", True)),
    ("WND", "999,9,N,0020,1", "wind", (None, "9", "N", 2.0, "1", True)),
    ("WND", "270,1,N,9999,9", "wind", (270, "1", "N", None, "9", False)),
    ("CIG", "99999,9,9,N", "ceiling", (None, "9", "9", "N", False)),
    ("CIG", "09999,1,C,N", "ceiling", (9999, "1", "C", "N", True)),
    ("VIS", "000000,1,N,9", "visibility", (0, "1", "N", "9", True)),
    ("VIS", "999999,9,N,9", "visibility", (None, "9", "N", "9", False)),
    ("SLP", "10200,1", "sea_level_pressure", (1020.0, "1", True)),
    ("SLP", "99999,9", "sea_level_pressure", (None, "9", False)),
    ("ELEVATION", "9999", "elevation", None),
    ("ELEVATION", "9999.0", "elevation", 9999.0),
]


def written(texts, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator="", quoting=quoting).writerow(texts)
    return out.getvalue()


def line(quoting=csv.QUOTE_ALL, upto=len(RAW_COLUMNS), **texts):
    return written([({"DATE": DATE} | texts).get(c, "") for c in RAW_COLUMNS[:upto]], quoting)


def normalized(spark, lines):
    raw = spark.createDataFrame(list(enumerate(lines)), "row_number long, raw_line string")
    readings, dead = normalize(raw)
    return {r.row_number: r for r in readings.collect()}, dead.collect()


def value(r, field):
    return tuple(r[field]) if isinstance(r[field], tuple) else r[field]


def test_field_rules(spark):
    got, dead = normalized(spark, [line(**{column: text}) for column, text, _, _ in RULES])
    assert not dead
    assert [(c, t, value(got[i], field)) for i, (c, t, field, _) in enumerate(RULES)] == [(c, t, want) for c, t, _, want in RULES]


TEXTS = ["", "0", "5", "+0078", "-0078", "7.8", "12a", "9999", "+9999", "-9999", "99999", "999999", "999", "1e3", ".5", "3.", 'say "hi"', "X, FI", "270,1,N,0159,1", "000100,2,N,9", "-0078,3", "10200,", ",", '""', "é"]
FREE = [c for c in RAW_COLUMNS if c != "DATE"]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.fixed_dictionaries({c: st.sampled_from(TEXTS) for c in FREE}), st.integers(2, 16), st.booleans()), min_size=10, max_size=30))
def test_lines_are_their_fields(spark, batch):
    lines = [line(csv.QUOTE_ALL if quoted else csv.QUOTE_MINIMAL, upto, **texts) for texts, upto, quoted in batch]
    alone = [(c, t) for c in FREE for t in TEXTS]
    got, dead = normalized(spark, lines + [line(**{c: t}) for c, t in alone])
    assert not dead
    single = {ct: got[len(lines) + i] for i, ct in enumerate(alone)}
    fields = {c: f for c, _, f, _ in RULES} | {"LATITUDE": "latitude", "LONGITUDE": "longitude", "STATION": "station", "NAME": "name"}
    for i, (texts, upto, _) in enumerate(batch):
        present = RAW_COLUMNS[:upto]
        assert got[i]["columns"] == {c.lower(): ({"DATE": DATE} | texts)[c] for c in present}
        for column, field in fields.items():
            if column in present:
                assert value(got[i], field) == value(single[column, texts[column]], field)
            elif column in ("STATION", "NAME"):
                assert got[i][field] is None


@pytest.mark.parametrize("text", ["x" * 1_000_000, 'a""b,' * 200_000, '""' * 500_000])
def test_long_quoted_fields(spark, text):
    """In a column that is read, and beyond the last one; on short lines too."""
    whole = line(NAME="n") + f',"{text}"'
    short = f'"S","{DATE}","{text}"'
    got, dead = normalized(spark, [whole, short, line(NAME="n")[:-3] + f',"","{text}"'])
    assert not dead and got[0]["name"] == "n" and len(got[0]["columns"]) == 16
    assert len(got[1]["columns"]) == 3 and got[1]["columns"]["source"] == text.replace('""', '"')


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(TEXTS), min_size=1, max_size=20), min_size=10, max_size=30))
def test_supported_line_matches_csv_module(spark, batch):
    from cirrus.sources.raw import supported_raw_line

    lines = [written(texts, csv.QUOTE_ALL) for texts in batch]
    raw = spark.createDataFrame(list(enumerate(lines)), "row_number long, raw_line string")
    got = {r.row_number: r.raw_line for r in supported_raw_line(raw).collect()}
    assert {i: next(csv.reader([t]), []) for i, t in got.items()} == {i: texts[:16] if texts != [""] else [] for i, texts in enumerate(batch)}


def test_supported_line_short_and_empty(spark):
    from cirrus.sources.raw import supported_raw_line

    raw = spark.createDataFrame([(0, "a,b"), (1, ""), (2, '"x, y",,"z"')], "row_number long, raw_line string")
    got = {r.row_number: r.raw_line for r in supported_raw_line(raw).collect()}
    assert got == {0: "a,b", 1: "", 2: '"x, y",,z'}
