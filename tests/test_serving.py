"""Serving SQL over result tables built from the reference vectors."""

from cirrus.plans import usecases as U
from cirrus.plans.serving import SERVING_SQL, register_results, serve
from cirrus.sources.bookings import bookings_frame
from tests.documents import reading

RANGE = ("1900-12-31 00:00:00", "1901-02-28 00:00:00")


def test_all_serving_queries(spark, readings_of):
    r = readings_of([
        reading("02907099999", "1901-01-01T00:00:00", 5.0, wind=20.0, visibility=100, pressure=1015.0),
        reading("02907099999", "1901-01-01T00:30:00", 7.0, wind=30.0, visibility=150, pressure=1010.0),
        reading("02907099999", "1901-01-01T02:00:00", 6.0, wind=5.0, visibility=800, pressure=1010.0),
        reading("02950099999", "1901-01-01T00:00:00", 1.0, wind=5.0, visibility=2000),
        reading("02950099999", "1901-01-01T03:00:00", 3.0, wind=5.0, visibility=2000),
    ])
    results = {uc: fn(r) for uc, fn in U.ANALYTICS.items()}
    results["uc08"] = U.user_notifications(r, bookings_frame(spark))
    register_results(spark, results)
    out = {q: serve(spark, q, *RANGE).collect() for q in SERVING_SQL}
    assert all(out[q] for q in SERVING_SQL), {q: len(v) for q, v in out.items()}
    assert {x.station for x in out["s01"]} == {"029070-99999", "029500-99999"}
    # the latest 24 h window starts at 03:00 and holds one reading only
    assert [x.label for x in out["s06"]] == ["1. 029500-99999"]
    assert [x.label for x in serve(spark, "s06", *RANGE, list_name="coldest").collect()] == ["1. 029500-99999"]
    assert out["s09"][0].duration_h == 2
    assert out["s10"][0].status == "storm_event"
    assert {x.alert_type for x in out["s08"]} == {"bad_conditions"}
    assert len(serve(spark, "s01", *RANGE, window_size="1h").collect()) > len(out["s01"])


def test_bands(spark, readings_of):
    r = readings_of([
        reading("A", "1901-01-01T00:00:00", 5.0, wind=5.0, pressure=1015.0),
        reading("A", "1901-01-01T00:30:00", 5.0, wind=30.0, pressure=1011.0),
        reading("A", "1901-01-01T00:10:00", 5.0, temp_quality="3"),
    ])
    register_results(spark, {"uc02": U.data_quality(r), "uc10": U.storm_warning(r)})
    q = serve(spark, "s02", *RANGE, bands=True).collect()
    assert {(x.value, x.band) for x in q} >= {(1, 2), (0, 1)}
    assert {x.band for x in serve(spark, "s10", *RANGE, bands=True).collect()} == {1}  # 108 km/h >= 100
