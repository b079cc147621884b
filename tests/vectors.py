"""The inputs and results of the ten analytics' vectors
(FIXTURES.md, section 2).  Times are hours and minutes of January 1901."""

#: use case: readings (station, day, time, temperature, other measured values)
READINGS = {
    "uc01": [("A", 1, "00:10", -5.0, {}), ("A", 1, "00:40", 5.0, {}), ("A", 2, "00:10", 15.0, {}), ("B", 1, "00:20", 20.0, {})],
    "uc02": [("A", 1, "00:00", 10.0, {}), ("A", 1, "00:10", 12.0, {"temp_quality": "3"}), ("A", 1, "00:20", None, {}), ("B", 1, "00:00", 5.0, {"wind_quality": "6"}), ("B", 1, "00:10", 6.0, {})],
    "uc03": [("A", 1, "00:00", 0.0, {}), ("A", 1, "02:00", 4.0, {}), ("A", 1, "03:00", 1.0, {}), ("B", 1, "00:00", 10.0, {}), ("B", 1, "01:00", 13.0, {})],
    "uc04": [("A", 1, "00:00", 1.0, {}), ("A", 1, "01:00", 2.0, {}), ("A", 1, "04:00", 3.0, {}), ("B", 1, "00:00", 1.0, {}), ("B", 1, "02:00", 2.0, {})],
    "uc05": [("02907099999", 1, "00:00", 5.0, {}), ("02907099999", 1, "12:00", 7.0, {}), ("02950099999", 1, "00:00", 1.0, {})],
    "uc06": [("A", 1, "00:00", -1.0, {}), ("A", 1, "01:00", 8.0, {}), ("B", 1, "00:00", 18.0, {}), ("C", 1, "00:00", 31.0, {})],
    "uc07": [("A", 1, "00:00", 0.0, {}), ("A", 15, "00:00", 10.0, {}), ("A", 30, "00:00", 20.0, {}), ("B", 10, "00:00", -5.0, {}), ("B", 20, "00:00", 5.0, {})],
    "uc08": [("02907099999", 1, "00:00", 0.0, {"wind": 8.0, "visibility": 2000}), ("02950099999", 1, "00:00", 0.0, {"wind": 20.0, "visibility": 2000}), ("X", 1, "00:00", 0.0, {"wind": 8.0, "visibility": 2000})],
    "uc09": [("A", 1, "00:00", 1.0, {"visibility": 100}), ("A", 1, "05:00", 2.0, {"visibility": 150}), ("A", 1, "06:00", 3.0, {"visibility": 500}), ("A", 1, "12:00", 4.0, {"visibility": 100}), ("B", 1, "00:00", 1.0, {"visibility": 1000}), ("B", 1, "01:00", 2.0, {"visibility": 100})],
    "uc10": [("A", 1, "00:00", 5.0, {"wind": 5.0, "pressure": 1015.0}), ("A", 1, "00:30", 5.0, {"wind": 25.0, "pressure": 1011.0}), ("B", 1, "00:00", 5.0, {"wind": 5.0, "pressure": 1015.0}), ("B", 1, "00:30", 5.0, {"wind": 5.0, "pressure": 1011.0}), ("C", 1, "00:00", 5.0, {"wind": 25.0, "pressure": 1010.0}), ("C", 1, "00:30", 5.0, {"wind": 25.0, "pressure": 1010.0})],
}

#: use case: (the rows looked at, their columns, what they are)
RESULTS = {
    "uc01": (None, ("station", "window_size", "window_start", "min_temp_c", "max_temp_c", "avg_temp_c"), {
        ("A", "1h", "01 00:00", -5.0, 5.0, 0.0), ("A", "24h", "01 00:00", -5.0, 5.0, 0.0), ("A", "1h", "02 00:00", 15.0, 15.0, 15.0),
        ("A", "24h", "02 00:00", 15.0, 15.0, 15.0), ("B", "1h", "01 00:00", 20.0, 20.0, 20.0), ("B", "24h", "01 00:00", 20.0, 20.0, 20.0)}),
    "uc02": ("01 00:00", ("station", "bad_count"), {("A", 2), ("B", 0)}),
    "uc03": (None, ("station", "event_time", "change_c_per_hour"), {("A", "01 02:00", 2.0), ("A", "01 03:00", -3.0), ("B", "01 01:00", 3.0)}),
    "uc04": (None, ("station", "interval_end", "status"), {("A", "01 01:00", "complete"), ("A", "01 04:00", "incomplete"), ("B", "01 02:00", "incomplete")}),
    "uc05": ("01 00:00", ("station", "deviation_c"), {("02907099999", 2.0), ("02950099999", -1.0)}),
    "uc06": ("01 00:00", ("list_name", "rank_position", "station", "temp_c"), {
        ("hottest", 1, "C", 31.0), ("hottest", 2, "B", 18.0), ("hottest", 3, "A", 8.0), ("coldest", 1, "A", -1.0), ("coldest", 2, "B", 18.0), ("coldest", 3, "C", 31.0)}),
    "uc07": ("03 00:00", ("station", "avg_temp_c", "trend_direction"), {("A", 15.0, "rising"), ("B", 0.0, "stable")}),
    "uc08": (None, ("user_id", "booking_id", "resort_id", "alert"), {("u-002", "b-002", "02950099999", "bad_conditions")}),
    "uc09": (None, ("station", "period_start", "duration_hours"), {("A", "01 00:00", 6)}),
    "uc10": (None, ("station", "pressure_drop_hpa_per_hour", "max_wind_kmh", "alert"), {("A", 8.0, 90.0, "storm_event")}),
}
