"""Physical-plan shape of the registered queries: the scale properties the
design relies on (see README, "Design for scale")."""

import re

import pytest

from cirrus.plans import events as E
from tests.conftest import SF_SMALL


@pytest.fixture
def plan(spark):
    def get(name):
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, before AQE re-planning
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        try:
            return E.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    return get


def test_multi_size_stats_scan_and_shuffle_once(plan):
    p = plan("interval_stats")
    assert p.count("FileScan parquet") == 1
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_min" in p


def test_top_n_limits_before_the_shuffle(plan):
    p = plan("top_extremes")
    assert "WindowGroupLimit" in p and "Partial" in p
    # windows are merged from the panes' lists: one read of the pruned input,
    # no (key, window) expansion
    assert p.count("FileScan parquet") == 1
    assert "Expand" not in p


def test_sequence_shuffles_rows_on_key_and_bucket(plan):
    p = plan("rate_change")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert any("user_id" in e and "_seq_bucket" in e for e in exchanges)
    # the carry comes from the per-(key, bucket) summary, aggregated once and
    # checkpointed; the main plan reads the input a single time
    assert "_seq_cnt" in p and "ExistingRDD" in p
    assert p.count("FileScan parquet") == 1
    # windows: one over rows partitioned by (key, bucket); the only key-only
    # window is the carry over per-bucket summaries, ordered by bucket
    specs = re.findall(r"^\s*(?:[:+-]+\s*)*Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]$", p, re.M)
    parts = [tuple(c.split("#")[0].strip() for c in part.split(",")) for part, _ in specs]
    assert ("user_id", "_seq_bucket") in parts
    key_only = [order for (part, order) in specs if part.split("#")[0].strip() == "user_id" and "," not in part]
    assert len(key_only) == 1 and key_only[0].startswith("_seq_bucket")


def test_interval_join_keys_include_time_bucket(plan):
    p = plan("booking_alerts")
    join = [line for line in p.splitlines() if "Join" in line][0]
    assert "level" in join and "range" in join and "resort_id" in join


def test_latest_ranking_filters_by_scalar_subquery(plan):
    p = plan("serve_ranking")
    assert "Subquery" in p


def test_filters_and_columns_reach_the_scan(plan):
    p = plan("booking_alerts")
    assert "PushedFilters: [IsNotNull(value)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_registered_queries_stay_in_the_jvm(plan, name):
    p = plan(name)
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
        assert python_node not in p, (name, python_node)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["serve_stats", "serve_quality", "serve_deviation"])
def test_panels_filter_time_at_the_scan(plan, name):
    p = plan(name)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert len(pushed) == 1 and "GreaterThanOrEqual(ts" in pushed[0] and "LessThan(ts" in pushed[0]


def test_ranking_panel_scans_twice(plan):
    assert plan("serve_ranking").count("FileScan parquet") <= 3  # the reused subquery is printed twice


def test_raw_lines_are_filtered_before_python(spark, tmp_path):
    from cirrus.sources.raw import read_raw

    (tmp_path / "1901").mkdir()
    (tmp_path / "1901" / "s.csv").write_text("h\na\nb\n")
    p = read_raw(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    branches = p.split("MapInPandas")[1:]
    assert len(branches) == 2 and all("_len" in b and "Filter" in b for b in branches)
