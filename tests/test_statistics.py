"""Percentiles by narrowing ranges, and slopes from merged moments, against
numpy."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirrus.operators.quantile import percentiles
from cirrus.operators.slope import sliding_slope

T0 = datetime(1969, 12, 20)


@pytest.mark.parametrize("few", [1, 40, 100_000])
def test_percentiles(spark, few):
    rng = np.random.default_rng(1)
    groups = {"even": rng.uniform(-5, 5, 700), "skewed": np.exp(rng.normal(0, 9, 500)), "same": np.full(60, 3.25), "two": np.array([1.0, 2.0]), "one": np.array([-7.5]),
              "ties": rng.integers(0, 4, 300).astype(float), None: rng.normal(0, 1e-300, 50), "far": np.array([-1.7e308, 1.7e308, 0.0, 1e-308])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    rows += [("even", None), ("none", None), ("even", float("nan")), ("even", float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: (r.p0, r.p12_5, r.p50, r.p99, r.p100) for r in percentiles(df, ["k"], "v", [0, 0.125, 0.5, 0.99, 1], few=few).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        if k != "far":
            assert got[k] == pytest.approx([np.quantile(vs, f) for f in (0, 0.125, 0.5, 0.99, 1)], rel=1e-12, abs=0), k
    assert got["far"][0] == -1.7e308 and got["far"][2] == 0.5e-308 and got["far"][4] == 1.7e308
    assert percentiles(df.where("false"), ["k"], "v", [0.5]).count() == 0


def test_slopes(spark):
    rng = np.random.default_rng(2)
    rows = [(f"k{i % 3}", T0 + timedelta(minutes=int(m)), None if i % 11 == 0 else float(1e6 + 0.25 * m / 60 + rng.normal())) for i, m in enumerate(rng.integers(0, 60 * 24 * 8, 300))]
    rows += [("flat", T0 + timedelta(hours=h), 5.0) for h in range(3)] + [("once", T0, 1.0), ("twice", T0, 1.0), ("twice", T0, 2.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double").repartition(3)
    got = {(r.k, r.window_start): r for r in sliding_slope(df, "k", "t", "v", "2 days", "12 hours", "6 hours").collect()}
    want = {}
    for k, t, v in rows:
        if v is not None:
            first = T0.replace(hour=0) + timedelta(hours=12) * ((t - T0.replace(hour=0)) // timedelta(hours=12))
            for i in range(4):
                w = first - timedelta(hours=12) * i
                want.setdefault((k, w), []).append(((t - w) / timedelta(hours=1), v))
    want = {k: np.array(p) for k, p in want.items() if len({t for t, _ in p}) > 1}
    assert set(got) == set(want) and not any(k in ("once", "twice") for k, _ in got)
    for k, p in want.items():
        t, v = p[:, 0], p[:, 1] - p[:, 1].mean()
        slope = ((t - t.mean()) * v).sum() / ((t - t.mean()) ** 2).sum()
        r = got[k]
        assert r.n == len(p) and r.slope_per_hour == pytest.approx(slope, rel=1e-9, abs=1e-9)
        assert r.forecast == pytest.approx(p[:, 1].mean() + slope * (54 - t.mean()), rel=1e-12)
        assert (r.r2 is None) == (k[0] == "flat") and (r.r2 is None or len(p) < 3 or r.r2 == pytest.approx(np.corrcoef(t, v)[0, 1] ** 2, rel=1e-6, abs=1e-9))
