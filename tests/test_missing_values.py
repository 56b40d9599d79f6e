"""NaN is a missing value, as in pandas; values beyond the exact sums are out
of sums, means and counts alike, and Silver quarantines them."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlake.functions.scalar import exact_mean, exact_sum
from gridlake.operators import analytics as an
from gridlake.operators import quality as qa
from gridlake.operators.aggregates import daily_usage, daily_weather
from gridlake.plans.pipeline import build_silver

NAN = float("nan")
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.one_of(st.none(), st.just(NAN), st.integers(-400, 400).map(lambda x: x / 8)), min_size=1, max_size=30)


def _num(s):
    return None if s is None or math.isnan(s) else float(s)


@SETTINGS
@given(values)
def test_sums_and_means_like_pandas(spark, xs):
    s = pd.Series(xs, dtype=float)
    r = spark.createDataFrame([(x,) for x in xs], "x double").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()
    assert _num(r["m"]) == _num(s.mean())
    assert (float(r["s"]) if r["s"] is not None else 0.0) == s.sum()


@SETTINGS
@given(values)
def test_profile_like_pandas_describe(spark, xs):
    s = pd.Series(xs, dtype=float)
    r = qa.profile(spark.createDataFrame([(x,) for x in xs], "x double")).first()
    d = s.describe()
    assert r["count"] == d["count"] and r["unique"] == s.nunique()
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        a, b = _num(r[ours]), _num(d[theirs])
        assert (a is None) == (b is None) and (a is None or abs(a - b) < 2e-6), ours


def _fact(spark, rows):
    return spark.createDataFrame(rows, "meter_id string, date_key string, tariff_code string, interval_kwh double, cost double, voltage double")


def test_daily_means_skip_nan(spark):
    rows = [("A", "2025-07-01", "green", 1.0, 0.1, NAN), ("A", "2025-07-01", "green", NAN, NAN, 230.0), ("A", "2025-07-01", "green", 2.0, 0.2, 232.0)]
    r = daily_usage(_fact(spark, rows), carry=True).first()
    assert (r["kwh"], r["cost"], r["avg_voltage"], r["voltage_n"]) == (3.0, 0.3, 231.0, 2)
    r = daily_usage(_fact(spark, [("A", "2025-07-01", "green", NAN, NAN, NAN)])).first()
    assert (r["kwh"], r["cost"], r["avg_voltage"]) == (0.0, 0.0, None)


def test_weather_and_load_curve_skip_nan(spark):
    w = spark.createDataFrame(
        [("2025-07-01T00:00:00", 10.0, NAN, 1.0), ("2025-07-01T01:00:00", NAN, NAN, 3.0), ("2025-07-01T02:00:00", 14.0, NAN, NAN)],
        "ts string, temperature_2m double, cloud_cover double, shortwave_radiation double",
    ).select(F.col("ts").cast("timestamp_ntz").alias("weather_ts"), "temperature_2m", "cloud_cover", "shortwave_radiation")
    r = daily_weather(w).first()
    assert (r["avg_temp_c"], r["min_temp_c"], r["max_temp_c"], r["avg_cloud_pct"], r["avg_radiation"]) == (12.0, 10.0, 14.0, None, 2.0)
    curve = spark.createDataFrame([("2025-07-01T05:00:00", v) for v in (NAN, 2.0, 4.0)], "ts string, interval_kwh double").select(
        F.col("ts").cast("timestamp_ntz").alias("reading_ts"), "interval_kwh"
    )
    assert qa.load_curve(curve).first()["avg_interval_kwh"] == 3.0


def test_voltage_metric_skips_nan(spark):
    df = daily_usage(_fact(spark, [("A", "2025-07-01", "green", 1.0, 0.1, v) for v in (NAN, 230.0)]), carry=True)
    assert an.usage_by(df, "avg_voltage", ["tariff_code"]).first()["avg_voltage"] == 230.0


def test_large_and_infinite_values_neither_fail_nor_count(spark):
    xs = [1e21, float("inf"), -float("inf"), 1.0, 3.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    r = df.agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()
    assert float(r["s"]) == 4.0 and r["m"] == 2.0
    p = qa.profile(df).first()
    assert p["count"] == 5 and p["max"] == float("inf") and p["p50"] == 3.0


def test_silver_nulls_nan_and_quarantines_what_no_sum_holds(spark):
    t = "2025-07-01T{:02d}:00:00Z"
    rows = [("A", "C", t.format(i), v, 230.0, "GOOD", i) for i, v in enumerate([1.0, NAN, 1e21, float("inf"), None])]
    readings = spark.createDataFrame(rows, "meter_id string, customer_id string, reading_ts string, interval_kwh double, voltage double, quality string, _ingested_at long")
    history = spark.createDataFrame([("A", "green", "2025-01-01", None)], "meter_id string, tariff_code string, valid_from string, valid_to string")
    s = build_silver(readings, history, None)
    good = {r.reading_ts.hour: r.interval_kwh for r in s.enriched.collect()}
    assert good == {0: 1.0, 1: None, 4: None}
    assert {(r.reading_ts.hour, r.reason) for r in s.quarantine.collect()} == {(2, "OUT_OF_RANGE"), (3, "OUT_OF_RANGE")}


def test_top_values_equal_the_full_count(spark):
    # a million values, of which a few stand out, with a tie at the edge
    many = spark.range(1_000_000).select(F.col("id").cast("string").alias("v"))
    hot = [("a", 30_000), ("b", 20_000), ("c", 20_000), ("d", 9_000), ("e", 20_000)]
    df = many
    for v, n in hot:
        df = df.union(spark.range(n - 1).select(F.lit(v).alias("v")))
    df = df.union(spark.createDataFrame([(v,) for v, _ in hot], "v string")).union(spark.createDataFrame([(None,)], "v string"))
    assert [tuple(r) for r in qa.top_values(df, "v", 3).collect()] == [("a", 30_000), ("b", 20_000), ("c", 20_000)]
    assert [tuple(r) for r in qa.top_values(df, "v", 5).collect()] == [("a", 30_000), ("b", 20_000), ("c", 20_000), ("e", 20_000), ("d", 9_000)]
    # nothing stands out: every value is counted
    flat = spark.range(30_000).select((F.col("id") % 15_000).alias("v"))
    assert [tuple(r) for r in qa.top_values(flat, "v", 2).collect()] == [(0, 2), (1, 2)]
    assert qa.top_values(flat.limit(0), "v", 2).count() == 0
    r = qa.profile(df, unique=False).first()
    assert (r["top"], r["freq"], r["unique"], r["count"]) == ("a", 30_000, None, 1_000_000 + 99_000)


def test_percentiles_are_refined_until_the_rank_is_hit(spark, monkeypatch):
    """Wrong and wide brackets, ties on a percentile, heavy values."""
    rng = np.random.default_rng(3)
    cases = [
        rng.lognormal(0, 2, 20_000).round(3), np.repeat([1.0, 2.0, 3.0, 4.0], 5_000), np.concatenate([np.full(15_000, 7.0), rng.random(5_000)]),
        np.arange(20_000) * 1e9, np.concatenate([rng.random(10_000) * 1e-9, 1e12 + rng.random(10_000)]),
    ]
    monkeypatch.setattr(qa, "INSIDE", 20)
    for slack, unique in ((0.0, True), (0.3, False)):
        monkeypatch.setattr(qa, "SLACK", slack)
        df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cases)], ", ".join(f"x{i} double" for i in range(len(cases))))
        for r, xs in zip(qa.profile(df, percentiles=(0.0, 0.25, 0.5, 0.9, 1.0), unique=unique).collect(), cases):
            for p in (0, 25, 50, 90, 100):
                want = float(np.percentile(xs, p))
                assert abs(r[f"p{p}"] - want) <= 2e-6 + 1e-12 * abs(want), (slack, r["column"], p)
