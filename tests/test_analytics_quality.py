import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlake.operators import analytics as an
from gridlake.functions.scalar import exact_mean, exact_sum
from gridlake.operators import quality as qa
from gridlake.operators.aggregates import daily_usage
from tests.conftest import rows


def _md(spark, data):
    return spark.createDataFrame(data, "meter_id string, date_key string, kwh double, cost double")


def test_rolling_is_gap_tolerant(spark):
    # FIXTURES 23: days 1, 2, 9 -> rolling-7 at day 9 is day 9 alone
    md = _md(spark, [("M1", "2025-07-01", 1.0, 0.1), ("M1", "2025-07-02", 2.0, 0.2), ("M1", "2025-07-09", 4.0, 0.4)])
    got = dict(rows(an.rolling_days(md, 7), "date_key", "rolling7_kwh"))
    assert got == {"2025-07-01": 1.0, "2025-07-02": 3.0, "2025-07-09": 4.0}


def test_period_to_date_resets(spark):
    md = _md(spark, [("M1", "2025-07-30", 1.0, 0.0), ("M1", "2025-07-31", 2.0, 0.0), ("M1", "2025-08-01", 4.0, 0.0)])
    got = dict(rows(an.period_to_date(md, "month"), "date_key", "mtd_kwh"))
    assert got == {"2025-07-30": 1.0, "2025-07-31": 3.0, "2025-08-01": 4.0}
    ytd = dict(rows(an.period_to_date(md, "year"), "date_key", "ytd_kwh"))
    assert ytd["2025-08-01"] == 7.0


def test_anomalies_need_two_prior_days(spark):
    data = [("M1", f"2025-07-0{d}", v, 0.0) for d, v in [(1, 1.0), (2, 1.2), (3, 0.8), (4, 1.1), (5, 9.0)]]
    got = {r["date_key"]: r for r in an.anomalies(_md(spark, data), 7, 3.0).collect()}
    assert got["2025-07-01"]["z"] is None and got["2025-07-01"]["is_anomaly"] is False
    assert got["2025-07-02"]["z"] is None
    assert got["2025-07-05"]["is_anomaly"] is True
    assert got["2025-07-04"]["is_anomaly"] is False


def test_what_if_scales_baseline(spark):
    fact = spark.createDataFrame(
        [("standard", 0.56), ("standard", 0.28), ("economy7", 0.14)], "tariff_code string, cost double",
    )
    got = {(r["tariff_code"], r["pct_change"]): r for r in an.simulate_tariff(fact, ["0.0", "0.5"]).collect()}
    assert got[("standard", 0.0)]["baseline_cost"] == 0.84
    assert got[("standard", 0.5)]["scenario_cost"] == 1.26
    assert got[("economy7", 0.5)]["difference"] == 0.07


def test_elasticity_exact_line(spark):
    md = _md(spark, [("M1", f"2025-07-0{d}", 10.0 - 2 * d, 0.0) for d in range(1, 6)])
    wd = spark.createDataFrame([(f"2025-07-0{d}", float(d)) for d in range(1, 6)], "date_key string, avg_temp_c double")
    meters = spark.createDataFrame([("M1", True)], "meter_id string, has_solar boolean")
    r = an.elasticity(md, wd, meters).first()
    assert (r["slope"], r["intercept"], r["r2"], r["n"]) == (-2.0, 10.0, 1.0, 5)


def test_fault_tree_rollup(spark):
    readings = spark.createDataFrame(
        [("M1", dt.datetime(2025, 7, 1), "MISSING"), ("M1", dt.datetime(2025, 8, 1), "STUCK"),
         ("M2", dt.datetime(2025, 7, 1), None), ("M2", dt.datetime(2025, 7, 2), "GOOD")],
        "meter_id string, reading_ts timestamp_ntz, quality string",
    )
    meters = spark.createDataFrame([("M1", "SM-S"), ("M2", "SM-B")], "meter_id string, meter_model string")
    t = an.fault_tree(readings, meters)
    total = t.filter(F.col("level") == 7).first()
    assert total["faults"] == 3
    assert t.filter(F.col("level") == 0).count() == 3


def test_usage_by_whitelist(spark):
    md = _md(spark, [("M1", "2025-07-01", 1.0, 0.5)])
    assert an.usage_by(md, "kwh", ["date_key"]).first()["kwh"] == 1.0
    try:
        an.usage_by(md, "drop table", ["date_key"])
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    with pytest.raises(ValueError):
        an.usage_by(md, "kwh", ["meter_id"])


def test_mean_voltage_is_weighted_by_readings(spark):
    fact = spark.createDataFrame(
        [("M1", "2025-07-01", "s", 1.0, 0.1, 230.16)] * 3 + [("M1", "2025-07-02", "s", 1.0, 0.1, 230.12)],
        "meter_id string, date_key string, tariff_code string, interval_kwh double, cost double, voltage double",
    )
    daily = daily_usage(fact, carry=True)
    assert sorted(r.avg_voltage for r in daily.collect()) == [230.12, 230.16]
    assert an.usage_by(daily, "avg_voltage", ["tariff_code"]).first()["avg_voltage"] == 230.15


def test_exact_sums_do_not_depend_on_the_partitioning(spark):
    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(10**7)) / 10_000).alias("v"))
    got = {
        df.repartition(n).agg(exact_mean("v").alias("m"), exact_sum("v").alias("s")).first() for n in (3, 7, 16)
    }
    assert len(got) == 1


def test_small_costs_are_not_rounded_away(spark):
    md = _md(spark, [("M1", "2025-07-01", 1.0, 0.000004)])
    assert an.period_to_date(md, "month", "cost").first()["mtd_cost"] == 0.000004


def test_entitled_semi_join(spark):
    md = _md(spark, [("M1", "2025-07-01", 1.0, 0.5), ("M2", "2025-07-01", 1.0, 0.5)])
    ent = spark.createDataFrame([("M1",), ("M1",)], "meter_id string")
    assert rows(an.entitled(md, ent), "meter_id") == [("M1",)]
    per_user = spark.createDataFrame([("u1", "M1"), ("u2", "M2"), ("u2", "M1")], "user_id string, meter_id string")
    assert rows(an.entitled(md, per_user, user="u2"), "meter_id") == [("M1",), ("M2",)]
    assert rows(an.entitled(md, per_user, user="u1"), "meter_id") == [("M1",)]


def test_profile_matches_pandas(spark):
    rng = random.Random(7)
    vals = [round(rng.uniform(0, 5), 2) for _ in range(501)] + [None, None]
    labels = [rng.choice(["GOOD", "GOOD", "STUCK", None]) for _ in range(503)]
    df = spark.createDataFrame(list(zip(vals, labels)), "kwh double, quality string")
    prof = {r["column"]: r for r in qa.profile(df).collect()}
    s = pd.Series([v for v in vals if v is not None])
    k = prof["kwh"]
    assert k["count"] == 501 and k["unique"] == s.nunique()
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert abs(k[name] - s.quantile(p)) < 1e-6
    assert abs(k["std"] - s.std()) < 1e-6 and k["top"] is None
    q = prof["quality"]
    assert q["top"] == "GOOD" and q["freq"] == labels.count("GOOD") and q["unique"] == 2


def test_frequencies_order_and_nulls(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",), (None,), ("C",)], "quality string")
    got = [tuple(r) for r in qa.value_frequencies(df).collect()]
    assert got == [("B", 2), ("A", 1), ("C", 1)]


def test_head_rows_explicit_order(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("x"))
    assert [r["x"] for r in qa.head_rows(df, 3, ["x"]).collect()] == [0, 1, 2]


def test_profile_timestamps_like_pandas_datetimes(spark):
    base = dt.datetime(2025, 7, 1)
    ts = [base + dt.timedelta(hours=h * 7 % 50) for h in range(41)]
    df = spark.createDataFrame([(t,) for t in ts], "reading_ts timestamp_ntz")
    r = qa.profile(df).first()
    s = pd.Series(pd.to_datetime(ts))
    desc = s.describe()
    epoch = pd.Timestamp("1970-01-01")

    def secs(x):
        return (pd.Timestamp(x) - epoch).total_seconds()

    assert r["count"] == 41 and r["std"] is None and r["top"] is None
    assert r["min"] == secs(desc["min"]) and r["max"] == secs(desc["max"])
    assert abs(r["mean"] - secs(desc["mean"])) < 1e-3
    for name, key in (("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
        assert abs(r[name] - secs(desc[key])) < 1e-6


def test_profile_keeps_all_null_and_boolean_columns(spark):
    df = spark.createDataFrame([(None, True), (None, False), (None, True)], "x double, flag boolean")
    prof = {r["column"]: r for r in qa.profile(df).collect()}
    assert prof["x"]["count"] == 0 and prof["x"]["unique"] == 0 and prof["x"]["mean"] is None
    assert (prof["flag"]["count"], prof["flag"]["unique"], prof["flag"]["top"], prof["flag"]["freq"]) == (3, 2, "true", 2)


def test_quarter_to_date_and_bad_period(spark):
    md = _md(spark, [("M1", "2025-06-30", 1.0, 0.0), ("M1", "2025-07-01", 2.0, 0.0), ("M1", "2025-09-30", 4.0, 0.0)])
    got = dict(rows(an.period_to_date(md, "quarter"), "date_key", "qtd_kwh"))
    assert got == {"2025-06-30": 1.0, "2025-07-01": 2.0, "2025-09-30": 6.0}
    try:
        an.period_to_date(md, "week")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
