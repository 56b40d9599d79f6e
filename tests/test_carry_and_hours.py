"""As-of by union and carry, the hour table by day, SCD2 by increments."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridlake.operators.analytics import elasticity
from gridlake.operators.dims import merge_scd2, read_scd2, scd2_apply, scd2_from_changes
from gridlake.operators.joins import hour_table, join_hour_table, join_hourly, resolve_as_of, resolve_as_of_carry
from tests.conftest import SF_SMALL, rows

READING = "meter_id string, reading_ts timestamp_ntz, n int"
HISTORY = "meter_id string, tariff_code string, valid_from string, valid_to string"


def _ordered(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def _readings(spark, rng, n=400):
    start = dt.datetime(2025, 1, 1)
    out = [(rng.choice(["A", "B", "C", "D", None]), start + dt.timedelta(minutes=15 * rng.randrange(40_000)), i) for i in range(n)]
    return spark.createDataFrame([*out, ("A", None, -1), (None, None, -2), ("A", start, -3), ("B", dt.datetime(2026, 3, 1), -4)], READING)


CASES = {
    "contiguous": [("A", "x", "2024-05-01", "2025-02-14"), ("A", "y", "2025-02-15", None), ("B", "x", "2025-03-31", "2025-03-31")],
    "gaps": [("A", "x", "2025-01-10", "2025-01-20"), ("A", "y", "2025-04-01", "2025-04-30"), ("C", "z", "2025-06-01", "2025-12-31")],
    "overlaps": [("A", "x", "2025-01-01", "2025-06-30"), ("A", "y", "2025-03-01", "2025-03-31"), ("A", "y", "2025-03-01", "2025-03-31"), ("B", "x", "2024-01-01", None)],
    "odd": [(None, "x", "2025-01-01", None), ("A", "x", None, None), ("A", "y", "2025-05-05", "2025-05-01"), ("B", "w", "2026-02-01", None)],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_carry_gives_the_rows_of_the_join(spark, case):
    readings = _readings(spark, random.Random(5))
    history = spark.createDataFrame(CASES[case], HISTORY)
    want = _ordered(resolve_as_of(readings, history))
    for how in ({}, {"horizon": "2025-12-31"}, {"horizon": "2025-12-31", "since": "2025-02-01"},
                {"horizon": "2025-12-31", "since": "2025-02-01", "bucket": "day"}):
        assert _ordered(resolve_as_of_carry(readings, history, **how)) == want, how
    assert _ordered(resolve_as_of_carry(readings, history, inclusive_to=False)) == _ordered(resolve_as_of(readings, history, inclusive_to=False))


def test_carry_takes_one_shuffle_less(spark):
    readings, history = _readings(spark, random.Random(1)), spark.createDataFrame(CASES["contiguous"], HISTORY)

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    join = resolve_as_of(readings, history, horizon="2025-12-31", since="2025-01-01")
    carry = resolve_as_of_carry(readings, history, horizon="2025-12-31", since="2025-01-01")
    assert exchanges(carry) == exchanges(join) - 1 == 1


def test_hour_table_gives_the_rows_of_the_hourly_join(spark):
    rng, start = random.Random(2), dt.datetime(2025, 3, 30)
    readings = _readings(spark, rng).withColumn("site", F.pmod("n", F.lit(3)).cast("int"))
    hours = [(start + dt.timedelta(hours=h), s, float(h), float(s)) for h in range(72) for s in (0, 1) if rng.random() < 0.8]
    hours += [(None, 0, 1.0, 1.0), (start, 1, 9.0, 9.0)]  # no instant; two rows in an hour
    weather = spark.createDataFrame(hours, "weather_ts timestamp_ntz, site int, temperature_2m double, relative_humidity_2m double")
    near = readings.withColumn("reading_ts", F.expr("timestampadd(DAY, 89 - dayofyear(reading_ts) + pmod(n, 4), reading_ts)"))
    for keys in ([], [("site", "site")]):
        table = hour_table(weather, keys=[w for _, w in keys])
        for few in (True, False):
            got = join_hour_table(near, table, keys=keys, few_days=few)
            assert _ordered(got) == _ordered(join_hourly(near, weather, keys=keys))
    assert hour_table(weather).count() == 3


def test_weather_moves_no_reading(spark):
    from gridlake.plans.queries import QUERIES

    plan = QUERIES["readings_with_weather"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hour_ts" not in "".join(x for x in plan.split("\n") if "Exchange" in x)


def test_bench_plan_has_no_weather(spark):
    from gridlake.plans.bench_plans import lineitem_daily_cost

    plan = lineitem_daily_cost(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan and "temperature_2m" not in plan


def _changes(rng, n=120):
    day = lambda: f"2025-{rng.randint(1, 14):02d}-10" if rng.random() < 0.05 else str(dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(420)))
    return [(rng.choice("ABCDEFGH"), day() if rng.random() < 0.97 else None, rng.choice(["w", "x", "y", "z"])) for _ in range(n)]


def _valid(changes):
    return [c for c in changes if c[1] is None or int(c[1][5:7]) <= 12]


LOG = "meter_id string, change_date string, tariff_code string"


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_of_the_log_gives_the_full_history(spark, seed):
    import tempfile

    rng = random.Random(seed)
    changes, end = _valid(_changes(rng)), "2025-12-31"
    want = _ordered(scd2_from_changes(spark.createDataFrame(changes, LOG), end, sk=None))
    rng.shuffle(changes)  # late changes fall into closed intervals
    cuts = sorted(rng.sample(range(1, len(changes)), 2))
    batches = [changes[:cuts[0]], changes[cuts[0]:cuts[1]], changes[cuts[1]:], changes[:5]]  # the last one again
    history = spark.createDataFrame([], "meter_id string, tariff_code string, valid_from string, valid_to string, is_current boolean")
    path = tempfile.mkdtemp(prefix="gridlake-test-") + "/history"
    for b in batches:
        batch = spark.createDataFrame(b, LOG)
        history = spark.createDataFrame(scd2_apply(history, batch, end).collect(), history.schema)
        merge_scd2(spark, path, batch, end, buckets=8)
    assert _ordered(history) == want
    assert _ordered(read_scd2(spark, path, end)) == want


def test_a_batch_rewrites_the_buckets_it_touches(spark):
    import os
    import tempfile

    path = tempfile.mkdtemp(prefix="gridlake-test-") + "/history"
    merge_scd2(spark, path, spark.createDataFrame([(f"M{i}", "2025-01-01", "x") for i in range(200)], LOG), "2025-06-30", buckets=16)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    before = files()
    merge_scd2(spark, path, spark.createDataFrame([("M7", "2025-03-01", "y")], LOG), "2025-12-31", buckets=16)
    assert len({os.path.dirname(f) for f in before - files()}) == 1
    h = read_scd2(spark, path, "2025-12-31")
    assert rows(h.filter("meter_id = 'M7'"), "tariff_code", "valid_from", "valid_to", "is_current") == [
        ("x", "2025-01-01", "2025-02-28", False), ("y", "2025-03-01", "2025-12-31", True)]
    assert rows(h.filter("is_current").select("valid_to").distinct()) == [("2025-12-31",)] and h.count() == 201


def test_regression_has_the_same_bits_for_any_partitioning(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    days = [str(dt.date(2025, 1, 1) + dt.timedelta(days=i)) for i in range(60)]
    temp = rng.normal(8, 7, 60)
    md = [(f"M{m}", d, round(float(20 - 0.4 * t + rng.normal()), 4)) for m in range(40) for d, t in zip(days, temp)]
    weather = spark.createDataFrame(list(zip(days, map(float, temp))), "date_key string, avg_temp_c double")
    meters = spark.createDataFrame([(f"M{m}", m % 3 == 0) for m in range(40)], "meter_id string, has_solar boolean")
    usage = spark.createDataFrame(md, "meter_id string, date_key string, kwh double")
    seen = {str(sorted(map(tuple, elasticity(usage.repartition(n), weather.repartition(n), meters).collect()))) for n in (3, 7, 16)}
    assert len(seen) == 1
    for r in elasticity(usage, weather, meters).collect():
        own = [(t, k) for m, d, k in md if (int(m[1:]) % 3 == 0) == r.has_solar for t in [temp[days.index(d)]]]
        x, y = np.array(own).T
        slope, level = np.polyfit(x, y, 1)
        assert abs(r.slope - slope) < 1e-7 and abs(r.intercept - level) < 1e-6
        assert abs(r.r2 - np.corrcoef(x, y)[0, 1] ** 2) < 1e-8 and r.n == len(own)
