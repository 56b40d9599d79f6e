import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators.aggregates import cost_fact, daily_usage
from gridlake.operators.dims import coverage, dim_date, dim_tariff_rate, scd2_from_changes
from gridlake.operators.ordering import with_sequence
from gridlake.plans.pipeline import build_gold, build_silver, reconcile_weather
from tests.conftest import rows

HIST = [
    (1, "M1", "standard", "2025-06-29", "2025-09-30", False),
    (2, "M1", "economy7", "2025-10-01", "2026-06-29", True),
    (3, "M2", "ev_special", "2025-06-29", "2026-06-29", True),
]


def _silver(spark, data):
    return spark.createDataFrame(
        data, "meter_id string, reading_ts timestamp_ntz, hour_ts timestamp_ntz, interval_kwh double, voltage double, tariff_code string"
    )


def test_rate_window_half_open_edge(spark):
    # FIXTURES 12: local 04:45 -> ev_window 0.09; local 05:00 -> day 0.30
    s = _silver(
        spark,
        [("M2", dt.datetime(2025, 7, 1, 2, 45), None, 1.0, 230.0, "ev_special"),
         ("M2", dt.datetime(2025, 7, 1, 3, 0), None, 1.0, 230.0, "ev_special")],
    )
    got = rows(cost_fact(s, dim_tariff_rate(spark)), "reading_ts", "period_name", "unit_rate")
    assert [(g[1], g[2]) for g in got] == [("ev_window", 0.09), ("day", 0.30)]


def test_cost_rounding_and_unknown_tariff(spark):
    # FIXTURES 19 + null/unknown tariff drops the reading
    s = _silver(
        spark,
        [("M1", dt.datetime(2025, 7, 1, 12), None, 1.2345, 230.0, "economy7"),
         ("M1", dt.datetime(2025, 7, 1, 13), None, 1.0, 230.0, None),
         ("M1", dt.datetime(2025, 7, 1, 14), None, 1.0, 230.0, "nope")],
    )
    f = cost_fact(s, dim_tariff_rate(spark)).collect()
    assert len(f) == 1 and f[0]["cost"] == 0.382695


def test_missing_only_day_without_quarantine(spark):
    # FIXTURES 14: quarantine off, a meter-day of MISSING rows -> 0.0 kWh/cost, avg voltage 0.0
    readings = spark.createDataFrame(
        [("M1", "C1", f"2025-07-01T1{h}:00:00Z", 0.0, 0.0, "MISSING", dt.datetime(2025, 7, 2)) for h in range(3)],
        schemas.READINGS_BRONZE,
    )
    hist = spark.createDataFrame(HIST, schemas.DIM_METER_TARIFF)
    weather = reconcile_weather(spark.createDataFrame([], schemas.WEATHER), spark.createDataFrame([], schemas.WEATHER))
    s = build_silver(readings, hist, weather, quarantine=False)
    daily = build_gold(s.enriched, dim_tariff_rate(spark)).daily.collect()
    assert len(daily) == 1
    assert (daily[0]["kwh"], daily[0]["cost"], daily[0]["avg_voltage"]) == (0.0, 0.0, 0.0)
    # with quarantine on, the rows leave and nothing is billed
    q = build_silver(readings, hist, weather, quarantine=True)
    assert q.enriched.count() == 0 and q.quarantine.count() == 3


def test_daily_sum_equals_fact_sum(spark):
    s = _silver(
        spark,
        [("M1", dt.datetime(2025, 7, 1, h), None, 0.1 * h, 230.0 + h, "economy7") for h in range(24)]
        + [("M2", dt.datetime(2025, 7, 1, h), None, 0.2, 231.0, "ev_special") for h in range(24)],
    )
    fact = cost_fact(s, dim_tariff_rate(spark))
    assert fact.count() == 48  # windows tile 0-24: one rate row per reading
    daily = daily_usage(fact)
    f = fact.agg(F.sum("cost")).first()[0]
    d = daily.agg(F.sum("cost")).first()[0]
    assert abs(f - d) < 1e-9


def test_dim_date(spark):
    # FIXTURES 20
    d = dim_date(spark, "2025-06-29", "2026-06-29")
    assert d.count() == 366
    first = d.filter(F.col("date") == "2025-06-29").first()
    assert (first["day_of_week"], first["is_weekend"], first["season"]) == (7, True, "summer")


def test_scd2_from_changes(spark):
    # FIXTURES 21
    ch = spark.createDataFrame(
        [("M1", "2025-06-29", "standard"), ("M1", "2025-10-01", "economy7"), ("M2", "2025-06-29", "ev_special")],
        schemas.TARIFF_CHANGES,
    )
    got = rows(scd2_from_changes(ch, "2026-06-29"))
    assert got == [(1, "M1", "standard", "2025-06-29", "2025-09-30", False),
                   (2, "M1", "economy7", "2025-10-01", "2026-06-29", True),
                   (3, "M2", "ev_special", "2025-06-29", "2026-06-29", True)]


def test_with_sequence_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") * 7919 % 5000).alias("b"))
    seq = with_sequence(df, ["a", "b"], out="s")
    ref = df.withColumn("s", F.row_number().over(Window.orderBy("a", "b")))
    assert rows(seq, "a", "b", "s") == rows(ref, "a", "b", "s")


def test_coverage(spark):
    # FIXTURES 22: 90 of 96 slots present
    base = dt.datetime(2025, 7, 1)
    r = spark.createDataFrame(
        [("M1", base + dt.timedelta(minutes=15 * i)) for i in range(96) if i not in (3, 4, 5, 50, 51, 90)],
        "meter_id string, reading_ts timestamp_ntz",
    )
    cov = coverage(r, r.select("meter_id").distinct(), "2025-07-01", "2025-07-02").collect()
    got = sorted((c["date_key"], c["expected"], c["present"]) for c in cov)
    assert got == [("2025-07-01", 96, 90), ("2025-07-02", 96, 0)]


def test_fixed_rate_windows_tile_the_day(spark):
    from gridlake.fixed import TARIFF_RATES, TARIFFS

    codes = {t[0] for t in TARIFFS}
    assert {r[0] for r in TARIFF_RATES} == codes
    for code in codes:
        hours = sorted(h for c, _, s, e, _ in TARIFF_RATES if c == code for h in range(s, e))
        assert hours == list(range(24)), code
    rates = dim_tariff_rate(spark)
    assert rates.count() == 6 and dict(zip(rates.columns, [f.dataType.simpleString() for f in rates.schema])) == {
        "tariff_code": "string", "period_name": "string", "start_hour": "int", "end_hour": "int", "unit_rate": "double"
    }


def test_profile_percentiles_without_aqe(spark):
    # Regression: with AQE off, a persisted range-partitioned relation was not
    # reused by the second side of the self-join inside with_offset, so the
    # two sides disagreed on partition ids and the percentiles came out wrong.
    import numpy as np

    from gridlake.operators.quality import profile
    from gridlake.plans.queries import nulled

    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        n = nulled(spark, "/root/testdata/sf0.01")
        vals = [r[0] for r in n.select("interval_kwh").collect() if r[0] is not None]
        r = profile(n, ["interval_kwh"]).first()
        for name, p in (("p25", 25), ("p50", 50), ("p75", 75)):
            assert abs(r[name] - round(float(np.percentile(vals, p)), 6)) < 1e-6, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])


def test_coverage_counts_distinct_slots_on_raw_input(spark):
    base = dt.datetime(2025, 7, 1)
    r = spark.createDataFrame([("M1", base), ("M1", base), ("M1", base + dt.timedelta(minutes=15))],
                              "meter_id string, reading_ts timestamp_ntz")
    raw = coverage(r, r.select("meter_id").distinct(), "2025-07-01", "2025-07-01", unique=False).first()
    assert raw["present"] == 2


def test_calendar_empty_when_start_after_end(spark):
    assert dim_date(spark, "2025-07-02", "2025-07-01").count() == 0
    assert dim_date(spark, "2025-07-01", "2025-07-01").count() == 1
