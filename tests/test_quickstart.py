"""The README quickstart, run end to end on a small domain feed written the
way the published tools write it: readings as JSON lines with ISO offsets,
dimensions as CSV with headers, weather as parallel-array payloads."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.fixed import LOCATION, WINDOW_END, WINDOW_START
from gridlake.operators.dims import dim_date, dim_tariff_rate
from gridlake.plans.pipeline import run_pipeline
from gridlake.sources.readers import read_csv, read_jsonl, read_payloads
from gridlake.sources.sinks import write_csv
from gridlake.streaming.ingest import stamp


def _write_feed(root):
    os.makedirs(f"{root}/readings")
    with open(f"{root}/readings/part-0.jsonl", "w") as f:
        for m in ("MTR-00000", "MTR-00001"):
            for q in range(8):  # 2025-07-01 00:00..01:45 UTC, 15 minutes apart
                ts = f"2025-07-01T0{q // 4}:{(q % 4) * 15:02d}:00+00:00"
                f.write(json.dumps({"meter_id": m, "customer_id": m.replace("MTR", "CUST"), "reading_ts": ts,
                                    "interval_kwh": 0.25, "voltage": 230.0,
                                    "quality": "MISSING" if q == 7 else "GOOD"}) + "\n")
        # a re-delivery of the first slot, spelled with a +02:00 offset
        f.write(json.dumps({"meter_id": "MTR-00000", "customer_id": "CUST-00000",
                            "reading_ts": "2025-07-01T02:00:00+02:00", "interval_kwh": 0.25, "voltage": 230.0,
                            "quality": "GOOD"}) + "\n")
    os.makedirs(f"{root}/weather")
    hours = [f"2025-07-01T{h:02d}:00" for h in range(3)]
    with open(f"{root}/weather/history.json", "w") as f:
        json.dump({"hourly": {"time": hours, "temperature_2m": [15.0, 14.5, 14.0],
                              "cloud_cover": [10.0, 20.0, 30.0], "shortwave_radiation": [0.0, 0.0, 5.0]}}, f)


def test_quickstart(spark):
    root = tempfile.mkdtemp(prefix="gridlake-quickstart-", dir="/tmp")
    _write_feed(root)
    # dimensions as CSV, as the published builder writes them
    tariff_hist = spark.createDataFrame(
        [(1, "MTR-00000", "economy7", WINDOW_START, WINDOW_END, True),
         (2, "MTR-00001", "ev_special", WINDOW_START, WINDOW_END, True)],
        schemas.DIM_METER_TARIFF,
    )
    write_csv(tariff_hist, f"{root}/dim_meter_tariff")

    # --- quickstart (as in README) ---------------------------------------
    readings = stamp(read_jsonl(spark, f"{root}/readings", schemas.READING_EVENT).drop("_corrupt_record"))
    history = read_csv(spark, f"{root}/dim_meter_tariff", schemas.DIM_METER_TARIFF)
    lat, lon = LOCATION[3], LOCATION[4]
    weather_hist = read_payloads(spark, f"{root}/weather", lat, lon)
    weather_fcst = spark.createDataFrame([], weather_hist.schema)
    out = run_pipeline(
        readings, history, weather_hist, weather_fcst, dim_tariff_rate(spark), f"{root}/lake",
        window=(WINDOW_START, WINDOW_END),
    )
    daily = spark.read.parquet(out.daily)
    # ----------------------------------------------------------------------

    got = {(r["meter_id"], r["tariff_code"]): r for r in daily.collect()}
    # MTR-00000: 7 GOOD slots (the re-delivered 00:00 copy collapses across offsets);
    # local hours 02-03 -> economy7 night rate 0.14
    assert got[("MTR-00000", "economy7")]["kwh"] == 7 * 0.25
    assert got[("MTR-00000", "economy7")]["cost"] == round(7 * 0.25 * 0.14, 6)
    # MTR-00001: 7 GOOD slots at local 02:00-03:45 -> ev_special ev_window 0.09
    assert got[("MTR-00001", "ev_special")]["kwh"] == 7 * 0.25
    quarantine = out.quarantine(spark)
    assert sorted(r["reason"] for r in quarantine.collect()) == ["MISSING", "MISSING"]
    silver = out.silver(spark)
    assert silver.filter(F.col("temperature_2m").isNull()).count() == 0
    assert dim_date(spark, WINDOW_START, WINDOW_END).count() == 366


def test_quickstart_location_aware_without_forecast(spark):
    from gridlake.operators.dims import dim_location

    root = tempfile.mkdtemp(prefix="gridlake-quickstart-", dir="/tmp")
    _write_feed(root)
    readings = stamp(read_jsonl(spark, f"{root}/readings", schemas.READING_EVENT).drop("_corrupt_record"))
    history = spark.createDataFrame(
        [(1, "MTR-00000", "standard", WINDOW_START, None, True), (2, "MTR-00001", "green", WINDOW_START, None, True)],
        schemas.DIM_METER_TARIFF,
    )
    weather_hist = read_payloads(spark, f"{root}/weather", LOCATION[3], LOCATION[4]).unionByName(
        read_payloads(spark, f"{root}/weather", 60.39, 5.32).withColumn("temperature_2m", F.lit(-1.0))
    )
    meters = spark.createDataFrame([("MTR-00000", 1), ("MTR-00001", 2)], "meter_id string, location_id int")
    locs = dim_location(spark).unionByName(spark.createDataFrame([(2, "Bergen", "NO", 60.39, 5.32)], schemas.DIM_LOCATION))
    out = run_pipeline(readings, history, weather_hist, None, dim_tariff_rate(spark), f"{root}/lake",
                       horizon=WINDOW_END, locations=(meters, locs))
    silver = out.silver(spark)
    temps = {r["meter_id"]: r["t"] for r in silver.groupBy("meter_id").agg(F.max("temperature_2m").alias("t")).collect()}
    assert temps == {"MTR-00000": 15.0, "MTR-00001": -1.0}
    assert silver.count() == 14  # no fan-out over the two sites


def test_pipeline_without_quarantine_keeps_faulty_rows(spark):
    # the published code path: MISSING kWh nulled, row kept (and billed at 0)
    root = tempfile.mkdtemp(prefix="gridlake-quickstart-", dir="/tmp")
    _write_feed(root)
    readings = stamp(read_jsonl(spark, f"{root}/readings", schemas.READING_EVENT).drop("_corrupt_record"))
    history = spark.createDataFrame(
        [(1, "MTR-00000", "standard", WINDOW_START, WINDOW_END, True)], schemas.DIM_METER_TARIFF
    )
    weather = read_payloads(spark, f"{root}/weather", LOCATION[3], LOCATION[4])
    out = run_pipeline(readings, history, weather, None, dim_tariff_rate(spark), f"{root}/lake",
                       quarantine=False, horizon=WINDOW_END, silver_partitioning="date")
    assert out.quarantine(spark).count() == 0
    fact = spark.read.parquet(out.fact)
    # MTR-00000: 8 slots incl. one MISSING (kWh NULL -> cost NULL); MTR-00001 has no tariff -> not billed
    assert fact.count() == 8 and fact.filter(F.col("interval_kwh").isNull()).count() == 1
    daily = spark.read.parquet(out.daily).collect()
    assert len(daily) == 1 and daily[0]["kwh"] == 7 * 0.25
    assert "reading_date=2025-07-01" in os.listdir(f"{out.readings}/status=good")
