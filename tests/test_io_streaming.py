import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.sources.readers import payload_rows, read_csv, read_jsonl, read_payloads, read_table
from gridlake.sources.sinks import LoadSpec, from_event_payload, load_tables, to_event_payload, write_csv, write_table
from gridlake.streaming.ingest import read_events, upsert_latest
from tests.conftest import rows


def _tmp():
    return tempfile.mkdtemp(prefix="gridlake-test-", dir="/tmp")


def test_payload_rows_align(spark):
    # FIXTURES 24
    d = _tmp()
    payload = {"hourly": {"time": ["2025-07-01T00:00", "2025-07-01T01:00"], "temperature_2m": [5.0, 6.0],
                          "cloud_cover": [10.0, 20.0]}}
    with open(os.path.join(d, "p.json"), "w") as f:
        json.dump(payload, f, indent=2)
    out = read_payloads(spark, d, 59.91, 10.75)
    got = rows(out, "weather_ts", "temperature_2m", "cloud_cover", "latitude", "wind_speed_10m")
    assert got == [("2025-07-01T00:00", 5.0, 10.0, 59.91, None), ("2025-07-01T01:00", 6.0, 20.0, 59.91, None)]


def test_jsonl_keeps_corrupt_line(spark):
    d = _tmp()
    with open(os.path.join(d, "r.jsonl"), "w") as f:
        f.write(json.dumps({"meter_id": "M1", "reading_ts": "2025-07-01T00:00:00+00:00", "interval_kwh": 1.0,
                            "voltage": 230.1, "quality": "GOOD"}) + "\n")
        f.write("{not json\n")
    df = read_jsonl(spark, d, schemas.READING_EVENT).cache()
    assert df.count() == 2
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 1


def test_csv_and_table_roundtrip(spark):
    df = spark.createDataFrame(
        [("M1", "2025-07-01", 1.5), ("M2", "2025-07-02", None)], "meter_id string, date_key string, kwh double"
    )
    d = _tmp()
    write_csv(df, f"{d}/csv")
    assert rows(read_csv(spark, f"{d}/csv", df.schema)) == rows(df)
    write_table(df, f"{d}/t", partition_by=["date_key"], sort_within=["meter_id"])
    write_table(df, f"{d}/t", partition_by=["date_key"])  # overwrite is idempotent
    back = read_table(spark, f"{d}/t", schema=df.schema)
    assert rows(back, "meter_id", "date_key", "kwh") == rows(df, "meter_id", "date_key", "kwh")
    # partition pruning on the sink's partition column
    plan = back.filter(F.col("date_key") == "2025-07-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan


def test_event_payload_roundtrip(spark):
    df = spark.createDataFrame(
        [("M1", "C1", "2025-07-01T00:00:00Z", 1.0, 230.0, "GOOD")], schemas.READING_EVENT
    )
    msg = to_event_payload(df)
    assert msg.columns == ["key", "value"]
    assert rows(from_event_payload(msg, schemas.READING_EVENT)) == rows(df)


def test_load_tables_counts(spark):
    d = _tmp()
    specs = [
        LoadSpec("a", lambda s: s.range(10), f"{d}/a"),
        LoadSpec("b", lambda s: s.range(3), f"{d}/b"),
    ]
    assert load_tables(spark, specs) == {"a": 10, "b": 3}
    assert load_tables(spark, specs) == {"a": 10, "b": 3}  # rerun replaces


def _drop(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def _rec(ts, kwh):
    return {"meter_id": "M1", "customer_id": "C1", "reading_ts": ts, "interval_kwh": kwh, "voltage": 230.0,
            "quality": "GOOD"}


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    # FIXTURES 25
    root = _tmp()
    src, bronze, silver, ck = f"{root}/src", f"{root}/bronze", f"{root}/silver", f"{root}/ck"
    _drop(src, "a.json", [_rec("2025-07-01T00:00:00Z", 1.0), _rec("2025-07-01T00:15:00Z", 2.0)])

    def run():
        q = upsert_latest(read_events(spark, src, schemas.READING_EVENT, files_per_trigger=1), bronze, silver, ck)
        q.awaitTermination()

    run()
    _drop(src, "b.json", [_rec("2025-07-01T02:00:00+02:00", 9.0), _rec("2025-07-01T00:30:00Z", 3.0)])
    run()
    assert spark.read.parquet(bronze).count() == 4
    got = rows(spark.read.parquet(silver), "reading_ts", "interval_kwh")
    assert got == [(dt.datetime(2025, 7, 1, 0, 0), 9.0), (dt.datetime(2025, 7, 1, 0, 15), 2.0),
                   (dt.datetime(2025, 7, 1, 0, 30), 3.0)]
    run()  # restart with no new files
    assert spark.read.parquet(bronze).count() == 4
    assert spark.read.parquet(silver).count() == 3


def test_payload_rows_from_column(spark):
    df = spark.createDataFrame(
        [({"hourly": {"time": ["2025-07-01T00:00"], "temperature_2m": [1.0]}},)],
        "payload struct<hourly: struct<time: array<string>, temperature_2m: array<double>, "
        "apparent_temperature: array<double>, relative_humidity_2m: array<double>, cloud_cover: array<double>, "
        "wind_speed_10m: array<double>, shortwave_radiation: array<double>>>",
    )
    assert payload_rows(df, 1.0, 2.0).first()["longitude"] == 2.0


def test_decode_bus_messages(spark):
    from gridlake.streaming.ingest import decode_events

    msgs = [(b"M1", json.dumps(_rec("2025-07-01T00:00:00Z", 1.5)).encode()), (b"M2", b"not json")]
    raw = spark.createDataFrame(msgs, "key binary, value binary")
    got = decode_events(raw, schemas.READING_EVENT).collect()
    assert len(got) == 2
    assert got[0]["interval_kwh"] == 1.5 and got[1]["meter_id"] is None


def test_append_bronze_stream(spark):
    from gridlake.streaming.ingest import append_bronze

    root = _tmp()
    _drop(f"{root}/src", "a.json", [_rec("2025-07-01T00:00:00Z", 1.0), _rec("2025-07-01T00:15:00Z", 2.0)])
    q = append_bronze(read_events(spark, f"{root}/src", schemas.READING_EVENT), f"{root}/bronze", f"{root}/ck")
    q.awaitTermination()
    b = spark.read.parquet(f"{root}/bronze")
    assert b.count() == 2 and "_ingested_at" in b.columns
    q = append_bronze(read_events(spark, f"{root}/src", schemas.READING_EVENT), f"{root}/bronze", f"{root}/ck")
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 2  # restart: nothing re-appended


def test_run_pipeline_layouts(spark):
    from gridlake.operators.dims import dim_tariff_rate
    from gridlake.plans import driver_tables as dt_
    from gridlake.plans.pipeline import run_pipeline
    from tests.conftest import SF_SMALL

    results = []
    for layout in ("month", "meter_id"):
        root = _tmp()
        _, last = dt_.window_bounds(spark, SF_SMALL)
        p = run_pipeline(
            dt_.readings(spark, SF_SMALL), dt_.tariff_history(spark, SF_SMALL, with_key=False),
            dt_.weather_history(spark, SF_SMALL), dt_.weather_forecast(spark, SF_SMALL),
            dim_tariff_rate(spark), root, horizon=last, silver_partitioning=layout,
        )
        key = "reading_month=" if layout == "month" else "meter_id="
        assert any(n.startswith(key) for n in os.listdir(f"{p.readings}/status=good"))
        results.append(rows(spark.read.parquet(p.daily)))
        assert p.quarantine(spark).count() > 0
    assert results[0] == results[1]


def test_partitioned_overwrite_is_full_even_if_session_is_dynamic(spark):
    d = _tmp()
    a = spark.createDataFrame([("M1", "2025-07-01", 1.0), ("M1", "2025-07-02", 2.0)], "meter_id string, date_key string, kwh double")
    b = spark.createDataFrame([("M1", "2025-07-03", 3.0)], "meter_id string, date_key string, kwh double")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(a, f"{d}/t", partition_by=["date_key"])
        write_table(b, f"{d}/t", partition_by=["date_key"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert rows(read_table(spark, f"{d}/t", schema=a.schema), "date_key") == [("2025-07-03",)]


def test_replayed_micro_batch_replaces_itself(spark):
    # a batch re-run under the same id (e.g. after a crash before its commit) adds nothing
    from gridlake.streaming.ingest import stamp, upsert_latest_batch

    root = _tmp()
    batch = stamp(spark.createDataFrame(
        [("M1", "C1", "2025-07-01T00:00:00Z", 1.0, 230.0, "GOOD"), ("M1", "C1", "2025-07-02T00:00:00Z", 2.0, 230.0, "GOOD")],
        schemas.READING_EVENT,
    ))
    for _ in range(2):
        upsert_latest_batch(batch, 0, f"{root}/bronze", f"{root}/silver")
    assert spark.read.parquet(f"{root}/bronze").count() == 2
    assert rows(spark.read.parquet(f"{root}/silver"), "interval_kwh") == [(1.0,), (2.0,)]
    newer = stamp(spark.createDataFrame([("M1", "C1", "2025-07-01T02:00:00+02:00", 5.0, 230.0, "GOOD")], schemas.READING_EVENT))
    upsert_latest_batch(newer, 1, f"{root}/bronze", f"{root}/silver")
    got = [(str(d), k) for d, k in rows(spark.read.parquet(f"{root}/silver"), "reading_date", "interval_kwh")]
    assert got == [("2025-07-01", 5.0), ("2025-07-02", 2.0)]


def _events(spark, root):
    return read_events(spark, f"{root}/src", schemas.READING_EVENT)


def test_two_streams_and_a_lost_checkpoint_keep_all_raw_rows(spark):
    root = _tmp()
    for i, meter in enumerate(("A", "B", "C")):  # each with a checkpoint of its own on one Bronze
        src = f"{root}/src{i}"
        _drop(src, "x.json", [_rec("2025-07-01T00:00:00Z", float(i)) | {"meter_id": meter}])
        events = read_events(spark, src, schemas.READING_EVENT)
        upsert_latest(events, f"{root}/bronze", f"{root}/silver", f"{root}/ck{i}").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/bronze"), "meter_id") == [("A",), ("B",), ("C",)]
    assert rows(spark.read.parquet(f"{root}/silver"), "meter_id") == [("A",), ("B",), ("C",)]


def test_correction_in_the_same_batch_wins(spark):
    root = _tmp()
    meters = [f"M{i}" for i in range(8)]
    rec = lambda m, v: _rec("2025-07-01T00:00:00Z", v) | {"meter_id": m}
    # original and correction in one file, and in two files of one batch
    _drop(f"{root}/src", "a.json", [rec(m, 1.0) for m in meters] + [rec(m, 2.0) for m in meters[:4]])
    _drop(f"{root}/src", "b.json", [rec(m, 3.0) for m in meters[4:]])
    os.utime(f"{root}/src/a.json", (1_750_000_000, 1_750_000_000))
    upsert_latest(_events(spark, root), f"{root}/bronze", f"{root}/silver", f"{root}/ck").awaitTermination()
    got = dict(rows(spark.read.parquet(f"{root}/silver"), "meter_id", "interval_kwh"))
    assert got == {m: 2.0 for m in meters[:4]} | {m: 3.0 for m in meters[4:]}
    assert spark.read.parquet(f"{root}/bronze").count() == 16


def test_bad_messages_keep_their_text(spark):
    from gridlake.streaming.ingest import decode_events

    raw = spark.createDataFrame([(b"not json",)], "value binary")
    assert decode_events(raw, schemas.READING_EVENT).first()["_raw"] == "not json"
    root = _tmp()
    _drop(f"{root}/src", "a.json", [_rec("2025-07-01T00:00:00Z", 1.0)])
    with open(f"{root}/src/a.json", "a") as f:
        f.write("{broken\n")
    upsert_latest(_events(spark, root), f"{root}/bronze", f"{root}/silver", f"{root}/ck").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/bronze").filter("_raw IS NOT NULL"), "_raw") == [("{broken",)]


def test_csv_is_read_by_column_name(spark):
    d = _tmp()
    os.makedirs(f"{d}/c")
    with open(f"{d}/c/a.csv", "w") as f:
        f.write("tariff_code,n,meter_id,other\nstandard,1,M1,x\neconomy7,bad,M2,y\n")
    got = read_csv(spark, f"{d}/c", _schema("meter_id string, tariff_code string, n int, gone double"), keep_corrupt=True)
    out = {r["meter_id"]: r for r in got.collect()}
    assert (out["M1"]["tariff_code"], out["M1"]["n"], out["M1"]["gone"], out["M1"]["_corrupt_record"]) == ("standard", 1, None, None)
    assert out["M2"]["n"] is None and '"n":"bad"' in out["M2"]["_corrupt_record"]


def _schema(ddl):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def test_appended_files_are_seen(spark):
    from gridlake.plans import driver_tables as dt_

    d = _tmp()
    spark.range(5).write.parquet(f"{d}/t.parquet")
    assert dt_.table(spark, d, "t").count() == 5
    spark.range(5).write.mode("append").parquet(f"{d}/t.parquet")
    assert dt_.table(spark, d, "t").count() == 10


def test_fact_is_partitioned_and_prunes(spark):
    from gridlake.operators.dims import dim_tariff_rate
    from gridlake.plans import driver_tables as dt_
    from gridlake.plans.pipeline import run_pipeline
    from tests.conftest import SF_SMALL

    root = _tmp()
    bounds = dt_.window_bounds(spark, SF_SMALL)
    p = run_pipeline(
        dt_.readings(spark, SF_SMALL), dt_.tariff_history(spark, SF_SMALL, with_key=False, bounds=bounds),
        dt_.weather_history(spark, SF_SMALL), dt_.weather_forecast(spark, SF_SMALL), dim_tariff_rate(spark), root, window=bounds,
    )
    assert any(n.startswith("reading_month=") for n in os.listdir(p.fact))
    plan = p.silver(spark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan
    assert spark.read.parquet(p.weather).count() > 0
