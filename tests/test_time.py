import datetime as dt

from pyspark.sql import functions as F

from gridlake.functions.time import date_key, local_hour, to_utc_ntz, trunc_hour, trunc_minutes


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_to_utc_ntz_offsets_and_garbage(spark):
    df = spark.createDataFrame(
        [("2025-07-01T00:00:00+00:00",), ("2025-07-01T02:00:00+02:00",), ("2025-07-01T00:00:00Z",),
         ("2024-01-20T19:00",), ("garbage",), (None,)],
        "s string",
    )
    got = [r[0] for r in df.select(to_utc_ntz("s")).collect()]
    assert got[:3] == [_ts("2025-07-01T00:00:00")] * 3
    # a bare date ends in "-01" but carries no offset: UTC midnight, whatever the session zone
    other = spark.createDataFrame(
        [("2025-07-01",), ("2025-07-01 10:00:00+0200",), ("2025-07-01T10:00:00.250-01",), ("2025-07-01T10:00Z",)],
        "s string",
    )
    assert [r[0] for r in other.select(to_utc_ntz("s")).collect()] == [
        _ts("2025-07-01T00:00:00"), _ts("2025-07-01T08:00:00"), _ts("2025-07-01T11:00:00.250"),
        _ts("2025-07-01T10:00:00"),
    ]
    assert got[3] == _ts("2024-01-20T19:00:00")
    assert got[4] is None and got[5] is None


def test_local_hour_dst_edges(spark):
    # FIXTURES 10 (autumn) and 11 (spring)
    df = spark.createDataFrame(
        [(_ts("2025-10-25T22:30:00"),), (_ts("2025-10-26T00:30:00"),), (_ts("2025-10-26T01:30:00"),),
         (_ts("2026-03-29T00:30:00"),), (_ts("2026-03-29T01:30:00"),)],
        "ts timestamp_ntz",
    )
    got = [r[0] for r in df.select(local_hour("ts", "Europe/Oslo")).collect()]
    assert got == [0, 2, 2, 1, 3]


def test_trunc_is_session_zone_free(spark):
    # 02:30 does not exist in Oslo on 2026-03-29; truncation must not move it.
    df = spark.createDataFrame([(_ts("2026-03-29T02:30:00"),), (_ts("2025-10-26T02:47:10"),)], "ts timestamp_ntz")
    got = df.select(trunc_hour("ts").alias("h"), trunc_minutes("ts", 15).alias("q")).collect()
    assert got[0]["h"] == _ts("2026-03-29T02:00:00")
    assert got[1]["h"] == _ts("2025-10-26T02:00:00")
    assert got[1]["q"] == _ts("2025-10-26T02:45:00")


def test_date_key_utc_and_local(spark):
    # FIXTURES 13
    df = spark.createDataFrame([(_ts("2025-07-01T22:30:00"),)], "ts timestamp_ntz")
    r = df.select(date_key("ts").alias("u"), date_key(F.col("ts"), "Europe/Oslo").alias("l")).first()
    assert r["u"] == "2025-07-01" and r["l"] == "2025-07-02"


def test_iso_offset_roundtrip(spark):
    from gridlake.functions.time import to_iso_offset

    df = spark.createDataFrame(
        [(_ts("2024-01-01T00:00:00"),), (_ts("2025-07-01T22:30:00"),), (_ts("2026-03-29T01:30:00"),)],
        "ts timestamp_ntz",
    )
    out = df.select(
        "ts",
        to_iso_offset("ts").alias("u"),
        to_iso_offset(F.col("ts"), "Europe/Oslo").alias("o"),
        to_iso_offset(F.col("ts"), "America/St_Johns").alias("n"),
    ).select("*", to_utc_ntz("u").alias("bu"), to_utc_ntz("o").alias("bo"), to_utc_ntz("n").alias("bn"))
    rows = out.collect()
    assert rows[0]["u"] == "2024-01-01T00:00:00+00:00" and rows[0]["o"] == "2024-01-01T01:00:00+01:00"
    assert rows[1]["o"] == "2025-07-02T00:30:00+02:00" and rows[2]["o"] == "2026-03-29T03:30:00+02:00"
    assert rows[0]["n"] == "2023-12-31T20:30:00-03:30"
    assert all(r["bu"] == r["ts"] == r["bo"] == r["bn"] for r in rows)


def test_text_keys_are_session_zone_free(spark):
    from gridlake.functions.time import iso_minute, month_key

    df = spark.createDataFrame([(_ts("2026-03-29T02:30:00"),), (_ts("2026-03-31T23:59:59.5"),)], "ts timestamp_ntz")
    got = [tuple(r) for r in df.select(iso_minute("ts"), month_key("ts")).collect()]
    assert got == [("2026-03-29T02:30", "2026-03"), ("2026-03-31T23:59", "2026-03")]


def test_ltz_input_becomes_utc_ntz(spark):
    from pyspark.sql.types import TimestampType

    from gridlake.plans.pipeline import type_instant

    # an instant typed as session-zone timestamp (LTZ), e.g. from a source that parses offsets itself
    df = spark.createDataFrame([("2025-07-01T02:00:00+02:00",), ("2026-03-29T01:30:00Z",)], "s string")
    ltz = df.select(F.col("s").cast(TimestampType()).alias("reading_ts"))
    got = [r[0] for r in type_instant(ltz, "reading_ts").collect()]
    assert got == [_ts("2025-07-01T00:00:00"), _ts("2026-03-29T01:30:00")]
