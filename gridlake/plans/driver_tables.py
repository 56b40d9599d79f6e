"""The driver's benchmark tables seen as metering data.

``events`` plays the meter readings (one user = one meter, one hour = one
reading slot, ``event_id`` = ingest order), its sign-ups play tariff
changes, its hourly ``view`` / ``click`` means play weather history /
forecast; ``customer`` / ``nation`` / ``region`` are the conformed
dimensions; ``lineitem`` is the high-volume feed for the bench. Everything
is derived by Spark from the tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.fixed import LOCAL_ZONE, LOCATION
from gridlake.functions.scalar import tariff_by_index
from gridlake.functions.time import to_iso_offset, trunc_hour, trunc_minutes
from gridlake.operators.dims import scd2_from_changes

# Mapping parameters (ours, not published values).
SUSPECT_ABOVE = 150.0  # a 'view' reading above this is SUSPECT_HIGH
VALUE_DECIMALS = 2  # events.value carries 2 decimal places
LAT, LON = LOCATION[3], LOCATION[4]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy scan, listed anew at each call, so that files
    appended since are read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quality(event_type, value):
    return (
        F.when(event_type == "error", F.lit("MISSING"))
        .when((event_type == "view") & (value > SUSPECT_ABOVE), F.lit("SUSPECT_HIGH"))
        .otherwise(F.lit("GOOD"))
    )


def _readings(ev: DataFrame, reading_ts) -> DataFrame:
    return ev.select(
        F.col("user_id").alias("meter_id"),
        F.col("user_id").alias("customer_id"),
        reading_ts.alias("reading_ts"),
        F.col("value").alias("interval_kwh"),
        (F.lit(230.0) + F.get_json_object("props", "$.k").cast("double") / 10).alias("voltage"),
        _quality(F.col("event_type"), F.col("value")).alias("quality"),
        F.col("event_id").alias("_ingested_at"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped readings from ``events``: one reading per user and hour
    slot, so re-deliveries within an hour are duplicates to resolve. The
    instant stays a UTC ``timestamp_ntz`` (Silver's typing passes it
    through); ``readings_text`` is the same feed spelled as ISO text."""
    return _readings(table(spark, sf_dir, "events"), trunc_hour(F.col("ts")))


def readings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as the wire carries them: ``reading_ts`` is ISO-8601 text
    with an offset. 'click' events spell the local Oslo wall clock with its
    offset, all others UTC ``+00:00``, so copies of one instant arrive under
    different spellings and must be typed before de-duplicating."""
    slot = trunc_hour(F.col("ts"))
    text = F.when(F.col("event_type") == "click", to_iso_offset(slot, LOCAL_ZONE)).otherwise(to_iso_offset(slot))
    return _readings(table(spark, sf_dir, "events"), text)


def window_bounds(spark: SparkSession, sf_dir: str):
    """(first, last) UTC day of the feed, as date literals for the plans that
    need them (calendar, trim, as-of horizon, SCD2 end). One aggregate over
    one column fetches the two dates; passing them as parameters avoids a
    scalar subquery (a scan of ``ts``) in every plan that uses them."""
    d = F.to_date("ts")
    row = table(spark, sf_dir, "events").agg(F.min(d).alias("first"), F.max(d).alias("last")).first()
    return F.lit(row["first"]).cast("date"), F.lit(row["last"]).cast("date")


def tariff_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log: one row per user and day with a sign-up; the day's last
    sign-up picks the tariff (``event_id mod 4`` into the catalogue)."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    per_day = ev.groupBy(
        F.col("user_id").alias("meter_id"), F.to_date("ts").alias("change_date")
    ).agg(F.max("event_id").alias("_eid"))
    return per_day.select("meter_id", "change_date", tariff_by_index(F.col("_eid")).alias("tariff_code"))


def tariff_history(spark: SparkSession, sf_dir: str, with_key: bool = True, bounds=None) -> DataFrame:
    """SCD2 tariff history built from the change log (``with_key=False``:
    without the surrogate key, as the as-of join consumes it)."""
    _, end = bounds or window_bounds(spark, sf_dir)
    sk = "meter_tariff_sk" if with_key else None
    return scd2_from_changes(tariff_changes(spark, sf_dir), end, sk=sk)


def _hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics of 'view' and 'click' events in one scan and one
    aggregation; history and forecast are two filters over it. Every
    variable except the count is an input value (2 decimal places): the
    temperature is the hour's first reading, cloud cover its minimum,
    radiation its maximum, so daily means are exact (``exact_mean``)."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    g = ev.groupBy(trunc_hour(F.col("ts")).alias("weather_ts"), F.col("event_type"))
    return g.agg(
        F.min_by("value", "event_id").alias("temperature_2m"),
        F.count(F.lit(1)).cast("double").alias("relative_humidity_2m"),
        F.min("value").alias("cloud_cover"),
        F.max("value").alias("shortwave_radiation"),
    ).withColumn("latitude", F.lit(LAT)).withColumn("longitude", F.lit(LON))


def weather_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly 'view' statistics as weather history."""
    h = _hourly_stats(spark, sf_dir)
    return h.filter(F.col("event_type") == "view").drop("event_type")


def weather_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly 'click' statistics as a forecast frame (it has no cloud cover,
    so the union must fill the missing column)."""
    h = _hourly_stats(spark, sf_dir)
    return h.filter(F.col("event_type") == "click").drop("event_type", "cloud_cover")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the customer/meter registry: the meter id is the
    customer key, solar when the account balance is positive, occupants from
    the nation key."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("meter_id"),
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_acctbal") > 0).alias("has_solar"),
        (F.pmod(F.col("c_nationkey"), F.lit(5)) + 1).cast("int").alias("occupants"),
        F.lit(None).cast("string").alias("join_date"),
        F.col("c_nationkey"),
        F.col("c_mktsegment"),
    )


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-volume feed: supplier = meter, ship date + line number x 15 min =
    slot, quantity = kWh; order key = ingest order."""
    li = table(spark, sf_dir, "lineitem")
    ts = F.timestamp_add("MINUTE", F.col("l_linenumber") * 15, F.col("l_shipdate"))
    return li.select(
        F.col("l_suppkey").alias("meter_id"),
        F.col("l_suppkey").alias("customer_id"),
        trunc_minutes(ts, 15).alias("reading_ts"),
        F.col("l_quantity").alias("interval_kwh"),
        (F.lit(225.0) + F.col("l_discount") * 100).alias("voltage"),
        F.when(F.col("l_returnflag") == "R", F.lit("MISSING")).otherwise(F.lit("GOOD")).alias("quality"),
        F.col("l_orderkey").alias("_ingested_at"),
    )


def lineitem_tariff_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log for the lineitem feed: one change per supplier and month it
    ships in; the month's largest order key picks the tariff."""
    li = table(spark, sf_dir, "lineitem")
    per_month = li.groupBy(
        F.col("l_suppkey").alias("meter_id"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("change_date"),
    ).agg(F.max("l_orderkey").alias("_ok"))
    return per_month.select("meter_id", "change_date", tariff_by_index(F.col("_ok")).alias("tariff_code"))
