"""The Silver and Gold builds as one lazy DataFrame chain.

Silver: type the instant -> keep the latest copy per (meter, instant) ->
NULL the MISSING sentinel -> quarantine split -> as-of tariff -> hourly
weather (+ ``hour_ts``). Gold: time-of-use cost fact -> daily usage, and
daily weather.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlake.fixed import LOCAL_ZONE
from gridlake.functions.time import date_key, month_key, to_utc_ntz, trunc_hour
from gridlake.operators.aggregates import cost_fact, daily_usage, daily_weather
from gridlake.operators.cleanse import null_missing, null_sentinel, split_quarantine, trim_window
from gridlake.operators.dedupe import dedupe_latest, prioritised_union
from gridlake.operators.joins import hour_table, join_hour_table, resolve_as_of, resolve_as_of_carry, with_location
from gridlake.session import apply_recommended
from gridlake.sources.readers import read_table
from gridlake.sources.sinks import write_table


def type_instant(df: DataFrame, col: str) -> DataFrame:
    """Make ``col`` a UTC ``timestamp_ntz`` whatever it arrives as."""
    return df.withColumn(col, to_utc_ntz(F.col(col), df.schema[col].dataType))


def reconcile_weather(
    history: DataFrame, forecast: DataFrame | None, ts: str = "weather_ts"
) -> DataFrame:
    """U1 + W2: history rows win over forecast rows for the same hour and
    location; hours only in the forecast are kept. ``forecast=None`` keeps
    the history alone (still one row per hour and location)."""
    frames = [type_instant(f, ts) for f in (history, forecast) if f is not None]
    return prioritised_union(frames, [ts, "latitude", "longitude"])


@dataclass
class Silver:
    enriched: DataFrame
    quarantine: DataFrame | None


def build_silver(
    readings: DataFrame,
    tariff_history: DataFrame,
    weather: DataFrame | None,
    quarantine: bool = True,
    weather_keys=(),
    order_col: str = "_ingested_at",
    horizon=None,
    window=None,
    locations: tuple[DataFrame, DataFrame] | None = None,
    few_weather_days: bool = False,
    as_of: str = "join",
    deduped: bool = False,
) -> Silver:
    """Silver readings with ``tariff_code``, ``temperature_2m``,
    ``relative_humidity_2m`` and ``hour_ts``.

    ``quarantine=True`` (default) removes rows with an unparsed instant or a
    non-GOOD label into ``Silver.quarantine``; ``False`` is the published
    code path (sentinel nulled, row kept; an unparsed instant is still kept
    out of the dedupe). ``window=(start, end)`` trims readings to the
    analysis window (B1, both ends inclusive, UTC dates) and, unless given,
    makes ``end`` the ``horizon`` that turns on the time-bucketed as-of join,
    which splits a hot meter (see ``resolve_as_of``). Readings with an
    unparsed instant are not trimmed; they go to quarantine or, without one,
    stay in Silver with a NULL instant.
    ``locations=(dim_meter, dim_location)`` makes the weather join
    location-aware (each reading matches its own site's hour) instead of the
    published hour-only join, which fans out with several sites.
    ``weather=None`` leaves the weather out: Gold keeps no weather column, so
    its plans need not move the readings to meet it. Weather is met by the
    day (``join_hour_table``); ``few_weather_days`` says that the caller has
    bounded its days times sites. ``as_of``: ``join``, or ``carry`` for the
    as-of match by union and carry. ``deduped``: the readings hold the newest
    copy of each instant already (``streaming.latest.read_latest``).
    """
    if as_of not in ("join", "carry"):
        raise ValueError("as_of must be 'join' or 'carry'")
    typed = type_instant(readings, "reading_ts")
    if window is not None:
        start, end = window
        typed = trim_window(typed, start, end, keep_unparsed=True)
        horizon = end if horizon is None else horizon
    latest = typed if deduped else dedupe_latest(typed, ("meter_id", "reading_ts"), order_col)
    nulled = null_missing(null_sentinel(latest), "interval_kwh", "voltage")
    if quarantine:
        good, bad = split_quarantine(nulled)
    else:
        good, bad = nulled, None
    since = window[0] if window is not None else None
    resolve = resolve_as_of if as_of == "join" else resolve_as_of_carry
    tariffed = resolve(good, tariff_history, horizon=horizon, since=since)
    if weather is None:
        return Silver(tariffed.withColumn("hour_ts", trunc_hour(F.col("reading_ts"))), bad)
    if locations is not None:
        tariffed = with_location(tariffed, *locations)
        weather_keys = [("latitude", "latitude"), ("longitude", "longitude")]
    hourly = tariffed.withColumn("hour_ts", trunc_hour(F.col("reading_ts")))
    hours = hour_table(weather, keys=[w for _, w in weather_keys])
    enriched = join_hour_table(hourly, hours, keys=weather_keys, few_days=few_weather_days)
    if locations is not None:
        enriched = enriched.drop("latitude", "longitude")
    return Silver(enriched, bad)


@dataclass
class Gold:
    fact: DataFrame
    daily: DataFrame


def build_gold(
    silver: DataFrame, rates: DataFrame, zone: str = LOCAL_ZONE, date_zone: str | None = None
) -> Gold:
    fact = cost_fact(silver, rates, zone=zone, date_zone=date_zone)
    return Gold(fact, daily_usage(fact))


#: Weather rows up to which the written table is broadcast to the readings: 64
#: bytes each at most, so 32 MB; more rows are joined by a shuffle.
WEATHER_BROADCAST_ROWS = 500_000


@dataclass
class PipelineOutputs:
    """Table paths. ``readings`` holds Silver and quarantine, told apart by
    the partition column ``status``."""

    readings: str
    weather: str
    fact: str
    daily: str
    weather_daily: str
    fmt: str = "parquet"

    def silver(self, spark) -> DataFrame:
        return self._with_status(spark, "good").drop("reason")

    def quarantine(self, spark) -> DataFrame:
        return self._with_status(spark, "quarantine")

    def _with_status(self, spark, status: str) -> DataFrame:
        # a filter on the partition column prunes; no partition folder is read by path
        return spark.read.format(self.fmt).load(self.readings).filter(F.col("status") == status).drop("status")


def run_pipeline(
    readings: DataFrame,
    tariff_history: DataFrame,
    weather_history: DataFrame,
    weather_forecast: DataFrame | None,
    rates: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    quarantine: bool = True,
    zone: str = LOCAL_ZONE,
    date_zone: str | None = None,
    horizon=None,
    silver_partitioning: str = "month",
    locations: tuple[DataFrame, DataFrame] | None = None,
    window=None,
    dimensions: dict[str, DataFrame] | None = None,
) -> PipelineOutputs:
    """E1 + E2 with their sinks. The reconciled weather is written first
    (``weather_silver``); Silver joins it as written, by broadcast when its
    counted rows allow it, and Gold's daily weather reads it. Silver and its
    quarantine are written in one job and Gold reads the written Silver, so
    the lineage is cut at the lake tables.

    Silver and quarantine are one table, ``meter_readings``, partitioned by
    ``status`` (``good`` / ``quarantine``) first: written as two separate
    tables, the second write would re-run the whole dedupe from Bronze.
    Placing rows by range samples the plan once more before the write.

    ``silver_partitioning``: ``month`` (default; ``reading_month``
    directories, meter and instant as the in-file sort), ``date``
    (``reading_date``), or ``meter_id`` (the published layout: one directory
    per meter, a small-file storm for a large fleet). The fact is partitioned
    by ``reading_month`` and sorted by meter. ``window=(start, end)`` trims
    readings to the analysis window and bounds the as-of join's time buckets
    (see ``build_silver``). ``dimensions`` (name to table) are written beside
    the facts, one folder each."""
    spark = readings.sparkSession
    apply_recommended(spark)
    paths = PipelineOutputs(
        readings=f"{out_dir}/meter_readings",
        weather=f"{out_dir}/weather_silver",
        fact=f"{out_dir}/fact_meter_reading_gold",
        daily=f"{out_dir}/fact_daily_usage_gold",
        weather_daily=f"{out_dir}/weather_daily_gold",
        fmt=fmt,
    )
    for name, table in (dimensions or {}).items():
        write_table(table, f"{out_dir}/{name}", fmt)
    counted = Observation("weather_silver")
    reconciled = reconcile_weather(weather_history, weather_forecast)
    write_table(reconciled.observe(counted, F.count(F.lit(1)).alias("rows")), paths.weather, fmt)
    weather = read_table(spark, paths.weather, fmt, schema=reconciled.schema)
    s = build_silver(
        readings, tariff_history, weather, quarantine=quarantine, horizon=horizon, locations=locations, window=window,
        few_weather_days=counted.get["rows"] <= WEATHER_BROADCAST_ROWS,
    )
    part_cols = {
        "month": ("reading_month", month_key(F.col("reading_ts"))),
        "date": ("reading_date", date_key(F.col("reading_ts"))),
        "meter_id": ("meter_id", F.col("meter_id")),
    }
    if silver_partitioning not in part_cols:
        raise ValueError(f"silver_partitioning must be one of {sorted(part_cols)}")
    pcol, pexpr = part_cols[silver_partitioning]
    sort = ["reading_ts"] if pcol == "meter_id" else ["meter_id", "reading_ts"]
    both = readings_with_status(s)
    write_table(both.withColumn(pcol, pexpr), paths.readings, fmt, partition_by=["status", pcol], sort_within=sort)
    written = StructType([
        *[f for f in both.schema.fields if f.name not in ("status", pcol)],
        StructField("status", StringType()),
        both.schema[pcol] if pcol in both.columns else StructField(pcol, StringType()),
    ])
    silver = read_table(spark, paths.readings, fmt, schema=written).filter(F.col("status") == "good")
    gold = build_gold(silver, rates, zone=zone, date_zone=date_zone)
    month = month_key(F.col("reading_ts"))
    write_table(
        gold.fact.withColumn("reading_month", month), paths.fact, fmt, partition_by=["reading_month"],
        sort_within=["meter_id", "reading_ts"],
    )
    fact = read_table(
        spark, paths.fact, fmt, schema=StructType([*gold.fact.schema.fields, StructField("reading_month", StringType())])
    )
    write_table(daily_usage(fact), paths.daily, fmt)
    write_table(daily_weather(weather), paths.weather_daily, fmt)
    return paths


def readings_with_status(s: Silver) -> DataFrame:
    """Silver rows (``status='good'``) and quarantined rows
    (``status='quarantine'``, with ``reason``) as one DataFrame. Written in
    one job, both branches read the same dedupe shuffle (``ReusedExchange``)."""
    both = s.enriched.withColumn("status", F.lit("good"))
    if s.quarantine is not None:
        both = both.unionByName(s.quarantine.withColumn("status", F.lit("quarantine")), allowMissingColumns=True)
    return both
