"""Registered queries over the driver's tables: each takes (spark, sf_dir)
and returns a lazy DataFrame (the I/O and stream queries run their writes
first, into the shared checkpoint folder, and return the read-back). The
matching DuckDB SQL lives in ``gridlake.plans.oracle``; column names are
identical on both sides."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlake import schemas
from gridlake.fixed import LOCAL_ZONE
from gridlake.functions.scalar import exact_sum
from gridlake.functions.time import date_key, iso_minute, to_utc_ntz, trunc_hour
from gridlake.operators import analytics as an
from gridlake.operators import quality as qa
from gridlake.operators.aggregates import daily_usage, daily_weather
from gridlake.operators.cleanse import fault_rows, null_sentinel, split_quarantine, trim_window
from gridlake.operators.dedupe import dedupe_latest
from gridlake.operators.dims import (
    coverage as coverage_op,
    dim_customer,
    dim_date,
    dim_location,
    dim_meter,
    dim_tariff,
    dim_tariff_rate,
    merge_scd2,
    read_scd2,
)
from gridlake.operators.distinct import rollup_state
from gridlake.operators.joins import resolve_as_of, resolve_as_of_carry
from gridlake.plans import driver_tables as dt
from gridlake.plans.pipeline import build_gold, build_silver, reconcile_weather, run_pipeline, type_instant
from gridlake.session import cut_lineage, ensure_checkpoint_dir
from gridlake.sources.bronze import land_by_day, read_days
from gridlake.sources.bucketed import Buckets, place, write_bucketed
from gridlake.sources.readers import payload_rows, read_csv, read_jsonl, read_table
from gridlake.sources.sinks import (
    LoadSpec,
    from_event_payload,
    load_tables,
    to_event_payload,
    write_csv,
    write_jsonl,
    write_table,
)
from gridlake.streaming.ingest import append_bronze, publish, read_events, upsert_latest
from gridlake.streaming.latest import bronze_events, read_latest, upsert_by_state

# -- building blocks ---------------------------------------------------------


def weather(spark: SparkSession, d: str) -> DataFrame:
    return reconcile_weather(dt.weather_history(spark, d), dt.weather_forecast(spark, d))


def latest(spark: SparkSession, d: str) -> DataFrame:
    return dedupe_latest(type_instant(dt.readings(spark, d), "reading_ts"))


def nulled(spark: SparkSession, d: str) -> DataFrame:
    return null_sentinel(latest(spark, d))


def silver(spark: SparkSession, d: str, quarantine: bool = True, bounds=None, with_weather: bool = True):
    bounds = bounds or dt.window_bounds(spark, d)
    return build_silver(
        dt.readings(spark, d), dt.tariff_history(spark, d, with_key=False, bounds=bounds),
        weather(spark, d) if with_weather else None, quarantine=quarantine, window=bounds,
        few_weather_days=True,  # one site: a row per day of the window
    )


def gold(spark: SparkSession, d: str, bounds=None, quarantine: bool = True, date_zone: str | None = None):
    """Gold keeps no weather column, so its Silver is built without."""
    tariffed = silver(spark, d, quarantine, bounds, with_weather=False).enriched
    return build_gold(tariffed, dim_tariff_rate(spark), date_zone=date_zone)


def meters(spark: SparkSession, d: str) -> DataFrame:
    return dim_meter(dt.customers(spark, d))


def meter_day(spark: SparkSession, d: str) -> DataFrame:
    return an.meter_day(gold(spark, d).daily)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- Silver --------------------------------------------------------------------


def q_dedupe_latest(spark, d):
    return latest(spark, d)


def q_bronze_text_typing(spark, d):
    """P1/F2 + W1 on the wire format: the feed spelled as ISO text with
    mixed offsets (UTC and Oslo local), typed back to UTC and de-duplicated;
    copies of one instant under different spellings collapse."""
    return dedupe_latest(type_instant(dt.readings_text(spark, d), "reading_ts"))


def q_null_sentinel(spark, d):
    return nulled(spark, d)


def q_fault_rows(spark, d):
    return fault_rows(nulled(spark, d))


def q_quarantine_split(spark, d):
    good, bad = split_quarantine(nulled(spark, d))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


def q_weather_reconciled(spark, d):
    return weather(spark, d)


def q_readings_with_tariff(spark, d):
    good, _ = split_quarantine(nulled(spark, d))
    bounds = dt.window_bounds(spark, d)
    hist = dt.tariff_history(spark, d, with_key=False, bounds=bounds)
    return resolve_as_of(good, hist, horizon=bounds[1], since=bounds[0])


def q_readings_with_tariff_carry(spark, d):
    """J1 by union and carry: the same rows as the join's."""
    good, _ = split_quarantine(nulled(spark, d))
    bounds = dt.window_bounds(spark, d)
    hist = dt.tariff_history(spark, d, with_key=False, bounds=bounds)
    return resolve_as_of_carry(good, hist, horizon=bounds[1], since=bounds[0])


def q_readings_with_weather(spark, d):
    return silver(spark, d).enriched


def q_window_trim(spark, d):
    first, last = dt.window_bounds(spark, d)
    # trimmed before the dedupe: the range reaches the scan, and both copies of
    # an instant are on the same day
    typed = type_instant(dt.readings(spark, d), "reading_ts")
    return dedupe_latest(trim_window(typed, F.date_add(first, 1), F.date_sub(last, 1)))


# -- Gold ----------------------------------------------------------------------


def q_cost_fact(spark, d):
    return gold(spark, d).fact


def q_daily_cost(spark, d):
    """Flagship: daily kWh, cost and mean voltage per meter, day and tariff."""
    return gold(spark, d).daily


def q_daily_cost_local_date(spark, d):
    """Billed on the local day instead of the UTC day."""
    return gold(spark, d, date_zone=LOCAL_ZONE).daily


def q_daily_cost_unquarantined(spark, d):
    """The published code path: the sentinel nulled, faulty rows kept."""
    return gold(spark, d, quarantine=False).daily


def q_weather_daily(spark, d):
    return daily_weather(weather(spark, d))


# -- dimensions ------------------------------------------------------------------


def q_scd2_history(spark, d):
    return dt.tariff_history(spark, d)


def q_scd2_incremental(spark, d):
    """D2 by increments: the change log merged in three batches that do not
    follow the calendar (late changes split closed intervals); the same rows
    as ``scd2_history``, without its running number."""
    bounds = dt.window_bounds(spark, d)
    root = f"{_scratch(spark, 'scd2')}/history"
    changes = dt.tariff_changes(spark, d)
    for i in range(3):
        merge_scd2(spark, root, changes.filter(F.pmod(F.dayofmonth("change_date") + 1, F.lit(3)) == i), bounds[1])
    return read_scd2(spark, root, bounds[1]).select("meter_id", "tariff_code", "valid_from", "valid_to", "is_current")


def q_calendar_dim(spark, d):
    first, last = dt.window_bounds(spark, d)
    return dim_date(spark, first, last)


def q_meter_dim(spark, d):
    return meters(spark, d)


def q_customer_dim(spark, d):
    return dim_customer(dt.customers(spark, d))


def q_coverage(spark, d):
    """The whole registered fleet: silent meters are what coverage looks for."""
    first, last = dt.window_bounds(spark, d)
    return coverage_op(latest(spark, d), meters(spark, d).select("meter_id"), first, last, slots_per_day=24)


# -- quality -----------------------------------------------------------------------


def q_value_frequencies(spark, d):
    return qa.value_frequencies(dt.readings(spark, d), "quality")


def q_top_meters(spark, d):
    """A3/L2: the ten meters with most readings, by heavy hitters."""
    return qa.top_values(dt.readings(spark, d), "meter_id", 10)


def q_load_curve(spark, d):
    return qa.load_curve(latest(spark, d))


def q_table_counts(spark, d):
    return qa.table_counts(dt.readings(spark, d))


def q_head_rows(spark, d):
    return qa.head_rows(latest(spark, d), 10, ["reading_ts", "meter_id"])


def q_table_profile(spark, d):
    return qa.profile(
        nulled(spark, d),
        ["reading_ts", "interval_kwh", "voltage", "quality"],
    )


# -- analytics -------------------------------------------------------------------------


def q_usage_mtd(spark, d):
    return an.period_to_date(meter_day(spark, d), "month")


def q_usage_ytd(spark, d):
    return an.period_to_date(meter_day(spark, d), "year")


def q_usage_qtd(spark, d):
    return an.period_to_date(meter_day(spark, d), "quarter")


def q_usage_rolling7(spark, d):
    return an.rolling_days(meter_day(spark, d), 7)


def q_tariff_what_if(spark, d):
    return an.simulate_tariff(gold(spark, d).fact)


def q_temp_elasticity(spark, d):
    wd = daily_weather(weather(spark, d))
    return an.elasticity(meter_day(spark, d), wd, meters(spark, d))


def q_fault_tree(spark, d):
    return an.fault_tree(latest(spark, d), meters(spark, d))


def q_fault_tree_meters(spark, d):
    """B6 with the distinct meters of every node."""
    return an.fault_tree(latest(spark, d), meters(spark, d), with_meters=True)


def q_usage_tree(spark, d):
    """B11 at every subtotal of region, nation and season, distinct meters too."""
    return an.usage_tree(star(spark, d), ["r_name", "n_name", "season"])


def q_active_meters(spark, d):
    """Reporting meters per day, month and in all: the daily state is written
    as a nightly load would leave it, and the spans are united from it."""
    path = _scratch(spark, "active")
    state = an.daily_meters(latest(spark, d))
    write_table(state, path, partition_by=["month"], sort_within=["date_key"])
    kept = read_table(spark, path, schema=state.schema)
    return rollup_state(kept, ["month", "date_key"], "meters", ["readings"])


def q_usage_anomalies(spark, d):
    return an.anomalies(meter_day(spark, d), 7, 3.0)


def q_meter_profile(spark, d):
    """Both halves, all readings and the billed days, from one Silver, which
    is written once: one scan of the readings and one dedupe."""
    first, last = dt.window_bounds(spark, d)
    base = cut_lineage(trim_window(nulled(spark, d), first, last, keep_unparsed=True))
    good, _ = split_quarantine(base)
    hist = dt.tariff_history(spark, d, with_key=False, bounds=(first, last))
    tariffed = resolve_as_of(good, hist, horizon=last, since=first).withColumn("hour_ts", trunc_hour("reading_ts"))
    return an.meter_profile(base, an.meter_day(build_gold(tariffed, dim_tariff_rate(spark)).daily))


def star(spark: SparkSession, d: str) -> DataFrame:
    """Daily usage joined to the conformed dimensions."""
    first, last = bounds = dt.window_bounds(spark, d)
    daily = daily_usage(gold(spark, d, bounds).fact, carry=True)
    # the fleet's dimensions as one side, joined before they meet the usage
    place = (
        dt.customers(spark, d).select("customer_id", "meter_id", "c_nationkey", "c_mktsegment")
        .join(dt.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(dt.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    cal = dim_date(spark, first, last).select(
        F.col("date").alias("date_key"), "is_weekend", "season", "day_of_week"
    )
    # a literal table, and a row per day of the window: both bounded
    return (
        daily.join(F.broadcast(dim_tariff(spark).select("tariff_code", "tariff_name")), "tariff_code")
        .join(F.broadcast(cal), "date_key").join(place, "meter_id")
    )


def q_star_usage(spark, d):
    return star(spark, d).groupBy("r_name", "tariff_name", "is_weekend").agg(
        F.round(exact_sum("kwh").cast("double"), 4).alias("kwh"),
        F.round(exact_sum("cost").cast("double"), 6).alias("cost"),
        F.count_distinct("meter_id").alias("meters"),
    )


def _usage_by(metric: str):
    return lambda spark, d: an.usage_by(star(spark, d), metric, ["n_name", "season"])


def q_entitled_rows(spark, d):
    grants = dt.customers(spark, d).filter(F.col("c_mktsegment") == "BUILDING").select("meter_id")
    return an.entitled(gold(spark, d).daily, grants)


def q_entitled_user(spark, d):
    """B9 for one user: an account manager (a nation's key) sees the meters of
    that nation."""
    grants = dt.customers(spark, d).select(F.col("c_nationkey").alias("user_id"), "meter_id")
    return an.entitled(gold(spark, d).daily, grants, user=3)


def q_weather_two_sites(spark, d):
    """J2 with two sites: each reading meets the weather of its own meter's
    site (odd meters: the second site, where it is 5 degrees warmer)."""
    sites = spark.sql("SELECT 1 AS location_id, 59.91D AS latitude, 10.75D AS longitude UNION ALL SELECT 2, 60.39D, 5.32D")
    here = weather(spark, d)
    there = here.select(
        "weather_ts", (F.col("temperature_2m") + 5).alias("temperature_2m"), "relative_humidity_2m",
        F.lit(60.39).alias("latitude"), F.lit(5.32).alias("longitude"),
    )
    both = here.select(*there.columns).union(there)
    placed = meters(spark, d).withColumn("location_id", (F.pmod("meter_id", F.lit(2)) + 1).cast("int"))
    bounds = dt.window_bounds(spark, d)
    return build_silver(
        dt.readings(spark, d), dt.tariff_history(spark, d, with_key=False, bounds=bounds), both, window=bounds,
        locations=(placed, sites),
    ).enriched


# -- Bronze by day, tables in buckets ---------------------------------------------------


def text_bronze(spark: SparkSession, d: str) -> tuple[str, StructType]:
    """The wire-format feed landed by reading day: its folder and schema."""
    feed = dt.readings_text(spark, d)
    path = _scratch(spark, "bronze-days")
    land_by_day(feed, path)
    return path, feed.schema


def q_daily_cost_bronze(spark, d):
    """B1: the batch build of the window but its first and last day, from
    text Bronze; the other days' folders are not read."""
    bounds = dt.window_bounds(spark, d)
    path, schema = text_bronze(spark, d)
    window = F.date_add(bounds[0], 1), F.date_sub(bounds[1], 1)
    feed = read_days(spark, path, schema, *window)
    hist = dt.tariff_history(spark, d, with_key=False, bounds=bounds)
    s = build_silver(feed, hist, None, window=window)
    return build_gold(s.enriched, dim_tariff_rate(spark)).daily


def q_weekend_cost(spark, d):
    """B1 by the calendar: only the weekends' folders of text Bronze are read."""
    bounds = dt.window_bounds(spark, d)
    path, schema = text_bronze(spark, d)
    weekends = dim_date(spark, *bounds).filter("day_of_week >= 6").select("date")
    feed = read_days(spark, path, schema, days=weekends)
    hist = dt.tariff_history(spark, d, with_key=False, bounds=bounds)
    s = build_silver(feed, hist, None, window=bounds)
    return build_gold(s.enriched, dim_tariff_rate(spark)).daily


def bucketed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """K2: de-duplicated readings (the sentinel nulled, faults kept) and the
    tariff history as tables bucketed by meter. The readings move once: the
    dedupe runs where their bucket is written."""
    run = uuid.uuid4().hex
    by_meter = Buckets(int(spark.conf.get("spark.sql.shuffle.partitions")), sort=("meter_id", "reading_ts"))
    feed = place(type_instant(dt.readings(spark, d), "reading_ts"), by_meter)
    silver_rows = write_bucketed(
        null_sentinel(dedupe_latest(feed)), f"silver_{run}", f"{_scratch(spark, 'silver-buckets')}", by_meter, placed=True
    )
    hist = write_bucketed(
        dt.tariff_history(spark, d, with_key=False), f"history_{run}", f"{_scratch(spark, 'history-buckets')}",
        Buckets(by_meter.count, sort=("meter_id", "valid_from")),
    )
    return silver_rows, hist


def bucketed_daily(spark: SparkSession, readings: DataFrame, hist: DataFrame) -> DataFrame:
    """Daily usage from bucketed tables: joined by meter alone, as they are
    laid out, so neither the join nor the sums by meter and day move a row."""
    good, _ = split_quarantine(readings)
    tariffed = resolve_as_of(good, hist).withColumn("hour_ts", trunc_hour("reading_ts"))
    return build_gold(tariffed, dim_tariff_rate(spark)).daily


def q_bucketed_daily_cost(spark, d):
    return bucketed_daily(spark, *bucketed(spark, d))


def q_bucketed_rolling7(spark, d):
    return an.rolling_days(an.meter_day(bucketed_daily(spark, *bucketed(spark, d))), 7)


def q_bucketed_profile(spark, d):
    readings, hist = bucketed(spark, d)
    return an.meter_profile(readings, an.meter_day(bucketed_daily(spark, readings, hist)))


# -- I/O and streaming ---------------------------------------------------------------------


def q_json_payload_roundtrip(spark, d):
    lt = latest(spark, d)
    return from_event_payload(to_event_payload(lt), lt.schema)


def q_weather_payload_rows(spark, d):
    """The reconciled weather re-shaped as one parallel-array payload per
    UTC day (24 entries at most, so each group is bounded), encoded to JSON,
    decoded with the payload schema and exploded back to hourly rows."""
    w = weather(spark, d).withColumn("_day", date_key("weather_ts"))
    hourly_struct = F.struct(
        iso_minute("weather_ts").alias("time"),
        *[
            (F.col(v) if v in w.columns else F.lit(None).cast("double")).alias(v)
            for v in schemas.WEATHER_PAYLOAD["hourly"].dataType.names[1:]
        ],
    )
    per_day = w.groupBy("_day", "latitude", "longitude").agg(
        F.array_sort(F.collect_list(hourly_struct)).alias("_rows")
    )
    names = schemas.WEATHER_PAYLOAD["hourly"].dataType.names
    payload = per_day.select(
        "latitude",
        "longitude",
        F.to_json(
            F.struct(F.struct(*[F.col(f"_rows.{n}").alias(n) for n in names]).alias("hourly"))
        ).alias("json"),
    )
    decoded = payload.select(
        "latitude", "longitude", F.from_json("json", schemas.WEATHER_PAYLOAD).alias("payload")
    )
    rows = payload_rows(decoded)
    return rows.withColumn("weather_ts", to_utc_ntz(F.col("weather_ts")))


def q_csv_roundtrip(spark, d):
    """S3/K3: latest readings written as CSV with a header and read back with
    the declared schema."""
    lt = latest(spark, d)
    path = _scratch(spark, "csv")
    write_csv(lt, path)
    return read_csv(spark, path, lt.schema)


def q_partitioned_roundtrip(spark, d):
    """Silver written partitioned by reading date (overwrite, sorted
    by meter within files), read back through the lake-table scan."""
    s = silver(spark, d).enriched.withColumn("reading_date", date_key("reading_ts"))
    path = _scratch(spark, "silver")
    write_table(s, path, partition_by=["reading_date"], sort_within=["meter_id", "reading_ts"])
    return read_table(spark, path, "parquet", schema=s.schema).drop("reading_date")


def q_jsonl_roundtrip(spark, d):
    """Latest readings written as JSON lines and read back with the
    declared schema (malformed lines would be kept in ``_corrupt_record``)."""
    lt = latest(spark, d)
    path = _scratch(spark, "jsonl")
    write_jsonl(lt, path)
    return read_jsonl(spark, path, lt.schema).drop("_corrupt_record")


def _bronze_specs(spark, d, root: str) -> list[LoadSpec]:
    """Readings, weather and the seven dimension tables."""
    bounds = dt.window_bounds(spark, d)
    tables = {
        "meter_readings": lambda s: dt.readings(s, d),
        "weather_history": lambda s: dt.weather_history(s, d),
        "weather_forecast": lambda s: dt.weather_forecast(s, d),
        "dim_date": lambda s: dim_date(s, *bounds),
        "dim_meter": lambda s: meters(s, d),
        "dim_customer": lambda s: dim_customer(dt.customers(s, d)),
        "dim_location": dim_location,
        "dim_tariff": dim_tariff,
        "dim_tariff_rate": dim_tariff_rate,
        "dim_meter_tariff": lambda s: dt.tariff_history(s, d, bounds=bounds),
    }
    return [LoadSpec(name, read, f"{root}/{name}") for name, read in tables.items()]


def q_bronze_load_counts(spark, d):
    """K6: the multi-table Bronze load; row counts come from an Observation
    taken during each write (no second pass). The result is one row per
    loaded table."""
    counts = load_tables(spark, _bronze_specs(spark, d, _scratch(spark, "bronze")))
    return spark.createDataFrame(sorted(counts.items()), "table_name string, row_count long")


def q_bronze_load_content(spark, d):
    """K6: the loaded tariff history, meters and customers read back and
    joined, so that content is compared and not counts alone."""
    root = _scratch(spark, "bronze-content")
    load_tables(spark, _bronze_specs(spark, d, root))
    read = lambda name: read_table(spark, f"{root}/{name}")
    return (
        read("dim_meter_tariff").join(read("dim_meter"), "meter_id").join(read("dim_customer"), "customer_id")
        .join(read("dim_tariff"), "tariff_code")
        .select("meter_id", "customer_id", "tariff_code", "tariff_name", "valid_from", "valid_to", "is_current", "meter_model", "occupants")
    )


def q_pipeline_run(spark, d):
    """E1 + E2 end to end with their sinks (Silver, quarantine, fact, daily,
    weather daily written to the shared folder); returns the daily table as
    read back from the lake."""
    root = _scratch(spark, "lake")
    bounds = dt.window_bounds(spark, d)
    paths = run_pipeline(
        dt.readings(spark, d),
        dt.tariff_history(spark, d, with_key=False, bounds=bounds),
        dt.weather_history(spark, d),
        dt.weather_forecast(spark, d),
        dim_tariff_rate(spark),
        root,
        window=bounds,
    )
    return spark.read.parquet(paths.daily)


#: Bytes of event files that a micro-batch takes.
TRIGGER_BYTES = 256 << 20


def q_stream_ingest_latest(spark, d):
    """Readings replayed as JSON event files (ISO text instants with
    mixed offsets, one drop per ISO week, in ingest order), streamed in
    micro-batches bounded by bytes, landed in Bronze and upserted latest-wins
    into Silver by their position in the source; returns Silver as read back."""
    root = _scratch(spark, "stream")
    slot = to_utc_ntz(F.col("reading_ts"))
    src = dt.readings_text(spark, d).withColumnRenamed("_ingested_at", "seq").withColumn(
        "drop", F.concat_ws("-", F.year(slot), F.lpad(F.weekofyear(slot).cast("string"), 2, "0"))
    )
    publish(src, f"{root}/src", drop_col="drop", order=["seq"])
    events = read_events(spark, f"{root}/src", src.schema, bytes_per_trigger=TRIGGER_BYTES)
    q = upsert_latest(
        events.drop("drop"), bronze=f"{root}/bronze", silver=f"{root}/silver", checkpoint=f"{root}/_checkpoint"
    )
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/silver")
    return out.select(
        "meter_id", "customer_id", "reading_ts", "interval_kwh", "voltage", "quality",
        F.col("seq").alias("_ingested_at"),
    )


def q_stream_latest_by_state(spark, d):
    """T2 + T3 by state: the same feed as ``stream_ingest_latest``, appended to
    Bronze by one stream and taken from there by a second, which keeps the
    newest copy per key in its state and logs changes; returns the newest rows
    of the log."""
    root = _scratch(spark, "stream-state")
    slot = to_utc_ntz(F.col("reading_ts"))
    src = dt.readings_text(spark, d).withColumnRenamed("_ingested_at", "seq").withColumn(
        "drop", F.concat_ws("-", F.year(slot), F.lpad(F.weekofyear(slot).cast("string"), 2, "0"))
    )
    publish(src, f"{root}/src", drop_col="drop", order=["seq"])
    events = read_events(spark, f"{root}/src", src.schema, bytes_per_trigger=TRIGGER_BYTES)
    append_bronze(events.drop("drop"), f"{root}/bronze", f"{root}/_bronze").awaitTermination()
    bronze = bronze_events(spark, f"{root}/bronze", TRIGGER_BYTES)
    upsert_by_state(bronze, f"{root}/silver", f"{root}/_silver").awaitTermination()
    return read_latest(spark, f"{root}/silver").select(
        "meter_id", "customer_id", "reading_ts", "interval_kwh", "voltage", "quality",
        F.col("seq").alias("_ingested_at"),
    )


def q_stream_bronze_append(spark, d):
    """The wire-format feed (ISO text instants) replayed as JSON files
    and appended to Bronze by a file stream (raw rows, plus ingest time and
    source position); returns Bronze as read back, instants typed, the ingest
    time left out (it is the processing time of the micro-batch)."""
    root = _scratch(spark, "bronze-stream")
    src = dt.readings_text(spark, d).withColumnRenamed("_ingested_at", "seq")
    publish(src, f"{root}/src")
    events = read_events(spark, f"{root}/src", src.schema, bytes_per_trigger=TRIGGER_BYTES)
    append_bronze(events, f"{root}/bronze", f"{root}/_checkpoint").awaitTermination()
    bronze = type_instant(spark.read.parquet(f"{root}/bronze"), "reading_ts")
    return bronze.select(
        "meter_id", "customer_id", "reading_ts", "interval_kwh", "voltage", "quality",
        F.col("seq").alias("_ingested_at"),
    )


QUERIES = {
    "dedupe_latest": q_dedupe_latest,
    "bronze_text_typing": q_bronze_text_typing,
    "null_sentinel": q_null_sentinel,
    "fault_rows": q_fault_rows,
    "quarantine_split": q_quarantine_split,
    "weather_reconciled": q_weather_reconciled,
    "readings_with_tariff": q_readings_with_tariff,
    "readings_with_tariff_carry": q_readings_with_tariff_carry,
    "readings_with_weather": q_readings_with_weather,
    "window_trim": q_window_trim,
    "cost_fact": q_cost_fact,
    "daily_cost": q_daily_cost,
    "weather_daily": q_weather_daily,
    "scd2_history": q_scd2_history,
    "scd2_incremental": q_scd2_incremental,
    "calendar_dim": q_calendar_dim,
    "meter_dim": q_meter_dim,
    "customer_dim": q_customer_dim,
    "coverage": q_coverage,
    "value_frequencies": q_value_frequencies,
    "top_meters": q_top_meters,
    "load_curve": q_load_curve,
    "table_counts": q_table_counts,
    "head_rows": q_head_rows,
    "table_profile": q_table_profile,
    "usage_mtd": q_usage_mtd,
    "usage_ytd": q_usage_ytd,
    "usage_qtd": q_usage_qtd,
    "usage_rolling7": q_usage_rolling7,
    "tariff_what_if": q_tariff_what_if,
    "temp_elasticity": q_temp_elasticity,
    "fault_tree": q_fault_tree,
    "fault_tree_meters": q_fault_tree_meters,
    "usage_tree": q_usage_tree,
    "active_meters": q_active_meters,
    "usage_anomalies": q_usage_anomalies,
    "meter_profile": q_meter_profile,
    "star_usage": q_star_usage,
    "usage_by_dim": _usage_by("cost"),
    "usage_by_kwh": _usage_by("kwh"),
    "usage_by_voltage": _usage_by("avg_voltage"),
    "usage_by_meter_days": _usage_by("meter_days"),
    "usage_by_meters": _usage_by("meters"),
    "entitled_rows": q_entitled_rows,
    "entitled_user": q_entitled_user,
    "weather_two_sites": q_weather_two_sites,
    "daily_cost_local_date": q_daily_cost_local_date,
    "daily_cost_unquarantined": q_daily_cost_unquarantined,
    "json_payload_roundtrip": q_json_payload_roundtrip,
    "weather_payload_rows": q_weather_payload_rows,
    "csv_roundtrip": q_csv_roundtrip,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "daily_cost_bronze": q_daily_cost_bronze,
    "weekend_cost": q_weekend_cost,
    "bucketed_daily_cost": q_bucketed_daily_cost,
    "bucketed_rolling7": q_bucketed_rolling7,
    "bucketed_profile": q_bucketed_profile,
    "stream_ingest_latest": q_stream_ingest_latest,
    "stream_latest_by_state": q_stream_latest_by_state,
    "stream_bronze_append": q_stream_bronze_append,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "bronze_load_counts": q_bronze_load_counts,
    "bronze_load_content": q_bronze_load_content,
    "pipeline_run": q_pipeline_run,
}

# Back-compat name used by entry().
daily_cost = q_daily_cost
