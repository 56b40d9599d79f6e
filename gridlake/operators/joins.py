"""Joins: SCD2 as-of (J1), grain-aligning hourly (J2), time-of-use band.

Broadcast policy: only the rate table (one row per tariff period, a literal
dimension) is broadcast by hint. Tables that grow with the data (tariff
history grows with the fleet, weather with hours x locations) are left to
AQE, which broadcasts them only when their measured runtime size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the
sort-merge join, splitting a skewed (hot-meter) partition into several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.fixed import LOCAL_ZONE
from gridlake.functions.time import local_hour, trunc_hour

# An open-ended validity interval (NULL valid_to) ends here.
OPEN_END = "9999-12-30"


def _as_ntz_midnight(c):
    return F.to_date(c).cast("timestamp_ntz")


def resolve_as_of(
    readings: DataFrame,
    history: DataFrame,
    key: str = "meter_id",
    ts: str = "reading_ts",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    take: Sequence[str] = ("tariff_code",),
    inclusive_to: bool = True,
    horizon=None,
    bucket: str = "month",
    since=None,
) -> DataFrame:
    """Left as-of join of each reading to the history row valid at its
    instant: ``valid_from <= ts < valid_to (+1 day when inclusive)``.

    ``valid_from``/``valid_to`` are dates (or ISO date strings) in UTC; a NULL
    ``valid_to`` is open-ended. Unmatched readings keep NULL ``take`` columns.
    Overlapping history rows would duplicate a reading (as in the published
    code); ``scd2_from_changes`` never produces overlaps.

    With a ``horizon`` (a date or date Column; the end of the analysis
    window) the join key is (meter, time bucket) instead of the meter alone:
    each history row is expanded over the time buckets (``bucket``: month or day)
    its interval covers, clipped at the horizon's bucket, and a reading
    carries its own bucket clipped the same way, so the result is exactly
    the same for readings on either side of the horizon. A hot meter's
    readings are then spread over one join key per bucket, and because the
    key is new on both sides both get a fresh shuffle, so AQE's skew-join
    handling can split a still-oversized (meter, bucket) partition further.
    ``since`` (the analysis window start) clips the low end the same way,
    so a history row expands over at most the buckets of [since, horizon]
    (a contract open since years before the window still yields about 12
    rows for a one-year window, not one per month since it began); a
    reading before ``since`` lands in the ``since`` bucket, where every
    interval that could cover it is also present, so results stay exact.
    """
    end = F.coalesce(F.to_date(F.col(valid_to)), F.lit(OPEN_END).cast("date"))
    if inclusive_to:
        end = F.date_add(end, 1)
    start = F.to_date(F.col(valid_from))
    cols = [
        F.col(key).alias("_h_key"),
        start.cast("timestamp_ntz").alias("_h_from"),
        end.cast("timestamp_ntz").alias("_h_to"),
        *[F.col(c).alias(f"_h_{c}") for c in take],
    ]
    cond = (
        (F.col(key) == F.col("_h_key"))
        & (F.col(ts) >= F.col("_h_from"))
        & (F.col(ts) < F.col("_h_to"))
    )
    if horizon is not None:
        if bucket not in ("month", "day"):
            raise ValueError("bucket must be 'month' or 'day'")
        h = _bucket_of(_as_date(horizon), bucket)
        lo = _bucket_of(_as_date(since), bucket) if since is not None else None

        def clip(b):
            return F.least(F.greatest(b, lo) if lo is not None else b, h)

        first = clip(_bucket_of(start, bucket))
        last = F.greatest(clip(_bucket_of(F.date_sub(end, 1), bucket)), first)
        step = F.expr(f"INTERVAL 1 {bucket.upper()}")
        cols.append(F.explode(F.sequence(first, last, step)).alias("_h_bucket"))
        # The reading's bucket is a projected column (not an expression in
        # the join condition), so a horizon given as a scalar subquery is
        # evaluated in a projection, never inside a shuffle's partitioning.
        readings = readings.withColumn("_r_bucket", clip(_bucket_of(F.to_date(F.col(ts)), bucket)))
        cond = cond & (F.col("_r_bucket") == F.col("_h_bucket"))
    hist = history.select(*cols)
    joined = readings.join(hist, cond, "left")
    return joined.select(
        *[F.col(c) for c in readings.columns if c not in take and c != "_r_bucket"],
        *[F.col(f"_h_{c}").alias(c) for c in take],
    )


def resolve_as_of_carry(
    readings: DataFrame,
    history: DataFrame,
    key: str = "meter_id",
    ts: str = "reading_ts",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    take: Sequence[str] = ("tariff_code",),
    inclusive_to: bool = True,
    horizon=None,
    bucket: str = "month",
    since=None,
) -> DataFrame:
    """J1 without a join: the same result as ``resolve_as_of`` from one
    ordered stream.

    Readings and history rows are united and put in order per (meter, time
    bucket); the last history row so far is carried forward to each reading
    (``last`` that passes over nulls) and counts while its validity lasts. A
    history row enters every bucket it covers, at the bucket's start, so a
    bucket opens with the row valid then. One shuffle of the union takes the
    place of one for each side, and no reading meets more than one history
    row, whatever number of rows its meter's history has.

    At most one row of a meter may be valid at a time for that. Meters whose
    history overlaps itself, where the join gives a reading once per valid
    row, go through the join; there are none in a proper history, and finding
    them is one window over the history. ``horizon``, ``since`` and ``bucket``
    as for the join: a bucket is one task's group, a ``day`` keeps that of a
    hot meter small.
    """
    if bucket not in ("month", "day"):
        raise ValueError("bucket must be 'month' or 'day'")
    end = F.coalesce(F.to_date(F.col(valid_to)), F.lit(OPEN_END).cast("date"))
    spans = history.select(
        F.col(key).alias("_key"), F.to_date(F.col(valid_from)).alias("_from"),
        (F.date_add(end, 1) if inclusive_to else end).alias("_to"), F.struct(*take).alias("_take"),
    ).filter(F.col("_key").isNotNull() & (F.col("_from") < F.col("_to")))
    before = Window.partitionBy("_key").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    twice = spans.withColumn("_reach", F.max("_to").over(before)).filter(F.col("_reach") > F.col("_from")).select("_key").distinct()
    rest = None
    if not twice.isEmpty():
        tangled = twice.withColumnRenamed("_key", key)
        rest = resolve_as_of(
            readings.join(tangled, key, "left_semi").select(*readings.columns), history, key, ts, valid_from, valid_to,
            take, inclusive_to, horizon, bucket, since,
        )
        readings = readings.join(tangled, key, "left_anti").select(*readings.columns)
        spans = spans.join(twice, "_key", "left_anti")

    low = _bucket_of(_as_date(since), bucket) if since is not None else None
    high = _bucket_of(_as_date(horizon), bucket) if horizon is not None else None

    def clip(b):
        b = F.greatest(b, low) if low is not None else b
        return F.least(b, high) if high is not None else b

    first = clip(_bucket_of(F.col("_from"), bucket))
    last_day = F.date_sub("_to", 1)
    if horizon is None:  # an open end covers no bucket beyond the last reading's
        latest = readings.agg(F.max(F.to_date(F.col(ts))).alias("d")).first()["d"]
        last_day = F.least(last_day, F.lit(latest)) if latest else F.col("_from")
    last = F.greatest(clip(_bucket_of(last_day, bucket)), first)
    step = F.expr(f"INTERVAL 1 {bucket.upper()}")
    opened = spans.withColumn("_first", first).withColumn("_bucket", F.explode(F.sequence("_first", last, step)))
    # in its first bucket a row enters where it begins
    at = F.when(F.col("_bucket") == F.col("_first"), F.col("_from")).otherwise(F.col("_bucket")).cast("timestamp_ntz")
    carried = F.struct(F.col("_to").cast("timestamp_ntz").alias("to"), F.col("_take").alias("take")).alias("_open")
    entries = opened.select(F.col("_key"), F.col("_bucket"), at.alias("_at"), carried, F.lit(None).alias("_row"))
    rows = readings.select(
        F.col(key).alias("_key"), clip(_bucket_of(F.to_date(F.col(ts)), bucket)).alias("_bucket"), F.col(ts).alias("_at"),
        F.lit(None).alias("_open"), F.struct(*readings.columns).alias("_row"),
    )
    both = entries.unionByName(rows)
    # at one instant the history row comes first
    order = Window.partitionBy("_key", "_bucket").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_open", F.last("_open", ignorenulls=True).over(order)).filter(F.col("_row").isNotNull())
    valid = F.col("_at") < F.col("_open.to")
    out = found.select(
        *[F.col(f"_row.{c}").alias(c) for c in readings.columns if c not in take],
        *[F.when(valid, F.col(f"_open.take.{c}")).alias(c) for c in take],
    )
    return out if rest is None else out.unionByName(rest)


def _as_date(x):
    return F.lit(x).cast("date") if isinstance(x, str) else F.to_date(x)


def _bucket_of(d, bucket: str):
    return F.trunc(d, "month") if bucket == "month" else d


def join_hourly(
    readings: DataFrame,
    weather: DataFrame,
    ts: str = "reading_ts",
    weather_ts: str = "weather_ts",
    cols: Sequence[str] = ("temperature_2m", "relative_humidity_2m"),
    keys: Sequence[tuple[str, str]] = (),
    hour_col: str | None = None,
) -> DataFrame:
    """Left join each reading to the weather row of its hour.

    ``keys`` adds (reading column, weather column) pairs, e.g. location;
    without them the join is on the hour alone, as published (one row per
    location per hour then fans a reading out). ``hour_col`` names a column
    that already holds the reading's hour (saves recomputing it).
    """
    w = weather.select(
        F.col(weather_ts).alias("_w_hour"),
        *[F.col(wc).alias(f"_w_k{i}") for i, (_, wc) in enumerate(keys)],
        *[F.col(c).alias(f"_w_{c}") for c in cols],
    )
    hour = F.col(hour_col) if hour_col else trunc_hour(F.col(ts))
    cond = hour == F.col("_w_hour")
    for i, (rc, _) in enumerate(keys):
        cond = cond & (F.col(rc) == F.col(f"_w_k{i}"))
    joined = readings.join(w, cond, "left")
    return joined.select(
        *[F.col(c) for c in readings.columns if c not in cols],
        *[F.col(f"_w_{c}").alias(c) for c in cols],
    )


def hour_table(
    weather: DataFrame, ts: str = "weather_ts", cols: Sequence[str] = ("temperature_2m", "relative_humidity_2m"),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Weather as one row per UTC day (and ``keys``, a site): ``_hours``, an
    array of 24 slots, each the array of the hour's rows (one, where the
    weather is reconciled and keyed by site; none in a gap)."""
    day, hour = F.to_date(F.col(ts)).alias("_day"), F.hour(F.col(ts)).alias("_hour")
    slots = weather.filter(F.col(ts).isNotNull()).groupBy(day, hour, *keys).agg(F.collect_list(F.struct(*cols)).alias("_rows"))
    filled = [F.first(F.when(F.col("_hour") == h, F.col("_rows")), ignorenulls=True).alias(f"_{h}") for h in range(24)]
    return slots.groupBy("_day", *keys).agg(*filled).select("_day", *keys, F.array(*[f"_{h}" for h in range(24)]).alias("_hours"))


def join_hour_table(
    readings: DataFrame, hours: DataFrame, ts: str = "reading_ts",
    cols: Sequence[str] = ("temperature_2m", "relative_humidity_2m"), keys: Sequence[tuple[str, str]] = (),
    few_days: bool = False,
) -> DataFrame:
    """J2 by the day: each reading meets its UTC day's row of ``hour_table``
    and takes its hour's slot by position; the same rows as ``join_hourly``.

    A year is 366 rows per site instead of 8,760, so the table is small where
    the readings are many. ``few_days`` says that the caller has bounded its
    rows (the days of a window, times the sites): it is then broadcast, and no
    reading is moved. Otherwise AQE decides on its measured size."""
    table = hours.select(
        F.col("_day").alias("_w_day"), *[F.col(wc).alias(f"_w_k{i}") for i, (_, wc) in enumerate(keys)], "_hours"
    )
    cond = F.to_date(F.col(ts)) == F.col("_w_day")
    for i, (rc, _) in enumerate(keys):
        cond = cond & (F.col(rc) == F.col(f"_w_k{i}"))
    met = readings.join(F.broadcast(table) if few_days else table, cond, "left")
    slot = F.get("_hours", F.hour(F.col(ts)))
    kept = [c for c in readings.columns if c not in cols]
    return met.select(*kept, F.explode_outer(slot).alias("_w")).select(*kept, *[F.col(f"_w.{c}").alias(c) for c in cols])


def with_location(
    readings: DataFrame, meters: DataFrame, locations: DataFrame, key: str = "meter_id"
) -> DataFrame:
    """Attach each reading's ``latitude``/``longitude`` through the meter
    dimension (``location_id``) and the location dimension, for the
    location-aware weather join (``join_hourly(..., keys=[("latitude",
    "latitude"), ("longitude", "longitude")])``). Left joins: a meter missing
    from the dimensions keeps its readings with NULL coordinates. Both
    dimensions are sized by the fleet and the sites, not by the readings;
    AQE decides whether to broadcast them."""
    loc = meters.select(key, "location_id").join(
        locations.select("location_id", "latitude", "longitude"), "location_id", "left"
    )
    return readings.join(loc.drop("location_id"), key, "left")


def rate_join(
    readings: DataFrame,
    rates: DataFrame,
    ts: str = "reading_ts",
    zone: str = LOCAL_ZONE,
    broadcast_rates: bool = True,
) -> DataFrame:
    """Inner join on tariff_code with the local hour inside
    ``[start_hour, end_hour)``. A NULL or unknown tariff, or an hour no window
    covers, drops the reading. The band is part of the join condition (a
    residual of the hash join), so no row is multiplied then filtered.

    ``rates`` is a dimension with one row per tariff period; it is broadcast
    by hint because its size is bounded by the tariff catalogue, not by data.
    """
    r = rates.select(
        F.col("tariff_code").alias("_r_code"),
        "period_name",
        "start_hour",
        "end_hour",
        "unit_rate",
    )
    if broadcast_rates:
        r = F.broadcast(r)
    lh = readings.withColumn("local_hour", local_hour(F.col(ts), zone))
    cond = (
        (F.col("tariff_code") == F.col("_r_code"))
        & (F.col("local_hour") >= F.col("start_hour"))
        & (F.col("local_hour") < F.col("end_hour"))
    )
    return lh.join(r, cond, "inner").drop("_r_code")
