"""Report analytics over Gold (B3-B11). The report formulas are not
published; these definitions are ours (see README)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.scalar import exact_mean, exact_sum, is_fault
from gridlake.functions.time import date_key, day_number, month_key
from gridlake.operators.distinct import distinct_state, rollup_state


#: Decimal places a metric is reported with (others: 6).
SCALES = {"kwh": 4, "cost": 6}


def _rounded_sum(value: str, window=None):
    return F.round(exact_sum(value, window=window).cast("double"), SCALES.get(value, 6))


def meter_day(daily: DataFrame) -> DataFrame:
    """Daily usage summed over tariffs: one row per (meter_id, date_key)."""
    return daily.groupBy("meter_id", "date_key").agg(
        _rounded_sum("kwh").alias("kwh"), _rounded_sum("cost").alias("cost")
    )


PERIODS = {"month": "mtd", "quarter": "qtd", "year": "ytd"}


def period_to_date(md: DataFrame, period: str = "month", value: str = "kwh") -> DataFrame:
    """Running total within the meter's calendar month, quarter or year
    (column ``mtd_<value>`` / ``qtd_<value>`` / ``ytd_<value>``)."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {sorted(PERIODS)}")
    bucket = F.trunc(F.to_date("date_key"), period)
    w = (
        Window.partitionBy("meter_id", bucket.alias("_p"))
        .orderBy("date_key")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return md.select(
        "meter_id", "date_key", value, _rounded_sum(value, w).alias(f"{PERIODS[period]}_{value}")
    )


def rolling_days(md: DataFrame, days: int = 7, value: str = "kwh") -> DataFrame:
    """Sum over the last ``days`` calendar days (gap tolerant: a frame
    over the day number, not over rows)."""
    w = (
        Window.partitionBy("meter_id")
        .orderBy(day_number("date_key"))
        .rangeBetween(-(days - 1), 0)
    )
    return md.select(
        "meter_id", "date_key", value, _rounded_sum(value, w).alias(f"rolling{days}_{value}")
    )


def simulate_tariff(fact: DataFrame, pct_changes: Sequence[str] = ("-0.1", "0.0", "0.1")) -> DataFrame:
    """Revenue per tariff under unit-rate changes of ``pct_changes``
    (decimal strings): the fact's costs, summed exactly, times the change.

    The fact is aggregated first (partial aggregation, one row per tariff);
    the scenarios are then generated on those few rows, so the scenario count
    never multiplies the fact."""
    base = fact.filter(F.col("tariff_code").isNotNull()).groupBy("tariff_code").agg(
        exact_sum("cost", 6).cast("decimal(30,6)").alias("_raw"), F.count(F.lit(1)).alias("readings")
    )
    scen = base.withColumn("_p", F.explode(F.array(*[F.lit(p).cast("decimal(6,4)") for p in pct_changes])))
    return scen.select(
        "tariff_code",
        F.col("_p").cast("double").alias("pct_change"),
        "readings",
        F.col("_raw").cast("double").alias("baseline_cost"),
        F.round(F.col("_raw") + F.col("_raw") * F.col("_p"), 6).cast("double").alias("scenario_cost"),
        F.round(F.col("_raw") * F.col("_p"), 6).cast("double").alias("difference"),
    )


def elasticity(md: DataFrame, weather_daily: DataFrame, meters: DataFrame, group: str = "has_solar") -> DataFrame:
    """Least squares of daily kWh on the day's mean temperature, per
    ``group`` of the meter dimension: slope, intercept, r2, n.

    The temperature is one number a day, so the meter-days are first added up
    per (group, day): their number, sum and sum of squares. The weather meets
    only those rows. All sums are exact decimal totals (temperatures to 8
    places, kWh to 6) of values shifted by the whole part of the group's mean,
    so nothing cancels in the closed form at the end, and the result has the
    same bits for any partitioning: no rounding hides the order of adding."""
    y = F.col("kwh").try_cast("decimal(18,6)")
    per_day = (
        md.join(meters.select("meter_id", group), "meter_id").filter(y.isNotNull()).groupBy(group, "date_key")
        .agg(F.count(F.lit(1)).cast("decimal(12,0)").alias("n"), F.sum(y).alias("y"), F.sum(y * y).alias("yy"))
    )
    x = F.col("avg_temp_c").try_cast("decimal(18,8)")
    days = per_day.join(weather_daily.select("date_key", x.alias("x")), "date_key").filter("x IS NOT NULL")
    # a group's days are one task's rows: as many as the calendar has
    of_group = Window.partitionBy(group).orderBy("date_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def shift(total: Column) -> Column:
        mean = F.sum(total).over(of_group).cast("double") / F.sum("n").over(of_group).cast("double")
        return F.floor(mean).cast("decimal(10,0)")

    n, x, y, yy = (F.col(c) for c in ("n", "x", "y", "yy"))
    shifted = days.withColumn("sx", shift(x * n)).withColumn("sy", shift(y)).select(
        group, "n", "sx", "sy", (x - F.col("sx")).cast("decimal(14,8)").alias("x"),
        (y - n * F.col("sy")).cast("decimal(24,6)").alias("y"),
        (yy - 2 * F.col("sy") * y + n * F.col("sy") * F.col("sy")).cast("decimal(28,12)").alias("yy"),
    )
    parts = {"n": n, "x": n * x, "y": y, "xx": n * (x * x).cast("decimal(22,12)"), "xy": x * y, "yy": yy}
    sums = shifted.groupBy(group).agg(
        *[F.sum(v.cast("decimal(28,12)")).cast("double").alias(c) for c, v in parts.items()],
        F.max("sx").cast("double").alias("sx"), F.max("sy").cast("double").alias("sy"),
    )
    xx, xy, yy = (F.col(a + b) - F.col(a) * F.col(b) / F.col("n") for a, b in ("xx", "xy", "yy"))
    slope = F.when(xx > 0, xy / xx)
    level = F.col("y") / F.col("n") + F.col("sy") - slope * (F.col("x") / F.col("n") + F.col("sx"))
    r2 = F.when(xx > 0, F.when(yy > 0, xy * xy / (xx * yy)).otherwise(1.0))
    return sums.select(group, slope.alias("slope"), level.alias("intercept"), r2.alias("r2"), F.col("n").cast("long").alias("n"))


def fault_tree(readings: DataFrame, meters: DataFrame, ts: str = "reading_ts", with_meters: bool = False) -> DataFrame:
    """Fault counts by label x meter model x month with every subtotal
    (ROLLUP), ``grouping_id`` telling the level. Faults are non-GOOD labels,
    NULL included (reported as the label 'NULL'). Faults are counted per
    (meter, label, month) before they meet the meter dimension.
    ``with_meters`` adds the distinct ``meters`` of each node (``meter_id`` is
    then a whole number), united from the leaves' bitmaps."""
    counted = (
        readings.filter(is_fault("quality"))
        .groupBy("meter_id", F.coalesce(F.col("quality"), F.lit("NULL")).alias("quality"), month_key(F.col(ts)).alias("month"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    f = counted.join(meters.select("meter_id", "meter_model"), "meter_id", "left").select(
        "quality", F.coalesce(F.col("meter_model"), F.lit("UNKNOWN")).alias("meter_model"), "month", "_n", "meter_id"
    )
    if with_meters:
        dims = ["quality", "meter_model", "month"]
        return rollup_state(distinct_state(f, dims, "meter_id", {"faults": F.sum("_n")}), dims, "meters", ["faults"])
    return f.rollup("quality", "meter_model", "month").agg(
        F.sum("_n").alias("faults"), F.grouping_id().cast("int").alias("level")
    )


def anomalies(md: DataFrame, days: int = 7, k: float = 3.0, value: str = "kwh") -> DataFrame:
    """Z-score of a meter's day against its preceding ``days`` calendar
    days (current day excluded); fewer than two prior days -> NULL z, not
    flagged; a zero std with a different value is flagged. The baseline mean
    is exact (``exact_mean``)."""
    w = Window.partitionBy("meter_id").orderBy(day_number("date_key")).rangeBetween(-days, -1)
    mean = exact_mean(value, window=w)
    std = F.stddev_samp(value).over(w)
    n = F.count(value).over(w)
    out = md.select("meter_id", "date_key", value, mean.alias("_m"), std.alias("_s"), n.alias("_n"))
    z = F.when(
        (F.col("_n") >= 2) & (F.col("_s") > 0), (F.col(value) - F.col("_m")) / F.col("_s")
    )
    flag = F.when(F.col("_n") < 2, F.lit(False)).when(
        F.col("_s") == 0, F.col(value) != F.col("_m")
    ).otherwise(F.abs(z) > k)
    return out.select(
        "meter_id",
        "date_key",
        value,
        F.col("_m").alias("baseline_mean"),
        F.round(z, 6).alias("z"),
        flag.alias("is_anomaly"),
    )


def meter_profile(silver: DataFrame, md: DataFrame) -> DataFrame:
    """Per meter: readings, faults and fault share, kWh, first/last
    reading, mean/min/max daily kWh."""
    r = silver.groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum(is_fault("quality").cast("long")).alias("faults"),
        F.round(F.coalesce(exact_sum("interval_kwh").cast("double"), F.lit(0.0)), 4).alias("total_kwh"),
        F.min("reading_ts").alias("first_reading"),
        F.max("reading_ts").alias("last_reading"),
    )
    d = md.groupBy("meter_id").agg(
        exact_mean("kwh").alias("avg_daily_kwh"),
        F.round(F.min("kwh"), 4).alias("min_daily_kwh"),
        F.round(F.max("kwh"), 4).alias("max_daily_kwh"),
        F.count(F.lit(1)).alias("days"),
    )
    out = r.join(d, "meter_id", "left")
    return out.withColumn("fault_share", F.round(F.col("faults") / F.col("readings"), 6))


def entitled(
    df: DataFrame,
    entitlements: DataFrame,
    key: str = "meter_id",
    user=None,
    user_col: str = "user_id",
) -> DataFrame:
    """Row-level security: rows whose ``key`` the entitlement table
    grants, optionally to one ``user`` (``user_col``) of a user -> key
    table. A left semi join: rows are never duplicated, whatever number of
    grants cover them."""
    grants = entitlements if user is None else entitlements.filter(F.col(user_col) == F.lit(user))
    return df.join(grants.select(F.col(key)), key, "left_semi")


METRICS = {
    "kwh": lambda: _rounded_sum("kwh"),
    "cost": lambda: _rounded_sum("cost"),
    # weighted by readings: the day's sums and counts, not its means
    "avg_voltage": lambda: F.try_divide(F.sum("voltage_sum").cast("double"), F.sum("voltage_n").cast("double")),
    "meter_days": lambda: F.count(F.lit(1)),
    "meters": lambda: F.count_distinct("meter_id"),
}
DIMENSIONS = (
    "r_name", "n_name", "c_mktsegment", "tariff_code", "tariff_name", "season", "is_weekend", "day_of_week", "date_key",
)


def usage_by(
    df: DataFrame, metric: str, dims: Sequence[str], allowed_dims: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """One whitelisted metric by any whitelisted dimensions (the
    field-parameter chart). The mean voltage needs the daily usage's carried
    sums (``daily_usage(fact, carry=True)``)."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {sorted(METRICS)}")
    bad = [d for d in dims if d not in allowed_dims]
    if bad:
        raise ValueError(f"dimension(s) not allowed: {bad}")
    return df.groupBy(*dims).agg(METRICS[metric]().alias(metric))


def usage_tree(df: DataFrame, dims: Sequence[str], allowed_dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """B11 at every subtotal of ROLLUP(``dims``): ``kwh``, ``cost``,
    ``meter_days``, distinct ``meters`` and ``level`` (the grouping id). The
    daily usage is read once, into leaves; levels are united from those."""
    bad = [d for d in dims if d not in allowed_dims]
    if bad:
        raise ValueError(f"dimension(s) not allowed: {bad}")
    sums = {"_kwh": exact_sum("kwh"), "_cost": exact_sum("cost"), "meter_days": F.count(F.lit(1))}
    tree = rollup_state(distinct_state(df, dims, "meter_id", sums), dims, "meters", list(sums))
    return tree.select(
        *dims, "level",
        *[F.round(F.col(f"_{c}").cast("double"), SCALES[c]).alias(c) for c in ("kwh", "cost")], "meter_days", "meters",
    )


def daily_meters(readings: DataFrame, ts: str = "reading_ts", key: str = "meter_id") -> DataFrame:
    """The state of the meters that report each day (``month``, ``date_key``),
    with their ``readings``: a day's rows are final once the day is loaded,
    and any longer span is united from them (``rollup_state``)."""
    dated = readings.filter(F.col(ts).isNotNull()).select(
        key, month_key(F.col(ts)).alias("month"), date_key(F.col(ts)).alias("date_key")
    )
    return distinct_state(dated, ["month", "date_key"], key, {"readings": F.count(F.lit(1))})
