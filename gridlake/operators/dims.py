"""Dimension builders (D1-D5), re-aimed as Spark jobs over data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from gridlake import schemas
from gridlake.fixed import LOCATION, SEGMENT, TARIFF_RATES, TARIFFS
from gridlake.functions.scalar import season_of
from gridlake.operators.ordering import with_sequence
from gridlake.session import cut_lineage


def _date(x) -> Column:
    return F.lit(x).cast("date") if isinstance(x, str) else F.to_date(x)


def _days(start, end) -> Column:
    """Inclusive day list; empty (NULL, so explode gives no row) when start
    is after end. A bare ``sequence`` would count down instead."""
    s, e = _date(start), _date(end)
    return F.when(s <= e, F.sequence(s, e))


def calendar(spark: SparkSession, start, end, col: str = "date") -> DataFrame:
    """Inclusive day range ``[start, end]`` as a one-column DataFrame.
    ``start``/``end`` are ISO strings or Columns (e.g. scalar subqueries).
    Its size is the number of days in the window, not the data volume."""
    return spark.range(1).select(F.explode(_days(start, end)).alias(col))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """One row per day: ISO date key, year, month, day, ISO weekday
    (1=Mon..7=Sun), weekend flag, season."""
    d = F.col("d")
    return calendar(spark, start, end, "d").select(
        d.cast("string").alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        season_of(F.month(d)).alias("season"),
    )


def scd2_from_changes(
    changes: DataFrame,
    window_end,
    key: str = "meter_id",
    change_date: str = "change_date",
    value: str = "tariff_code",
    sk: str | None = "meter_tariff_sk",
) -> DataFrame:
    """Contiguous SCD2 intervals from a change log. ``valid_to`` is the day
    before the next change (inclusive), the last interval ends at
    ``window_end`` and is the current one, so ``valid_from <= valid_to <=
    window_end`` always holds: changes after the window or without a date are
    left out, and of several changes of a key on one date the largest value
    counts. A change to the same value opens a version too (the log says
    something happened). The surrogate key numbers rows in (key, valid_from)
    order, computed without a single-partition window; ``sk=None`` leaves it
    out (an as-of join needs only the validity columns, so it need not pay for
    the global numbering)."""
    per_day = (
        changes.select(F.col(key), F.to_date(F.col(change_date)).alias("_from"), F.col(value))
        .filter(F.col("_from") <= _date(window_end))
        .groupBy(key, "_from").agg(F.max(value).alias(value))
    )
    nxt = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    hist = per_day.select(
        F.col(key),
        F.col(value),
        F.col("_from").cast("string").alias("valid_from"),
        F.coalesce(F.date_sub(nxt, 1), _date(window_end)).cast("string").alias("valid_to"),
        nxt.isNull().alias("is_current"),
    )
    if sk is None:
        return hist.select(key, value, "valid_from", "valid_to", "is_current")
    seq = with_sequence(hist, [key, "valid_from"], out=sk)
    return seq.select(sk, key, value, "valid_from", "valid_to", "is_current")


_HISTORY = ("valid_from", "valid_to", "is_current")


def scd2_apply(
    history: DataFrame, changes: DataFrame, window_end, key: str = "meter_id", change_date: str = "change_date",
    value: str = "tariff_code",
) -> DataFrame:
    """D2 by increments: a batch of ``changes`` merged into an existing SCD2
    ``history`` (``key``, ``value``, validity). Only the keys in the batch are
    rebuilt: an open interval is closed, a late change splits the closed
    interval it falls into, a change on a date that has a version already
    keeps the larger value; all other rows pass through, the current ones
    with their end moved to ``window_end``. The result is that of
    ``scd2_from_changes`` over all changes so far, however they were split
    into batches and in whatever order these came (under one
    ``window_end``)."""
    batch = changes.select(F.col(key), F.to_date(F.col(change_date)).cast("string").alias("valid_from"), F.col(value))
    batch = batch.filter(F.to_date("valid_from") <= _date(window_end))
    touched = batch.select(key).distinct()
    old = history.select(key, value, *_HISTORY)
    rest = old.join(touched, key, "left_anti").withColumn(
        "valid_to", F.when(F.col("is_current"), _date(window_end).cast("string")).otherwise(F.col("valid_to"))
    )
    # a version is its key, first day and value: the history of the touched keys is a change log again
    log = old.join(touched, key, "left_semi").select(key, "valid_from", value).unionByName(batch)
    rebuilt = scd2_from_changes(log, window_end, key, "valid_from", value, sk=None)
    return rest.select(key, value, *_HISTORY).unionByName(rebuilt)


def merge_scd2(
    spark: SparkSession, path: str, changes: DataFrame, window_end, key: str = "meter_id",
    change_date: str = "change_date", value: str = "tariff_code", buckets: int = 64,
) -> None:
    """``scd2_apply`` on a table: the history under ``path`` is kept in
    ``buckets`` directories by a hash of the key, and only those that a key of
    the batch falls into are read and replaced. The table is made by its first
    batch; a batch applied twice changes nothing. Rows outside the touched
    buckets keep their end: ``read_scd2`` moves it to the window's end."""
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    held = cut_lineage(changes.withColumn("_bucket", at))
    touched = [r[0] for r in held.select("_bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    kinds = held.schema
    schema = StructType([kinds[key], kinds[value], *[StructField(c, StringType()) for c in _HISTORY[:2]],
                         StructField(_HISTORY[2], BooleanType()), StructField("_bucket", IntegerType())])
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    old = spark.read.schema(schema).parquet(path) if known else spark.createDataFrame([], schema)
    merged = scd2_apply(old.filter(F.col("_bucket").isin(touched)), held, window_end, key, change_date, value)
    # written elsewhere first: the buckets that are read are replaced
    (
        cut_lineage(merged.withColumn("_bucket", at)).repartition("_bucket").sortWithinPartitions(key, "valid_from")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
    )


def read_scd2(spark: SparkSession, path: str, window_end) -> DataFrame:
    """The history that ``merge_scd2`` keeps, its current rows ending at
    ``window_end``."""
    h = spark.read.parquet(path).drop("_bucket")
    end = F.when(F.col("is_current"), _date(window_end).cast("string")).otherwise(F.col("valid_to"))
    return h.withColumn("valid_to", end)


def dim_meter(fleet: DataFrame, location_id: int = LOCATION[0]) -> DataFrame:
    """D3: meter dimension from a fleet registry with ``has_solar``."""
    return fleet.select(
        "meter_id",
        "customer_id",
        F.lit(location_id).cast("int").alias("location_id"),
        F.col("has_solar").cast("boolean").alias("has_solar"),
        F.concat(F.lit("SM-"), F.when(F.col("has_solar"), "S").otherwise("B")).alias("meter_model"),
    )


def dim_customer(fleet: DataFrame, join_date: str = "join_date") -> DataFrame:
    """Customer dimension: registry projection with constant segment."""
    return fleet.select(
        "customer_id",
        F.lit(SEGMENT).alias("segment"),
        F.col("occupants").cast("int").alias("occupants"),
        F.col(join_date).cast("string").alias("join_date"),
    )


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table as an inline relation (folded by Catalyst into
    a local scan with exact size statistics, no RDD behind it)."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_tariff(spark: SparkSession) -> DataFrame:
    """The tariff catalogue (fixed literal rows)."""
    return literal_table(spark, TARIFFS, schemas.DIM_TARIFF)


def dim_tariff_rate(spark: SparkSession) -> DataFrame:
    """Time-of-use windows (fixed literal rows)."""
    return literal_table(spark, TARIFF_RATES, schemas.DIM_TARIFF_RATE)


def dim_location(spark: SparkSession) -> DataFrame:
    """The metering location (fixed literal row)."""
    return literal_table(spark, [LOCATION], schemas.DIM_LOCATION)


def coverage(
    readings: DataFrame,
    meters: DataFrame,
    start,
    end,
    slots_per_day: int = 96,
    key: str = "meter_id",
    ts: str = "reading_ts",
    unique: bool = True,
) -> DataFrame:
    """Expected vs present slots per meter and UTC day over ``[start,
    end]``. ``unique=True`` (Silver, de-duplicated per meter and instant by
    W1) counts rows: one shuffle of per-(meter, day) partial counts. With
    ``unique=False`` distinct instants are counted, which needs a shuffle of
    every (meter, day, instant) first. Each meter row is expanded over the window's days with a
    generator (one row per meter-day, the size of the output), then the
    per-meter-day reading counts are left-joined; both sides are keyed by
    (meter, day)."""
    grid = meters.select(
        F.col(key), F.explode(_days(start, end)).alias("_day")
    )
    present = (
        readings.filter(F.col(ts).isNotNull())
        .groupBy(F.col(key).alias("_k"), F.to_date(F.col(ts)).alias("_d"))
        .agg((F.count(F.col(ts)) if unique else F.countDistinct(F.col(ts))).alias("present"))
    )
    j = grid.join(present, (F.col(key) == F.col("_k")) & (F.col("_day") == F.col("_d")), "left")
    return j.select(
        F.col(key),
        F.col("_day").cast("string").alias("date_key"),
        F.lit(slots_per_day).cast("long").alias("expected"),
        F.coalesce(F.col("present"), F.lit(0)).cast("long").alias("present"),
    )
