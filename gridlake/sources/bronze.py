"""Bronze by reading day (B1/T2): readings as delivered, instants as text or
typed, in one folder per UTC day.

The day is worked out once, when a row lands, so a build of some days reads
their folders only: by literal bounds, or by whatever a calendar join leaves
(dynamic partition pruning). All copies of an instant, however spelled, are
in one folder, so a dedupe of some days is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlake.functions.time import to_utc_ntz
from gridlake.sources.sinks import write_table

DAY = "reading_date"
#: The folder of rows whose instant can't be read.
UNPARSED = "unparsed"


def with_day(df: DataFrame, ts: str = "reading_ts") -> DataFrame:
    """Add ``reading_date``: the instant's UTC day, or ``unparsed``."""
    day = F.to_date(to_utc_ntz(F.col(ts), df.schema[ts].dataType)).cast("string")
    return df.withColumn(DAY, F.coalesce(day, F.lit(UNPARSED)))


def land_by_day(df: DataFrame, path: str, ts: str = "reading_ts", key: str = "meter_id", fmt: str = "parquet") -> None:
    """Write readings unchanged, one folder per day, sorted by ``key`` in the
    files; a day of any size is spread over tasks by range."""
    write_table(with_day(df, ts), path, fmt, partition_by=[DAY], sort_within=[key])


def read_days(
    spark: SparkSession, path: str, schema: StructType, start=None, end=None, days: DataFrame | None = None,
    unparsed: bool = True, fmt: str = "parquet",
) -> DataFrame:
    """Readings of ``[start, end]`` (ISO dates or date literals, both
    inclusive; none: unbounded) as delivered, and those of the ``unparsed``
    folder, which the quarantine wants, unless it is False.

    ``days``: a one-column table of dates (or ISO text), such as a filtered
    calendar. Its different days, which a calendar bounds, are broadcast and
    prune the folders when the query runs; undated rows are in none."""
    wide = StructType([*[f for f in schema.fields if f.name != DAY], StructField(DAY, StringType())])
    rows = spark.read.format(fmt).schema(wide).load(path)
    if days is not None:
        # the bounds go to the calendar's side: with a literal filter of its own
        # the scan gets no dynamic one
        wanted = days.select(F.col(days.columns[0]).cast("string").alias("_day"))
        wanted = wanted.filter(_between("_day", start, end)).distinct()
        return rows.join(F.broadcast(wanted), F.col(DAY) == F.col("_day"), "left_semi").drop(DAY)
    # as text "unparsed" lies behind every date
    dated = _between(DAY, start, end) & (F.col(DAY) != UNPARSED)
    rows = rows.filter(dated | (F.col(DAY) == UNPARSED) if unparsed else dated)
    return rows.drop(DAY)


def _between(day: str, start, end) -> Column:
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(day) >= _text(start))
    if end is not None:
        keep = keep & (F.col(day) <= _text(end))
    return keep


def _text(day) -> Column:
    return (F.lit(day) if isinstance(day, str) else day).cast("date").cast("string")
