"""Scans: lake table (format switch), CSV, JSON lines, weather payloads.

Every reader takes an explicit schema (no inference); filters and
projections applied afterwards reach the scan (Parquet pushdown / pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlake import schemas
from gridlake.fixed import HOURLY_VARS

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Lake table scan, format switchable (``parquet``; ``delta``
    when its connector is on the classpath)."""
    r = spark.read.format(fmt)
    if schema is not None and fmt not in ("delta",):
        r = r.schema(schema)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = False) -> DataFrame:
    """S3: CSV with a header row and a declared schema, matched by column
    name: the file's order does not matter, a missing column is NULL, others
    are left out. A value that is not of its column's type is NULL; with
    ``keep_corrupt`` such a row carries its whole text, as JSON, in
    ``_corrupt_record``."""
    raw = spark.read.option("header", True).csv(path)
    fields = [f for f in schema.fields if f.name in raw.columns]
    typed = [
        (F.col(f.name).try_cast(f.dataType) if f in fields else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    if keep_corrupt:
        bad = F.lit(False)
        for f in fields:
            bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        whole = F.to_json(F.struct(*[F.col(c) for c in raw.columns]))
        typed.append(F.when(bad, whole).alias(CORRUPT))
    return raw.select(*typed)


def read_jsonl(spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = True) -> DataFrame:
    """JSON lines. A malformed line is kept (PERMISSIVE) with its raw
    text in ``_corrupt_record`` instead of failing the job."""
    if keep_corrupt:
        schema = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
        return (
            spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
        )
    return spark.read.schema(schema).json(path)


def payload_rows(payloads: DataFrame, lat="latitude", lon="longitude", col: str = "payload") -> DataFrame:
    """Parallel-array weather payloads (a ``hourly`` struct of arrays in
    column ``col``) -> one row per hour: ``time`` renamed ``weather_ts``,
    the location attached from ``lat``/``lon`` columns (or constants)."""
    h = F.col(f"{col}.hourly")
    n = F.size(h["time"])
    # A variable absent from the payload becomes NULLs (arrays_zip would
    # otherwise return NULL for the whole payload).
    filled = [
        F.coalesce(h[v], F.array_repeat(F.lit(None).cast("double"), n)).alias(v) for v in HOURLY_VARS
    ]
    zipped = F.arrays_zip(h["time"].alias("weather_ts"), *filled)
    lat_c = F.col(lat) if isinstance(lat, str) else F.lit(float(lat))
    lon_c = F.col(lon) if isinstance(lon, str) else F.lit(float(lon))
    return payloads.select(lat_c.alias("_lat"), lon_c.alias("_lon"), F.inline(zipped)).select(
        "weather_ts", *HOURLY_VARS, F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude")
    )


def read_payloads(spark: SparkSession, path: str, lat: float, lon: float) -> DataFrame:
    """S5 from files: one JSON payload document per file (multi-line)."""
    raw = spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", True).json(path)
    return payload_rows(raw.select(F.struct("hourly").alias("payload")), lat, lon)
