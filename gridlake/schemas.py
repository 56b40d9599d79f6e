"""Declared schemas of the domain tables (no inference anywhere).

Bronze keeps instants and dates as strings, exactly as they arrive; Silver
types them. Internally an instant is ``timestamp_ntz`` holding UTC.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from gridlake.fixed import HOURLY_VARS


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


READINGS_BRONZE = _s(
    ("meter_id", StringType()),
    ("customer_id", StringType()),
    ("reading_ts", StringType()),
    ("interval_kwh", DoubleType()),
    ("voltage", DoubleType()),
    ("quality", StringType()),
    ("_ingested_at", TimestampType()),
)

# What arrives on the wire: the Bronze row without the ingest time.
READING_EVENT = StructType(READINGS_BRONZE.fields[:-1])

WEATHER = _s(
    ("weather_ts", StringType()),
    *[(v, DoubleType()) for v in HOURLY_VARS],
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)

WEATHER_PAYLOAD = _s(
    (
        "hourly",
        StructType(
            [StructField("time", ArrayType(StringType()), True)]
            + [StructField(v, ArrayType(DoubleType()), True) for v in HOURLY_VARS]
        ),
    ),
)

DIM_LOCATION = _s(
    ("location_id", IntegerType()),
    ("city", StringType()),
    ("country", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)

DIM_CUSTOMER = _s(
    ("customer_id", StringType()),
    ("segment", StringType()),
    ("occupants", IntegerType()),
    ("join_date", StringType()),
)

DIM_METER = _s(
    ("meter_id", StringType()),
    ("customer_id", StringType()),
    ("location_id", IntegerType()),
    ("has_solar", BooleanType()),
    ("meter_model", StringType()),
)

DIM_METER_TARIFF = _s(
    ("meter_tariff_sk", LongType()),
    ("meter_id", StringType()),
    ("tariff_code", StringType()),
    ("valid_from", StringType()),
    ("valid_to", StringType()),
    ("is_current", BooleanType()),
)

DIM_TARIFF = _s(
    ("tariff_code", StringType()),
    ("tariff_name", StringType()),
    ("standing_charge", DoubleType()),
    ("currency", StringType()),
)

DIM_TARIFF_RATE = _s(
    ("tariff_code", StringType()),
    ("period_name", StringType()),
    ("start_hour", IntegerType()),
    ("end_hour", IntegerType()),
    ("unit_rate", DoubleType()),
)

DIM_DATE = _s(
    ("date", StringType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("day_of_week", IntegerType()),
    ("is_weekend", BooleanType()),
    ("season", StringType()),
)

TARIFF_CHANGES = _s(
    ("meter_id", StringType()),
    ("change_date", StringType()),
    ("tariff_code", StringType()),
)
