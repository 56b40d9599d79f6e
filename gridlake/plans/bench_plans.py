"""Volume plans for the bench: the full Silver -> Gold chain over
``lineitem`` seen as 15-minute meter readings (supplier = meter)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.dedupe import dedupe_latest
from gridlake.operators.dims import dim_tariff_rate, scd2_from_changes
from gridlake.plans import driver_tables as dt
from gridlake.plans.pipeline import build_gold, build_silver


def lineitem_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return dedupe_latest(dt.lineitem_readings(spark, d))


def lineitem_end(spark: SparkSession, d: str):
    """Last ship day, fetched once as a date literal (window end and as-of
    horizon)."""
    li = dt.table(spark, d, "lineitem")
    return F.lit(li.agg(F.max(F.to_date("l_shipdate"))).first()[0]).cast("date")


def lineitem_history(spark: SparkSession, d: str, end=None) -> DataFrame:
    end = end if end is not None else lineitem_end(spark, d)
    return scd2_from_changes(dt.lineitem_tariff_changes(spark, d), end, sk=None)


def lineitem_daily_cost(spark: SparkSession, d: str) -> DataFrame:
    """Gold keeps no weather column, so its Silver is built without."""
    end = lineitem_end(spark, d)
    silver = build_silver(dt.lineitem_readings(spark, d), lineitem_history(spark, d, end), None, horizon=end)
    return build_gold(silver.enriched, dim_tariff_rate(spark)).daily
