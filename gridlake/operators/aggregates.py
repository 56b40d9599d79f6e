"""Gold aggregations (A1, A2) and the cost fact (J3 + P3/P4/P7/P8).

NaN is a missing value: neither summed nor counted. Values that no exact sum
holds (infinite, or 10^20 and more) are left out of sums, means and counts
alike; Silver quarantines such readings.

Sums of an all-NULL group are 0.0 (pandas semantics of the published Gold);
means of an all-NULL group stay NULL; NULL group keys are dropped. Double
aggregates are rounded (kWh 4 dp, money 6 dp, means 6 dp) so results do not
depend on the summation order of a distributed run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.fixed import LOCAL_ZONE
from gridlake.functions.scalar import cost, exact_count, exact_mean, exact_sum, known
from gridlake.functions.time import date_key
from gridlake.operators.joins import rate_join

FACT_COLUMNS = [
    "meter_id",
    "reading_ts",
    "hour_ts",
    "date_key",
    "interval_kwh",
    "voltage",
    "tariff_code",
    "period_name",
    "unit_rate",
    "cost",
]


def _not_null(*cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def cost_fact(
    silver: DataFrame,
    rates: DataFrame,
    zone: str = LOCAL_ZONE,
    date_zone: str | None = None,
    ts: str = "reading_ts",
) -> DataFrame:
    """Time-of-use cost per reading: local hour in ``zone`` picks the rate
    window, ``cost = round(kwh * unit_rate, 6)``, ``date_key`` is the UTC date
    unless ``date_zone`` is given."""
    j = rate_join(silver, rates, ts=ts, zone=zone)
    out = j.withColumn("date_key", date_key(F.col(ts), date_zone)).withColumn(
        "cost", cost("interval_kwh", "unit_rate")
    )
    return out.select(*FACT_COLUMNS)


def daily_usage(fact: DataFrame, carry: bool = False) -> DataFrame:
    """A1: per (meter_id, date_key, tariff_code): kWh, cost, mean voltage, all
    from exact decimal sums. ``carry`` adds ``voltage_sum`` and ``voltage_n``,
    from which a mean over several days is weighted by readings."""
    keys = ["meter_id", "date_key", "tariff_code"]
    carried = [exact_sum("voltage").alias("voltage_sum"), exact_count("voltage").alias("voltage_n")] if carry else []
    return (
        fact.filter(_not_null(*keys))
        .groupBy(*keys)
        .agg(
            F.round(F.coalesce(exact_sum("interval_kwh").cast("double"), F.lit(0.0)), 4).alias("kwh"),
            F.round(F.coalesce(exact_sum("cost").cast("double"), F.lit(0.0)), 6).alias("cost"),
            exact_mean("voltage").alias("avg_voltage"),
            *carried,
        )
    )


def daily_weather(weather: DataFrame, ts: str = "weather_ts") -> DataFrame:
    """A2: per UTC date: mean/min/max temperature, mean cloud, mean radiation
    (means from exact decimal sums; min and max are input values)."""
    mean = exact_mean
    return (
        weather.withColumn("date_key", date_key(F.col(ts)))
        .filter(F.col("date_key").isNotNull())
        .groupBy("date_key")
        .agg(
            mean("temperature_2m").alias("avg_temp_c"),
            F.min(known("temperature_2m")).alias("min_temp_c"),
            F.max(known("temperature_2m")).alias("max_temp_c"),
            mean("cloud_cover").alias("avg_cloud_pct"),
            mean("shortwave_radiation").alias("avg_radiation"),
        )
    )
