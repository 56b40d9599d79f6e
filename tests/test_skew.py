"""A hot key holding a third of all rows: results stay whole and exact, and
the plans split the hot key instead of sending it to one task."""

import datetime as dt

from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators.dedupe import dedupe_latest
from gridlake.operators.joins import resolve_as_of


def _readings(spark, n_hot=3000, n_cold_meters=60, per_cold=100):
    base = dt.datetime(2025, 7, 1)
    hot = spark.range(n_hot).select(
        F.lit("HOT").alias("meter_id"),
        F.timestamp_add("MINUTE", (F.col("id") * 15).cast("int"), F.lit(base)).cast("timestamp_ntz").alias("reading_ts"),
        F.lit(1.0).alias("interval_kwh"),
    )
    cold = spark.range(n_cold_meters * per_cold).select(
        F.concat(F.lit("M"), (F.col("id") % n_cold_meters).cast("string")).alias("meter_id"),
        F.timestamp_add("MINUTE", (F.floor(F.col("id") / n_cold_meters) * 15).cast("int"), F.lit(base))
        .cast("timestamp_ntz").alias("reading_ts"),
        F.lit(1.0).alias("interval_kwh"),
    )
    return hot.unionByName(cold)


def test_as_of_join_splits_hot_meter(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        r = _readings(spark)
        meters = r.select("meter_id").distinct()
        hist = meters.select(
            F.lit(1).alias("meter_tariff_sk"), "meter_id", F.lit("standard").alias("tariff_code"),
            F.lit("2025-06-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"),
            F.lit(True).alias("is_current"),
        )
        out = resolve_as_of(r, hist, horizon="2025-12-31")
        out.collect()  # runs this DataFrame's own query execution, so the final AQE plan is visible
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan, plan
        got = out.groupBy((F.col("meter_id") == "HOT").alias("hot")).agg(
            F.count(F.lit(1)).alias("n"), F.count("tariff_code").alias("matched")
        )
        assert sorted(tuple(x) for x in got.collect()) == [(False, 6000, 6000), (True, 3000, 3000)]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_dedupe_hot_meter_is_whole(spark):
    r = _readings(spark).withColumn("_ingested_at", F.current_timestamp())
    doubled = r.unionByName(r.withColumn("interval_kwh", F.lit(2.0)))
    out = dedupe_latest(doubled)
    assert out.count() == 9000
    assert out.filter(F.col("meter_id") == "HOT").count() == 3000


def test_schema_constants_are_structs():
    assert schemas.READINGS_BRONZE.names[0] == "meter_id"
