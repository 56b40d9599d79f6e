"""Tables in buckets, and Bronze by reading day."""

import datetime as dt
import glob
import uuid

import pytest
from pyspark.sql import functions as F

from gridlake.plans.queries import QUERIES
from gridlake.sources.bronze import land_by_day, read_days
from gridlake.sources.bucketed import Buckets, open_bucketed, write_bucketed
from gridlake.streaming.ingest import append_bronze, read_events
from tests.conftest import SF_SMALL

FEED = "meter_id string, reading_ts string, interval_kwh double"
# one instant under three spellings, both sides of midnight UTC, and rows without an instant
SAMPLE = [
    ("A", "2025-01-01T23:30:00+00:00", 1.0), ("A", "2025-01-02T00:30:00+01:00", 2.0), ("A", "2025-01-01 23:30:00", 3.0),
    ("B", "2025-01-02T00:00:00Z", 4.0), ("B", "2025-01-03T12:00:00Z", 5.0), ("C", "2025-01-04T12:00:00+02:00", 6.0),
    ("C", "soon", 7.0), (None, None, 8.0), ("D", "2025-01-05T00:00:00Z", None),
]


def _plan(df):
    df.collect()
    plan = df._jdf.queryExecution()
    return plan.executedPlan().toString() + plan.optimizedPlan().toString()


def _name():
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture
def bronze(spark, tmp_path):
    feed = spark.createDataFrame(SAMPLE, FEED)
    land_by_day(feed, str(tmp_path / "bronze"))
    return str(tmp_path / "bronze"), feed.schema


def _kwh(df):
    return sorted((r.interval_kwh is None, r.interval_kwh) for r in df.collect())


def test_rows_come_back_as_delivered(spark, bronze):
    assert sorted(str(tuple(r)) for r in read_days(spark, *bronze).collect()) == sorted(map(str, SAMPLE))


def test_only_the_wanted_days_are_read(spark, bronze):
    some = read_days(spark, *bronze, "2025-01-02", "2025-01-03")
    assert {v for _, v in _kwh(some)} == {4.0, 5.0, 7.0, 8.0}
    assert {v for _, v in _kwh(read_days(spark, *bronze, "2025-01-02", "2025-01-03", unparsed=False))} == {4.0, 5.0}
    plan = _plan(some)
    assert "PartitionFilters: [" in plan and "reading_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # copies of one instant, however spelled, are on one day
    one = read_days(spark, *bronze, "2025-01-01", "2025-01-01", unparsed=False)
    assert {v for _, v in _kwh(one)} == {1.0, 2.0, 3.0}
    assert {v for _, v in _kwh(read_days(spark, *bronze, start="2025-01-04", unparsed=False))} == {6.0, None}
    assert {v for _, v in _kwh(read_days(spark, *bronze, end="2025-01-02", unparsed=False))} == {1.0, 2.0, 3.0, 4.0}
    literal = F.lit(dt.date(2025, 1, 3))
    assert {v for _, v in _kwh(read_days(spark, *bronze, literal, literal, unparsed=False))} == {5.0}


def test_a_calendar_prunes_when_the_query_runs(spark, bronze):
    days = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-01-31')) AS d")
    some = read_days(spark, *bronze, days=days.filter("dayofweek(d) IN (1, 7)"))  # 4 and 5 January
    assert {v for _, v in _kwh(some)} == {6.0, None}
    assert "dynamicpruning" in _plan(some)
    bounded = read_days(spark, *bronze, "2025-01-05", "2025-01-31", days=days.filter("dayofweek(d) IN (1, 7)"))
    assert _kwh(bounded) == [(True, None)]
    twice = days.filter("day(d) = 3").union(days.filter("day(d) = 3"))
    assert {v for _, v in _kwh(read_days(spark, *bronze, days=twice))} == {5.0}


def test_registered_build_reads_pruned_bronze(spark):
    assert "dynamicpruning" in _plan(QUERIES["weekend_cost"](spark, SF_SMALL))
    some = QUERIES["daily_cost_bronze"](spark, SF_SMALL)
    read = [x for x in _plan(some).splitlines() if "PartitionFilters: [" in x and "reading_date" in x.split("PartitionFilters: [")[1]]
    assert read


def test_stream_appends_by_day(spark, tmp_path):
    spark.createDataFrame(SAMPLE, FEED).write.json(str(tmp_path / "src"))
    schema = spark.createDataFrame([], FEED).schema
    events = read_events(spark, str(tmp_path / "src"), schema)
    append_bronze(events, str(tmp_path / "bronze"), str(tmp_path / "check"), by_day=True).awaitTermination()
    some = read_days(spark, str(tmp_path / "bronze"), schema, "2025-01-03", "2025-01-04")
    assert {v for _, v in _kwh(some)} == {5.0, 6.0, 7.0, 8.0}


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path):
    left = spark.range(500).selectExpr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id END AS meter_id", "id AS v")
    right = spark.range(100).selectExpr("id AS meter_id", "id * 2 AS w")
    b = Buckets(5, sort=("meter_id",))
    names = _name(), _name()
    tables = [write_bucketed(df, n, str(tmp_path / n), b) for df, n in zip((left, right), names)]

    def joined(a, c):
        return a.join(c, "meter_id").groupBy("meter_id").agg(F.count("v").alias("n"), F.max("w").alias("w"))

    got = joined(*tables)
    assert "Exchange" not in _plan(got) and "SortMergeJoin" in _plan(got)
    want = sorted(map(str, joined(left, right).collect()))
    assert sorted(map(str, got.collect())) == want
    assert len(glob.glob(str(tmp_path / names[0] / "*.parquet"))) <= 5

    # another session knows nothing of them: they are named again from their folders
    for n in names:
        spark.sql(f"DROP TABLE {n}")
    again = [open_bucketed(spark, n, str(tmp_path / n), df.schema, b) for df, n in zip((left, right), names)]
    assert "Exchange" not in _plan(joined(*again)) and sorted(map(str, joined(*again).collect())) == want
    # a second write replaces the first
    assert write_bucketed(right.limit(3), names[0], str(tmp_path / names[0]), b).count() == 3
    for n in names:
        spark.sql(f"DROP TABLE {n}")


@pytest.mark.parametrize("name", ["bucketed_daily_cost", "bucketed_rolling7", "bucketed_profile"])
def test_bucketed_plans_move_nothing(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert "Bucketed: true" in plan
