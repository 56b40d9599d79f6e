"""Latest-wins by state: what a batch writes, and what readers see."""

import json
import os
import tempfile
import time

import pytest

from gridlake import schemas
from gridlake.streaming.ingest import append_bronze, read_events
from gridlake.streaming.latest import bronze_events, compact, read_latest, upsert_by_state


def _rec(meter, ts, kwh):
    return {"meter_id": meter, "customer_id": "C", "reading_ts": ts, "interval_kwh": kwh, "voltage": 230.0, "quality": "GOOD"}


class Feed:
    """A feed of drops into Bronze, and Silver by state."""

    def __init__(self, spark):
        self.spark, self.root, self.drops = spark, tempfile.mkdtemp(prefix="gridlake-test-"), 0

    def path(self, name):
        return f"{self.root}/{name}"

    def drop(self, recs, raw=()):
        os.makedirs(self.path("src"), exist_ok=True)
        with open(self.path(f"src/{self.drops:03d}.json"), "w") as f:
            f.writelines([json.dumps(r) + "\n" for r in recs] + [x + "\n" for x in raw])
        self.drops += 1
        append_bronze(read_events(self.spark, self.path("src"), schemas.READING_EVENT), self.path("bronze"), self.path("b")).awaitTermination()
        return self

    def run(self, checkpoint="s", **how):
        q = upsert_by_state(bronze_events(self.spark, self.path("bronze")), self.path("silver"), self.path(checkpoint), **how)
        q.awaitTermination()
        return [p for p in q.recentProgress if p["numInputRows"]]

    def silver(self):
        return dict(((r.meter_id, str(r.reading_ts)), r.interval_kwh) for r in read_latest(self.spark, self.path("silver")).collect())

    def logged(self):
        return self.spark.read.parquet(self.path("silver")).count()


@pytest.fixture
def feed(spark):
    return Feed(spark)


T = "2025-07-01T{:02d}:00:00Z"


def test_a_batch_writes_what_it_changes_and_not_the_days_it_touches(feed):
    feed.drop([_rec(f"M{m}", T.format(h), 1.0) for m in range(10) for h in range(24)]).run()
    assert feed.logged() == 240
    progress = feed.drop([_rec("M3", "2025-07-01T07:00:00+02:00", 9.0)]).run()  # 05:00 UTC
    assert feed.logged() == 241
    assert [p["numInputRows"] for p in progress] == [1]
    assert sum(s["numRowsUpdated"] for p in progress for s in p["stateOperators"]) == 1
    got = feed.silver()
    assert len(got) == 240 and got["M3", "2025-07-01 05:00:00"] == 9.0 and got["M3", "2025-07-01 06:00:00"] == 1.0


def test_a_copy_that_is_older_changes_nothing(feed):
    order = ("interval_kwh",)  # any order of copies, here not that of arrival
    feed.drop([_rec("A", T.format(0), 5.0), _rec("B", T.format(0), 1.0)]).run(order=order)
    feed.drop([_rec("A", T.format(0), 3.0), _rec("B", T.format(0), 2.0)]).run(order=order)
    assert feed.logged() == 3  # A's older copy was not written
    got = {r.meter_id: r.interval_kwh for r in read_latest(feed.spark, feed.path("silver"), order=order).collect()}
    assert got == {"A": 5.0, "B": 2.0}


def test_copies_of_one_batch_and_one_file_are_in_their_order(feed):
    feed.drop([_rec("A", T.format(0), v) for v in (3.0, 1.0, 2.0)] + [_rec("B", T.format(1), 7.0)])
    feed.drop([_rec("B", T.format(1), 6.0)])
    feed.run()
    assert feed.silver() == {("A", "2025-07-01 00:00:00"): 2.0, ("B", "2025-07-01 01:00:00"): 6.0}
    assert feed.logged() == 2


def test_a_replayed_batch_replaces_itself(feed):
    feed.drop([_rec("A", T.format(h), 1.0) for h in range(5)]).run()
    feed.drop([_rec("A", T.format(2), 4.0)]).run()
    want = feed.silver()
    # the commit of the last batch that had rows is lost: it runs again
    commits = sorted(int(n) for n in os.listdir(feed.path("s/commits")) if n.isdigit())
    last = max(b for b in commits if any(f"_batch_id={b}" in d for d, _, _ in os.walk(feed.path("silver"))))
    for b in commits:
        if b >= last:
            for name in (f"s/commits/{b}", f"s/commits/.{b}.crc", *([f"s/offsets/{b}", f"s/offsets/.{b}.crc"] if b > last else [])):
                if os.path.exists(feed.path(name)):
                    os.remove(feed.path(name))
    feed.run()
    assert feed.silver() == want and feed.logged() == 6


def test_a_lost_checkpoint_and_a_second_stream_change_no_result(feed):
    feed.drop([_rec("A", T.format(h), 1.0) for h in range(3)], raw=["{broken"]).run()
    feed.drop([_rec("A", T.format(1), 2.0)]).run()
    def seen():
        return sorted((str(r.meter_id), str(r.reading_ts), r.interval_kwh, r._raw) for r in read_latest(feed.spark, feed.path("silver")).collect())

    before = seen()
    assert len(before) == 4
    feed.run(checkpoint="another")  # reads all of Bronze again, without the state
    assert seen() == before


def test_state_is_dropped_and_results_stay(feed):
    feed.drop([_rec("A", T.format(0), 1.0)]).run(keep="1 second")
    time.sleep(3)
    feed.drop([_rec("B", T.format(0), 1.0)]).run(keep="1 second")
    progress = feed.drop([_rec("A", T.format(0), 2.0)]).run(keep="1 second")
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 2
    assert feed.silver() == {("A", "2025-07-01 00:00:00"): 2.0, ("B", "2025-07-01 00:00:00"): 1.0}


def test_rows_without_a_key_are_kept_once_and_written_once(feed):
    bad = [_rec(None, T.format(0), 1.0), _rec(None, T.format(0), 1.0), _rec("A", "no time", 2.0), _rec("A", "no time", 2.0)]
    feed.drop(bad).run()
    assert feed.logged() == 4
    feed.drop([_rec("A", "no time", 3.0)]).run()
    assert feed.logged() == 5  # the earlier ones are not written again
    assert read_latest(feed.spark, feed.path("silver")).count() == 5


def test_compaction_keeps_results_and_later_parts(feed):
    for v in (1.0, 2.0, 3.0):
        feed.drop([_rec("A", T.format(0), v), _rec("A", f"2025-07-0{int(v) + 1}T00:00:00Z", v), _rec("A", "no time", v)]).run()
    want = feed.silver()
    assert compact(feed.spark, feed.path("silver")) == ["2025-07-01", "unparsed"]
    assert feed.silver() == want and feed.logged() == 7  # 3 + 1 + 3 without a time
    assert compact(feed.spark, feed.path("silver")) == []
    feed.drop([_rec("A", T.format(0), 8.0)]).run()
    assert feed.silver() == want | {("A", "2025-07-01 00:00:00"): 8.0}
    assert compact(feed.spark, feed.path("silver")) == ["2025-07-01"]
    assert feed.silver() == want | {("A", "2025-07-01 00:00:00"): 8.0}


def test_days_of_one_batch_are_read_without_a_shuffle(feed):
    feed.drop([_rec("A", T.format(h), 1.0) for h in range(3)]).run()
    plan = read_latest(feed.spark, feed.path("silver"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_silver_from_the_log_is_that_of_the_batch_build(feed):
    """Quarantine, tariff and sentinel over the stream's newest rows."""
    from gridlake.plans.pipeline import build_silver

    spark = feed.spark
    bad = _rec("A", T.format(3), 9.0) | {"quality": "MISSING"}
    feed.drop([_rec(m, T.format(h), 1.0 + h) for m in "AB" for h in range(4)] + [_rec("A", "no time", 2.0)]).run()
    feed.drop([bad, _rec("B", T.format(1), 7.5)]).run()
    history = spark.createDataFrame([("A", "green", "2025-01-01", None), ("B", "standard", "2025-07-02", None)],
                                    "meter_id string, tariff_code string, valid_from string, valid_to string")
    drops = [f"_source_{c}" for c in ("time", "at", "seq")] + ["_source", "_ingested_at"]
    streamed = build_silver(read_latest(spark, feed.path("silver")).drop("reading_date"), history, None, deduped=True)
    batch = build_silver(spark.read.parquet(feed.path("bronze")), history, None)

    def seen(df):
        return sorted(str(tuple(r)) for r in df.select(*sorted(set(df.columns) - set(drops))).collect())

    assert seen(streamed.enriched) == seen(batch.enriched) and streamed.enriched.count() == 7
    assert seen(streamed.quarantine) == seen(batch.quarantine) and streamed.quarantine.count() == 2
