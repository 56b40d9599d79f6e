"""Latest-wins Silver by state and a change log.

``ingest.upsert_latest`` rebuilds the whole days that a micro-batch touches.
Here a batch costs what it brings:

1. a stateful aggregate holds the newest copy so far of each (meter, instant),
   by ``max_by`` over the order of copies. Its state lives in the state store,
   for ``keep`` of processing time; a copy that is older than the one held
   changes nothing and is not written;
2. the rows that a batch did change go to a change log, partitioned by
   (``reading_date``, ``_stream_id``, ``_batch_id``). A replayed batch replaces
   its own files;
3. ``read_latest`` gives the newest row per key of the log. Days that one batch
   alone wrote are read as they are; ``compact`` makes days so.

The state saves work, it does not decide: a copy that comes after its key's
state has gone, or to a stream that has lost its checkpoint, is written, and
the reader, which compares the same order over all of the log, drops the older
one. Rows without an instant or a meter are kept each (equal ones at one place
in the source are one), and are logged under
``reading_date=unparsed`` once, however often a day is touched.

For large state set ``spark.sql.streaming.stateStore.providerClass`` to the
RocksDB provider; the number of state partitions is fixed by
``spark.sql.shuffle.partitions`` at the first start.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlake.functions.time import to_utc_ntz
from gridlake.streaming.ingest import POSITION, _reading_date

KEYS = ("meter_id", "reading_ts")
ORDER = ("_ingested_at", *POSITION)
_PARTS = ("reading_date", "_stream_id", "_batch_id")


def bronze_events(spark: SparkSession, path: str, bytes_per_trigger: int | None = None) -> DataFrame:
    """A stream over the Parquet files of ``ingest.append_bronze``. A row's
    place in its file completes its position: a task appends the rows of a
    source file in their order."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", bytes_per_trigger)
    return r.parquet(path).select("*", F.col("_metadata.row_index").alias("_source_seq"))


def _no_key(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return missing


def latest_changes(
    stream: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, keep: str = "1 day"
) -> DataFrame:
    """The rows of ``stream`` that are the newest copy of their key when they
    come, one per key and micro-batch (output mode ``update``). The state of a
    key is dropped after the processing-time window of length ``keep`` that it
    was seen in; rows are never late, as the watermark is on their arrival."""
    order = [c for c in order if c in stream.columns]
    seen = stream.withColumn("_seen_at", F.current_timestamp()).withColumn(
        "_lone", F.when(_no_key(keys), F.xxhash64(*stream.columns))
    ).withWatermark("_seen_at", "0 seconds")
    # equal places in the order: any copy, but the same one on a replay
    place = F.struct(*order, F.xxhash64(*stream.columns).alias("_hash"))
    newest = seen.groupBy(F.window("_seen_at", keep), *keys, "_lone").agg(
        F.max_by(F.struct(*[c for c in stream.columns if c not in keys], "_seen_at"), place).alias("_row"),
        F.max("_seen_at").alias("_touched"),
    )
    # the copy held may be an older batch's: then this batch changed nothing
    changed = newest.filter(F.col("_row._seen_at") == F.col("_touched"))
    return changed.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in stream.columns])


def _log(batch: DataFrame, batch_id: int, silver: str, stream_id: str) -> None:
    (
        batch.withColumn("reading_date", _reading_date(F.col("reading_ts")))
        .withColumn("_stream_id", F.lit(stream_id)).withColumn("_batch_id", F.lit(batch_id).cast("long"))
        .repartition("reading_date", F.pmod(F.xxhash64(*KEYS[:1]), F.lit(16)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTS).parquet(silver)
    )


def upsert_by_state(
    stream: DataFrame, silver: str, checkpoint: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
    keep: str = "1 day", available_now: bool = True,
) -> StreamingQuery:
    """Start the latest-wins stream of typed-as-received readings (a stream
    over Bronze, see ``ingest.append_bronze``) into the change log ``silver``."""
    typed = stream.withColumn("reading_ts", to_utc_ntz(F.col("reading_ts"), stream.schema["reading_ts"].dataType))
    started: Future[str] = Future()  # the query's id is known once it has started
    w = (
        latest_changes(typed, keys, order, keep).writeStream.option("checkpointLocation", checkpoint).outputMode("update")
        .foreachBatch(lambda df, bid: _log(df, bid, silver, started.result()))
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    try:
        query = w.start()
    except BaseException as e:
        started.set_exception(e)
        raise
    started.set_result(query.id)
    return query


def _newest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key. Rows without a key are told apart by their place in
    the source: one place is one event, also where it was read twice."""
    order = [c for c in order if c in log.columns]
    place = [c for c in POSITION if c in log.columns]
    columns = [c for c in log.columns if c not in _PARTS]
    lone = F.when(_no_key(keys), F.xxhash64(*(place or columns)))
    by = Window.partitionBy(*keys, "_lone").orderBy(
        *[F.col(c).desc_nulls_last() for c in order], F.xxhash64(*columns).desc()
    )
    return (
        log.withColumn("_lone", lone).withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_lone", "_rn")
    )


def _dates(log: DataFrame) -> dict[str, list[tuple[str, int]]]:
    """The (stream, batch) parts of each date: directories, not rows."""
    out: dict[str, list[tuple[str, int]]] = {}
    for r in log.select(*_PARTS).distinct().collect():
        out.setdefault(str(r[0]), []).append((r[1], r[2]))
    return out


def read_latest(
    spark: SparkSession, silver: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER
) -> DataFrame:
    """The newest row per key of the change log. Only days with changes of
    several batches are compared; the others are read without a shuffle."""
    log = _read_log(spark, silver)
    several = sorted(d for d, parts in _dates(log).items() if len(parts) > 1)
    touched = F.col("reading_date").isin(several)
    both = _newest(log.filter(touched), keys, order).unionByName(log.filter(~touched)) if several else log
    return both.drop("_stream_id", "_batch_id")


def _read_log(spark: SparkSession, silver: str) -> DataFrame:
    log = spark.read.option("mergeSchema", True).parquet(silver)
    return log.withColumns({"reading_date": F.col("reading_date").cast("string"), "_stream_id": F.col("_stream_id").cast("string")})


def compact(
    spark: SparkSession, silver: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, most: int = 1
) -> list[str]:
    """Rewrite the days that more than ``most`` batches wrote as one part
    each, and return them. The new part is complete before the old ones are
    deleted, and a reader between the two sees equal copies, so a compaction
    that breaks off loses and doubles nothing. A stream may go on meanwhile:
    parts that came later stay."""
    log = _read_log(spark, silver)
    old = {d: parts for d, parts in _dates(log).items() if len(parts) > most}
    if not old:
        return []
    number = 1 + max((b for parts in old.values() for s, b in parts if s == "compact"), default=-1)
    listed = None
    for d, parts in old.items():
        own = F.col("reading_date") == d
        known = F.struct("_stream_id", "_batch_id").isin([F.struct(F.lit(s).alias("_stream_id"), F.lit(b).alias("_batch_id")) for s, b in parts])
        listed = own & known if listed is None else listed | (own & known)
    newest = _newest(log.filter(listed), keys, order)
    (
        newest.withColumn("_stream_id", F.lit("compact")).withColumn("_batch_id", F.lit(number).cast("long"))
        .repartition("reading_date", F.pmod(F.xxhash64(*KEYS[:1]), F.lit(16)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTS).parquet(silver)
    )
    paths = spark._jvm.org.apache.hadoop.fs.Path
    for d, parts in old.items():
        for s, b in parts:
            at = paths(f"{silver}/reading_date={d}/_stream_id={s}/_batch_id={b}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return sorted(old)
