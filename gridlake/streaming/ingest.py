"""Stream -> Bronze append and latest-wins Silver upsert.

Without a table format that has MERGE, the upsert runs in ``foreachBatch``:

1. the micro-batch lands in Bronze partitioned by (``reading_date``,
   ``_stream_id``, ``_batch_id``) with dynamic partition overwrite, so a
   replayed batch id replaces its own files and adds nothing. The stream id is
   the query's id, which lives in its checkpoint: another stream, or the same
   one after its checkpoint was lost, never replaces what is there;
2. only the Silver ``reading_date`` partitions the batch touched are rebuilt
   from those Bronze date directories with the keep-latest dedupe (W1) and
   dynamically overwritten. The cost of a batch is the volume of the days it
   touches (a table format with MERGE would make it the batch's own size).

Rows of one batch share their ingest time; among them the position in the
source decides (file time, file, place in it; or broker time, partition,
offset), so a later copy wins.

Silver is never read while it is being overwritten (it is rebuilt from
Bronze), and the result equals a one-shot batch dedupe of everything
ingested. Offsets and the batch id live in the query checkpoint, which must
be in a shared folder (``spark.checkpoint.dir`` on a cluster).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from gridlake.functions.time import to_utc_ntz
from gridlake.operators.dedupe import keep_first
from gridlake.sources.bronze import DAY, with_day
from gridlake.sources.sinks import to_event_payload


def read_events(
    spark: SparkSession,
    path: str | None,
    schema: StructType,
    fmt: str = "json",
    files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """T2 source: a stream of reading events with a declared schema, stamped
    with ``_ingested_at`` and the event's position in its source (POSITION).
    A micro-batch is bounded by ``bytes_per_trigger`` or ``files_per_trigger``. ``fmt='json'`` (or any file format) reads files
    under ``path``; ``fmt='kafka'`` reads a topic given in ``options``
    (``kafka.bootstrap.servers``, ``subscribe``; needs the connector on the
    classpath) and decodes each message's JSON ``value``."""
    r = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        return stamp(decode_events(r.load(), schema))
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", bytes_per_trigger)
    if fmt == "json":
        schema = StructType([*schema.fields, StructField(RAW, StringType())])
        r = r.option("columnNameOfCorruptRecord", RAW)
    events = r.schema(schema).load(path)
    return stamp(events.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_source_time"),
        F.col("_metadata.file_path").alias("_source"),
        F.col("_metadata.file_block_start").alias("_source_at"),
    ))


#: Text of a message that is no event of the schema (NULL for others).
RAW = "_raw"
#: Where an event stands in its source; later positions are newer.
POSITION = ("_source_time", "_source", "_source_at", "_source_seq")


def decode_events(raw: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Message-bus rows (binary or string ``value`` holding one JSON event)
    -> typed event columns. A message that is not valid JSON for the schema
    gives a row of NULLs with its text in ``_raw``, so nothing is lost. The
    broker's time, partition and offset, where the rows have them, become the
    position columns."""
    wide = StructType([*schema.fields, StructField(RAW, StringType())])
    event = F.from_json(F.col(value).cast("string"), wide, {"columnNameOfCorruptRecord": RAW})
    place = []
    if {"timestamp", "partition", "offset"} <= set(raw.columns):
        place = [
            F.col("timestamp").alias("_source_time"),
            F.concat_ws("-", "topic", F.lpad(F.col("partition").cast("string"), 10, "0")).alias("_source")
            if "topic" in raw.columns else F.lpad(F.col("partition").cast("string"), 10, "0").alias("_source"),
            F.col("offset").alias("_source_at"),
        ]
    return raw.select(event.alias("_e"), *place).select("_e.*", *[c for c in POSITION[:3] if place])


def stamp(events: DataFrame) -> DataFrame:
    """Add the ingest time that orders re-deliveries (latest wins)."""
    return events.withColumn("_ingested_at", F.current_timestamp())


def append_bronze(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by_day: bool = False
) -> StreamingQuery:
    """T2 sink: append raw rows unchanged (plus ingest time) to Bronze;
    ``by_day`` puts them in one folder per reading day (``sources.bronze``)."""
    w = (with_day(stream) if by_day else stream).writeStream.format(fmt)
    if by_day:
        w = w.partitionBy(DAY)
    return (
        w.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def _reading_date(ts):
    return F.coalesce(F.to_date(ts).cast("string"), F.lit("unparsed"))


def upsert_latest_batch(
    batch: DataFrame,
    batch_id: int,
    bronze: str,
    silver: str,
    keys: Sequence[str] = ("meter_id", "reading_ts"),
    order: Sequence[str] = ("_ingested_at", *POSITION),
    stream_id: str = "batch",
) -> None:
    """One micro-batch of the latest-wins upsert (see module doc)."""
    spark = batch.sparkSession
    # the place within the file block a task reads, in the order it reads it
    landed = (
        batch.withColumn("_source_seq", F.monotonically_increasing_id())
        .withColumn("reading_ts", to_utc_ntz(F.col("reading_ts"), batch.schema["reading_ts"].dataType))
        .withColumn("reading_date", _reading_date(F.col("reading_ts")))
        .withColumn("_stream_id", F.lit(stream_id))
        .withColumn("_batch_id", F.lit(batch_id).cast("long"))
    )
    # The dates this batch touches, gathered while it is written: a handful of
    # values per micro-batch (bounded by the trigger, not by the data).
    seen = Observation()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        landed.observe(seen, F.collect_set("reading_date").alias("dates"))
        .repartitionByRange(n, "reading_date", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reading_date", "_stream_id", "_batch_id")
        .parquet(bronze)
    )
    touched = seen.get["dates"]
    if not touched:
        return
    # Bronze is laid out date first, so the rebuild lists and reads only the
    # touched dates' directories (every batch that ever landed rows there),
    # never the whole Bronze history.
    paths = [f"{bronze}/reading_date={d}" for d in touched]
    history = (
        spark.read.option("basePath", bronze)
        .option("mergeSchema", True)
        .parquet(*paths)
        .drop("reading_date", "_stream_id", "_batch_id")
        .withColumn("reading_date", _reading_date(F.col("reading_ts")))
    )
    order = [c for c in order if c in history.columns]
    latest = keep_first(history, list(keys), [F.col(c).desc_nulls_last() for c in order])
    (
        latest.repartitionByRange(n, "reading_date", *keys)
        .sortWithinPartitions("reading_date", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reading_date")
        .parquet(silver)
    )


def upsert_latest(
    stream: DataFrame,
    bronze: str,
    silver: str,
    checkpoint: str,
    keys: Sequence[str] = ("meter_id", "reading_ts"),
    order: Sequence[str] = ("_ingested_at", *POSITION),
    available_now: bool = True,
) -> StreamingQuery:
    """Start the T3 stream (``availableNow`` drains what is there and stops)."""
    started: Future[str] = Future()  # the query's id is known once it has started
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, bid: upsert_latest_batch(df, bid, bronze, silver, keys, order, started.result())
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    try:
        query = w.start()
    except BaseException as e:
        started.set_exception(e)
        raise
    started.set_result(query.id)
    return query


def publish(
    df: DataFrame,
    path: str | None,
    drop_col: str | None = None,
    batch_size: int | None = None,
    order: Sequence[str] = (),
    fmt: str = "json",
    options: dict[str, str] | None = None,
    key: str = "meter_id",
) -> None:
    """Replay stored readings as events.

    ``fmt='json'`` writes JSON event files under ``path``: with ``drop_col``
    one folder per value of it (one "drop" each), written in one job. A large
    drop is split over several files by ``key``, so all events of a key are in
    one file, there in ``order``. With
    ``batch_size`` no file holds more than that many events (the sender's
    batch), so a file stream with ``maxFilesPerTrigger`` replays them batch
    by batch. ``fmt='kafka'`` sends each row as one JSON message keyed by
    ``key`` to the topic in ``options`` (``kafka.bootstrap.servers``,
    ``topic``; needs the connector on the classpath); the producer batches.
    """
    if fmt == "kafka":
        w = to_event_payload(df, key).write.format("kafka")
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
        return
    writer_df = df
    if drop_col:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        writer_df = df.repartitionByRange(n, drop_col, key).sortWithinPartitions(drop_col, *order)
    w = writer_df.write.mode("overwrite")
    if batch_size:
        w = w.option("maxRecordsPerFile", batch_size)
    if drop_col:
        w = w.partitionBy(drop_col)
    w.format(fmt).save(path)
