"""Incremental ingest with Structured Streaming.

The reference collects candles in one batch.  When events or payload files
keep landing, the same stage runs incrementally:

* ``stream_candles`` -- event files -> hourly candles, a windowed aggregation
  with a watermark, so a candle is emitted once (append mode) when no more
  events can arrive for it and its state is then dropped;
* ``stream_klines`` -- landed payload files -> decoded candles;
  ``start_klines_to_parquet`` appends those that the stored table does not hold
  yet, so a payload delivered twice, however late, counts its candles once and no
  candle of a late payload is lost.  There is no state to keep: each trigger is
  compared with the stored candles of its own time range.

Both reuse the batch expressions.  Checkpoints go to the shared folder named
by ``spark.checkpoint.dir`` (see ``session.checkpoint_dir``), so a restarted
query or a lost executor resumes from committed offsets and state.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.schema import FIELDNAMES
from candlewick.sources.sinks import write_by_date
from candlewick.session import checkpoint_dir, ensure_session_defaults
from candlewick.sources.events import INTERVALS, bar_aggregates, finish_bars, symbol_from_event_type
from candlewick.sources.klines import decode_klines

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def stream_candles(
    spark: SparkSession,
    events_path: str,
    unit: str = "hour",
    lateness: str = "1 hour",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming candles from an event-file folder (parquet)."""
    ensure_session_defaults(spark)
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(events_path)
    _, length = INTERVALS[unit]
    bucket = length.replace("INTERVAL ", "").lower()
    # event-time operators need a zoned TIMESTAMP; with the session zone
    # pinned to UTC the cast keeps the same instant
    events = events.withColumn("_event_time", F.col("ts").cast("timestamp"))
    bars = (
        events.withWatermark("_event_time", lateness)
        .groupBy(symbol_from_event_type("event_type").alias("symbol"), F.window("_event_time", bucket).alias("_w"))
        .agg(*bar_aggregates())
        .withColumn("open_time", F.col("_w.start").cast("timestamp_ntz"))
        .drop("_w")
    )
    return finish_bars(bars, unit)


def stream_klines(spark: SparkSession, landing_path: str, interval: str = "1h") -> DataFrame:
    """Streaming decode of landed payload files (``<SYMBOL>.json``), copies included."""
    ensure_session_defaults(spark)
    raw = spark.readStream.option("wholetext", True).text(landing_path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    payloads = raw.select(F.upper(name).alias("symbol"), F.lit(interval).alias("interval"), F.col("value").alias("payload"))
    return decode_klines(payloads)


def new_candles(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Candles of ``batch`` whose key ``stored`` does not hold, one row a key.

    Of copies with one key the stored one stays.  Rows without an open time are copies
    only if all their cells are equal.
    """
    key = ["symbol", "interval", "open_time", "_cells"]
    cells = F.when(F.col("open_time").isNull(), F.to_json(F.struct(*FIELDNAMES)))
    first, last = batch.agg(F.min("open_time"), F.max("open_time")).first()
    held = stored.where(F.col("open_time").between(first, last) | F.col("open_time").isNull())
    if "trade_date" in stored.columns:  # only the folders of the batch's dates are read
        held = held.where(F.col("trade_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))) | F.col("trade_date").isNull())
    held = held.withColumn("_cells", cells).select(*[F.col(c).alias(f"_held_{c}") for c in key])
    fresh = batch.withColumn("_cells", cells).dropDuplicates(key)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in key])
    return fresh.join(held, same, "left_anti").drop("_cells")


def start_klines_to_parquet(stream: DataFrame, output_path: str, name: str, trigger_available_now: bool = True) -> StreamingQuery:
    """Append each trigger's new candles to ``output_path``, in a folder ``batch_id=N`` of its
    own, by ``trade_date``.

    A trigger is decoded once and compared with the stored candles of its own dates.  One
    that is run again after a failure replaces its folder and is compared only with the
    folders of earlier triggers, so its result is the same.
    """
    spark = stream.sparkSession
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # an empty frame makes the folder, so the first trigger can read it
        batch.limit(0).write.mode("append").parquet(output_path)
        stored = session.read.schema(f"{columns}, batch_id BIGINT, trade_date DATE").parquet(output_path)
        batch = batch.persist()
        try:
            fresh = new_candles(batch, stored.where(F.col("batch_id") < batch_id))
            write_by_date(fresh, os.path.join(output_path, f"batch_id={batch_id}"), replace_all=True)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()


def start_to_parquet(stream: DataFrame, output_path: str, name: str, trigger_available_now: bool = True) -> StreamingQuery:
    """Append the stream to a parquet folder with a checkpoint in the shared checkpoint dir."""
    spark = stream.sparkSession
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start(output_path)
