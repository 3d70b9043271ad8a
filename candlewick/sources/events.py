"""Candle source built from a raw trade/event stream.

The reference downloads ready-made candles; here the same table is produced
from an event log with one aggregation: group by (symbol, time bucket).  The
aggregation is fully partial-able (min_by/max_by/sum/count are declarative
aggregates), so every map task pre-aggregates its rows before the shuffle and
a hot symbol costs one row per task and bucket, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalar import exact_sum

# unit understood by date_trunc -> (interval label, bucket length)
INTERVALS = {
    "minute": ("1m", "INTERVAL 1 MINUTE"),
    "hour": ("1h", "INTERVAL 1 HOUR"),
    "day": ("1d", "INTERVAL 1 DAY"),
}


def event_order_key(ts: str, event_id: str) -> F.Column:
    """(ts, event_id) packed into one DECIMAL(38,0) that sorts the same way.

    min_by/max_by over a struct key force a SortAggregate (struct buffers are
    not mutable in the hash map); a single decimal key keeps both phases in
    HashAggregate.  micros * 10^20 + (event_id + 2^63): event_id shifted to be
    non-negative and < 10^20, micros of years 0001-9999 keep the sum < 10^38.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(38,0)")
    shifted_id = F.col(event_id).cast("decimal(38,0)") + F.expr("CAST(9223372036854775808 AS DECIMAL(38,0))")
    return micros * F.expr("CAST(100000000000000000000 AS DECIMAL(38,0))") + shifted_id


def symbol_from_event_type(c) -> F.Column:
    """'click' -> 'CLICKUSDT': event types become ticker-like symbols."""
    return F.concat(F.upper(F.col(c) if isinstance(c, str) else c), F.lit("USDT"))


def bar_aggregates() -> list[F.Column]:
    """Aggregates of one candle over its events (shared by batch and streaming)."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    taker = (F.col("user_id") % 2) == 0
    first_last = event_order_key("ts", "event_id")
    return [
        F.min("event_id").alias("row_id"),
        F.min_by("value", first_last).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", first_last).alias("close"),
        F.sum(k).alias("_volume"),
        exact_sum("value").alias("_quote"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(taker, k)).alias("_taker_base"),
        exact_sum(F.when(taker, F.col("value"))).alias("_taker_quote"),
    ]


def finish_bars(bars: DataFrame, unit: str = "hour") -> DataFrame:
    """Aggregated bars (symbol, open_time, aggregates) -> the candle columns."""
    label, length = INTERVALS[unit]
    return bars.select(
        "row_id",
        "symbol",
        F.lit(label).alias("interval"),
        "open_time",
        "open",
        "high",
        "low",
        "close",
        F.col("_volume").cast("double").alias("volume"),
        (F.col("open_time") + F.expr(length) - F.expr("INTERVAL 1 MILLISECOND")).alias("close_time"),
        F.col("_quote").cast("double").alias("quote_volume"),
        "trade_count",
        F.coalesce(F.col("_taker_base"), F.lit(0)).cast("double").alias("taker_buy_base_volume"),
        F.coalesce(F.col("_taker_quote"), F.lit(0)).cast("double").alias("taker_buy_quote_volume"),
    )


def candles_from_events(events: DataFrame, unit: str = "hour") -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> candles.

    One row per (symbol, bucket): open/close are the first/last value by
    (ts, event_id); high/low the extremes; volume the sum of ``props.k``;
    quote_volume the sum of value; trade_count the event count.
    The generator has no trade side, so events of even ``user_id`` stand in for
    taker-buy trades.  ``row_id`` = min(event_id) is a stable unique candle id.
    """
    bars = (
        events.select("event_id", "ts", "user_id", "event_type", "value", "props")
        .groupBy(
            symbol_from_event_type("event_type").alias("symbol"),
            F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("open_time"),
        )
        .agg(*bar_aggregates())
    )
    return finish_bars(bars, unit)


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")
