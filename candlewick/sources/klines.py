"""Raw kline payloads: JSON arrays of positional arrays.

A payload is what the market-data endpoint returns for one symbol:
``[[openTime, "open", "high", "low", "close", "volume", closeTime,
"quoteVolume", trades, "takerBase", "takerQuote", ...], ...]`` with epoch-ms
times and numbers given either as JSON numbers or as strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.scalar import epoch_ms_to_ts
from candlewick.schema import FIELDNAMES, INTERVAL

# Position of each field inside one kline record (fixed by the payload format).
KLINE_POSITIONS = {
    "open_time": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "close_time": 6,
    "quote_volume": 7,
    "trade_count": 8,
    "taker_buy_base_volume": 9,
    "taker_buy_quote_volume": 10,
}

#: Milliseconds beyond this do not fit a timestamp in microseconds.
MAX_EPOCH_MS = 9_000_000_000_000_000


def _records(payload_col: str) -> F.Column:
    return F.from_json(F.col(payload_col), "array<array<string>>")


#: What became of a record: all cells read, some cells NULL, no candle; or the payload
#: itself could not be read.
WHOLE, CELLS, RECORD, PAYLOAD = "whole", "cells", "record", "payload"


def decode_tagged(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """(symbol, interval, payload) -> the 13 candle columns, ``tag``, ``cells``, ``content``.

    The payload is parsed once, as ARRAY<ARRAY<STRING>> (both number and string elements
    stay text); each element is then cast by position.  One row a record:

    * ``whole``: every cell was read; ``content`` is NULL;
    * ``cells``: a candle, but the columns listed in ``cells`` are absent or could not be
      read and are NULL;
    * ``record``: no candle, as it is null or has a time that can't be read (out of range,
      not a whole number); a time that is absent is a cell like any other;
    * ``payload``: no JSON array of arrays; one row for the whole payload.

    ``content`` holds the record or payload as it came.  A partitioned write by ``tag``
    routes candles and rejects from this one parse.
    """
    parsed = payloads.select("symbol", "interval", F.col(payload_col).alias("_p"), _records(payload_col).alias("_rs"))
    unread = F.array(F.lit(None).cast("array<string>"))
    records = parsed.select(
        "symbol", "interval", F.col("_rs").isNull().alias("_bad"), F.when(F.col("_rs").isNull(), F.col("_p")).alias("_p"),
        F.explode(F.coalesce("_rs", unread)).alias("_r"),
    )

    def at(name: str) -> F.Column:
        return F.get(F.col("_r"), F.lit(KLINE_POSITIONS[name]))

    def stamp(name: str) -> F.Column:
        ms = at(name).try_cast("bigint")
        return epoch_ms_to_ts(F.when(F.abs(ms) <= MAX_EPOCH_MS, ms))

    typed = {"open_time": stamp("open_time"), "close_time": stamp("close_time"), "trade_count": at("trade_count").try_cast("bigint")}
    for name in ("open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"):
        typed[name] = at(name).try_cast("double")
    times = [at("open_time").alias("_open"), at("close_time").alias("_close")]
    rows = records.select("symbol", "interval", "_bad", "_p", "_r", *times, *[c.alias(name) for name, c in typed.items()])
    missing = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in FIELDNAMES if name in typed]))
    lost = F.col("_r").isNull() | (F.col("open_time").isNull() & F.col("_open").isNotNull()) | (F.col("close_time").isNull() & F.col("_close").isNotNull())
    tag = F.when(F.col("_bad"), PAYLOAD).when(lost, RECORD).when(F.size(missing) > 0, CELLS).otherwise(WHOLE)
    content = F.when(F.col("_bad"), F.col("_p")).when(tag != WHOLE, F.to_json("_r"))
    return rows.select(*FIELDNAMES, tag.alias("tag"), F.when(tag.isin(CELLS, RECORD), missing).alias("cells"), content.alias("content"))


def decoded_candles(tagged: DataFrame) -> DataFrame:
    """The candles of ``decode_tagged`` (or of what was written from it)."""
    return tagged.where(F.col("tag").isin(WHOLE, CELLS)).select(*FIELDNAMES)


def decoded_rejects(tagged: DataFrame) -> DataFrame:
    """(symbol, interval, reason, cells, content) of all that was not read whole."""
    reason = F.when(F.col("tag") == PAYLOAD, PAYLOAD).otherwise(RECORD)
    return tagged.where(F.col("tag") != WHOLE).select("symbol", "interval", reason.alias("reason"), "cells", "content")


def decode_klines(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """(symbol, interval, payload) -> one typed candle row per record.

    An element that is absent or is no number becomes NULL.  A record whose times can't be
    read is no candle; ``kline_rejects`` lists it, and every cell that was not read.
    """
    return decoded_candles(decode_tagged(payloads, payload_col))


def kline_rejects(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """(symbol, interval, reason, cells, content) of what ``decode_klines`` could not read whole.

    A payload that is no JSON array of arrays is returned as it came; it gives no candle.
    A record with unread cells is returned by itself, with the names of these cells.
    """
    return decoded_rejects(decode_tagged(payloads, payload_col))


def scan_kline_files(spark: SparkSession, path: str, interval: str = INTERVAL) -> DataFrame:
    """Landed payload files, one JSON payload per file named ``<SYMBOL>.json``.

    Each file is read whole (a payload is one JSON document) and the symbol
    is taken from the file name.
    """
    raw = spark.read.option("wholetext", True).text(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    return raw.select(F.upper(name).alias("symbol"), F.lit(interval).alias("interval"), F.col("value").alias("payload"))


def encode_klines(candles: DataFrame, limit: int = 1000, interval_ms: int = 3_600_000) -> DataFrame:
    """Candles -> payload rows, the inverse of ``decode_klines``.

    Like the endpoint, a payload holds at most ``limit`` consecutive records:
    candles are grouped by (symbol, interval, block of ``limit`` intervals),
    so the ``collect_list`` behind each payload row is bounded by ``limit``
    (plus any repeated copies of a candle), never by the size of the table.
    """
    open_ms = F.unix_millis(F.col("open_time").cast("timestamp"))
    rec = F.array(
        open_ms.cast("string"),
        *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        F.unix_millis(F.col("close_time").cast("timestamp")).cast("string"),
        F.col("quote_volume").cast("string"),
        F.col("trade_count").cast("bigint").cast("string"),
        F.col("taker_buy_base_volume").cast("string"),
        F.col("taker_buy_quote_volume").cast("string"),
    )
    block = F.floor(open_ms / F.lit(limit * interval_ms)).alias("block")
    grouped = candles.groupBy("symbol", "interval", block).agg(
        F.sort_array(F.collect_list(F.struct(F.col("open_time").alias("k"), rec.alias("r")))).alias("_rs")
    )
    return grouped.select("symbol", "interval", "block", F.to_json(F.transform("_rs", lambda s: s["r"])).alias("payload"))
