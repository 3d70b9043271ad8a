"""Column names, types and the fixed domain values of the candle data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (column names and order,
# column groups, defect tokens, default market parameters).
# ---------------------------------------------------------------------------
SYMBOLS = [
    "BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT",
    "ADAUSDT", "DOGEUSDT", "AVAXUSDT", "LINKUSDT", "DOTUSDT",
]
INTERVAL = "1h"
LIMIT = 1000
RATE_LIMIT = 100
RATE_WINDOW_SECONDS = 60
MAX_WORKERS = 5

FIELDNAMES = [
    "symbol", "interval", "open_time", "open", "high", "low", "close",
    "volume", "close_time", "quote_volume", "trade_count",
    "taker_buy_base_volume", "taker_buy_quote_volume",
]
NUMERIC_COLS = [
    "open", "high", "low", "close",
    "volume", "quote_volume", "trade_count",
    "taker_buy_base_volume", "taker_buy_quote_volume",
]
TIME_COLS = ["open_time", "close_time"]
VOLUME_COLS = ["volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]

NUMERIC_TEXT_TOKENS = ["not_available", "error", "missing", "unknown"]
INVALID_TIME_TOKENS = ["not_a_date", "1900-99-99", "missing_time"]

DERIVED_COLS = ["price_range", "price_change", "percent_change", "candle_direction"]
TIME_FEATURE_COLS = ["trade_date", "trade_hour", "day_of_week"]
# ---------------------------------------------------------------------------

# ``interval`` is a SQL keyword in most engines; the column is kept under the
# reference's name in files and renamed only where SQL text needs it.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FIELDNAMES])

CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("interval", T.StringType(), True),
        T.StructField("open_time", T.TimestampNTZType(), True),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("volume", T.DoubleType(), True),
        T.StructField("close_time", T.TimestampNTZType(), True),
        T.StructField("quote_volume", T.DoubleType(), True),
        T.StructField("trade_count", T.DoubleType(), True),
        T.StructField("taker_buy_base_volume", T.DoubleType(), True),
        T.StructField("taker_buy_quote_volume", T.DoubleType(), True),
    ]
)

CLEANED_SCHEMA = T.StructType(
    CANDLE_SCHEMA.fields
    + [
        T.StructField("price_range", T.DoubleType(), True),
        T.StructField("price_change", T.DoubleType(), True),
        T.StructField("percent_change", T.DoubleType(), True),
        T.StructField("candle_direction", T.StringType(), True),
    ]
)
