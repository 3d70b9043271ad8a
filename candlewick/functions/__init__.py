"""Column-level building blocks (pure expressions, no actions)."""

from candlewick.functions.scalar import (
    activity_score,
    candle_direction,
    epoch_ms_to_ts,
    normalise_symbol,
    percent_change,
    price_change,
    price_range,
    safe_double,
    safe_timestamp,
    strip_unicode,
    to_iso_text,
)

__all__ = [
    "activity_score",
    "candle_direction",
    "epoch_ms_to_ts",
    "normalise_symbol",
    "percent_change",
    "price_change",
    "price_range",
    "safe_double",
    "safe_timestamp",
    "strip_unicode",
    "to_iso_text",
]
