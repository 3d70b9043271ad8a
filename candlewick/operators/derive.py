"""Derived price columns and calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions import scalar
from candlewick.schema import DERIVED_COLS


def _derived_exprs() -> dict:
    return {
        "price_range": scalar.price_range(),
        "price_change": scalar.price_change(),
        "percent_change": scalar.percent_change(),
        "candle_direction": scalar.candle_direction(),
    }


def derived_columns(df: DataFrame) -> DataFrame:
    """Add (or replace) price_range, price_change, percent_change, candle_direction."""
    return df.withColumns(_derived_exprs())


def derived_status(df: DataFrame) -> tuple[list[str], list[str]]:
    """(already present, missing) derived columns -- a schema check, no job."""
    present = [c for c in DERIVED_COLS if c in df.columns]
    return present, [c for c in DERIVED_COLS if c not in df.columns]


def ensure_derived(df: DataFrame) -> DataFrame:
    """Add only the derived columns that are missing; existing ones are kept as they are."""
    _, missing = derived_status(df)
    exprs = _derived_exprs()
    return df.withColumns({c: exprs[c] for c in missing}) if missing else df


def time_features(df: DataFrame, ts_col: str = "open_time") -> DataFrame:
    """trade_date, trade_hour, day_of_week ('Mon'...) of a UTC wall-clock timestamp."""
    ts = F.col(ts_col)
    return df.withColumns(
        {
            "trade_date": F.to_date(ts),
            "trade_hour": F.hour(ts),
            "day_of_week": F.date_format(ts, "E"),
        }
    )
