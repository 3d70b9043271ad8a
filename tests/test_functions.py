"""Scalar expressions and the semantic traps they guard against."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from candlewick.functions import scalar

SYMBOL_CASES = [
    ("  BTCUSDT", "BTCUSDT"),
    ("BTCUSDT ", "BTCUSDT"),
    (" btcusdt ", "BTCUSDT"),
    ("BTC/USDT", "BTCUSDT"),
    (" btc/usdt ", "BTCUSDT"),
    ("  linkusdt  ", "LINKUSDT"),
    ("LINKUSDT", "LINKUSDT"),
]


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", SYMBOL_CASES)
def test_normalise_symbol(spark, raw, expected):
    assert _one(spark, scalar.normalise_symbol, raw) == expected


def test_normalise_symbol_batch_and_unicode_blanks(spark):
    rows = [("\tethusdt\n",), ("\x1cSOL/USDT\x1f",), (" dogeusdt ",), ("BNBUSDT",)]
    out = [r["s"] for r in spark.createDataFrame(rows, "x string").select(scalar.normalise_symbol("x").alias("s")).collect()]
    assert out == ["ETHUSDT", "SOLUSDT", "DOGEUSDT", "BNBUSDT"]  # trap T4: Python strip semantics


@pytest.mark.parametrize(
    "ms,iso",
    [
        (0, "1970-01-01T00:00:00+00:00"),
        (1000, "1970-01-01T00:00:01+00:00"),
        (2000, "1970-01-01T00:00:02+00:00"),
        (-3600000, "1969-12-31T23:00:00+00:00"),
        (1717200000000, "2024-06-01T00:00:00+00:00"),
    ],
)
def test_epoch_ms_to_ts(spark, ms, iso):
    row = spark.createDataFrame([(ms,)], "ms bigint").select(
        scalar.epoch_ms_to_ts("ms").alias("t"), scalar.to_iso_text(scalar.epoch_ms_to_ts("ms")).alias("iso")
    ).first()
    assert row["iso"] == iso
    assert row["t"] == dt.datetime.fromisoformat(iso).replace(tzinfo=None)


def test_iso_text_writes_fraction_only_when_nonzero(spark):
    df = spark.createDataFrame([("2026-06-01T00:59:59.999+00:00",), ("2026-06-01T00:00:00+00:00",)], "s string")
    out = [r["iso"] for r in df.select(scalar.to_iso_text(scalar.safe_timestamp("s")).alias("iso")).collect()]
    assert out == ["2026-06-01T00:59:59.999000+00:00", "2026-06-01T00:00:00+00:00"]


@pytest.mark.parametrize(
    "text,expected",
    [
        (" 5 ", 5.0), ("1e5", 1e5), ("-999", -999.0), (".5", 0.5), ("+2.50", 2.5), ("12.", 12.0),
        # trap T2: Spark's own cast would accept these
        ("1d", None), ("2f", None), ("0x1p3", None), ("Infinity", None), ("NaN", None),
        ("1,000", None), ("true", None), ("", None), ("not_available", None), (None, None),
    ],
)
def test_safe_double(spark, text, expected):
    assert _one(spark, scalar.safe_double, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2026-06-01T00:00:00+00:00", dt.datetime(2026, 6, 1)),
        ("2026-06-01 05:30:00+02:00", dt.datetime(2026, 6, 1, 3, 30)),
        ("2026-06-01T00:59:59.999000+00:00", dt.datetime(2026, 6, 1, 0, 59, 59, 999000)),
        ("2026-06-01T10:00:00Z", dt.datetime(2026, 6, 1, 10)),
        ("2026-06-01 10:00", dt.datetime(2026, 6, 1, 10)),
        # trap T3: date-only / time-only / impossible dates are missing
        ("2026", None), ("2026-06", None), ("12:00", None), ("1900-99-99", None),
        ("2026-13-01T00:00:00", None), ("not_a_date", None), ("missing_time", None), ("", None),
    ],
)
def test_safe_timestamp(spark, text, expected):
    assert _one(spark, scalar.safe_timestamp, text) == expected


def test_percent_change_zero_open_is_null(spark):
    # trap T5: ANSI division by zero raises; the operator yields NULL instead
    df = spark.createDataFrame([(0.0, 5.0), (100.0, 105.0), (None, 1.0)], "open double, close double")
    out = [r["p"] for r in df.select(scalar.percent_change().alias("p")).collect()]
    assert out[0] is None and out[1] == pytest.approx(5.0) and out[2] is None


def test_direction_flat_when_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, None)], "open double, close double")
    assert [r["d"] for r in df.select(scalar.candle_direction().alias("d")).collect()] == ["up", "down", "flat", "flat", "flat"]


def test_activity_score_natural_log(spark):
    df = spark.createDataFrame([(3000.0, 1500000.0), (1500.0, 600000.0), (10.0, -5.0)], "t double, q double")
    out = [r["s"] for r in df.select(scalar.activity_score("t", "q").alias("s")).collect()]
    assert out[0] == pytest.approx(3000 * math.log(1500001))
    assert out[1] == pytest.approx(1500 * math.log(600001))
    assert out[2] is None  # trap T6: log of a non-positive number is NULL
    assert out[0] > out[1]
