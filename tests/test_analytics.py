"""Analytics on the six-candle table (2 symbols x 3 candles): literal goldens."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from candlewick.functions.scalar import safe_timestamp
from candlewick.operators import derive, rankings, summary

# The six candles whose results are known.
ROWS = [
    ("BTCUSDT", "2026-06-01T00:00:00+00:00", 100.0, 110.0, 90.0, 105.0, 5000.0, 500000.0, 1000),
    ("BTCUSDT", "2026-06-01T01:00:00+00:00", 105.0, 115.0, 100.0, 95.0, 6000.0, 600000.0, 1200),
    ("BTCUSDT", "2026-06-02T00:00:00+00:00", 95.0, 100.0, 90.0, 95.0, 4000.0, 400000.0, 800),
    ("ETHUSDT", "2026-06-01T00:00:00+00:00", 10.0, 11.0, 9.0, 10.5, 20000.0, 200000.0, 500),
    ("ETHUSDT", "2026-06-01T01:00:00+00:00", 10.5, 11.5, 10.0, 9.5, 25000.0, 250000.0, 600),
    ("ETHUSDT", "2026-06-02T00:00:00+00:00", 9.5, 10.0, 9.0, 9.5, 15000.0, 150000.0, 400),
]
SCHEMA = "symbol string, open_time string, open double, high double, low double, close double, volume double, quote_volume double, trade_count bigint"


@pytest.fixture
def table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("open_time", safe_timestamp("open_time"))
    return derive.time_features(derive.derived_columns(df))


def _by_symbol(df, col):
    return {r["symbol"]: r[col] for r in df.collect()}


def test_derived_columns(table):
    rows = table.filter(F.col("symbol") == "BTCUSDT").orderBy("open_time").collect()
    assert [r["price_range"] for r in rows] == [20.0, 15.0, 10.0]
    assert [r["price_change"] for r in rows] == [5.0, -10.0, 0.0]
    assert [r["percent_change"] for r in rows] == pytest.approx([5.0, -9.5238, 0.0], rel=1e-3)
    assert [r["candle_direction"] for r in rows] == ["up", "down", "flat"]


def test_ensure_derived_adds_only_missing(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("price_range", F.lit(-1.0))
    present, missing = derive.derived_status(df)
    assert present == ["price_range"] and missing == ["price_change", "percent_change", "candle_direction"]
    out = derive.ensure_derived(df)
    assert set(out.columns) >= {"price_range", "price_change", "percent_change", "candle_direction"}
    assert out.first()["price_range"] == -1.0  # existing column kept as is


def test_time_features(table):
    row = table.orderBy("symbol", "open_time").first()
    assert row["trade_date"] == dt.date(2026, 6, 1)
    assert row["trade_hour"] == 0
    assert row["day_of_week"] == "Mon"


def test_temp_view_replace_refreshes(spark):
    from candlewick.sources.sinks import register_views

    register_views(spark, {"t_refresh": spark.createDataFrame([("A", 1)], "s string, v int")})
    register_views(spark, {"t_refresh": spark.createDataFrame([("B", 2)], "s string, v int")})
    assert spark.sql("SELECT s FROM t_refresh").first()["s"] == "B"


def test_simple_aggregates(table):
    assert _by_symbol(rankings.avg_close_by_symbol(table), "avg_close") == pytest.approx({"BTCUSDT": 295 / 3, "ETHUSDT": 29.5 / 3})
    assert _by_symbol(rankings.row_count_by_symbol(table), "row_count") == {"BTCUSDT": 3, "ETHUSDT": 3}
    shown = _by_symbol(rankings.avg_volume_by_symbol(table, decimals=2), "avg_volume")
    assert shown == {"BTCUSDT": 5000.0, "ETHUSDT": 20000.0}


def test_volatility_ranking(table):
    out = rankings.volatility_ranking(table)
    assert _by_symbol(out, "avg_price_range") == {"BTCUSDT": 15.0, "ETHUSDT": 1.5}
    assert _by_symbol(out, "volatility_rank") == {"BTCUSDT": 1, "ETHUSDT": 2}
    assert _by_symbol(out, "stddev_price_range")["BTCUSDT"] == pytest.approx(5.0)


def test_activity_ranking(table):
    out = rankings.activity_ranking(table)
    scores = _by_symbol(out, "symbol_activity_score")
    assert scores["BTCUSDT"] == pytest.approx(3000 * math.log(1500001))
    assert scores["ETHUSDT"] == pytest.approx(1500 * math.log(600001))
    assert _by_symbol(out, "symbol_activity_rank") == {"BTCUSDT": 1, "ETHUSDT": 2}


def test_busiest_hour_and_date(table):
    assert rankings.busiest_hour(table).first()["trade_hour"] == 0
    assert rankings.busiest_date(table).first()["trade_date"] == dt.date(2026, 6, 1)
    assert rankings.activity_by_hour(table).count() == 2
    assert rankings.activity_by_date(table).count() == 2
    assert rankings.busiest_hour_by_trades(table).first()["trade_hour"] == 0
    assert rankings.busiest_date_by_quote_volume(table).first()["trade_date"] == dt.date(2026, 6, 1)


def test_market_summary(table):
    out = summary.market_summary(table)
    assert out.columns == summary.SUMMARY_COLUMNS
    rows = {r["symbol"]: r for r in out.collect()}
    assert len(rows) == 2
    btc = rows["BTCUSDT"]
    assert btc["row_count"] == 3 and btc["symbol_activity_rank"] == 1 and btc["volatility_rank"] == 1
    assert (btc["up_count"], btc["down_count"], btc["flat_count"]) == (1, 1, 1)
    top = {r["ranking"]: r["symbol"] for r in summary.top_symbols(out).collect()}
    assert top == {"activity": "BTCUSDT", "volatility": "BTCUSDT"}
    notes = {r["symbol"]: r["interpretation"] for r in summary.summary_interpretation(out).collect()}
    assert notes["BTCUSDT"] == "BTCUSDT: activity #1, volatility #1 (most active) (most volatile)"


def test_summary_equals_a_count_in_python(table, spark):
    """Each figure of the one-pass summary against plain Python over the collected rows (incl. T14, T15)."""
    extra = spark.createDataFrame(
        [("XRPUSDT", "2026-06-03T00:00:00+00:00", None, 1.0, 0.5, 1.0, 10.0, 10.0, 1)], SCHEMA
    ).withColumn("open_time", safe_timestamp("open_time"))
    df = table.unionByName(derive.time_features(derive.derived_columns(extra)))
    groups = {}
    for r in df.collect():
        groups.setdefault(r["symbol"], []).append(r)
    width = {k: sum(r["price_range"] for r in g) / len(g) for k, g in groups.items()}
    trades = {k: sum(r["trade_count"] for r in g) for k, g in groups.items()}
    score = {k: trades[k] * math.log(sum(r["quote_volume"] for r in g) + 1) for k, g in groups.items()}
    moves = {k: [r["percent_change"] for r in g if r["percent_change"] is not None] for k, g in groups.items()}

    def rank(values, k):
        return 1 + sum(v > values[k] for v in values.values())

    got = {r["symbol"]: r for r in summary.market_summary(df).collect()}
    assert set(got) == {k for k, m in moves.items() if m}  # a symbol without any percent_change is left out
    for k, r in got.items():
        assert (r["row_count"], r["total_trades"]) == (len(groups[k]), trades[k])
        assert (r["volatility_rank"], r["symbol_activity_rank"]) == (rank(width, k), rank(score, k))
        assert r["avg_price_range"] == pytest.approx(width[k])
        assert r["avg_percent_change"] == pytest.approx(sum(moves[k]) / len(moves[k]))
        assert r["flat_count"] == sum(c["candle_direction"] == "flat" for c in groups[k])


def test_rounding_is_display_only(table):
    ranked = rankings.volatility_ranking(table, decimals=2)
    assert _by_symbol(ranked, "volatility_rank") == {"BTCUSDT": 1, "ETHUSDT": 2}


def test_profile_shape_preview(table):
    from candlewick.operators import quality

    prof = quality.profile_schema(table).collect()
    assert [r["column_name"] for r in prof] == table.columns
    assert prof[0]["data_type"] == "string"
    shape = quality.table_shape(table).first()
    assert (shape["rows"], shape["columns"]) == (6, len(table.columns))
    first = quality.preview(table, 2, ["symbol", "open_time"]).collect()
    assert [r["price_range"] for r in first] == [20.0, 15.0]


def test_two_avg_volumes_and_direction_totals(spark):
    """Traps T13 / T14: the activity average needs both counters; direction
    counts skip rows without percent_change, so they need not add up to row_count."""
    rows = ROWS[:3] + [("BTCUSDT", "2026-06-02T01:00:00+00:00", None, 100.0, 90.0, 95.0, 9000.0, 900000.0, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("open_time", safe_timestamp("open_time"))
    df = derive.time_features(derive.derived_columns(df))
    plain = rankings.avg_volume_by_symbol(df).first()["avg_volume"]
    active = rankings.activity_ranking(df).first()["avg_volume"]
    assert plain == pytest.approx(6000.0) and active == pytest.approx(5000.0)
    s = summary.market_summary(df).first()
    assert s["row_count"] == 4
    assert s["up_count"] + s["down_count"] + s["flat_count"] == 3  # the NULL-open row has no percent_change
