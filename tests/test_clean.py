"""Injector -> cleaner on a clean 10-symbol table; trap tests for the cleaner."""

import pytest
from pyspark.sql import functions as F

from candlewick.operators import clean, defects, quality, sample
from candlewick.schema import FIELDNAMES, SYMBOLS

DAYS = 40


@pytest.fixture(scope="module")
def candles(spark):
    """A saw-tooth market: each symbol has its own level and a period of seven days."""
    market = spark.createDataFrame(list(enumerate(SYMBOLS)), "nr long, symbol string")
    day = F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1))).alias("day")
    level = F.col("nr") * 37.5 + 12.25
    step = (F.col("day") % 7 - 3) * 0.25
    traded = (F.col("day") * 13 + F.col("nr") * 5 + 40).cast("double")
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("day"))
    return market.select("nr", "symbol", day).select(
        (F.col("nr") * DAYS + F.col("day")).alias("row_id"),
        "symbol",
        F.lit("1h").alias("interval"),
        start.alias("open_time"),
        level.alias("open"),
        (level + F.abs(step) + 0.125).alias("high"),
        (level - F.abs(step) - 0.125).alias("low"),
        (level + step).alias("close"),
        traded.alias("volume"),
        (start + F.expr("INTERVAL 1 HOUR") - F.expr("INTERVAL 1 MILLISECOND")).alias("close_time"),
        (traded * level).alias("quote_volume"),
        (F.col("day") + 1).cast("bigint").alias("trade_count"),
        (traded / 4).alias("taker_buy_base_volume"),
        (traded * level / 4).alias("taker_buy_quote_volume"),
    )


@pytest.fixture(scope="module")
def messy(candles):
    return defects.inject_defects(candles, seed=42).cache()


def test_messy_is_text_with_reference_columns(messy):
    assert messy.columns == FIELDNAMES
    assert all(t == "string" for _, t in messy.dtypes)


def test_injector_counters_positive_and_consistent(candles, messy):
    counters = {r["metric"]: r["value"] for r in defects.defect_summary(candles, seed=42).collect()}
    assert counters["original_rows"] == len(SYMBOLS) * DAYS
    for k in ("dropped_rows", "duplicated_rows", "missing_values", "text_in_numeric_columns", "invalid_times", "inconsistent_symbols", "negative_volumes"):
        assert counters[k] > 0, k
    assert counters["final_rows"] == counters["original_rows"] - counters["dropped_rows"] + counters["duplicated_rows"]
    assert counters["final_rows"] == messy.count()


def test_injector_is_repeatable_and_seeded(candles, messy):
    again = defects.inject_defects(candles, seed=42)
    other = defects.inject_defects(candles, seed=7)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, messy.collect()), key=str)
    assert sorted(map(tuple, other.collect()), key=str) != sorted(map(tuple, messy.collect()), key=str)


def test_clean_properties(messy):
    cleaned = clean.clean_candles(messy)
    assert cleaned.columns == FIELDNAMES + ["price_range", "price_change", "percent_change", "candle_direction"]
    types = dict(cleaned.dtypes)
    assert types["open"] == "double" and types["trade_count"] == "double" and types["open_time"] == "timestamp_ntz"
    symbols = {r["symbol"] for r in cleaned.select("symbol").distinct().collect()}
    assert symbols <= set(SYMBOLS)
    assert quality.duplicate_count(cleaned).first()["duplicate_rows"] == 0
    assert quality.impossible_counts(cleaned).first()["impossible_rows"] == 0
    bad = cleaned.filter(
        (F.abs(F.col("price_range") - (F.col("high") - F.col("low"))) > 1e-9)
        | (F.abs(F.col("price_change") - (F.col("close") - F.col("open"))) > 1e-9)
    )
    assert bad.count() == 0


def test_injected_at_least_detected(candles, messy):
    counters = {r["metric"]: r["value"] for r in defects.defect_summary(candles, seed=42).collect()}
    report = {r["metric"]: r["value"] for r in quality.dq_report(messy).collect()}
    assert report["rows_before"] == counters["final_rows"]
    assert report["invalid_numeric_cells"] <= counters["text_in_numeric_columns"] + counters["negative_volumes"]
    assert report["invalid_timestamp_cells"] <= counters["invalid_times"]
    assert report["duplicates_found"] <= counters["duplicated_rows"]
    assert report["rows_after"] == clean.clean_candles(messy).count()


def test_dq_report_matches_individual_measures(messy):
    report = {r["metric"]: r["value"] for r in quality.dq_report(messy).collect()}
    typed = clean.coerce_and_normalise(messy)
    deduped = clean.drop_duplicates(typed)
    cleaned = clean.clean_candles(messy)
    assert report["duplicates_found"] == quality.duplicate_count(typed).first()["duplicate_rows"]
    imp = quality.impossible_counts(deduped).first()
    assert report["dropped_impossible"] == imp["impossible_rows"]
    assert report["negative_volume"] == imp["negative_volume"]
    missing_after = sum(r["missing_count"] for r in quality.missing_by_column(cleaned).collect())
    assert report["missing_after"] == missing_after
    missing_before = sum(r["missing_count"] for r in quality.missing_by_column(messy).collect())
    assert report["missing_before"] == missing_before
    invalid = {r["column_name"]: r["invalid_count"] for r in quality.invalid_by_column(messy).collect()}
    assert report["invalid_timestamp_cells"] == invalid["open_time"] + invalid["close_time"]


def test_missing_by_column_flags_first_max(spark):
    df = spark.createDataFrame([(None, None, 1), (None, None, None), (1, 2, 3)], "a int, b int, c int")
    rows = {r["column_name"]: (r["missing_count"], r["most_affected"]) for r in quality.missing_by_column(df).collect()}
    assert rows == {"a": (2, True), "b": (2, False), "c": (1, False)}


def test_null_comparisons_keep_row(spark):
    # trap T8: NOT(NULL < 0) would drop the row in plain SQL; pandas keeps it
    df = spark.createDataFrame(
        [(None, 1.0, 2.0, 1.0), (-1.0, 1.0, 2.0, 1.0), (1.0, None, 1.0, 2.0), (1.0, 1.0, None, None)],
        "volume double, trade_count double, high double, low double",
    )
    assert clean.drop_impossible(df).count() == 2


def test_only_volume_rule_by_default(spark):
    # trap T12: negative quote volume survives the parity rule
    df = spark.createDataFrame([(1.0, 1.0, 2.0, 1.0, -5.0, 1.0, 1.0)], "volume double, trade_count double, high double, low double, quote_volume double, taker_buy_base_volume double, taker_buy_quote_volume double")
    assert clean.drop_impossible(df).count() == 1
    assert clean.drop_impossible(df, rule="all_volumes").count() == 0


def test_exact_dedup_keeps_nulls_equal(spark):
    df = spark.createDataFrame([("A", None), ("A", None), ("A", "x")], "s string, v string")
    assert clean.drop_duplicates(df).count() == 2


def test_dedup_by_candle_key_prefers_complete_copy(spark):
    # trap T7: two copies of one candle, one corrupted -> exact de-dup keeps both
    df = spark.createDataFrame(
        [("BTCUSDT", "1h", "2026-06-01", 1.0, None), ("BTCUSDT", "1h", "2026-06-01", 1.0, 2.0), ("BTCUSDT", "1h", None, 3.0, 4.0), ("BTCUSDT", "1h", None, 5.0, 6.0)],
        "symbol string, interval string, open_time string, open double, close double",
    )
    out = clean.dedup_by_candle_key(df).collect()
    keyed = [r for r in out if r["open_time"] is not None]
    assert len(keyed) == 1 and keyed[0]["close"] == 2.0
    assert len(out) == 3  # rows with an incomplete key are not merged


def test_strict_and_subset_drops(messy):
    cleaned = clean.clean_candles(messy)
    strict = clean.clean_candles_strict(messy)
    assert strict.count() == clean.drop_any_null(cleaned).count()
    assert sum(r["missing_count"] for r in quality.missing_by_column(strict).collect()) == 0
    subset = clean.drop_subset_null(cleaned, ["open", "close"])
    assert subset.filter(F.col("open").isNull() | F.col("close").isNull()).count() == 0


def test_unknown_symbols(spark, messy):
    known = spark.createDataFrame([(s,) for s in SYMBOLS], "symbol string")
    raw_unknown = clean.unknown_symbols(messy, known).count()
    assert raw_unknown > 0
    assert clean.unknown_symbols(clean.clean_candles(messy), known).count() == 0


def test_symbol_domain(messy):
    row = quality.symbol_domain(messy).first()
    assert row["symbols_after"] == len(SYMBOLS) and row["symbols_before"] > len(SYMBOLS)


def test_balanced_sample(messy):
    cleaned = clean.clean_candles(messy)
    s = sample.balanced_sample(cleaned, n=5, seed=42)
    per = {r["symbol"]: r["c"] for r in s.groupBy("symbol").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert per == {sym: 5 for sym in SYMBOLS}
    assert s.count() == 50
    assert sum(r["missing_count"] for r in quality.missing_by_column(s).collect()) == 0
    assert sample.short_sample_groups(s, n=5).count() == 0
    again = sample.balanced_sample(cleaned, n=5, seed=42)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, s.collect()), key=str)
    assert sum(r["direction_count"] for r in sample.direction_counts(s).collect()) == 50
    assert sample.top_avg_volume_symbol(s).count() == 1
    assert sample.widest_candle(s).first()["price_range"] == s.agg(F.max("price_range")).first()[0]
    assert sample.sample_vs_full(s, cleaned).count() == len(SYMBOLS)


def test_balanced_sample_plans_partial_group_limit(messy):
    s = sample.balanced_sample(clean.clean_candles(messy), n=5)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the shuffle) + final


def test_require_full_sample_raises_on_short_group(spark, messy):
    cleaned = clean.clean_candles(messy)
    s = sample.balanced_sample(cleaned, n=5)
    assert sample.require_full_sample(s, n=5) is s
    with pytest.raises(ValueError, match="fewer than 500"):
        sample.require_full_sample(sample.balanced_sample(cleaned, n=500), n=500)
