"""Spark side of every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.scalar import epoch_ms_to_ts, normalise_symbol, to_iso_text
from candlewick.operators import clean, defects, derive, quality, rankings, requests, sample, summary
from candlewick.plans import jobs, views
from candlewick.plans.tables import SEED, Stages
from candlewick.schema import SYMBOLS
from candlewick.session import scratch_path
from candlewick.sources import events as ev
from candlewick.sources import files, ingest, klines, requestlog, sinks

Query = Callable[[SparkSession, str], DataFrame]

# whole hours in the 30 days the driver's event log spans: the "limit" the
# count check compares against
EXPECTED_CANDLES_PER_SYMBOL = 720
RATE_WINDOW_S = 3600
RATE_CAP = 3
RERUN_DAY = "2024-01-10"


def _stages(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(spark, sf_dir)


# ---------------------------------------------------------------- sources
def q_candles(spark, sf_dir):
    return _stages(spark, sf_dir).candles()


def q_epoch_ms_to_ts(spark, sf_dir):
    c = _stages(spark, sf_dir).candles()
    ms = F.unix_millis(F.col("open_time").cast("timestamp"))
    return c.select(
        "row_id",
        ms.alias("open_time_ms"),
        epoch_ms_to_ts(ms).alias("open_time_utc"),
        to_iso_text(epoch_ms_to_ts(ms)).alias("open_time_iso"),
        to_iso_text("close_time").alias("close_time_iso"),
    )


def q_union_batches(spark, sf_dir):
    """Batches as they land, one file a half month, read as one table."""
    path = scratch_path(spark, "batches")
    half = F.when(F.col("open_time") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), "first").otherwise("second")
    candles = _stages(spark, sf_dir).candles().withColumn("batch", half)
    sinks.write_parquet(candles, path, partition_by=["batch"])
    stored = spark.read.schema(candles.schema).parquet(path)
    return files.union_batches(*[stored.where(F.col("batch") == b).drop("batch") for b in ("first", "second")])


def q_decode_klines(spark, sf_dir):
    payloads = klines.encode_klines(_stages(spark, sf_dir).candles(), limit=1000)
    return klines.decode_klines(payloads)


def q_record_count_check(spark, sf_dir):
    return ingest.record_count_check(_stages(spark, sf_dir).candles(), EXPECTED_CANDLES_PER_SYMBOL)


def q_ingest_status(spark, sf_dir):
    s = _stages(spark, sf_dir)
    candles = s.candles()
    expected = ingest.expected_symbols_frame(spark, SYMBOLS).unionByName(
        s.events().select(ev.symbol_from_event_type("event_type").alias("symbol"))
    )
    return ingest.ingest_status(candles, expected, EXPECTED_CANDLES_PER_SYMBOL)


def q_parse_request_log(spark, sf_dir):
    lines = requestlog.log_lines_from_requests(_stages(spark, sf_dir).requests())
    return requestlog.parse_request_log(lines)


# ---------------------------------------------------------------- defects
def q_inject_defects(spark, sf_dir):
    return _stages(spark, sf_dir).messy()


def q_defect_summary(spark, sf_dir):
    return defects.defect_summary(_stages(spark, sf_dir).candles(), seed=SEED)


def q_guarded_defect_summary(spark, sf_dir):
    """Counters where the table lacks the times and the volumes: their defects are left out."""
    text = defects.candles_as_text(_stages(spark, sf_dir).candles()).select("row_id", "symbol", "open", "close")
    return defects.text_defect_summary(text, seed=SEED)


# ---------------------------------------------------------------- cleaning
def q_coerce_numeric(spark, sf_dir):
    return clean.coerce_numeric(_stages(spark, sf_dir).messy())


def q_coerce_timestamp(spark, sf_dir):
    m = _stages(spark, sf_dir).messy()
    return clean.coerce_timestamp(
        m.select("symbol", F.col("open_time").alias("open_time_text"), F.col("close_time").alias("close_time_text"), "open_time", "close_time")
    )


def q_normalise_symbol(spark, sf_dir):
    m = _stages(spark, sf_dir).messy()
    return m.select(F.col("symbol").alias("symbol_text"), "symbol").transform(clean.normalise_symbols)


def q_drop_duplicates(spark, sf_dir):
    return clean.drop_duplicates(clean.coerce_and_normalise(_stages(spark, sf_dir).messy()))


def q_drop_impossible(spark, sf_dir):
    return clean.drop_impossible(clean.drop_duplicates(clean.coerce_and_normalise(_stages(spark, sf_dir).messy())))


def q_clean_candles(spark, sf_dir):
    return _stages(spark, sf_dir).cleaned()


def q_clean_candles_strict(spark, sf_dir):
    return clean.clean_candles_strict(_stages(spark, sf_dir).messy())


def q_drop_subset_null(spark, sf_dir):
    return clean.drop_subset_null(_stages(spark, sf_dir).cleaned(), ["open", "close", "open_time"])


def q_dedup_by_candle_key(spark, sf_dir):
    return clean.dedup_by_candle_key(_stages(spark, sf_dir).cleaned())


def q_unknown_symbols(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return clean.unknown_symbols(s.messy(), s.candles().select("symbol"))


# ---------------------------------------------------------------- derived columns
def q_derived_columns(spark, sf_dir):
    c = _stages(spark, sf_dir).candles()
    return derive.derived_columns(c).select("row_id", "symbol", "open_time", "price_range", "price_change", "percent_change", "candle_direction")


def q_ensure_derived(spark, sf_dir):
    c = _stages(spark, sf_dir).candles().withColumn("price_range", F.col("high") - F.col("low"))
    return derive.ensure_derived(c).select("row_id", "price_range", "price_change", "percent_change", "candle_direction")


def q_time_features(spark, sf_dir):
    return _stages(spark, sf_dir).featured().select("symbol", "open_time", "trade_date", "trade_hour", "day_of_week")


# ---------------------------------------------------------------- data quality
def q_missing_by_column(spark, sf_dir):
    return quality.missing_by_column(_stages(spark, sf_dir).messy())


def q_invalid_by_column(spark, sf_dir):
    return quality.invalid_by_column(_stages(spark, sf_dir).messy())


def q_duplicate_count(spark, sf_dir):
    return quality.duplicate_count(clean.coerce_and_normalise(_stages(spark, sf_dir).messy()))


def q_impossible_counts(spark, sf_dir):
    return quality.impossible_counts(clean.drop_duplicates(clean.coerce_and_normalise(_stages(spark, sf_dir).messy())))


def q_symbol_domain(spark, sf_dir):
    return quality.symbol_domain(_stages(spark, sf_dir).messy())


def q_symbol_lists(spark, sf_dir):
    return quality.symbol_lists(_stages(spark, sf_dir).messy())


def q_dq_report(spark, sf_dir):
    return quality.dq_report(_stages(spark, sf_dir).messy())


def q_table_shape(spark, sf_dir):
    return quality.table_shape(_stages(spark, sf_dir).messy())


def q_preview(spark, sf_dir):
    return quality.preview(_stages(spark, sf_dir).candles(), 10, ["symbol", "open_time"])


def q_dup_after(spark, sf_dir):
    return quality.duplicate_count(_stages(spark, sf_dir).cleaned())


# ---------------------------------------------------------------- analytics
def q_avg_close_by_symbol(spark, sf_dir):
    return rankings.avg_close_by_symbol(_stages(spark, sf_dir).featured())


def q_avg_volume_by_symbol(spark, sf_dir):
    return rankings.avg_volume_by_symbol(_stages(spark, sf_dir).featured())


def q_row_count_by_symbol(spark, sf_dir):
    return rankings.row_count_by_symbol(_stages(spark, sf_dir).featured())


def q_volatility_ranking(spark, sf_dir):
    return rankings.volatility_ranking(_stages(spark, sf_dir).featured())


def q_activity_ranking(spark, sf_dir):
    return rankings.activity_ranking(_stages(spark, sf_dir).featured())


def q_activity_by_hour(spark, sf_dir):
    return rankings.activity_by_hour(_stages(spark, sf_dir).featured())


def q_activity_by_date(spark, sf_dir):
    return rankings.activity_by_date(_stages(spark, sf_dir).featured())


def q_volatility_ranking_display(spark, sf_dir):
    return rankings.volatility_ranking(_stages(spark, sf_dir).featured(), decimals=2)


def q_avg_close_ordered(spark, sf_dir):
    return rankings.with_position(rankings.avg_close_by_symbol(_stages(spark, sf_dir).featured(), decimals=4))


def q_activity_by_hour_ordered(spark, sf_dir):
    return rankings.with_position(rankings.activity_by_hour(_stages(spark, sf_dir).featured()))


def q_busiest_hour(spark, sf_dir):
    return rankings.busiest_hour(_stages(spark, sf_dir).featured())


def q_busiest_date(spark, sf_dir):
    return rankings.busiest_date(_stages(spark, sf_dir).featured())


def q_busiest_hour_by_trades(spark, sf_dir):
    return rankings.busiest_hour_by_trades(_stages(spark, sf_dir).featured())


def q_busiest_hour_by_quote_volume(spark, sf_dir):
    return rankings.busiest_hour(_stages(spark, sf_dir).featured(), by="total_quote_volume")


def q_busiest_date_by_trades(spark, sf_dir):
    return rankings.busiest_date(_stages(spark, sf_dir).featured(), by="total_trades")


def q_busiest_date_by_quote_volume(spark, sf_dir):
    return rankings.busiest_date_by_quote_volume(_stages(spark, sf_dir).featured())


def q_market_summary(spark, sf_dir):
    return summary.market_summary(_stages(spark, sf_dir).featured())


def q_summary_with_interpretation(spark, sf_dir):
    return summary.with_interpretation(summary.market_summary(_stages(spark, sf_dir).featured()))


def q_summary_interpretation(spark, sf_dir):
    return summary.summary_interpretation(summary.market_summary(_stages(spark, sf_dir).featured()))


def q_top_symbols(spark, sf_dir):
    return summary.top_symbols(summary.market_summary(_stages(spark, sf_dir).featured()))


# ---------------------------------------------------------------- sample
def _sample(spark, sf_dir):
    return sample.balanced_sample(_stages(spark, sf_dir).cleaned(), n=5, seed=SEED)


def q_balanced_sample(spark, sf_dir):
    return _sample(spark, sf_dir)


def q_direction_counts(spark, sf_dir):
    return sample.direction_counts(_sample(spark, sf_dir))


def q_sample_avg_close(spark, sf_dir):
    return sample.sample_avg_close(_sample(spark, sf_dir))


def q_top_avg_volume_symbol(spark, sf_dir):
    return sample.top_avg_volume_symbol(_sample(spark, sf_dir))


def q_widest_candle(spark, sf_dir):
    return sample.widest_candle(_sample(spark, sf_dir))


def q_sample_vs_full(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return sample.sample_vs_full(sample.balanced_sample(s.cleaned(), n=5, seed=SEED), s.cleaned())


# ---------------------------------------------------------------- request log
def q_rate_window_counts(spark, sf_dir):
    r = _stages(spark, sf_dir).requests().select("request_id", "client", F.col("start_ts").alias("ts"))
    return requests.rate_window_counts(r, "client", "ts", window_seconds=RATE_WINDOW_S, cap=RATE_CAP)


def q_rate_window_minute(spark, sf_dir):
    r = _stages(spark, sf_dir).requests().select("request_id", "client", F.col("start_ts").alias("ts"))
    return requests.rate_window_counts(r, "client", "ts")


def q_concurrency_breaches(spark, sf_dir):
    return requests.concurrency_breaches(_stages(spark, sf_dir).requests(), "client", "start_ts", "end_ts")


def q_max_concurrency(spark, sf_dir):
    return requests.max_concurrency(_stages(spark, sf_dir).requests(), "client", "start_ts", "end_ts")


def q_request_latency(spark, sf_dir):
    lines = requestlog.log_lines_from_requests(_stages(spark, sf_dir).requests())
    return requests.request_latency(requestlog.parse_request_log(lines))


def _run_log(spark, sf_dir):
    """A log without ids, written as files in the shared folder and read back."""
    path = scratch_path(spark, "run-log")
    requestlog.write_log(requestlog.run_log_lines(_stages(spark, sf_dir).requests()), path)
    return requestlog.parse_request_log(requestlog.read_log_lines(spark, path), with_line_order=True)


def q_request_runs(spark, sf_dir):
    return requests.request_runs(_run_log(spark, sf_dir))


def q_run_report(spark, sf_dir):
    return requests.run_report(_run_log(spark, sf_dir))


# ---------------------------------------------------------------- files and hand-offs
def _through_csv(spark, df, name: str, **options):
    path = scratch_path(spark, name)
    sinks.write_csv(df, path, **options)
    return path


def q_scan_messy(spark, sf_dir):
    return files.scan_messy(spark, _through_csv(spark, _stages(spark, sf_dir).messy(), "messy-csv"))


def q_scan_nonempty(spark, sf_dir):
    text = defects.candles_as_text(_stages(spark, sf_dir).candles())
    back = files.scan_nonempty(spark, _through_csv(spark, text, "candles-csv"))
    return back.withColumn("row_id", F.col("row_id").cast("bigint"))


def q_scan_cleaned(spark, sf_dir):
    return files.scan_cleaned(spark, _through_csv(spark, _stages(spark, sf_dir).cleaned(), "cleaned-csv"))


def q_write_csv(spark, sf_dir):
    """Texts with quotes, commas and line breaks, through a CSV file and back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return files.scan_typed(spark, _through_csv(spark, docs, "texts-csv"), docs.schema, multi_line=True)


def q_write_summary(spark, sf_dir):
    ranked = summary.market_summary(_stages(spark, sf_dir).featured())
    path = scratch_path(spark, "summary-csv")
    sinks.write_summary(ranked, path)
    return files.scan_typed(spark, path, ranked.schema)


def q_rerun_one_day(spark, sf_dir):
    """A table by trade date, of which one day is written again without its flat candles."""
    cleaned = _stages(spark, sf_dir).cleaned()
    path = scratch_path(spark, "by-date")
    sinks.write_by_date(cleaned, path)
    day = jobs.read_cleaned(spark, path, RERUN_DAY, RERUN_DAY, cleaned.schema)
    # a day's rows replace the files they are read from: they go through a table of their own
    kept = scratch_path(spark, "one-day")
    sinks.write_parquet(day.where(F.col("candle_direction") != "flat"), kept)
    sinks.write_by_date(spark.read.parquet(kept), path)
    return jobs.read_cleaned(spark, path, columns=cleaned.schema)


def q_clean_job_reports(spark, sf_dir):
    """All reports of one cleaning run over a CSV, read once, as (report, name, value)."""
    raw = files.scan_nonempty(spark, _through_csv(spark, _stages(spark, sf_dir).messy(), "messy-csv"))
    reports = jobs.clean_to(raw, scratch_path(spark, "cleaned"))
    impossible = reports["impossible_counts"]
    parts = [
        reports["dq_report"].select(F.lit("dq_report").alias("report"), F.col("metric").alias("name"), "value"),
        reports["missing_by_column"].select(F.lit("missing"), "column_name", "missing_count"),
        reports["missing_by_column"].where("most_affected").select(F.lit("most_affected"), "column_name", "missing_count"),
        reports["invalid_by_column"].select(F.lit("invalid"), "column_name", "invalid_count"),
        impossible.select(F.lit("impossible"), F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in impossible.columns]))),
    ]
    return reduce(lambda a, b: a.union(b), parts)


def q_kline_outcomes(spark, sf_dir):
    """What became of each record of payloads in which some volumes are no numbers."""
    candles = _stages(spark, sf_dir).candles()
    odd = F.when(F.col("row_id") % 59 == 0, "n/a").when(F.col("row_id") % 61 == 0, "1.5.2").otherwise(F.col("volume").cast("string"))
    tagged = klines.decode_tagged(klines.encode_klines(candles.withColumn("volume", odd), limit=1000))
    path = scratch_path(spark, "decoded")
    sinks.write_parquet(tagged, path, partition_by=["tag"])
    decoded = spark.read.schema(tagged.schema).parquet(path)
    return decoded.groupBy("symbol", "tag", F.array_join("cells", " ").alias("cells")).agg(F.count(F.lit(1)).alias("records"), F.count("volume").alias("volumes"))


def q_symbol_domain_sketch(spark, sf_dir):
    """Distinct symbols and cells by sketches that are stored by batch and merged, beside exact counts."""
    messy = _stages(spark, sf_dir).messy()
    texts = messy.select("symbol", normalise_symbol("symbol").alias("normalised"), "open_time")
    cols = ["symbol", "normalised"]
    path = scratch_path(spark, "sketches")
    batches = texts.withColumn("batch", F.coalesce(F.substring("open_time", 1, 10), F.lit("")))
    sinks.write_parquet(quality.domain_sketches(batches, "batch", cols), path)
    return quality.domain_check(quality.exact_domains(texts, cols), quality.merged_domains(spark.read.parquet(path)))


def q_market_summary_sql(spark, sf_dir):
    views.register_market_views(spark, _stages(spark, sf_dir).cleaned())
    return views.market_summary_sql(spark)


def q_symbol_history_sql(spark, sf_dir):
    views.register_market_views(spark, _stages(spark, sf_dir).cleaned())
    return views.symbol_history_sql(spark, "CLICKUSDT", "2024-01-05", "2024-01-20")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
