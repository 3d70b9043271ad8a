"""The reference's three entry points as Spark jobs over files.

collect  landed kline payloads -> candle table (+ ingest status, count check)
mess     candle table -> messy all-text copy (+ injector counters)
clean    messy CSV -> cleaned table (+ DQ report, missing/invalid per column)
analyse  cleaned table -> rankings, activity by hour/date, market summary

Every output is written by the executors (CSV with header, or Parquet); the
driver only plans.  A job that must fail (missing symbols) raises after its
outputs are written, like the reference's non-zero exit.

    python -m candlewick.plans.jobs collect LANDING OUT [--limit 1000]
    python -m candlewick.plans.jobs mess CANDLES OUT [--seed 42]
    python -m candlewick.plans.jobs clean MESSY OUT
    python -m candlewick.plans.jobs analyse CLEANED OUT
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalar import to_iso_text
from candlewick.operators import clean, defects, derive, quality, rankings, sample, summary
from candlewick.schema import FIELDNAMES, LIMIT, SYMBOLS, TIME_COLS
from candlewick.session import ensure_session_defaults
from candlewick.sources import files, ingest, klines, sinks


class IngestFailed(RuntimeError):
    pass


def collect(spark: SparkSession, landing: str, out: str, symbols: list[str] | None = None, limit: int = LIMIT) -> None:
    ensure_session_defaults(spark)
    # one parse: candles and rejects are told apart by the folder they are written to
    tagged = klines.decode_tagged(klines.scan_kline_files(spark, landing))
    sinks.write_parquet(tagged, os.path.join(out, "decoded"), partition_by=["tag"])
    schema = T.StructType([*tagged.schema.fields])
    decoded = spark.read.schema(schema).parquet(os.path.join(out, "decoded"))
    candles = klines.decoded_candles(decoded)
    text = candles.select(
        *[(to_iso_text(c) if c in TIME_COLS else F.col(c).cast("string")).alias(c) for c in FIELDNAMES]
    )
    sinks.write_csv(text, os.path.join(out, "candles"))
    rejects = klines.decoded_rejects(decoded).withColumn("cells", F.array_join("cells", " "))
    sinks.write_csv(rejects, os.path.join(out, "rejects"))
    # what was written is counted; the payloads are not decoded again
    candles = files.scan_messy(spark, os.path.join(out, "candles")).select("symbol")
    expected = ingest.expected_symbols_frame(spark, symbols or SYMBOLS)
    status = ingest.ingest_status(candles, expected, limit)
    sinks.write_csv(status, os.path.join(out, "ingest_status"), single_file=True)
    sinks.write_csv(
        ingest.record_count_check(candles, limit, n_symbols=len(symbols or SYMBOLS)), os.path.join(out, "record_count_check"), single_file=True
    )
    failures = ingest.ingest_failures(spark.read.options(**sinks.CSV_READ_FORM).csv(os.path.join(out, "ingest_status"))).first()["failures"]
    if failures:
        raise IngestFailed(f"{failures} symbol(s) missing; see {out}/ingest_status")


def mess(spark: SparkSession, candles_csv: str, out: str, seed: int = 42) -> None:
    """Candle CSV (as written by ``collect``) -> messy CSV + counters.

    Cells without a defect are written as they were read."""
    ensure_session_defaults(spark)
    text = files.scan_messy(spark, candles_csv)
    # a stable row id from the whole row, so the defects are repeatable; equal rows are
    # numbered, so that each has an id of its own
    whole = F.xxhash64(*text.columns)
    copy = F.row_number().over(Window.partitionBy(*text.columns).orderBy(F.lit(0)))
    text = text.withColumn("row_id", F.pmod(whole + copy - 1, F.lit(1 << 47)))
    plan = defects.plan_defects(text, seed=seed)
    sinks.write_csv(defects.inject_into_text(text, seed, plan=plan), os.path.join(out, "messy"))
    sinks.write_csv(defects.text_defect_summary(text, seed, plan=plan), os.path.join(out, "defect_summary"), single_file=True)


def clean_to(raw: DataFrame, out: str, strict: bool = False, rule: str = "parity") -> dict[str, DataFrame]:
    """Clean ``raw`` into ``out`` and return the reports, in one pass over the raw text.

    The text is parsed once into ``typed`` (with the symbol as it came), where missing and
    invalid cells are counted on the way.  ``cleaned``, one folder a trade date, is made
    from there; duplicates and impossible rows are counted as it is written.
    """
    reports = quality.CleanReports(raw.columns, rule)
    typed = reports.observe_raw(raw, clean.typed_columns(reports.columns))
    typed = typed.select(F.col("_raw.symbol").alias("symbol_text"), *reports.columns)
    sinks.write_parquet(typed, os.path.join(out, "typed"))
    stored = raw.sparkSession.read.parquet(os.path.join(out, "typed"))
    distinct = reports.observe_distinct(clean.drop_duplicates(stored.select(*reports.columns)))
    cleaned = derive.derived_columns(clean.drop_impossible(distinct, rule))
    sinks.write_by_date(reports.observe_cleaned(clean.drop_any_null(cleaned) if strict else cleaned), os.path.join(out, "cleaned"))
    return reports.frames(raw.sparkSession)


def clean_job(spark: SparkSession, messy_csv: str, out: str, strict: bool = False, sample_size: int = 5) -> None:
    """Messy CSV -> cleaned table (Parquet by trade date, and CSV), reports, sample.

    The CSV is read once.  Raises ``ValueError`` before anything is written if it holds no
    row, and after writing all else if a symbol has fewer than ``sample_size`` complete
    rows."""
    ensure_session_defaults(spark)
    raw = files.scan_nonempty(spark, messy_csv)
    for name, report in clean_to(raw, out, strict).items():
        sinks.write_csv(report, os.path.join(out, name), single_file=True)
    written = read_cleaned(spark, os.path.join(out, "cleaned"), columns=clean.clean_candles(raw).schema)
    sinks.write_csv(written, os.path.join(out, "cleaned_csv"))
    texts = spark.read.parquet(os.path.join(out, "typed")).select(F.col("symbol_text").alias("symbol"))
    sinks.write_csv(quality.symbol_lists(texts), os.path.join(out, "symbol_lists"), single_file=True)
    s = sample.balanced_sample(written, n=sample_size, seed=42)
    sinks.write_csv(s, os.path.join(out, "sample"), single_file=True)
    sinks.write_csv(sample.sample_vs_full(s, written), os.path.join(out, "sample_vs_full"), single_file=True)
    sample.require_full_sample(s, sample_size)


def read_cleaned(spark: SparkSession, cleaned: str, since: str | None = None, until: str | None = None, columns: T.StructType | None = None) -> DataFrame:
    """The cleaned Parquet table, or its trade dates from ``since`` to ``until``: only the
    folders of these dates are read.  A table that may hold no row at all needs ``columns``."""
    reader = spark.read if columns is None else spark.read.schema(T.StructType([*columns.fields, T.StructField("trade_date", T.DateType())]))
    table = reader.parquet(cleaned)
    if since is not None:
        table = table.where(F.col("trade_date") >= F.lit(since).cast("date"))
    if until is not None:
        table = table.where(F.col("trade_date") <= F.lit(until).cast("date"))
    return table.drop("trade_date")


def analyse(
    spark: SparkSession, cleaned: str, out: str, decimals: int | None = 2, csv: bool = False, since: str | None = None, until: str | None = None
) -> None:
    """Cleaned table (Parquet by trade date, or CSV with ``csv``) -> rankings and the market
    summary; of a Parquet table, maybe of some dates alone."""
    ensure_session_defaults(spark)
    table = files.scan_cleaned(spark, cleaned) if csv else read_cleaned(spark, cleaned, since, until)
    df = derive.time_features(derive.ensure_derived(table))
    outputs = {
        "avg_close_by_symbol": rankings.avg_close_by_symbol(df, decimals),
        "avg_volume_by_symbol": rankings.avg_volume_by_symbol(df, decimals),
        "row_count_by_symbol": rankings.row_count_by_symbol(df),
        "volatility_ranking": rankings.volatility_ranking(df, decimals),
        "activity_ranking": rankings.activity_ranking(df, decimals),
        "activity_by_hour": rankings.activity_by_hour(df),
        "activity_by_date": rankings.activity_by_date(df),
        "busiest_hour": rankings.busiest_hour(df),
        "busiest_hour_by_trades": rankings.busiest_hour(df, by="total_trades"),
        "busiest_hour_by_quote_volume": rankings.busiest_hour(df, by="total_quote_volume"),
        "busiest_date": rankings.busiest_date(df),
        "busiest_date_by_trades": rankings.busiest_date(df, by="total_trades"),
        "busiest_date_by_quote_volume": rankings.busiest_date(df, by="total_quote_volume"),
    }
    for name, frame in outputs.items():
        sinks.write_csv(frame, os.path.join(out, name), single_file=True)
    ranked = summary.with_interpretation(summary.market_summary(df, decimals))
    sinks.write_summary(ranked, os.path.join(out, "market_summary"))
    written = spark.read.options(**sinks.CSV_READ_FORM).csv(os.path.join(out, "market_summary"))
    sinks.write_csv(summary.top_symbols(written), os.path.join(out, "top_symbols"), single_file=True)
    sinks.write_csv(written.select("symbol", "symbol_activity_rank", "volatility_rank"), os.path.join(out, "ranks"), single_file=True)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="candlewick jobs")
    parser.add_argument("job", choices=["collect", "mess", "clean", "analyse"])
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--limit", type=int, default=LIMIT)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--csv", action="store_true", help="analyse: the cleaned table is CSV")
    parser.add_argument("--since", help="analyse: first trade date")
    parser.add_argument("--until", help="analyse: last trade date")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"candlewick-{args.job}").getOrCreate()
    if args.job == "collect":
        collect(spark, args.input, args.output, limit=args.limit)
    elif args.job == "mess":
        mess(spark, args.input, args.output, seed=args.seed)
    elif args.job == "clean":
        clean_job(spark, args.input, args.output, strict=args.strict)
    else:
        analyse(spark, args.input, args.output, csv=args.csv, since=args.since, until=args.until)


if __name__ == "__main__":
    main()
