"""Ingest checks: record counts and per-symbol status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def record_count_check(candles: DataFrame, expected_per_symbol: int, n_symbols: int | None = None) -> DataFrame:
    """One row: records, expected (= symbols x limit) and 'passed' / 'failed'.

    ``n_symbols`` defaults to the distinct symbols seen.
    """
    agg = candles.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("symbol").alias("_seen"))
    symbols = F.lit(n_symbols) if n_symbols is not None else F.col("_seen")
    expected = (symbols * F.lit(expected_per_symbol)).cast("bigint")
    return agg.select(
        "records",
        expected.alias("expected"),
        F.when(F.col("records") == expected, F.lit("passed")).otherwise(F.lit("failed")).alias("check"),
    )


def expected_symbols_frame(spark: SparkSession, symbols: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("symbol", T.StringType(), False)])
    return spark.createDataFrame([(s,) for s in symbols], schema)


def ingest_status(candles: DataFrame, expected: DataFrame, limit: int) -> DataFrame:
    """Per expected symbol: records received and 'ok' / 'short' / 'missing'.

    ``expected`` is the symbol dimension; received counts are aggregated
    first (one row per symbol), so the join sides are both per-symbol sized.
    Symbols received but not expected are reported as 'unexpected'.
    """
    got = candles.groupBy("symbol").agg(F.count(F.lit(1)).alias("records"))
    exp = expected.select("symbol").distinct().withColumn("_expected", F.lit(True))
    joined = exp.join(got, "symbol", "full_outer")
    records = F.coalesce(F.col("records"), F.lit(0)).cast("bigint")
    status = (
        F.when(F.col("_expected").isNull(), F.lit("unexpected"))
        .when(records == 0, F.lit("missing"))
        .when(records < F.lit(limit), F.lit("short"))
        .otherwise(F.lit("ok"))
    )
    return joined.select("symbol", records.alias("records"), F.lit(limit).cast("bigint").alias("expected"), status.alias("status"))


def ingest_failures(status: DataFrame) -> DataFrame:
    """Symbols of which nothing came; a job exits non-zero when > 0.  A short count is
    no failure (a young market has fewer candles), ``record_count_check`` reports it."""
    return status.agg(F.count_if(F.col("status") == "missing").alias("failures"))
