"""Balanced per-symbol sample and the questions asked of it.

``balanced_sample`` keeps the n rows with the smallest seeded hash in each
group.  ``row_number() <= n`` is planned with a partial WindowGroupLimit, so
every map task forwards at most n rows per group before the shuffle: a
symbol holding a third of all rows still ships only n rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.scalar import exact_avg
from candlewick.operators.rankings import avg_close_by_symbol, sorted_small


def sample_order_key(seed: int, key_cols: list[str]) -> F.Column:
    """md5 of 'seed|k1|k2...' -- portable across SQL engines (hex text)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))


def balanced_sample(
    df: DataFrame,
    n: int = 5,
    seed: int = 42,
    group: str = "symbol",
    key_cols: tuple[str, ...] = ("symbol", "open_time"),
) -> DataFrame:
    """n rows per group, drawn from rows without missing values; adds ``sample_rank``."""
    base = df.na.drop(how="any")
    ties = [F.col(c).asc_nulls_last() for c in base.columns]
    w = Window.partitionBy(group).orderBy(sample_order_key(seed, list(key_cols)).asc(), *ties)
    return base.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= n)


def short_sample_groups(sample: DataFrame, n: int = 5, group: str = "symbol") -> DataFrame:
    """Groups that could not supply n rows (the reference raises for these)."""
    return sample.groupBy(group).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") < n)


def require_full_sample(sample: DataFrame, n: int = 5, group: str = "symbol") -> DataFrame:
    """Raise ``ValueError`` when a group could not supply n rows, as the
    reference's sampler does; otherwise return the sample unchanged.  The check
    is one small job over per-group counts (at most 20 groups reach the driver
    for the message)."""
    short = short_sample_groups(sample, n, group).limit(20).collect()
    if short:
        listed = ", ".join(f"{r[group]}={r['rows']}" for r in short)
        raise ValueError(f"groups with fewer than {n} complete rows: {listed}")
    return sample


def direction_counts(sample: DataFrame) -> DataFrame:
    counts = sample.groupBy("candle_direction").agg(F.count(F.lit(1)).alias("direction_count"))
    return sorted_small(counts, F.col("direction_count").desc(), F.col("candle_direction").asc_nulls_first())


def sample_avg_close(sample: DataFrame) -> DataFrame:
    return avg_close_by_symbol(sample)


def top_avg_volume_symbol(sample: DataFrame) -> DataFrame:
    per = sample.groupBy("symbol").agg(exact_avg("volume").alias("avg_volume"))
    return per.orderBy(F.col("avg_volume").desc_nulls_last(), F.col("symbol").asc_nulls_first()).limit(1)


def widest_candle(sample: DataFrame) -> DataFrame:
    """The sampled row with the largest price_range (first in sample order on ties)."""
    return sample.orderBy(
        F.col("price_range").desc_nulls_last(), F.col("symbol").asc_nulls_first(), F.col("sample_rank").asc()
    ).limit(1)


def sample_vs_full(sample: DataFrame, full: DataFrame) -> DataFrame:
    """Per-symbol average close, average volume and row count in the sample against the full table."""

    def averages(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("symbol").agg(
            exact_avg("close").alias(f"{prefix}_avg_close"),
            exact_avg("volume").alias(f"{prefix}_avg_volume"),
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
        ).filter(F.col(f"{prefix}_avg_close").isNotNull())

    s, f = averages(sample, "sample"), averages(full, "full")
    diff = F.col("sample_avg_close") - F.col("full_avg_close")
    out = f.join(s, "symbol", "inner").select(
        "symbol",
        "full_avg_close",
        "sample_avg_close",
        diff.alias("abs_diff"),
        (F.try_divide(diff, F.col("full_avg_close")) * F.lit(100)).alias("pct_diff"),
        "full_avg_volume",
        "sample_avg_volume",
        "full_rows",
        "sample_rows",
    )
    return sorted_small(out, "symbol")
