"""Final ranked market summary: one row per symbol.

The reference joins the detail rows back to three per-symbol views and
re-groups on twelve columns.  Here the same numbers come from ONE
``groupBy(symbol)`` with conditional aggregates -- one scan, one (partial
pre-aggregated) shuffle, no join -- followed by two rankings over the
per-symbol rows.  Each rank is taken among the symbols its own view would
hold (the NULL symbol included, as SQL GROUP BY keeps it), then symbols the
inner joins would drop are filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.scalar import activity_score, exact_avg, exact_moments, exact_sum

SUMMARY_COLUMNS = [
    "symbol", "row_count",
    "avg_price_range", "min_price_range", "max_price_range", "stddev_price_range", "volatility_rank",
    "total_trades", "total_quote_volume", "avg_volume", "symbol_activity_score", "symbol_activity_rank",
    "avg_percent_change", "up_count", "down_count", "flat_count",
]


def _rank_where(eligible: F.Column, metric: F.Column) -> F.Column:
    # eligible rows first: their row numbers are their ranks among eligible
    # rows.  Both rank windows are unpartitioned, so they share one
    # single-partition step (one row per symbol) that the final ordering reuses.
    w = Window.orderBy(eligible.desc(), metric.desc_nulls_last(), F.col("symbol").asc_nulls_first())
    return F.when(eligible, F.row_number().over(w))


def market_summary(df: DataFrame, decimals: int | None = None) -> DataFrame:
    rng = F.col("price_range")
    both = F.col("trade_count").isNotNull() & F.col("quote_volume").isNotNull()
    move = F.col("percent_change").isNotNull() & F.col("candle_direction").isNotNull()
    direction = F.col("candle_direction")
    average, spread = exact_moments(rng)
    per_symbol = df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(rng).alias("_n_range"),
        average.alias("avg_price_range"),
        F.min(rng).alias("min_price_range"),
        F.max(rng).alias("max_price_range"),
        spread.alias("stddev_price_range"),
        F.count_if(both).alias("_n_activity"),
        F.sum(F.when(both, F.col("trade_count"))).alias("total_trades"),
        exact_sum(F.when(both, F.col("quote_volume"))).alias("total_quote_volume"),
        exact_avg(F.when(both, F.col("volume"))).alias("avg_volume"),
        F.count_if(move).alias("_n_move"),
        exact_avg(F.when(move, F.col("percent_change"))).alias("avg_percent_change"),
        F.count_if(move & (direction == "up")).alias("up_count"),
        F.count_if(move & (direction == "down")).alias("down_count"),
        F.count_if(move & (direction == "flat")).alias("flat_count"),
    )
    # score and both ranks in one projection over the per-symbol rows
    score = activity_score("total_trades", "total_quote_volume")
    has_range, has_activity = F.col("_n_range") > 0, F.col("_n_activity") > 0
    kept = (
        per_symbol.select(
            "*",
            score.alias("symbol_activity_score"),
            _rank_where(has_range, F.col("avg_price_range")).alias("volatility_rank"),
            _rank_where(has_activity, score).alias("symbol_activity_rank"),
        )
        .filter(F.col("symbol").isNotNull() & has_range & has_activity & (F.col("_n_move") > 0))
        .select(*SUMMARY_COLUMNS)
    )
    if decimals is not None:
        kept = kept.withColumns(
            {c: F.round(c, decimals) for c in ("avg_price_range", "min_price_range", "max_price_range", "stddev_price_range", "avg_volume", "avg_percent_change")}
        )
    return kept.orderBy("symbol_activity_rank")


def with_interpretation(summary: DataFrame) -> DataFrame:
    """The summary plus ``interpretation``: one sentence per symbol naming its two ranks; the leaders are marked."""
    a, v = F.col("symbol_activity_rank"), F.col("volatility_rank")
    note = F.concat(
        F.col("symbol"),
        F.lit(": activity #"), a.cast("string"),
        F.lit(", volatility #"), v.cast("string"),
        F.when(a == 1, F.lit(" (most active)")).otherwise(F.lit("")),
        F.when(v == 1, F.lit(" (most volatile)")).otherwise(F.lit("")),
    )
    return summary.withColumn("interpretation", note)


def summary_interpretation(summary: DataFrame) -> DataFrame:
    return with_interpretation(summary).select("symbol", "symbol_activity_rank", "volatility_rank", "interpretation")


def top_symbols(summary: DataFrame) -> DataFrame:
    """The rank-1 symbol of each ranking, as (ranking, symbol) rows."""
    return summary.select(
        F.explode(
            F.array(
                F.when(F.col("symbol_activity_rank") == 1, F.struct(F.lit("activity").alias("ranking"), F.col("symbol"))),
                F.when(F.col("volatility_rank") == 1, F.struct(F.lit("volatility").alias("ranking"), F.col("symbol"))),
            )
        ).alias("_t")
    ).filter(F.col("_t").isNotNull()).select("_t.ranking", "_t.symbol")
