"""Per-symbol / per-hour / per-date aggregates and their rankings.

Each ranking first aggregates (partial + final hash aggregate, so a hot
symbol is pre-combined on the map side) and only then numbers the rows.
The numbering window has no partition key, i.e. it runs in one task, which
is safe because its input has one row per symbol / hour / date -- bounded by
the key domain, never by the number of candles.  Ranks are taken on
unrounded values with the key as tie-break, so they are deterministic;
``decimals`` rounds the displayed statistics only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.scalar import activity_score, exact_avg, exact_moments, exact_sum


def _ranked(df: DataFrame, metric: str, key: str, name: str) -> DataFrame:
    w = Window.orderBy(F.col(metric).desc_nulls_last(), F.col(key).asc_nulls_first())
    return df.withColumn(name, F.row_number().over(w))


def sorted_small(df: DataFrame, *order) -> DataFrame:
    """Order a result whose size is bounded by a key domain (symbols, hours,
    dates): one single-partition exchange and a local sort, instead of a
    range-partitioned sort that first samples its input in an extra job.
    Never use it on detail rows."""
    return df.repartition(1).sortWithinPartitions(*order)


def with_position(df: DataFrame) -> DataFrame:
    """Number the rows of a ``sorted_small`` result from 0, in the order they come."""
    return df.withColumn("position", F.monotonically_increasing_id())


def _display(df: DataFrame, cols: list[str], decimals: int | None) -> DataFrame:
    if decimals is None:
        return df
    return df.withColumns({c: F.round(c, decimals) for c in cols})


def avg_close_by_symbol(df: DataFrame, decimals: int | None = None) -> DataFrame:
    out = df.filter(F.col("close").isNotNull()).groupBy("symbol").agg(exact_avg("close").alias("avg_close"))
    return sorted_small(_display(out, ["avg_close"], decimals), F.col("symbol").asc_nulls_first())


def avg_volume_by_symbol(df: DataFrame, decimals: int | None = None) -> DataFrame:
    out = df.filter(F.col("volume").isNotNull()).groupBy("symbol").agg(exact_avg("volume").alias("avg_volume"))
    return sorted_small(_display(out, ["avg_volume"], decimals), F.col("symbol").asc_nulls_first())


def row_count_by_symbol(df: DataFrame) -> DataFrame:
    return sorted_small(df.groupBy("symbol").agg(F.count(F.lit(1)).alias("row_count")), F.col("symbol").asc_nulls_first())


def volatility_ranking(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """avg / min / max / sample stddev of price_range per symbol, ranked by the average."""
    average, spread = exact_moments("price_range")
    stats = (
        df.filter(F.col("price_range").isNotNull())
        .groupBy("symbol")
        .agg(
            average.alias("avg_price_range"),
            F.min("price_range").alias("min_price_range"),
            F.max("price_range").alias("max_price_range"),
            spread.alias("stddev_price_range"),
        )
    )
    ranked = _ranked(stats, "avg_price_range", "symbol", "volatility_rank")
    shown = ["avg_price_range", "min_price_range", "max_price_range", "stddev_price_range"]
    return _display(ranked, shown, decimals).orderBy("volatility_rank")


def activity_ranking(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """Trades, quote volume and average volume over rows having both counters;
    score = trades * ln(quote volume + 1)."""
    average, spread = exact_moments("price_range")
    stats = (
        df.filter(F.col("trade_count").isNotNull() & F.col("quote_volume").isNotNull())
        .groupBy("symbol")
        .agg(
            F.sum("trade_count").alias("total_trades"),
            exact_sum("quote_volume").alias("total_quote_volume"),
            exact_avg("volume").alias("avg_volume"),
        )
        .withColumn("symbol_activity_score", activity_score("total_trades", "total_quote_volume"))
    )
    ranked = _ranked(stats, "symbol_activity_score", "symbol", "symbol_activity_rank")
    return _display(ranked, ["avg_volume"], decimals).orderBy("symbol_activity_rank")


def _activity_by(df: DataFrame, key: str, score_name: str) -> DataFrame:
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum("trade_count").alias("total_trades"),
            exact_sum("quote_volume").alias("total_quote_volume"),
        )
        .withColumn(score_name, activity_score("total_trades", "total_quote_volume"))
    )


def activity_by_hour(df: DataFrame) -> DataFrame:
    """Needs ``trade_hour`` (see ``time_features``)."""
    return sorted_small(_activity_by(df, "trade_hour", "hour_activity_score"), F.col("hour_activity_score").desc_nulls_last(), "trade_hour")


def activity_by_date(df: DataFrame) -> DataFrame:
    """Needs ``trade_date`` (see ``time_features``)."""
    return sorted_small(_activity_by(df, "trade_date", "date_activity_score"), F.col("date_activity_score").desc_nulls_last(), "trade_date")


def _top1(df: DataFrame, metric: str, key: str) -> DataFrame:
    # orderBy + limit plans as TakeOrderedAndProject: a per-task top-1, then a merge
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(key).asc_nulls_first()).limit(1)


def busiest_hour(df: DataFrame, by: str = "hour_activity_score") -> DataFrame:
    return _top1(_activity_by(df, "trade_hour", "hour_activity_score"), by, "trade_hour")


def busiest_date(df: DataFrame, by: str = "date_activity_score") -> DataFrame:
    return _top1(_activity_by(df, "trade_date", "date_activity_score"), by, "trade_date")


def busiest_hour_by_trades(df: DataFrame) -> DataFrame:
    return busiest_hour(df, by="total_trades")


def busiest_date_by_quote_volume(df: DataFrame) -> DataFrame:
    return busiest_date(df, by="total_quote_volume")
