"""The market analysis as SQL over registered views.

``register_market_views`` names the candles and the per-symbol results; the statements
below use named parameters, so a value never becomes part of the SQL text.  A frame
returned by one of them keeps the views it was made from: registering others under the
same names changes later statements only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import rankings
from candlewick.operators.derive import ensure_derived, time_features
from candlewick.sources.sinks import register_views

#: One row a symbol that all views hold, with its moves counted from the candles.
MARKET_SUMMARY = """
WITH moves AS (
  SELECT symbol,
         avg(percent_change) AS avg_percent_change,
         count_if(candle_direction = 'up') AS up_count,
         count_if(candle_direction = 'down') AS down_count,
         count_if(candle_direction = 'flat') AS flat_count
  FROM market_data
  WHERE percent_change IS NOT NULL AND candle_direction IS NOT NULL
  GROUP BY symbol
)
SELECT symbol, row_count,
       avg_price_range, min_price_range, max_price_range, stddev_price_range, volatility_rank,
       total_trades, total_quote_volume, avg_volume, symbol_activity_score, symbol_activity_rank,
       avg_percent_change, up_count, down_count, flat_count
FROM symbol_counts
JOIN volatility_results USING (symbol)
JOIN activity_results USING (symbol)
JOIN moves USING (symbol)
WHERE row_count >= :least_rows
"""

#: One row a trade date of one symbol.
SYMBOL_HISTORY = """
SELECT trade_date, count(*) AS candles, min(low) AS low, max(high) AS high,
       sum(CAST(trade_count AS BIGINT)) AS trades, count_if(candle_direction = :direction) AS moves
FROM market_data
WHERE symbol = :symbol AND trade_date BETWEEN CAST(:since AS DATE) AND CAST(:until AS DATE)
GROUP BY trade_date
"""


def register_market_views(spark: SparkSession, cleaned: DataFrame) -> None:
    """``market_data`` (candles with derived columns and time features), ``symbol_counts``,
    ``volatility_results`` and ``activity_results``; views of these names are replaced."""
    featured = time_features(ensure_derived(cleaned))
    register_views(
        spark,
        {
            "market_data": featured,
            "symbol_counts": rankings.row_count_by_symbol(featured),
            "volatility_results": rankings.volatility_ranking(featured),
            "activity_results": rankings.activity_ranking(featured),
        },
    )


def market_summary_sql(spark: SparkSession, least_rows: int = 1) -> DataFrame:
    """The ranked market summary of the registered views, of symbols with enough candles."""
    return spark.sql(MARKET_SUMMARY, args={"least_rows": least_rows})


def symbol_history_sql(spark: SparkSession, symbol: str, since: str, until: str, direction: str = "up") -> DataFrame:
    """Daily history of one symbol from ``market_data``."""
    return spark.sql(SYMBOL_HISTORY, args={"symbol": symbol, "since": since, "until": until, "direction": direction})
