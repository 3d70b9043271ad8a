"""candlewick: Spark-native candle (OHLCV) ingest, data-quality and market analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins; nothing is collected to the driver inside an operator.
"""

from candlewick.session import build_session, ensure_session_defaults, checkpoint_dir

__all__ = ["build_session", "ensure_session_defaults", "checkpoint_dir"]
