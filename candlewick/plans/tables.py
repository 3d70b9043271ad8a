"""The reference's three stages, applied to the driver tables.

events -> candles (collect) -> messy copy (defect injection) -> cleaned
(clean) -> featured (time features for analytics).  Every stage is a lazy
plan; nothing is materialised unless a caller asks for it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators.clean import clean_candles
from candlewick.operators.defects import inject_defects
from candlewick.operators.derive import time_features
from candlewick.session import ensure_session_defaults
from candlewick.sources.events import candles_from_events, read_events
from candlewick.sources.requestlog import requests_from_events

SEED = 42


class Stages:
    """Lazy plans of each stage for one session and data folder.

    One instance serves one query: files that land later are seen by the next.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ensure_session_defaults(spark)
        self.sf_dir = sf_dir.rstrip("/")

    @cached_property
    def _events(self) -> DataFrame:
        return read_events(self.spark, self.sf_dir)

    @cached_property
    def _candles(self) -> DataFrame:
        return candles_from_events(self._events)

    @cached_property
    def _messy(self) -> DataFrame:
        return inject_defects(self._candles, seed=SEED)

    @cached_property
    def _cleaned(self) -> DataFrame:
        return clean_candles(self._messy)

    @cached_property
    def _featured(self) -> DataFrame:
        return time_features(self._cleaned)

    @cached_property
    def _requests(self) -> DataFrame:
        return requests_from_events(self._events)

    def events(self) -> DataFrame:
        return self._events

    def candles(self) -> DataFrame:
        return self._candles

    def messy(self) -> DataFrame:
        return self._messy

    def cleaned(self) -> DataFrame:
        return self._cleaned

    def featured(self) -> DataFrame:
        return self._featured

    def requests(self) -> DataFrame:
        return self._requests
