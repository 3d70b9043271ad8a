"""Cleaning: safe coercion, symbol normalisation, de-duplication, impossible rows.

``clean_candles`` applies the steps in the reference order
coerce numbers -> coerce times -> normalise symbols -> drop exact duplicates
-> drop impossible rows -> derive price columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions import scalar
from candlewick.operators.derive import derived_columns
from candlewick.schema import NUMERIC_COLS, TIME_COLS


def coerce_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or NUMERIC_COLS) if c in df.columns]
    return df.withColumns({c: scalar.safe_double(c) for c in cols})


def coerce_timestamp(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or TIME_COLS) if c in df.columns]
    return df.withColumns({c: scalar.safe_timestamp(c) for c in cols})


def normalise_symbols(df: DataFrame, col: str = "symbol") -> DataFrame:
    return df.withColumn(col, scalar.normalise_symbol(col))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns, NULL equal to NULL; one copy kept.

    Planned as a partial+final hash aggregate, so repeated rows collapse on the
    map side before the shuffle.
    """
    return df.dropDuplicates()


def impossible_condition(rule: str = "parity") -> F.Column:
    """volume < 0 OR trade_count < 0 OR high < low (``all_volumes`` also checks
    the other three volume columns).  A comparison with NULL counts as false."""
    checks = [F.col("volume") < 0, F.col("trade_count") < 0, F.col("high") < F.col("low")]
    if rule == "all_volumes":
        checks += [F.col(c) < 0 for c in ("quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")]
    return F.coalesce(reduce(lambda a, b: a | b, checks), F.lit(False))


def drop_impossible(df: DataFrame, rule: str = "parity") -> DataFrame:
    return df.filter(~impossible_condition(rule))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def drop_subset_null(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def typed_columns(columns: list[str]) -> list[F.Column]:
    """The coerced form of every column: numbers, times, symbol; others as is."""
    out = []
    for c in columns:
        if c in NUMERIC_COLS:
            out.append(scalar.safe_double(c).alias(c))
        elif c in TIME_COLS:
            out.append(scalar.safe_timestamp(c).alias(c))
        elif c == "symbol":
            out.append(scalar.normalise_symbol(c).alias(c))
        else:
            out.append(F.col(c))
    return out


def coerce_and_normalise(raw: DataFrame, extra: list[F.Column] | None = None) -> DataFrame:
    """coerce_numeric + coerce_timestamp + normalise_symbols as one projection
    (``extra`` columns are computed from the raw text in the same pass)."""
    return raw.select(*typed_columns(raw.columns), *(extra or []))


def clean_candles(raw: DataFrame, rule: str = "parity") -> DataFrame:
    """All-text candle table -> typed, de-duplicated, plausible candles + 4 derived columns."""
    return derived_columns(drop_impossible(drop_duplicates(coerce_and_normalise(raw)), rule))


def clean_candles_strict(raw: DataFrame, rule: str = "parity") -> DataFrame:
    """``clean_candles`` that also drops every row still holding a missing value."""
    return drop_any_null(clean_candles(raw, rule))


def dedup_by_candle_key(df: DataFrame, key: tuple[str, ...] = ("symbol", "interval", "open_time")) -> DataFrame:
    """One row per market candle (symbol, interval, open_time): the copy with the
    fewest missing cells wins, remaining ties broken by the row values.

    An arg-min as an aggregate: ``min`` of one struct that compares as the order does, so
    each map task forwards one row a key and there is one exchange.  Rows whose key
    is incomplete cannot be identified as the same candle and are all kept: their group is
    their whole row, with the number of times it came.
    """
    key = [k for k in key if k in df.columns]
    others = [c for c in df.columns if c not in key]
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    n_missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
    # NULL sorts last within each column: a flag goes before the value
    order = F.struct(n_missing.alias("n"), *[x for i, c in enumerate(others) for x in (F.col(c).isNull().alias(f"f{i}"), F.col(c).alias(f"v{i}"))])
    groups = df.groupBy(*key, F.when(incomplete, order).alias("_own")).agg(F.min(order).alias("_best"), F.count(F.lit(1)).alias("_n"))
    times = F.when(F.col("_own").isNotNull(), F.col("_n")).otherwise(F.lit(1)).cast("int")
    kept = groups.select(*key, "_best", F.explode(F.array_repeat(F.lit(0), times)))
    values = {**{k: F.col(k) for k in key}, **{c: F.col(f"_best.v{i}").alias(c) for i, c in enumerate(others)}}
    return kept.select(*[values[c] for c in df.columns])


def unknown_symbols(df: DataFrame, known: DataFrame, col: str = "symbol") -> DataFrame:
    """(symbol, rows) of the symbols that the ``known`` dimension lacks, NULL included.

    Rows are counted before the anti join, so it meets one row a symbol and a symbol
    with a third of all rows is no hot key.
    """
    dim = known.select(F.col(col).alias("_known")).distinct()
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(dim, counts[col] == dim["_known"], "left_anti")
