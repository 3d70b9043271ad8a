"""Data-quality measurements, each a single aggregation pass.

The reference computes ~10 counters with one eager pass each; here they are
folded into as few aggregations as possible.  ``dq_report`` needs exactly one
shuffle (the group-by-all-columns that is also the de-duplication).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import scalar
from candlewick.operators.clean import coerce_and_normalise, impossible_condition
from candlewick.schema import FIELDNAMES, NUMERIC_COLS, TIME_COLS


def _long(one_row: DataFrame, name_col: str, value_col: str) -> DataFrame:
    """One-row frame of counters -> (position, name, value) rows, no shuffle."""
    cols = one_row.columns
    structs = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias(name_col), F.col(c).cast("bigint").alias(value_col))
        for i, c in enumerate(cols)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def _nulls_in_row(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in cols])


def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing cells per column (only columns with some), with the most affected
    column flagged (first column wins a tie).  One aggregation; the flag is
    worked out inside the single result row, before it is unpivoted."""
    cols = df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    top = F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])
    first_top = F.coalesce(*[F.when(F.col(c) == top, F.lit(i)) for i, c in enumerate(cols)])
    one = one.select("*", first_top.alias("_top"))
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).cast("bigint").alias("missing_count"),
            F.lit(i).alias("position"),
            (F.col("_top") == F.lit(i)).alias("most_affected"),
        )
        for i, c in enumerate(cols)
    ]
    return one.select(F.inline(F.array(*structs))).filter(F.col("missing_count") > 0)


def invalid_by_column(raw: DataFrame) -> DataFrame:
    """Cells that had text but did not parse (NULL after coercion, not before)."""
    exprs = []
    for c in NUMERIC_COLS + TIME_COLS:
        if c not in raw.columns:
            continue
        parsed = scalar.safe_double(c) if c in NUMERIC_COLS else scalar.safe_timestamp(c)
        exprs.append(F.count_if(F.col(c).isNotNull() & parsed.isNull()).alias(c))
    out = _long(raw.agg(*exprs), "column_name", "invalid_count")
    return out.withColumn("kind", F.when(F.col("column_name").isin(*TIME_COLS), F.lit("timestamp")).otherwise(F.lit("numeric")))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row: n - n_distinct (NULL == NULL)."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def impossible_counts(df: DataFrame) -> DataFrame:
    """Per-rule violations and the number of rows violating any rule."""
    return df.agg(
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        F.count_if(F.col("trade_count") < 0).alias("negative_trade_count"),
        F.count_if(F.col("high") < F.col("low")).alias("high_below_low"),
        F.count_if(impossible_condition()).alias("impossible_rows"),
    )


def symbol_domain(raw: DataFrame) -> DataFrame:
    """Distinct symbols before and after normalisation (NULL not counted).

    ``count_distinct`` is exact (one extra shuffle on the symbol); swap in
    ``approx_count_distinct`` when only the order of magnitude matters.
    """
    return raw.agg(
        F.count_distinct("symbol").alias("symbols_before"),
        F.count_distinct(scalar.normalise_symbol("symbol")).alias("symbols_after"),
    )


#: log2 of the registers of a sketch: a standard error of about 1.6 %.
SKETCH_SIZE = 12


def domain_sketches(raw: DataFrame, batch: str, cols: list[str] | None = None) -> DataFrame:
    """(batch, column_name, sketch): mergeable distinct-count sketches of each column's
    values, NULL not counted, for each value of ``batch``.

    A sketch is a few KB whatever the number of rows.  Stored by batch, it lets the domain
    of a new batch be merged with all earlier ones without reading them again.
    """
    cols = cols or [c for c in raw.columns if c != batch]
    one = raw.groupBy(F.col(batch).alias("batch")).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_SIZE).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("sketch")) for c in cols]
    return one.select("batch", F.inline(F.array(*pairs)))


def merged_domains(sketches: DataFrame) -> DataFrame:
    """(column_name, estimate): distinct values over all batches of ``domain_sketches``."""
    return sketches.groupBy("column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def domain_check(exact: DataFrame, merged: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Exact counts (column_name, exact) beside the sketches', and whether these are within
    ``tolerance`` of them."""
    within = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * F.lit(tolerance)
    return exact.join(merged, "column_name", "left").select("column_name", "exact", "estimate", F.coalesce(within, F.lit(False)).alias("within"))


def exact_domains(raw: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, exact): distinct values of each column, NULL not counted."""
    return _long(raw.agg(*[F.count_distinct(c).alias(c) for c in cols]), "column_name", "exact").drop("position")


def symbol_lists(raw: DataFrame) -> DataFrame:
    """(stage, symbol, rows): every distinct symbol before and after normalisation, NULL left out.

    Rows are counted as they came first; the normalised list is summed from those counts.
    """
    before = raw.where(F.col("symbol").isNotNull()).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    forms = F.array(
        F.struct(F.lit("before").alias("stage"), F.col("symbol").alias("symbol")),
        F.struct(F.lit("after").alias("stage"), scalar.normalise_symbol("symbol").alias("symbol")),
    )
    return before.select(F.explode(forms).alias("_s"), "rows").groupBy("_s.stage", "_s.symbol").agg(F.sum("rows").alias("rows"))


def dq_report(raw: DataFrame, rule: str = "parity") -> DataFrame:
    """Before/after report of ``clean_candles`` as (position, metric, value) rows.

    One scan and one shuffle: rows are coerced and grouped by all 13 columns
    (the de-duplication itself), carrying per-row raw counters as sums.
    ``missing_after`` counts over the 17 output columns, derived ones included.
    """
    present_num = [c for c in NUMERIC_COLS if c in raw.columns]
    present_time = [c for c in TIME_COLS if c in raw.columns]
    invalid_num = reduce(
        lambda a, b: a + b,
        [(F.col(c).isNotNull() & scalar.safe_double(c).isNull()).cast("bigint") for c in present_num],
    )
    invalid_time = reduce(
        lambda a, b: a + b,
        [(F.col(c).isNotNull() & scalar.safe_timestamp(c).isNull()).cast("bigint") for c in present_time],
    )
    typed = coerce_and_normalise(
        raw,
        extra=[
            _nulls_in_row(raw.columns).alias("_raw_nulls"),
            invalid_num.alias("_bad_num"),
            invalid_time.alias("_bad_time"),
        ],
    )
    cols = [c for c in FIELDNAMES if c in raw.columns]
    groups = typed.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_raw_nulls").alias("_raw_nulls"),
        F.sum("_bad_num").alias("_bad_num"),
        F.sum("_bad_time").alias("_bad_time"),
    )
    bad = impossible_condition(rule)
    derived_nulls = (
        (F.col("high").isNull() | F.col("low").isNull()).cast("bigint")
        + (F.col("close").isNull() | F.col("open").isNull()).cast("bigint")
        + (F.col("close").isNull() | F.col("open").isNull() | (F.col("open") == 0)).cast("bigint")
    )
    def total(c: F.Column) -> F.Column:
        return F.coalesce(F.sum(c), F.lit(0))

    one = groups.agg(
        total(F.col("_n")).alias("rows_before"),
        F.count_if(~bad).alias("rows_after"),
        total(F.col("_raw_nulls")).alias("missing_before"),
        total(F.when(~bad, _nulls_in_row(cols) + derived_nulls)).alias("missing_after"),
        total(F.col("_n") - 1).alias("duplicates_found"),
        total(F.col("_bad_num")).alias("invalid_numeric_cells"),
        total(F.col("_bad_time")).alias("invalid_timestamp_cells"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        F.count_if(bad).alias("dropped_impossible"),
    )
    return _long(one, "metric", "value")


class CleanReports:
    """Counters of a cleaning run, observed on its two writes.

    ``observe_raw`` goes on the narrow typed write and ``observe_distinct`` /
    ``observe_cleaned`` behind the de-duplication of the next: metrics of the tasks that
    write are counted once each, also when executors are lost and earlier stages run again.
    """

    def __init__(self, columns: list[str], rule: str = "parity"):
        self.rule = rule
        self.columns = [c for c in FIELDNAMES if c in columns]
        self.checked = [c for c in NUMERIC_COLS + TIME_COLS if c in columns]
        self.raw, self.distinct, self.cleaned = (Observation(f"{part}-{uuid.uuid4().hex}") for part in ("raw", "distinct", "cleaned"))

    def observe_raw(self, raw: DataFrame, as_typed: list[Column]) -> DataFrame:
        """Typed columns of the raw text, with missing and invalid cells counted."""
        both = raw.select(F.struct(*[F.col(c) for c in self.columns]).alias("_raw"), *as_typed)
        missing = [F.count_if(F.col(f"_raw.{c}").isNull()).alias(f"missing {c}") for c in self.columns]
        invalid = [F.count_if(F.col(f"_raw.{c}").isNotNull() & F.col(c).isNull()).alias(f"invalid {c}") for c in self.checked]
        return both.observe(self.raw, F.count(F.lit(1)).alias("rows"), *missing, *invalid)

    def observe_distinct(self, typed: DataFrame) -> DataFrame:
        bad = impossible_condition(self.rule)
        return typed.observe(
            self.distinct,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("volume") < 0).alias("negative_volume"),
            F.count_if(F.col("trade_count") < 0).alias("negative_trade_count"),
            F.count_if(F.col("high") < F.col("low")).alias("high_below_low"),
            F.count_if(bad).alias("impossible_rows"),
        )

    def observe_cleaned(self, cleaned: DataFrame) -> DataFrame:
        missing = F.coalesce(F.sum(_nulls_in_row(cleaned.columns)), F.lit(0)).alias("missing")
        return cleaned.observe(self.cleaned, F.count(F.lit(1)).alias("rows"), missing)

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The reports of ``dq_report``, ``missing_by_column``, ``invalid_by_column`` and
        ``impossible_counts``, after both writes."""
        raw, distinct, cleaned = self.raw.get, self.distinct.get, self.cleaned.get
        missing = {c: raw[f"missing {c}"] for c in self.columns}
        invalid = {c: raw[f"invalid {c}"] for c in self.checked}
        most = max(missing.values(), default=0)
        first = next((c for c, n in missing.items() if n == most), None)
        report = {
            "rows_before": raw["rows"],
            "rows_after": cleaned["rows"],
            "missing_before": sum(missing.values()),
            "missing_after": cleaned["missing"],
            "duplicates_found": raw["rows"] - distinct["rows"],
            "invalid_numeric_cells": sum(invalid[c] for c in self.checked if c in NUMERIC_COLS),
            "invalid_timestamp_cells": sum(invalid[c] for c in self.checked if c in TIME_COLS),
            "negative_volume": distinct["negative_volume"],
            "dropped_impossible": distinct["impossible_rows"],
        }
        impossible = [distinct[k] for k in ("negative_volume", "negative_trade_count", "high_below_low", "impossible_rows")]
        return {
            "dq_report": spark.createDataFrame([(i, k, n) for i, (k, n) in enumerate(report.items())], "position int, metric string, value bigint"),
            "missing_by_column": spark.createDataFrame(
                [(c, n, i, c == first) for i, (c, n) in enumerate(missing.items()) if n], "column_name string, missing_count bigint, position int, most_affected boolean"
            ),
            "invalid_by_column": spark.createDataFrame(
                [(i, c, n, "timestamp" if c in TIME_COLS else "numeric") for i, (c, n) in enumerate(invalid.items())],
                "position int, column_name string, invalid_count bigint, kind string",
            ),
            "impossible_counts": spark.createDataFrame([impossible], "negative_volume bigint, negative_trade_count bigint, high_below_low bigint, impossible_rows bigint"),
        }


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column counts in one row (the column count is schema metadata)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def profile_schema(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) of a frame's schema -- metadata only, no job."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First n rows in a stated order (a per-task top-n, then a merge).

    The reference previews with an unordered LIMIT; ordering first makes the
    preview repeatable.
    """
    keys = order_by or df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in keys]).limit(n)
