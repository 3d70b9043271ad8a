"""CSV scans bound by header name: no type inference, only the header line is read first.

All files of one folder must carry the same header; one that differs raises instead of
being read with its columns mixed up.  A column absent from the header is absent from the
result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalar import safe_timestamp
from candlewick.schema import CLEANED_SCHEMA, FIELDNAMES, TIME_COLS
from candlewick.sources.sinks import CSV_EXACT_FORM, CSV_READ_FORM


def _scan_by_header(spark: SparkSession, path: str, types: dict[str, T.DataType], rejects: str | None, multi_line: bool = False, form: dict = CSV_READ_FORM) -> DataFrame:
    header = spark.read.options(**form).option("multiLine", multi_line).csv(path).columns
    fields = [T.StructField(c, types.get(c, T.StringType()), True) for c in header]
    reader = spark.read.options(**form).option("enforceSchema", False).option("multiLine", multi_line)
    if rejects:
        fields.append(T.StructField(rejects, T.StringType(), True))
        # a line's cells are only counted when all its columns are parsed
        reader = reader.option("columnNameOfCorruptRecord", rejects).option("columnPruning", False)
    return reader.schema(T.StructType(fields)).csv(path)


def scan_typed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Any CSV of ``write_csv``, bound by header name, with the types of ``schema``; empty
    texts and NULL stay apart.

    ``multi_line`` reads cells that hold line breaks; each file is then read by one task.
    """
    df = _scan_by_header(spark, path, {f.name: f.dataType for f in schema.fields}, None, multi_line, CSV_EXACT_FORM)
    return df.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def scan_messy(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """Dirty candle CSV, every column as text; empty fields are NULL.

    The candle columns come in their usual order, followed by any others of the file.
    With ``rejects`` a column of that name holds the whole line where its number of cells
    differs from the header's, and NULL elsewhere.
    """
    df = _scan_by_header(spark, path, {}, rejects)
    known = [c for c in FIELDNAMES if c in df.columns]
    return df.select(*known, *[F.col(f"`{c}`") for c in df.columns if c not in known])


def scan_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned candle CSV with its known types; other columns stay text.

    Time columns are read as text and parsed with ``safe_timestamp`` so any
    ISO-8601 form (with or without offset / fraction) lands as UTC wall time.
    Derived columns the file lacks stay absent, for ``ensure_derived`` to add.
    """
    df = _scan_by_header(spark, path, {f.name: f.dataType for f in CLEANED_SCHEMA.fields if f.name not in TIME_COLS}, None)
    return df.withColumns({c: safe_timestamp(c) for c in TIME_COLS if c in df.columns})


def scan_nonempty(spark: SparkSession, path: str) -> DataFrame:
    """``scan_messy`` that raises ``ValueError`` when the file holds no rows
    (the check reads at most one row)."""
    df = scan_messy(spark, path)
    if df.isEmpty():
        raise ValueError(f"No rows found in {path}")
    return df


def union_batches(*batches: DataFrame) -> DataFrame:
    """Concatenate per-symbol (or per-file) batches by column name; order is not significant."""
    if not batches:
        raise ValueError("no batches")
    return reduce(lambda a, b: a.unionByName(b), batches)
