"""Sinks: CSV / Parquet writers and temp views.  Nothing goes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How cells are written and read back: quotes are doubled, blanks around a cell are part
#: of it, an empty cell is NULL and an empty text is a pair of quotes.
CSV_FORM = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "",
    "emptyValue": '""',
}
#: ``emptyValue`` is what is written; on reading it is what such a cell becomes: NULL, too,
#: as most readers have it, or (with a mark for NULL that no text is) the empty text.
CSV_READ_FORM = {**CSV_FORM, "emptyValue": ""}
CSV_EXACT_FORM = {**CSV_READ_FORM, "nullValue": "\x01NULL\x01"}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header, overwrite, parents created.  A zero-row frame still writes a
    header-only part file.  ``single_file`` coalesces to one task -- only for
    small, bounded outputs such as the per-symbol summary."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_FORM).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_by_date(df: DataFrame, path: str, time: str = "open_time", replace_all: bool = False) -> None:
    """Parquet in one folder a ``trade_date`` (the date of ``time``; none for NULL).

    Only the dates that ``df`` holds are replaced, so a day can be run again by itself;
    with ``replace_all`` every date goes.
    """
    dated = df.drop("trade_date").withColumn("trade_date", F.to_date(time))
    mode = "static" if replace_all else "dynamic"
    dated.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("trade_date").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary has one row per symbol, so a single CSV part is cheap."""
    write_csv(summary, path, single_file=True)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Name frames for SQL; a name that is taken is given to the new frame."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
