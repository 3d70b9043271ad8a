"""Request log: ``YYYY-MM-DDTHH:MM:SSZ | message`` lines -> typed table.

Message kinds: START (symbol, interval, limit), END (symbol, records),
ERROR (symbol, text), RATE_LIMIT (wait seconds), WROTE (csv, records),
DOWNLOADED (symbol, records); anything else is kept as OTHER.  An optional
``id=<n>`` token names the request when the log carries one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Line and message formats (fixed by the log writer).
LINE_PATTERN = r"^(\S+) \| (.*)$"
KIND_STARTS = [
    ("START", "START request "),
    ("END", "END request "),
    ("ERROR", "ERROR request "),
    ("RATE_LIMIT", "RATE_LIMIT wait "),
    ("WROTE", "WROTE "),
    ("DOWNLOADED", "Downloaded "),
]
SYMBOL_PATTERN = r"(?:symbol=|^Downloaded )([^\s:]+)"
INTERVAL_PATTERN = r"interval=(\S+)"
LIMIT_PATTERN = r"limit=(\d+)"
RECORDS_PATTERN = r"(?:records=|: )(\d+)(?: records)?"
WAIT_PATTERN = r"^RATE_LIMIT wait ([0-9.]+)s"
CSV_PATTERN = r"csv=(\S+)"
ID_PATTERN = r"\bid=(\d+)"
ERROR_PATTERN = r"^ERROR request symbol=[^\s:]+(?: id=\d+)?: (.*)$"


#: Where a line stands: file, block of the file (as it was split for reading), and a
#: number that grows along the block.
LINE_PLACE = ["log_file", "log_block", "line_order"]


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of one or more log files, with their place in file order.

    Files are ordered by path, as rotated logs are named; a block's lines are read by one
    task, in order, so the running id orders them whatever else that task reads.
    """
    lines = spark.read.text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("log_file"), F.col("_metadata.file_block_start").alias("log_block"), F.monotonically_increasing_id().alias("line_order")
    )


def _extract(text: F.Column, pattern: str) -> F.Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def parse_request_log(lines: DataFrame, line_col: str = "value", with_line_order: bool = False) -> DataFrame:
    """Typed log table, one row a line.

    A line of another form is kept whole as the message of an OTHER row.  A number that
    can't be read (too large, malformed) is NULL; the message still holds its text.
    ``with_line_order`` adds ``log_file, log_block, line_order``, the line's place: from
    ``read_log_lines``, or in the order in which the frame's partitions hold the lines.
    """
    if with_line_order and "line_order" not in lines.columns:
        placed = lines.withColumn("line_order", F.monotonically_increasing_id())
        lines = placed.withColumns({"log_file": F.lit(""), "log_block": F.shiftright("line_order", 33)})
    place = LINE_PLACE if with_line_order else []
    line = F.col(line_col)
    # stamp and message are extracted once, for all columns that need them
    parted = lines.select(line.alias("_line"), F.regexp_extract(line, LINE_PATTERN, 1).alias("_stamp"), F.regexp_extract(line, LINE_PATTERN, 2).alias("_text"), *place)
    parted = parted.select("_stamp", F.when(F.col("_stamp") == "", F.col("_line")).otherwise(F.col("_text")).alias("_msg"), *place)
    msg, stamp = F.col("_msg"), F.col("_stamp")
    kind = F.lit("OTHER")
    for name, start in reversed(KIND_STARTS):
        kind = F.when((stamp != "") & msg.startswith(start), F.lit(name)).otherwise(kind)
    typed = parted.withColumn("kind", kind)
    return typed.select(
        F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz").alias("ts"),
        "kind",
        _extract(msg, SYMBOL_PATTERN).alias("symbol"),
        _extract(msg, INTERVAL_PATTERN).alias("interval"),
        _extract(msg, LIMIT_PATTERN).try_cast("bigint").alias("limit"),
        F.when(F.col("kind").isin("END", "WROTE", "DOWNLOADED"), _extract(msg, RECORDS_PATTERN).try_cast("bigint")).alias("records"),
        _extract(msg, WAIT_PATTERN).try_cast("double").alias("wait_seconds"),
        _extract(msg, CSV_PATTERN).alias("csv"),
        _extract(msg, ID_PATTERN).try_cast("bigint").alias("request_id"),
        _extract(msg, ERROR_PATTERN).alias("error"),
        msg.alias("message"),
        *place,
    )


def requests_from_events(events: DataFrame) -> DataFrame:
    """events -> request intervals: client = symbol, start = ts,
    end = ts + value minutes (whole microseconds), records = props.k."""
    from candlewick.sources.events import symbol_from_event_type

    start_us = F.unix_micros(F.col("ts").cast("timestamp"))
    dur_us = F.floor(F.col("value") * F.lit(60_000_000.0)).cast("bigint")
    return events.select(
        F.col("event_id").alias("request_id"),
        symbol_from_event_type("event_type").alias("client"),
        F.col("ts").alias("start_ts"),
        F.timestamp_micros(start_us + dur_us).cast("timestamp_ntz").alias("end_ts"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("records"),
        (F.col("event_type") == F.lit("error")).alias("failed"),
    )


def log_lines_from_requests(requests: DataFrame, interval: str = "1h", limit: int = 1000) -> DataFrame:
    """Render requests as log lines (START, then END + Downloaded, or ERROR)."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    start = F.date_format(F.col("start_ts"), fmt)
    end = F.date_format(F.col("end_ts"), fmt)
    sym, rid, rec = F.col("client"), F.col("request_id").cast("string"), F.col("records").cast("string")
    start_line = F.concat(start, F.lit(f" | START request symbol="), sym, F.lit(f" interval={interval} limit={limit} id="), rid)
    end_line = F.concat(end, F.lit(" | END request symbol="), sym, F.lit(" records="), rec, F.lit(" id="), rid)
    done_line = F.concat(end, F.lit(" | Downloaded "), sym, F.lit(": "), rec, F.lit(" records"))
    error_line = F.concat(end, F.lit(" | ERROR request symbol="), sym, F.lit(" id="), rid, F.lit(": 500 Server Error"))
    lines = F.when(F.col("failed"), F.array(start_line, error_line)).otherwise(F.array(start_line, end_line, done_line))
    return requests.select(F.explode(lines).alias("value"))


def run_log_lines(requests: DataFrame, interval: str = "1h", limit: int = 1000) -> DataFrame:
    """Render requests as a log without ids, the way a downloader writes it: one run a day.

    Returns (t, k, seq, value): ``t`` whole seconds, and the order of lines within one.
    A run begins with a ``Starting`` line and ends with ``WROTE``.  A request that is still
    open at the end of its day ends then.  Every seventh request first waits for the rate
    limit; some numbers are malformed, as a log cut by a crash has them.
    """
    day = F.to_date("start_ts")
    start = F.unix_seconds(F.col("start_ts").cast("timestamp"))
    last = F.unix_seconds((day + F.expr("INTERVAL 1 DAY")).cast("timestamp")) - 2
    end = F.least(F.unix_seconds(F.col("end_ts").cast("timestamp")), last)
    rid, sym = F.col("request_id"), F.col("client")
    count = F.when(rid % 101 == 0, F.lit("99999999999999999999")).otherwise(F.col("records").cast("string"))
    wait = F.when(rid % 77 == 0, F.lit("1.2.3")).otherwise(((rid % 6000) / 100).cast("decimal(10,2)").cast("string"))

    def line(t: F.Column, seq: int, *text) -> F.Column:
        parts = [x if isinstance(x, F.Column) else F.lit(x) for x in text]
        return F.struct(t.alias("t"), rid.alias("k"), F.lit(seq).alias("seq"), F.concat(*parts).alias("text"))

    waits = F.when(rid % 7 == 0, F.array(line(start, 0, "RATE_LIMIT wait ", wait, "s"))).otherwise(F.array())
    begun = F.array(line(start, 1, "START request symbol=", sym, f" interval={interval} limit={limit}"))
    ended = F.when(F.col("failed"), F.array(line(end, 2, "ERROR request symbol=", sym, ": 500 Server Error"))).otherwise(
        F.array(line(end, 2, "END request symbol=", sym, " records=", count), line(end, 3, "Downloaded ", sym, ": ", count, " records"))
    )
    each = requests.select(F.explode(F.concat(waits, begun, ended)).alias("_l")).select("_l.*")
    days = requests.groupBy(day.alias("day")).agg(F.sum("records").alias("records"), F.count_distinct("client").alias("symbols"))
    midnight = F.unix_seconds(F.col("day").cast("timestamp"))
    how = F.when(F.dayofmonth("day") % 2 == 1, F.lit("serial")).otherwise(F.lit("multithreaded"))
    marks = F.array(
        F.struct(midnight.alias("t"), F.lit(-1).cast("bigint").alias("k"), F.lit(0).alias("seq"), F.concat(F.lit("Starting "), how, F.lit(" download for "), F.col("symbols").cast("string"), F.lit(" symbols")).alias("text")),
        F.struct((midnight + 86399).alias("t"), F.lit(-1).cast("bigint").alias("k"), F.lit(1).alias("seq"), F.concat(F.lit("WROTE csv=data/"), F.col("day").cast("string"), F.lit(".csv records="), F.col("records").cast("string")).alias("text")),
    )
    lines = each.unionByName(days.select(F.explode(marks).alias("_l")).select("_l.*")).where(F.col("text").isNotNull())
    stamp = F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return lines.select("t", "k", "seq", F.concat(stamp, F.lit(" | "), F.col("text")).alias("value"))


def write_log(lines: DataFrame, path: str, files: int = 4) -> None:
    """Write lines that carry (t, k, seq) as log files whose names and lines are in that order."""
    order = ["t", "k", "seq"]
    lines.repartitionByRange(files, *order).sortWithinPartitions(*order).select("value").write.text(path)
