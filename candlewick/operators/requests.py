"""Request-log analytics: the data side of the reference's rate limiter,
semaphore and START/END log.

The reference throttles its own HTTP calls in-process; what can be computed
from data is what actually happened: how many requests fell in each trailing
window, how many were in flight at once, and how long each took.

Per-client time-ordered windows are the skew hazard here -- one client may
own a third of all requests -- so no window below is partitioned by client
alone.  Rows are split by (client, time bucket):

* trailing-window counts are the difference of two prefix counts: requests so far less
  those that have left the window, each a mark on one time line, through the scan below;
* running sums (in-flight counts) are done as a two-level scan: per-bucket
  totals -> cumulative offsets over buckets (one row per client and bucket)
  -> running sum inside the bucket plus its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.scalar import exact_sum
from candlewick.schema import MAX_WORKERS, RATE_LIMIT, RATE_WINDOW_SECONDS

MICROS = 1_000_000


def _micros(c: str) -> F.Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def rate_window_counts(
    requests: DataFrame,
    client: str = "client",
    ts: str = "ts",
    window_seconds: int = RATE_WINDOW_SECONDS,
    cap: int = RATE_LIMIT,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Adds ``in_window`` = requests of the same client in (ts - W, ts] and
    ``over_limit`` = in_window > cap.  Equal timestamps count each other.

    Requests up to t less requests up to t - W: every request puts a mark +1 at t, and -1 at
    t + W, on its client's time line, and the answer is the sum of marks so far.  That sum
    is taken in time buckets of ``bucket_seconds`` (an hour), which have nothing to do with
    W, plus what the buckets before add up to; a narrower bucket splits a hot client further.
    Requests without a time are kept, with NULL counts.
    """
    w_us, b_us = int(window_seconds * MICROS), int((bucket_seconds or 3600) * MICROS)
    row = F.struct(*[F.col(f"`{c}`") for c in requests.columns])
    none = F.lit(None).cast(requests.select(row.alias("r")).schema["r"].dataType)
    t = _micros(ts)
    marks = F.array(
        F.struct(t.alias("t"), F.lit(1).cast("bigint").alias("delta"), row.alias("row")),
        F.struct((t + w_us).alias("t"), F.lit(-1).cast("bigint").alias("delta"), none.alias("row")),
    )
    timed = requests.filter(F.col(ts).isNotNull()).select(F.col(client).alias("_c"), F.explode(marks).alias("_m"))
    events = timed.select("_c", "_m.*").withColumn("_b", F.floor(F.col("t") / F.lit(b_us)))
    totals = events.groupBy("_c", "_b").agg(F.sum("delta").alias("_sum"))
    offsets = _prefix_offsets(totals, "_c").select(F.col("_c").alias("_oc"), F.col("_b").alias("_ob"), "_offset")
    sofar = Window.partitionBy("_c", "_b").orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    counted = events.withColumn("_run", F.sum("delta").over(sofar)).filter(F.col("row").isNotNull())
    joined = counted.join(offsets, F.col("_c").eqNullSafe(F.col("_oc")) & (F.col("_b") == F.col("_ob")))
    count = F.col("_offset") + F.col("_run")
    out = joined.select("row.*", count.alias("in_window"), (count > F.lit(cap)).alias("over_limit"))
    untimed = requests.filter(F.col(ts).isNull())
    return out.unionByName(untimed.select("*", F.lit(None).cast("bigint").alias("in_window"), F.lit(None).cast("boolean").alias("over_limit")))


def rate_window_summary(counted: DataFrame, client: str = "client") -> DataFrame:
    return counted.groupBy(client).agg(
        F.count(F.lit(1)).alias("requests"),
        F.max("in_window").alias("max_in_window"),
        F.count_if("over_limit").alias("over_limit_requests"),
    )


def _prefix_offsets(totals: DataFrame, client: str) -> DataFrame:
    """(client, _b, _sum) -> (client, _b, _offset = sum of earlier buckets)."""
    w = Window.partitionBy(client).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_offset", F.coalesce(F.sum("_sum").over(w), F.lit(0)))


def _flight_events(requests: DataFrame, client: str, start: str, end: str, b_us: int) -> DataFrame:
    """+1 at each start, -1 at each end; a request without an end stays open."""
    points = F.array(
        F.struct(_micros(start).alias("t"), F.lit(1).cast("bigint").alias("delta")),
        F.struct(_micros(end).alias("t"), F.lit(-1).cast("bigint").alias("delta")),
    )
    events = requests.filter(F.col(start).isNotNull()).select(F.col(client).alias(client), F.explode(points).alias("_e"))
    events = events.select(client, "_e.t", "_e.delta").filter(F.col("t").isNotNull())
    return events.withColumn("_b", F.floor(F.col("t") / F.lit(b_us)))


def in_flight(
    requests: DataFrame,
    client: str = "client",
    start: str = "start_ts",
    end: str = "end_ts",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Number of a client's requests in flight right after each start/end event.

    A request occupies [start, end), or [start, ...) without an end: at equal times
    ends are applied before starts.  Requests without a start are left out.  A NULL
    client is a client of its own.  Returns (client, t, delta, in_flight).
    """
    events = _flight_events(requests, client, start, end, int(bucket_seconds * MICROS))
    totals = events.groupBy(client, "_b").agg(F.sum("delta").alias("_sum"))
    offsets = _prefix_offsets(totals, client).select(F.col(client).alias("_c"), F.col("_b").alias("_ob"), "_offset")
    inner = Window.partitionBy(client, "_b").orderBy("t", "delta").rowsBetween(Window.unboundedPreceding, 0)
    joined = events.join(offsets, F.col(client).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_ob")), "inner")
    return joined.select(
        client,
        "t",
        "delta",
        (F.col("_offset") + F.sum("delta").over(inner)).alias("in_flight"),
    )


def max_concurrency(
    requests: DataFrame,
    client: str = "client",
    start: str = "start_ts",
    end: str = "end_ts",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Peak number of simultaneous requests per client.

    Each (client, bucket) is reduced to its sum and its highest running count; the
    peak is the highest (sum of earlier buckets + highest running count).  No join.
    """
    events = _flight_events(requests, client, start, end, int(bucket_seconds * MICROS))
    inner = Window.partitionBy(client, "_b").orderBy("t", "delta").rowsBetween(Window.unboundedPreceding, 0)
    running = events.withColumn("_run", F.sum("delta").over(inner))
    buckets = running.groupBy(client, "_b").agg(F.sum("delta").alias("_sum"), F.max("_run").alias("_top"))
    peaks = _prefix_offsets(buckets, client)
    return peaks.groupBy(client).agg(F.max(F.col("_offset") + F.col("_top")).alias("max_concurrency"))


def concurrency_breaches(
    requests: DataFrame, client: str = "client", start: str = "start_ts", end: str = "end_ts", cap: int = MAX_WORKERS, bucket_seconds: int = 3600
) -> DataFrame:
    """Per client: requests, and those that were started while more than ``cap`` (themselves
    included) were in flight; requests of one instant count in the order of their numbers
    in flight."""
    begun = in_flight(requests, client, start, end, bucket_seconds).filter(F.col("delta") == 1)
    return begun.groupBy(client).agg(F.count(F.lit(1)).alias("requests"), F.count_if(F.col("in_flight") > cap).alias("over_cap"))


RUN_MARKER = r"^Starting .* download"
#: Lines of a log that one task numbers.
BLOCK_LINES = 1_000_000


def _numbered(rows: DataFrame, group: list[str], value: F.Column, into: str) -> DataFrame:
    """Add ``into``: the sum of ``value`` over the rows of the same group up to each row, in
    file order.  Rows carry ``_blk`` (their block, a struct that orders) and ``line_order``.

    A two-level scan: sums inside a block, plus the sums of the group's earlier blocks.
    """
    rows = rows.withColumn("_v", value)
    keys = ["_k", *group]
    rows = rows.withColumn("_k", F.lit(0))
    totals = rows.groupBy(*keys, "_blk").agg(F.sum("_v").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_o_{c}") for c in [*keys, "_blk"]], F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_blk").orderBy("line_order").rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in [*keys, "_blk"]]
    joined = rows.withColumn("_in", F.sum("_v").over(inside)).join(offsets, same)
    return joined.withColumn(into, F.col("_offset") + F.col("_in")).drop("_v", "_in", "_k", "_offset", *[f"_o_{c}" for c in [*keys, "_blk"]])


def assign_runs(log: DataFrame, marker: str = RUN_MARKER, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Number the download runs of a log: ``run`` = how many run-start lines (``marker``)
    came up to each line in file order (0 before the first).

    Needs ``parse_request_log(..., with_line_order=True)``.  Times play no part, so lines
    of one second, or without a stamp, are in the run they were written in.  No window
    is larger than ``block_lines`` lines of one block of a file.
    """
    blk = F.struct("log_file", "log_block", F.floor(F.col("line_order") / F.lit(block_lines)).alias("part"))
    return _numbered(log.withColumn("_blk", blk), [], F.col("message").rlike(marker).cast("bigint"), "run").drop("_blk")


def request_runs(log: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """The requests of a log without ids: (run, symbol, attempt, start_ts, end_ts, records,
    error, failed, latency_seconds).

    The n-th START of a symbol in a run belongs with its n-th END or ERROR, in file order,
    so tries of one symbol stay apart.  A try without an end (or without a start) has NULL
    there.  Numbers are counted inside blocks first, so a run that holds a third of all
    lines is spread over them; the pairing itself is a hash aggregate.
    """
    if "run" not in log.columns:
        log = assign_runs(log, block_lines=block_lines)
    blk = F.struct("log_file", "log_block", F.floor(F.col("line_order") / F.lit(block_lines)).alias("part"))
    kind = F.col("kind")
    some = log.filter(kind.isin("START", "END", "ERROR")).withColumns({"_blk": blk, "_begins": kind == "START"})
    numbered = _numbered(some, ["run", "symbol", "_begins"], F.lit(1).cast("bigint"), "attempt")
    paired = numbered.groupBy("run", "symbol", "attempt").agg(
        F.min(F.when(kind == "START", F.col("ts"))).alias("start_ts"),
        F.min(F.when(kind != "START", F.col("ts"))).alias("end_ts"),
        F.max(F.when(kind == "END", F.col("records"))).alias("records"),
        F.max("error").alias("error"),
        (F.count_if(kind == "ERROR") > 0).alias("failed"),
    )
    return paired.withColumn("latency_seconds", _latency())


def _latency() -> F.Column:
    return (F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))) / F.lit(float(MICROS))


def run_report(log: DataFrame) -> DataFrame:
    """One row a run: its kind, first and last stamp, lines, requests by outcome, records,
    rate-limit waits and what was written.  One hash aggregate after the run numbers."""
    if "run" not in log.columns:
        log = assign_runs(log)
    kind = F.col("kind")
    mode = F.nullif(F.regexp_extract("message", r"^Starting (\w+) download", 1), F.lit(""))
    return log.groupBy("run").agg(
        F.max(mode).alias("mode"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if(kind == "START").alias("started"),
        F.count_if(kind == "END").alias("ended"),
        F.count_if(kind == "ERROR").alias("failed"),
        F.sum(F.when(kind == "DOWNLOADED", F.col("records"))).alias("downloaded_records"),
        F.count_if(kind == "RATE_LIMIT").alias("rate_limit_waits"),
        F.count_if((kind == "RATE_LIMIT") & F.col("wait_seconds").isNull()).alias("unread_waits"),
        exact_sum(F.col("wait_seconds")).alias("wait_seconds"),
        F.count_if(kind == "WROTE").alias("files_written"),
        F.sum(F.when(kind == "WROTE", F.col("records"))).alias("written_records"),
    )


def request_latency(log: DataFrame) -> DataFrame:
    """Pair each START with its END or ERROR.

    The request key is ``request_id`` when the log carries one: a hash aggregate on
    (symbol, id), no ordering and no per-symbol partition.  For the plain START/END
    format (a log with ``line_order``) requests without an id are paired by
    ``request_runs``, and ``request_id`` is their run.
    """
    kind = F.col("kind")
    req = log.filter(kind.isin("START", "END", "ERROR"))
    paired = req.filter(F.col("request_id").isNotNull()).groupBy("symbol", "request_id").agg(
        F.min(F.when(kind == "START", F.col("ts"))).alias("start_ts"),
        F.min(F.when(kind != "START", F.col("ts"))).alias("end_ts"),
        F.max(F.when(kind == "END", F.col("records"))).alias("records"),
        (F.count_if(kind == "ERROR") > 0).alias("failed"),
    )
    paired = paired.withColumn("latency_seconds", _latency())
    if "line_order" not in log.columns:
        return paired
    runs = request_runs(log.filter(~kind.isin("START", "END", "ERROR") | F.col("request_id").isNull()))
    return paired.unionByName(runs.select("symbol", F.col("run").alias("request_id"), "start_ts", "end_ts", "records", "failed", "latency_seconds"))
