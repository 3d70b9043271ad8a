"""Scalar column expressions.

All of these compile to JVM expressions (whole-stage codegen); none is a
Python UDF.  Null model: missing is always SQL NULL, never NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A decimal number as plain text: optional sign, digits with optional point,
# optional exponent, surrounding blanks allowed (group 1 is the number).
# Spark's own string->double cast is looser (it takes "1d", "2f", "0x1p3",
# "Infinity", "NaN"), so only the captured text is ever cast.
NUMBER_PATTERN = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"

# A full ISO-8601 date and time (T or blank separator), optional seconds and
# fraction, optional UTC offset (group 1).  Date-only or time-only text is
# rejected, where a bare cast would accept "2026" or "12:00" (today's date).
TIMESTAMP_PATTERN = (
    r"^\s*(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
    r"\s*(?:Z|[+-]\d{2}(?::?\d{2})?)?)\s*$"
)

# Of such text: without seconds (a cast takes no offset then), and without an offset.
_NO_SECONDS = r"^(.{16})(\s*(?:Z|[+-].*)?)$"
_NO_OFFSET = r"^([^ T]+[ T][0-9:.]+)$"

# Python's str.strip() also removes the ASCII separators 0x1C-0x1F, which are
# not Unicode white space to Java.
_EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: ColumnOrName) -> Column:
    """Text -> DOUBLE; anything that is not a decimal number -> NULL.

    The input is referenced once (extract, then cast), which keeps the
    expression small when upstream columns are themselves expressions.
    A number too large for a double becomes +-Infinity, as in pandas.
    """
    number = F.nullif(F.regexp_extract(_col(c).cast("string"), NUMBER_PATTERN, 1), F.lit(""))
    return number.try_cast("double")


def _utc_wall_time(micros: Column) -> Column:
    # counting from the epoch, where a cast would go through the session's time zone
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def safe_timestamp(c: ColumnOrName) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ holding the UTC wall-clock time.

    Offsets are honoured, text without one is UTC, and the session's time zone
    plays no part.  Unparsable or out-of-range text -> NULL.
    """
    stamp = F.nullif(F.regexp_extract(_col(c).cast("string"), TIMESTAMP_PATTERN, 1), F.lit(""))
    full = F.regexp_replace(F.regexp_replace(stamp, _NO_SECONDS, "$1:00$2"), _NO_OFFSET, "$1Z")
    return _utc_wall_time(F.unix_micros(full.try_cast("timestamp")))


def strip_unicode(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), _EDGE_BLANKS, "")


def normalise_symbol(c: ColumnOrName) -> Column:
    """strip blanks -> upper case -> remove every '/' (e.g. ' btc/usdt ' -> 'BTCUSDT')."""
    return F.replace(F.upper(strip_unicode(c)), F.lit("/"), F.lit(""))


def epoch_ms_to_ts(c: ColumnOrName) -> Column:
    """Epoch milliseconds (negative allowed) -> TIMESTAMP_NTZ in UTC."""
    return _utc_wall_time(_col(c).cast("bigint") * F.lit(1000).cast("bigint"))


def to_iso_text(c: ColumnOrName, with_fraction: bool | None = None) -> Column:
    """TIMESTAMP_NTZ (UTC) -> '2026-06-01T00:00:00+00:00' style text.

    By default the 6-digit fraction is written only when it is non-zero
    ('...T00:59:59.999000+00:00'), like Python's ``isoformat``.
    """
    c = _col(c)
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    frac = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    if with_fraction is None:
        return F.when(F.date_format(c, "SSSSSS") == F.lit("000000"), whole).otherwise(frac)
    return frac if with_fraction else whole


def price_range(high: ColumnOrName = "high", low: ColumnOrName = "low") -> Column:
    return _col(high) - _col(low)


def price_change(open_: ColumnOrName = "open", close: ColumnOrName = "close") -> Column:
    return _col(close) - _col(open_)


def percent_change(open_: ColumnOrName = "open", close: ColumnOrName = "close") -> Column:
    """(close - open) / open * 100, in that order; open = 0 -> NULL instead of an error."""
    return F.try_divide(_col(close) - _col(open_), _col(open_)) * F.lit(100)


def candle_direction(open_: ColumnOrName = "open", close: ColumnOrName = "close") -> Column:
    """'up' / 'down', otherwise 'flat' -- also when either price is missing."""
    o, c = _col(open_), _col(close)
    return F.when(c > o, F.lit("up")).when(c < o, F.lit("down")).otherwise(F.lit("flat"))


def activity_score(trades: ColumnOrName, quote_volume: ColumnOrName) -> Column:
    """trades * ln(quote_volume + 1); NULL where the logarithm is undefined."""
    return _col(trades) * F.log(_col(quote_volume) + F.lit(1))


# Sums of doubles depend on the order rows meet in, i.e. on partitioning
# and retries.  Values that DECIMAL(38,8) holds without change (8 decimals =
# exchange precision) are accumulated exactly, so such sums are the same on
# every run and cluster size.  All others (tiny, huge, infinite) are added as
# doubles: no value leaves the sum or the count.
EXACT_TYPE = "decimal(38,8)"
EXACT_LIMIT = 1e15  # 10^15 such values still fit the 38 digits


def exact_sum(c: ColumnOrName) -> Column:
    value = _col(c).cast("double")
    exact = value.try_cast(EXACT_TYPE)
    fits = F.coalesce((F.abs(value) < F.lit(EXACT_LIMIT)) & (exact.cast("double") == value), F.lit(False))
    whole = F.sum(F.when(fits, exact)).cast("double")
    rest = F.sum(F.when(~fits, value))
    return F.coalesce(whole + rest, whole, rest)


def exact_avg(c: ColumnOrName) -> Column:
    return F.try_divide(exact_sum(c), F.count(_col(c)).cast("double"))


def exact_moments(c: ColumnOrName) -> tuple[Column, Column]:
    """Average and sample standard deviation that are the same bits however rows are spread.

    A value below a million whose shortest decimal form has at most 20 decimals is taken as
    two whole numbers, ``value = (high * 10^13 + low) / 10^20``; both, their squares and
    their product are added up exactly in DECIMAL(38,0).  The squares are then shifted to
    the group's mean before anything becomes a double, so nothing cancels.  A group that
    holds any other value (or would overflow) falls back to ``avg`` and ``stddev_samp``.
    """
    value = _col(c).cast("double")
    fixed = value.try_cast("decimal(26,20)")
    fits = F.coalesce((F.abs(value) < F.lit(1e6)) & (fixed.cast("double") == value), F.lit(False))
    scaled = F.when(fits, fixed) * F.expr("CAST(10000000 AS DECIMAL(8,0))")
    whole = F.floor(scaled)
    high = whole.cast("decimal(14,0)")
    low = ((scaled - whole).cast("decimal(14,13)") * F.expr("CAST(10000000000000 AS DECIMAL(14,0))")).cast("decimal(14,0)")

    def total(x: Column) -> Column:
        return F.try_sum(x).cast("decimal(38,0)")

    n = F.count_if(fits)
    count = n.cast("decimal(20,0)")
    sh, sl, shh, shl, sll = total(high), total(low), total(high * high), total(high * low), total(low * low)
    # whole numbers next to the mean of each part
    ch, cl = (F.round(F.try_divide(s, count)).cast("decimal(14,0)") for s in (sh, sl))

    def wide(x: Column) -> Column:
        return x.try_cast("decimal(38,0)")

    def shifted(sxy: Column, sx: Column, sy: Column, cx: Column, cy: Column) -> Column:
        """Sum of (x - cx)(y - cy), a whole number."""
        back = F.try_add(wide(F.try_multiply(cx, sy)), wide(F.try_multiply(cy, sx)))
        return wide(F.try_add(F.try_subtract(sxy, wide(back)), wide(F.try_multiply(count, wide(F.try_multiply(cx, cy))))))

    hh, hl, ll = (shifted(*a).cast("double") for a in ((shh, sh, sh, ch, ch), (shl, sh, sl, ch, cl), (sll, sl, sl, cl, cl)))
    off = wide(F.try_subtract(sh, wide(F.try_multiply(count, ch)))).cast("double") * 1e13 + wide(F.try_subtract(sl, wide(F.try_multiply(count, cl)))).cast("double")
    size = n.cast("double")
    squares = F.greatest(hh * 1e26 + 2 * hl * 1e13 + ll - F.try_divide(off * off, size), F.lit(0.0))
    spread = F.when(n > 1, F.sqrt(F.try_divide(squares, size - 1)) / 1e20)
    mean = F.try_divide(sh.cast("double") / 1e7 + sl.cast("double") / 1e20, size)
    whole_group = n == F.count(value)
    return F.when(whole_group & mean.isNotNull(), mean).otherwise(exact_avg(value)), F.when(whole_group & (spread.isNotNull() | (n <= 1)), spread).otherwise(F.stddev_samp(value))
