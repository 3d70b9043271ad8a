"""Resampling towards a target distribution by word n-gram buckets (operator 11).

Words are runs of ASCII digits, ASCII letters (lower-cased) and characters beyond ASCII.
Features are all runs of one to three words, hashed with CRC-32 into buckets.  The CRC of
a run comes from those of its words: ``crc(a + b) = shift(crc(a), len(b)) ^ crc(b)``, so
each distinct word is hashed once and runs are array arithmetic.

1. ``bucket_counts`` adds up an array of bucket counts in each task, over whole tables.
2. ``bucket_gains`` makes the array of log ratios, one entry a bucket (the only broadcast;
   its size is the number of buckets).
3. ``with_weights`` adds each document's features up against that array.
4. ``cutoff_key`` finds the exact key of the last document drawn by weighted medians of
   medians: each partition tells how many keys it has left and their median; the median
   of these, weighted by the sizes, parts the keys so that at least a quarter of them is
   discarded in every round, whichever side the cutoff is on.  One row a partition
   reaches the driver, and keys are never sorted as a whole.
5. Only the documents drawn are sorted, for their ranks, by ranges.

Order of documents: score from high to low, then the smaller id (null last), then
``n_features``; rows equal in all of these are interchangeable.

Defined results: a null text is empty; a text without words has no features, weight 0 and
is never drawn when ``least_words`` is above 0; a null id is hashed as an empty one;
repeated rows are documents of their own; texts of any length are read whole, in pieces
that share two words; empty tables give empty results, an empty target table counts as
T = 0; columns not named here play no part, whatever their names.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.shared import build_struct, factorize, per_slice, raw, ship_code, slices, struct_type, written

BUCKETS = 10_000
#: Longest run of words that is a feature.
ORDER = 3
#: Percent of the documents with enough words that is drawn, and the words it takes.
PERCENT, LEAST_WORDS = 5, 20
#: Bytes of one text whose words are held at once.
PIECE_BYTES = 1 << 20

_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SCORED = struct_type(n_words=pa.int64(), n_features=pa.int64(), weight=pa.int64())


def _times(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Product of a 32 x 32 bit matrix (one word a column) with each value."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0))
    return out


@functools.cache
def _zero_bytes(n: int) -> np.ndarray:
    """The matrix that takes a CRC-32 past ``n`` zero bytes."""
    if n == 1:
        value = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(8):
            value = np.where(value & np.uint32(1), value >> np.uint32(1) ^ np.uint32(0xEDB88320), value >> np.uint32(1))
        return value
    half = _zero_bytes(n // 2)
    double = _times(half, half)
    return _times(_zero_bytes(1), double) if n % 2 else double


@functools.cache
def _byte_tables(n: int) -> np.ndarray:
    """``_zero_bytes(n)`` as four tables of 256 entries, one for each byte of a CRC."""
    matrix = _zero_bytes(n)
    return np.concatenate([_times(matrix, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


class Shifts:
    """Takes arrays of CRCs past as many bytes as each one's successor has."""

    def __init__(self, lengths: np.ndarray):
        known, self.row = np.unique(lengths, return_inverse=True)
        self.tables = np.concatenate([_byte_tables(int(n)) for n in known]) if len(known) else np.zeros(0, np.uint32)

    def past(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """``crc`` past the bytes of distinct word number ``word``."""
        base = self.row[word] * 1024
        out = np.zeros_like(crc)
        for k in range(4):
            out ^= self.tables[base + (k << 8) + (crc >> np.uint32(8 * k) & np.uint32(255))]
        return out


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in runs of about ``PIECE_BYTES``."""
    clean = text.translate(_WORD_BYTES)
    at = 0
    while at < len(clean):
        end = len(clean) if len(clean) - at <= PIECE_BYTES else clean.find(b" ", at + PIECE_BYTES)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def _runs(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[list[bytes]], list[int]]]:
    """Groups of word runs: document number, words, and how many words were seen before.

    A text of several pieces starts each later one with the last words of the one before.
    """
    docs, words, seen, size = [], [], [], 0
    for i, text in enumerate(texts):
        tail: list[bytes] = []
        for piece in _pieces(text or b""):
            docs.append(i)
            words.append(tail + piece)
            seen.append(len(tail))
            tail = words[-1][-(ORDER - 1) :]
            size += len(piece)
            if size > 1 << 18:
                yield docs, words, seen
                docs, words, seen, size = [], [], [], 0
    if docs:
        yield docs, words, seen


def _features(words: list[list[bytes]], seen: list[int], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and run number of every feature, in one pair of arrays for each order."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    distinct, ids = factorize([w for run in words for w in run])
    run = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fresh = place >= np.repeat(np.asarray(seen), sizes)
    alone = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in distinct), np.uint32, len(distinct))
    shifts = Shifts(np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1)
    crc = alone[ids]
    for order in range(ORDER):
        if order:  # crc[i] ends at word i: put the run that ended at i - 1 before word i
            crc = shifts.past(crc[:-1], ids[order:]) ^ spaced[ids[order:]]
        whole = fresh[order:] & (place[order:] >= order)
        yield crc[whole] % np.uint32(buckets), run[order:][whole]


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of all texts; absent buckets have no row."""
    ship_code(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                for _, words, seen in _runs(raw(part)):
                    for bucket, _ in _features(words, seen, buckets):
                        total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = docs.select(F.col(text)).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(share in target / share in source)) of each bucket, from two tables of
    ``bucket_counts`` (at most one row a bucket each)."""
    s, t = [0] * buckets, [0] * buckets
    for counts, found in ((s, source), (t, target)):
        for r in found.collect():
            counts[r.bucket] = r.n
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)], np.int64)


def with_weights(docs: DataFrame, gains: np.ndarray, text: str = "text", into: str = "__cw_weight") -> DataFrame:
    """Add a struct ``n_words, n_features, weight`` for each whole text."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def one(texts: pa.Array) -> pa.Array:
        gain = shared.value
        out = np.zeros((3, len(texts)), np.int64)
        for docs_of, words, seen in _runs(raw(texts)):
            owner = np.asarray(docs_of)
            for order, (bucket, run) in enumerate(_features(words, seen, len(gain))):
                n = np.bincount(owner[run], minlength=len(texts))
                out[0] += n if order == 0 else 0
                out[1] += n
                # sums of integers below 2**53: exact as doubles
                out[2] += np.bincount(owner[run], gain[bucket], len(texts)).astype(np.int64)
        return build_struct(SCORED, *out)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, SCORED)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "n_words long, n_features long, weight long")(F.col(text)))


def gumbel(doc_id: str, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u the first 32 bits of SHA-256 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


# Keys are rows (-score, id is null, id, n_features): the smaller, the earlier drawn.
_KEY = ["k0", "k1", "k2", "k3"]


def _compare(columns: list[np.ndarray], key: tuple[int, ...]) -> np.ndarray:
    """-1, 0 or 1 for keys before, equal to and after ``key``."""
    out = np.zeros(len(columns[0]), np.int8)
    for column, value in zip(columns[::-1], key[::-1]):
        out = np.where(column < value, np.int8(-1), np.where(column > value, np.int8(1), out))
    return out


def _split_medians(keys: DataFrame, low: tuple | None, pivot: tuple | None, high: tuple | None) -> list:
    """Of the keys strictly between ``low`` and ``high``, for each partition: how many come
    before the pivot, are equal to it and come after it (all come after no pivot), with the
    median of each of these sides."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            left = np.ones(len(columns[0]), bool)
            if low is not None:
                left &= _compare(columns, low) > 0
            if high is not None:
                left &= _compare(columns, high) < 0
            held.append([c[left] for c in columns])
        if not held:
            return
        columns = [np.concatenate(c) for c in zip(*held)]
        where = _compare(columns, pivot) if pivot is not None else np.ones(len(columns[0]), np.int8)
        rows = []
        for side in (-1, 0, 1):
            some = [c[where == side] for c in columns]
            n = len(some[0])
            if n:
                at = np.lexsort(some[::-1])[(n - 1) // 2]
                rows.append((side, n, *(int(c[at]) for c in some)))
        if rows:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=["side", "n", *_KEY])

    return keys.select(*_KEY).mapInArrow(parts, "side long, n long, " + ", ".join(f"{c} long" for c in _KEY)).collect()


def cutoff_key(keys: DataFrame, k: int) -> tuple[int, ...] | None:
    """The ``k``-th smallest key of a written table (None if there are fewer).

    Each round reads one row a partition and side.  The pivot is the median of partition
    medians weighted by the keys they stand for, so about a quarter of the keys left, or
    more, lies on either side of it, and the side without the ``k``-th is discarded.
    """
    low = pivot = high = None
    while k > 0:
        sides: dict[int, list] = {-1: [], 0: [], 1: []}
        for r in _split_medians(keys, low, pivot, high):
            sides[r.side].append((tuple(r[c] for c in _KEY), r.n))
        before, same = (sum(n for _, n in sides[side]) for side in (-1, 0))
        if k <= before:
            high, left = pivot, sides[-1]
        elif k <= before + same:
            return pivot
        else:
            k -= before + same
            low, left = pivot or low, sides[1]
        total, passed = sum(n for _, n in left), 0
        if k > total:
            break
        for pivot, n in sorted(left):
            passed += n
            if 2 * passed >= total:
                break
    return None


def importance_sample(
    docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42, buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``rank`` is
    null for those not drawn.  Counts, weights and the draw cover all rows."""
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    weighed = with_weights(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), gains)
    flat = weighed.select("doc_id", "__cw_weight.*").withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = written(flat, "importance")
    key = [(-F.col("score")).alias("k0"), F.col("doc_id").isNull().cast("bigint").alias("k1"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("k2"), F.col("n_features").alias("k3")]
    able = scored.where(F.col("n_words") >= least_words)
    draw = percent * able.count() // 100
    cut = cutoff_key(able.select(*key), draw)
    enough = F.col("n_words") >= least_words
    row = F.struct(*key)
    wins = F.lit(False) if cut is None else enough & (row <= F.struct(*[F.lit(v).cast("bigint").alias(c) for v, c in zip(cut, _KEY)]))
    winners = scored.where(wins).select("*", *key)
    ranked = with_rank(winners, _KEY, "rank")
    # rows equal to the cutoff key in all of it may be more than the draw has room for
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))).drop(*_KEY)
    return drawn.unionByName(scored.where(~wins).withColumn("rank", F.lit(None).cast("bigint")))


def with_rank(rows: DataFrame, key: list[str], into: str) -> DataFrame:
    """Number rows 1, 2, 3... in key order: ranges of keys, sorted each by itself, after as
    many rows as the ranges before hold (one number a range reaches the driver)."""
    parted = rows.repartitionByRange(*[F.col(c) for c in key]).withColumn("__cw_range", F.spark_partition_id())
    ranges = written(parted, "importance-drawn")
    sizes = sorted((r[0], r[1]) for r in ranges.groupBy("__cw_range").count().collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(starts, "__cw_range int, __cw_before long")
    order = Window.partitionBy("__cw_range").orderBy(*key)
    numbered = ranges.join(F.broadcast(offsets), "__cw_range")
    return numbered.withColumn(into, F.col("__cw_before") + F.row_number().over(order)).drop("__cw_range", "__cw_before")
