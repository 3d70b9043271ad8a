"""SimHash near-duplicates through a Gray-order hierarchical index (operator 2).

Fingerprints: every word shingle of a whole text is hashed (XXH64, seed 42); a bit is
set if it is set in over half of the hashes.

Links: distinct fingerprints at ``max_bits`` or fewer differing bits.  The upper nodes
of the index are masked bit patterns: 64 bits are cut into ``max_bits + 2`` blocks, and
two linked fingerprints agree on at least two of them, so they meet under one of the
masks of two blocks.  A pattern that more than ``SPLIT`` fingerprints share gets a
second level of masks within its free bits.  With ``max_bits`` 2 that leaves 16 free
bits, so no group is above 65,536 fingerprints whatever the data.  Inside a group,
fingerprints are sorted by Gray rank and packed into a tree whose nodes hold the bits
that all their members share; walking pairs of nodes, the bits in which they surely
differ add up from level to level, and a pair above ``max_bits`` goes with all its
members.  A group sends on a spanning forest of its links, never all pairs.

Equal fingerprints are one node from the start, so copies cost one row.

Defined results: null, empty and blank texts have fingerprint zero and are linked like
any other; texts of fewer words than a shingle have one shingle, the whole sequence.
A text of any length is hashed whole.  A component's id is its least id, whichever order
rows come in; rows that repeat an id, or lack one, each keep the fingerprint of their own
text, and a component without any id has a null one.  An empty table gives an empty result;
columns that are not named are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import connected_components, local_forest
from candlewick.llm.shared import cut, per_slice, raw, ship_code

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints under one pattern beyond which the second level of masks is used.
SPLIT = 1024
#: Hot patterns of at most this many are broadcast; more are joined by shuffle.
BROADCAST_PATTERNS = 10_000
#: Shingles hashed at once; children of a tree node; node pairs expanded at once.
PIECE, FAN, FRONT = 1 << 15, 8, 1 << 16


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text."""
    words = (text or b"").lower().split()  # bytes: only A-Z and ASCII white space
    total = max(len(words) - width + 1, 1 if words else 0)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, PIECE):
        some = words[at : at + PIECE + width - 1]
        if len(words) < width:
            shingles = [b" ".join(words)]
        else:
            shingles = list(map(b" ".join, zip(*(some[k:] for k in range(width)))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", width: int = SHINGLE, into: str = "__cw_fp") -> DataFrame:
    """Add the fingerprint as a signed long."""
    ship_code(df.sparkSession)

    def one(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint(t, width) for t in raw(texts)], np.uint64)
        return pa.array(prints.view(np.int64))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(into, F.arrow_udf(run, "long")(F.col(text)))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def masks(max_bits: int, free: list[int]) -> list[int]:
    """Masks that cover two of ``max_bits + 2`` blocks of the bits in ``free``."""
    blocks = np.array_split(np.array(free), max_bits + 2)
    ones = [sum(1 << int(b) for b in block) for block in blocks]
    return [a | b for a, b in combinations(ones, 2)]


def near_pairs(group: np.ndarray, codes: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of the same group within ``max_bits``; rows sorted by group and Gray rank."""
    both, some, first, last = [codes], [codes], [group], [group]
    while len(both[-1]) > 1:
        at = np.arange(0, len(both[-1]), FAN)
        both.append(np.bitwise_and.reduceat(both[-1], at))
        some.append(np.bitwise_or.reduceat(some[-1], at))
        first.append(first[-1][at])
        last.append(last[-1][np.minimum(at + FAN, len(last[-1])) - 1])
    top = len(both) - 1
    if top == 0:
        return
    step = np.arange(FAN)
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > FRONT // FAN**2 and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        level -= 1
        n = len(both[level])
        i = (a[:, None, None] * FAN + step[None, :, None]).repeat(FAN, axis=2).ravel()
        j = (b[:, None, None] * FAN + step[None, None, :]).repeat(FAN, axis=1).ravel()
        ok = (i < n) & (j < n) & ((i < j) if level == 0 else (i <= j))
        i, j = i[ok], j[ok]
        ok = (last[level][i] >= first[level][j])
        i, j = i[ok], j[ok]
        sure = (both[level][i] & ~some[level][j]) | (both[level][j] & ~some[level][i])
        ok = np.bitwise_count(sure) <= max_bits
        i, j = i[ok], j[ok]
        if len(i):
            if level == 0:
                yield i, j
            else:
                stack.append((level, i, j))


def _forest(mask: np.ndarray, pattern: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((gray_rank(codes), pattern, mask))
    mask, pattern, codes = mask[order], pattern[order], codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
    group = np.cumsum(new)
    alone = np.bincount(group)[group] < 2
    group, codes = group[~alone], codes[~alone]
    found = list(near_pairs(group, codes, max_bits))
    if not found:
        return codes[:0], codes[:0]
    root = local_forest(len(codes), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    child = np.flatnonzero(root != np.arange(len(root)))
    return codes[child], codes[root[child]]


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """Links ``(a, b)`` that span every component of the distinct longs in column ``fp``."""
    spark = prints.sparkSession
    ship_code(spark)
    upper = masks(max_bits, list(range(64)))
    signed = [m - (1 << 64) if m >> 63 else m for m in upper]
    keys = F.inline(F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern")) for k, m in enumerate(signed)]))
    keyed = prints.select("fp", keys)
    hot = cut(keyed.groupBy("mask", "pattern").count().where(F.col("count") > split).select("mask", "pattern"))
    few = hot.count() <= BROADCAST_PATTERNS
    marks = F.broadcast(hot) if few else hot
    level2 = []
    for k, m in enumerate(upper):
        for inner in masks(max_bits, [b for b in range(64) if not m >> b & 1]):
            full = m | inner
            level2.append((k, len(upper) + len(level2), full - (1 << 64) if full >> 63 else full))
    lower = keyed.join(marks, ["mask", "pattern"], "left_semi")
    inner = F.array(*[F.struct(F.lit(k).alias("m0"), F.lit(n).alias("mask"), F.col("fp").bitwiseAND(F.lit(f)).alias("pattern")) for k, n, f in level2])
    lower = lower.select("fp", F.col("mask").alias("m"), F.inline(F.filter(inner, lambda x: x["m0"] == F.col("mask")))).select("mask", "pattern", "fp")
    rows = keyed.join(marks, ["mask", "pattern"], "left_anti").select("mask", "pattern", "fp").unionByName(lower)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "mask", "pattern").sortWithinPartitions("mask", "pattern")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def links(cols: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _forest(cols[0], cols[1], cols[2].view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            cols = [np.array(c) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            # the last group may go on in the next batch
            open_ = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            start = int(np.argmax(open_))
            held = [c[start:] for c in cols]
            if start:
                yield links([c[:start] for c in cols])
        if held is not None:
            yield links(held)

    return dealt.mapInArrow(run, "a long, b long")


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, root)`` for fingerprints that are linked to another one."""
    distinct = cut(prints.select("fp").distinct())
    found = connected_components(fingerprint_links(distinct, max_bits))
    return found.select(F.col("node").alias("fp"), "root")


def simhash_components(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS, text: str = "text", doc_id: str = "doc_id", extra: dict | None = None) -> DataFrame:
    """One row a document: ``doc_id, fp, component_id``, and columns of ``extra``.

    ``component_id`` is the least id reachable by links (null only if all ids are).
    """
    more = [c.alias(n) for n, c in (extra or {}).items()]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__cw_text"), *more)
    printed = with_fingerprint(narrow, "__cw_text", width).drop("__cw_text").withColumnRenamed("__cw_fp", "fp")
    rows = cut(printed)
    per_print = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = cut(fingerprint_components(per_print, max_bits)).withColumnRenamed("fp", "node")
    named = per_print.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = cut(named.groupBy("root").agg(F.min("least").alias("component_id"))).withColumnRenamed("root", "r")
    table = cut(named.join(ids, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), F.col("root").alias("group"), "component_id"))
    joined = rows.join(table, F.col("fp") == F.col("f"))
    return joined.select("doc_id", "fp", "component_id", "group", *(extra or {}))


def keep_one_of_each(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the least id, columns unchanged.

    Equal ids within a component are told apart by their text's hash; rows equal in
    both are copies, of which one stays.
    """
    key = F.xxhash64(F.col(text))
    rows = simhash_components(docs, width, max_bits, text, doc_id, {"h": key})
    each = rows.groupBy("group", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h", "n")).alias("k")
    keep = cut(each.groupBy("group").agg(best).select(F.col("group").alias("__cw_g"), F.col("k.doc_id").alias("__cw_id"), F.col("k.h").alias("__cw_h"), F.col("k.n").alias("__cw_n")))
    kept = docs.withColumn("__cw_key", key).join(keep, F.col(doc_id).eqNullSafe(F.col("__cw_id")) & (F.col("__cw_key") == F.col("__cw_h")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = kept.where("__cw_n = 1").select(*columns)
    again = kept.where("__cw_n > 1").dropDuplicates(["__cw_g"]).select(*columns)
    return single.unionByName(again)
