"""Embedding near-duplicates by a subspace pigeonhole join (operator 6).

Unit vectors at cosine ``c`` or more are at squared distance ``2 - 2c`` or less.  A
fixed random rotation (signs and Hadamard steps, twice) spreads that distance over all
coordinates, which are cut into blocks of ``BLOCK``; a linked pair is within the
block's proportional share of the squared distance in at least one block.

Each block is range-joined on its own, in all of its coordinates.  Median splits, fitted
on a bounded sample, cut its space into boxes; a vector goes to the box it lies in and
visits every earlier box that comes within the block's radius of it, so each close pair
meets in one box.  Inside a box, rows are split further into leaves, and a leaf only meets
the rows that come within the radius of its bounds.  A box with too many rows is cut into
chunks, and every pair of chunks is one bounded task.  A candidate counts only in
the first block that admits it, so the union of the blocks has each pair once, and is
verified there by its cosine in double precision.

Equal vectors are one row with a count.  A task sends on, for each vector, how many
others it linked and its root in a spanning forest, so dense groups cost rows in
proportion to their vectors, not to their pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, link with nothing; vectors of different lengths
never link; equal vectors link with each other; rows that repeat an id are
one node, with the links of all its vectors; an empty table gives an empty result; columns
that are not named play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import connected_components, local_forest
from candlewick.llm.shared import cut, ship_code

LEAST_COSINE = 0.95
BLOCK = 8
#: Rows of a chunk; a task holds two chunks.  Rows of a leaf, and pairs verified in one
#: step of a task.
CHUNK, LEAF_ROWS, TILE_PAIRS = 32_768, 128, 1 << 19
#: Vectors that the splits are fitted on, at most, for each vector length; any splits give
#: the same links.
SAMPLE = 20_000
SLACK = 1 + 1e-9


def rotate(rows: np.ndarray, seed: int = 11) -> np.ndarray:
    """Unit vectors, rotated.  Element by element, so a row's result never depends on
    the rows around it; widths are filled up with zeros to a power of two."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither vanish nor overflow
    squares = x * x
    total = squares[:, 0].copy()
    for k in range(1, x.shape[1]):
        total += squares[:, k]
    x /= np.sqrt(total)[:, None]
    width = max(BLOCK, 1 << (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng(seed + width)
    for _ in range(2):
        x = x * rng.choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = x.reshape(len(x), -1, 2, half)
            x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), width)
            half *= 2
        x = x / np.sqrt(width)
    return x


def _budget(width: int, least_cosine: float) -> float:
    return (2 - 2 * least_cosine) * BLOCK / width * SLACK


def _matrix(column: pa.Array, indices: np.ndarray, size: int) -> np.ndarray:
    flat = column.take(pa.array(indices)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(indices), size)


def _by_size(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def fit_splits(part: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Axis and value of ``2**depth - 1`` median splits, node k's children being 2k+1 and
    2k+2; each node is cut where its sample is widest."""
    splits, todo = [], [part]
    for node in range(2**depth - 1):
        rows = todo[node]
        axis = int(np.argmax(rows.std(axis=0))) if len(rows) else node % part.shape[1]
        value = float(np.median(rows[:, axis])) if len(rows) else 0.0
        splits.append((axis, value))
        upper = rows[:, axis] >= value
        todo += [rows[~upper], rows[upper]]
    return splits


def boxes_met(part: np.ndarray, splits: list[tuple[int, float]], limit: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Box number, rows and whether they lie in it, of every box that a row lies in or (an
    earlier one than its own) is within ``limit``, squared, of."""

    def walk(node: int, rows: np.ndarray, home: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if not len(rows):
            return
        if node >= len(splits):
            yield node - len(splits), rows, home
            return
        axis, value = splits[node]
        x = part[rows, axis] - value
        for child, here in ((2 * node + 1, x < 0), (2 * node + 2, x >= 0)):
            # a row that is still at home may only stray to the lower side
            go = here | ~home if child % 2 == 0 else np.ones(len(rows), bool)
            away = gap[go].copy()
            out = ~here[go]
            away[out, axis] = np.maximum(away[out, axis], np.abs(x[go][out]))
            near = (away * away).sum(axis=1) <= limit
            yield from walk(child, rows[go][near], (home & here)[go][near], away[near])

    yield from walk(0, np.arange(len(part)), np.ones(len(part), bool), np.zeros(part.shape))


def _leaves(part: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """``rows`` cut at medians of their widest coordinate into leaves."""
    if len(rows) <= LEAF_ROWS:
        if len(rows):
            yield rows
        return
    some = part[rows]
    axis = int(np.argmax(some.max(axis=0) - some.min(axis=0)))
    order = np.argpartition(some[:, axis], len(rows) // 2)
    yield from _leaves(part, rows[order[: len(rows) // 2]])
    yield from _leaves(part, rows[order[len(rows) // 2 :]])


def close_rows(low: np.ndarray, home: np.ndarray, side: np.ndarray, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Index pairs of one task within ``limit``, squared, in the block; and how many pairs
    were compared for them.  Pairs of two visitors belong to another box."""
    norm = np.einsum("ij,ij->i", low, low)
    two = bool((side == 1).any())
    left = np.flatnonzero(side == 0)
    leaves = list(_leaves(low, left if two else left[home[left]]))
    others = [] if two else [left[~home[left]]]
    # of one chunk: a leaf meets itself, the leaves after it, and the visitors
    right = np.flatnonzero(side == 1) if two else np.concatenate([*leaves, *others]) if leaves else left[:0]
    upto = np.cumsum([0, *map(len, leaves)])
    wide = np.sqrt(np.float32(limit)) * np.float32(1.0001) + np.float32(1e-4)
    for k, a in enumerate(leaves):
        b = right if two else right[upto[k] :]
        box = low[a]
        gap = np.maximum(np.maximum(box.min(axis=0) - low[b], low[b] - box.max(axis=0)), 0)
        b = b[np.einsum("ij,ij->i", gap, gap) <= wide * wide]
        near = norm[a][:, None] + norm[b][None, :] - 2 * (box @ low[b].T) <= limit + 1e-4
        if two:
            near &= home[a][:, None] | home[b][None, :]
        ia, ib = np.nonzero(near)
        ia, ib = a[ia], b[ib]
        if not two:  # inside the leaf, each pair once
            place = np.full(len(low), -1)
            place[a] = np.arange(len(a))
            keep = (place[ib] < 0) | (place[ia] < place[ib])
            ia, ib = ia[keep], ib[keep]
        yield ia, ib, len(a) * len(b)


def block_pairs(ids: np.ndarray, vectors: np.ndarray, weight: np.ndarray, home: np.ndarray, side: np.ndarray, block: int, least_cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one task: ``(id, root of its local forest, weight of the vectors linked)``.

    ``side`` 0 and 1 are two chunks whose rows meet each other; a task of one chunk has
    side 0 only, and its rows meet among themselves.  Rows that are not at ``home`` visit.
    """
    turned = rotate(vectors)
    width = turned.shape[1]
    limit = _budget(width, least_cosine)
    low = turned[:, block * BLOCK : (block + 1) * BLOCK].astype(np.float32)
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    links, degree = [], np.zeros(len(ids), np.int64)
    for ia, ib, _ in close_rows(low, home, side, limit):
        for k in range(0, len(ia), TILE_PAIRS // width):
            i, j = ia[k : k + TILE_PAIRS // width], ib[k : k + TILE_PAIRS // width]
            gap = (turned[i] - turned[j]) ** 2
            first = np.stack([gap[:, c * BLOCK : (c + 1) * BLOCK].sum(axis=1) for c in range(block + 1)], axis=1) <= limit
            mine = first[:, block] & ~first[:, :block].any(axis=1)
            i, j = i[mine], j[mine]
            ok = np.einsum("ij,ij->i", x[i], x[j]) / (length[i] * length[j]) >= least_cosine
            i, j = i[ok], j[ok]
            np.add.at(degree, i, weight[j])
            np.add.at(degree, j, weight[i])
            if len(i):  # keep a forest of the links so far, not the links
                links.append((i, j))
                if sum(len(p[0]) for p in links) > 4 * TILE_PAIRS:
                    root = local_forest(len(ids), *map(np.concatenate, zip(*links)))
                    child = np.flatnonzero(root != np.arange(len(root)))
                    links = [(child, root[child])]
    root = local_forest(len(ids), *map(np.concatenate, zip(*links))) if links else np.arange(len(ids))
    some = np.flatnonzero(degree > 0)
    return ids[some], ids[root[some]], degree[some]


def block_splits(reps: DataFrame, sample: int = SAMPLE, chunk: int = CHUNK) -> dict[int, list[list[tuple[int, float]]]]:
    """Splits of every block, for each vector length, fitted on at most about ``sample``
    vectors of that length, chosen by a hash; more vectors give more boxes."""
    counts = {r[0]: r[1] for r in reps.groupBy(F.size("embedding").alias("size")).count().collect()}
    shares = [F.when(F.size("embedding") == size, F.lit(min(1.0, sample / n))) for size, n in counts.items()]
    if not counts:
        return {}
    picked = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < F.coalesce(*shares) * (1 << 20)
    out: dict[int, list] = {}
    for size, n in counts.items():
        rows = reps.where(picked & (F.size("embedding") == size)).select("embedding").toArrow().column(0).combine_chunks()
        turned = rotate(_matrix(rows, np.arange(len(rows)), size)) if len(rows) else np.zeros((0, max(BLOCK, size)))
        # visitors grow with the boxes, so these grow slower than the vectors
        depth = max(0, round(0.75 * np.log2(max(1.0, 5 * n / chunk))))
        out[size] = [fit_splits(turned[:, at : at + BLOCK], depth) for at in range(0, turned.shape[1], BLOCK)]
    return out


def vector_links(reps: DataFrame, least_cosine: float = LEAST_COSINE, chunk: int = CHUNK) -> DataFrame:
    """``(a, b, weight)`` for distinct valid vectors (columns ``rep, n, embedding``):
    b is a vector linked to a through others (or a itself), and the weights of a's rows
    add up to the count of vectors linked to a directly."""
    ship_code(reps.sparkSession)

    splits = reps.sparkSession.sparkContext.broadcast(block_splits(reps, chunk=chunk))

    def met(column: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """Vector length, block, box, rows and whether they are at home."""
        for size, rows in _by_size(column):
            turned = rotate(_matrix(column, rows, size))
            limit = _budget(turned.shape[1], least_cosine) * (1 + 1e-6)
            for block, cuts in enumerate(splits.value[size]):
                for box, some, home in boxes_met(turned[:, block * BLOCK : (block + 1) * BLOCK], cuts, limit):
                    yield size, block, box, rows[some], home

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for start in range(0, len(batch), 2048):
                for size, block, box, rows, _ in met(batch.column(2).slice(start, 2048)):
                    total[size, block, box] += len(rows)
        if total:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*total)), pa.array(list(total.values()))], ["size", "block", "box", "n"])

    # one row a box: there are fewer of them than of vectors
    sizes = reps.mapInArrow(measure, "size long, block long, box long, n long").groupBy("size", "block", "box").agg(F.sum("n").alias("n")).collect()
    pieces = {(r["size"], r.block, r.box): -(-r.n // chunk) for r in sizes}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 2048):
                batch = whole.slice(start, 2048)
                ids = batch.column(0).to_numpy()
                out = []
                for size, block, box, rows, home in met(batch.column(2)):
                    k, n = pieces[size, block, box], len(rows)
                    piece = ((ids[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(k)).astype(np.int64)
                    for other in range(k):
                        lo, hi = np.minimum(piece, other), np.maximum(piece, other)
                        out.append((np.full(n, size), np.full(n, block), np.full(n, box), lo, hi, np.where(piece == lo, 0, 1), home, rows))
                if not out:
                    continue
                *columns, rows = (np.concatenate(c) for c in zip(*out))
                for at in range(0, len(rows), 20_000):
                    take = pa.array(rows[at : at + 20_000])
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c[at : at + 20_000]) for c in columns), *(batch.column(c).take(take) for c in (0, 1, 2))],
                        ["size", "block", "box", "lo", "hi", "side", "home", "rep", "n", "embedding"],
                    )

    kind = reps.schema["embedding"].dataType.simpleString()
    dealt = reps.mapInArrow(deal, f"size long, block long, box long, lo long, hi long, side long, home boolean, rep long, n long, embedding {kind}")

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows["embedding"].to_numpy())
        block = int(rows["block"].iloc[0])
        a, b, degree = block_pairs(rows["rep"].to_numpy(), vectors, rows["n"].to_numpy(), rows["home"].to_numpy(bool), rows["side"].to_numpy(), block, least_cosine)
        return pd.DataFrame({"a": a, "b": b, "weight": degree})

    return dealt.groupBy("size", "block", "box", "lo", "hi").applyInPandas(join, "a long, b long, weight long")


def embedding_components(vectors: DataFrame, least_cosine: float = LEAST_COSINE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row a vector: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    valid = rows.where("vec_id is not null and size(embedding) > 0").where(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x != 0)"
    )
    reps = cut(valid.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).select("rep", "n", "embedding"))
    links = cut(vector_links(reps, least_cosine))
    roots = connected_components(links.select("a", "b").where("a != b"))
    degrees = links.groupBy("a").agg(F.sum("weight").alias("links"))
    info = reps.join(degrees, F.col("rep") == F.col("a"), "left").join(roots, F.col("rep") == F.col("node"), "left")
    info = cut(info.select(F.col("embedding").alias("e"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "rep").alias("root")))
    known = F.col("vec_id").isNotNull() & (F.col("embedding") == F.col("e"))
    out = rows.join(info, known, "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
