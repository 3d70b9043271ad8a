"""Toxicity scores from subword-bag embeddings and a linear softmax (operator 1).

A word is the mean of the embeddings of its byte n-grams (three to six, with edge
marks) and of itself, all hashed into ``2 ** BUCKET_BITS`` rows; a text is the mean of
its distinct words, each weighted by a power of its count; two class vectors and a bias make a softmax of it.  Embeddings and classes
are trained together by Adam, in numpy on the driver, on at most ``SAMPLE_ROWS``
labelled texts of a class and ``SAMPLE_BYTES`` in all, chosen by a hash of the id.  A
misspelt insult shares n-grams with the insult and so its vectors.

Gradients and scores need products of the text matrix with vectors only: the matrix is
kept as texts by words and words by buckets.  On workers a word's share of the logit is
one number, taken once for each distinct word of a slice of texts.

Defined results: null and empty texts, and texts without a letter, get the score of the
bias alone; with no labels of one of the classes, all scores are 0 or 1 for that class.
Repeated rows are each scored, and each counted in the sample; labels that differ for
one id count on both sides; texts of equal hash order are taken by id, length, hash.  A
text of any length is scored whole, by itself where it is long.  An empty table gives an
empty result.  Columns that are not named play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.shared import cut, pack, per_slice, segment_sum, ship_code

#: Labelled texts of each class to learn from, and their bytes in all.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 40 << 20
BUCKET_BITS, DIMENSIONS = 16, 8
NGRAMS = (3, 4, 5, 6)
STEPS, BATCH, RATE, DECAY = 320, 128, 0.05, 1e-6
#: Embeddings start within this of zero, so that n-grams never trained say little.
START = 0.01
#: A word that a text holds n times weighs n to this power in the text's mean.
DAMPING = 0.5
#: Scores from here on are predicted toxic.
THRESHOLD = 0.3

_TOKENS = re.compile(r"[^\W\d_]+").findall
_BASE, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return _TOKENS(text.lower()) if text else []


def buckets(words: list[str], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each word: bucket numbers, and len(words) + 1 offsets."""
    parts = [_buckets(words[at : at + 20_000], bits) for at in range(0, len(words), 20_000)]
    sizes = [np.diff(ends) for _, ends in parts]
    return np.concatenate([np.zeros(0, np.int32), *(n for n, _ in parts)]), np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))])


def _buckets(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = pack([b"<%s>" % w.encode("utf-8", "surrogatepass") for w in words])
    data, sizes = data.astype(np.uint64) + np.uint64(1), np.diff(offsets)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = offsets[1:][owner] - np.arange(len(data))  # bytes from here to the word's end
    found, whose = [], []
    rolling = np.zeros(len(data), np.uint64)
    for n in range(1, min(max(NGRAMS), len(data)) + 1):
        rolling[: len(data) - n + 1] = rolling[: len(data) - n + 1] * _BASE + data[n - 1 :]
        if n in NGRAMS:
            here = np.flatnonzero(left >= n)
            found.append(rolling[here] ^ np.uint64(n))
            whose.append(owner[here])
    # the whole word: a sum of position-weighted bytes
    weight = (np.arange(len(data)) - offsets[:-1][owner] + 1).astype(np.uint64) * _SPREAD
    mixed = data * (weight ^ (weight >> np.uint64(29)))
    found.append(segment_sum(mixed, offsets) ^ np.uint64(63))
    whose.append(np.arange(len(words)))
    hashed, whose = np.concatenate(found), np.concatenate(whose)
    hashed ^= hashed >> np.uint64(31)
    number = (hashed * _SPREAD) >> np.uint64(64 - bits)
    order = np.argsort(whose, kind="stable")
    ends = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bincount(whose, minlength=len(words)), out=ends[1:])
    return number[order].astype(np.int32), ends


def bags(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of all texts; and of each text (by offsets) its words and their
    weights, which add up to one."""
    place: dict[str, int] = {}
    ids, counts, sizes = [], [], []
    for text in texts:  # one text's words at a time; only distinct ones stay
        bag = Counter(tokens(text))
        ids.append(np.fromiter((place.setdefault(w, len(place)) for w in bag), np.int32, len(bag)))
        counts.append(np.fromiter(bag.values(), np.float64, len(bag)))
        sizes.append(len(bag))
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    weight = np.concatenate([np.zeros(0), *counts]) ** DAMPING
    weight /= np.repeat(segment_sum(weight, offsets), np.diff(offsets))
    return list(place), offsets, np.concatenate([np.zeros(0, np.int32), *ids]), weight


@dataclass
class ToxicityModel:
    """``embeddings`` (buckets by dimensions), ``classes`` (2 by dimensions), ``bias`` (2)."""

    embeddings: np.ndarray
    classes: np.ndarray
    bias: np.ndarray
    bits: int = BUCKET_BITS

    def scorer(self) -> Scorer:
        gain = self.embeddings @ (self.classes[1] - self.classes[0])
        return Scorer(gain.astype(np.float64), float(self.bias[1] - self.bias[0]), self.bits)


@dataclass
class Scorer:
    """The softmax as one logit: each bucket's share and the bias."""

    gain: np.ndarray
    bias: float
    bits: int

    def score(self, texts: list[str | None]) -> np.ndarray:
        distinct, offsets, ids, weight = bags(texts)
        number, ends = buckets(distinct, self.bits)
        word = segment_sum(self.gain[number], ends) / np.diff(ends)
        logit = segment_sum(word[ids] * weight, offsets) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500.0, 500.0)))


def fit(texts: list[str | None], labels: np.ndarray, share: float | None = None, bits: int = BUCKET_BITS, dimensions: int = DIMENSIONS, steps: int = STEPS, seed: int = 7) -> ToxicityModel:
    """Train embeddings and classes together.  ``share``: class 1 among all labelled rows."""
    size, rng = 1 << bits, np.random.default_rng(seed)
    params = [rng.uniform(-START, START, (size, dimensions)), rng.uniform(-1.0, 1.0, (2, dimensions)), np.zeros(2)]
    labels = np.asarray(labels, np.float64)
    mean = labels.mean() if len(labels) else 0.0
    if mean in (0.0, 1.0):
        params[2] = np.array([0.0, 1e3 if mean else -1e3])
        return ToxicityModel(np.zeros((size, dimensions)), params[1], params[2], bits)
    share = mean if share is None else share
    cost = np.where(labels == 1, share / mean, (1 - share) / (1 - mean))
    distinct, doc_ends, ids, weight = bags(texts)
    number, word_ends = buckets(distinct, bits)
    word_size = np.diff(word_ends)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    while step < steps:
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            sizes = doc_ends[rows + 1] - doc_ends[rows]
            ends = np.cumsum([0, *sizes])
            inside = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes) + np.repeat(doc_ends[rows], sizes)
            words, local = np.unique(ids[inside], return_inverse=True)
            spans = np.cumsum([0, *word_size[words]])
            flat = number[np.arange(spans[-1]) - np.repeat(spans[:-1], word_size[words]) + np.repeat(word_ends[words], word_size[words])]
            embeddings, classes, bias = params
            gain = embeddings @ (classes[1] - classes[0])
            word = segment_sum(gain[flat], spans) / word_size[words]
            logit = segment_sum(word[local] * weight[inside], ends) + bias[1] - bias[0]
            chance = 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))
            off = (chance - labels[rows]) * cost[rows] / len(rows)  # d loss / d (class 1 logit)
            per_word = np.bincount(local, np.repeat(off, sizes) * weight[inside], len(words)) / word_size[words]
            bucket = np.bincount(flat, np.repeat(per_word, word_size[words]), size)
            pull = bucket @ embeddings  # d loss / d class 1; class 0 gets the opposite
            grads = [np.outer(bucket, classes[1] - classes[0]) + DECAY * embeddings, np.stack([-pull, pull]), np.array([-off.sum(), off.sum()])]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ToxicityModel(*params, bits)


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[str], np.ndarray, float]:
    """At most ``rows`` whole texts of each class, in order of a hash of their id, as far
    as ``most_bytes`` go; and class 1's share of all labelled rows.

    Rows are chosen by id, length and hash first, so only the texts of the sample move.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__cw_id"), F.col(label).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    sized = docs.select(F.col(doc_id).alias("d"), F.coalesce(F.octet_length(text), F.lit(0)).alias("size"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    marked = sized.drop("text").join(marks, F.col("d") == F.col("__cw_id"))
    # rows that are alike in all of this are one group with a count
    groups = cut(marked.groupBy("y", "__cw_id", "size", "h").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("times")))
    counts = {r.y: r.n for r in groups.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    ranked = groups.where(F.col("size") <= most_bytes).select("__cw_id", "size", "h", "y", "times")
    found = first_rows(ranked, rows)
    picked = [found[at] for at in within([(r.y, r.size) for r in found], most_bytes)]
    keys = docs.sparkSession.createDataFrame(list(dict.fromkeys((r["__cw_id"], r["size"], r["h"]) for r in picked)), ranked.select("__cw_id", F.col("size").alias("size2"), F.col("h").alias("h2")).schema)
    # two classes of at most ``rows`` keys: small enough to broadcast
    same = (F.col("d") == F.col("__cw_id")) & (F.col("size") == F.col("size2")) & (F.col("h") == F.col("h2"))
    some = sized.join(F.broadcast(keys), same).dropDuplicates(["__cw_id", "size", "h"])
    texts = {(r["__cw_id"], r["size"], r["h"]): r["text"] for r in some.select("__cw_id", "size", "h", "text").collect()}
    total = sum(counts.values())
    return [texts[r["__cw_id"], r["size"], r["h"]] for r in picked], np.array([r.y for r in picked], np.float64), counts.get(1, 0) / total if total else 0.0


def first_rows(groups: DataFrame, rows: int) -> list:
    """The first ``rows`` rows of each class ``y`` in order of (hash of id, id, size, h), as
    one list in order of place, then class.

    Counts of rows by ranges of the hash tell where each class reaches ``rows``; only the
    groups up to there come to the driver.  The range that holds the boundary is refined
    once, to a share of 1 / 2^24 of all hashes, so no class is ever sorted or gathered.
    """
    order = F.xxhash64("__cw_id")

    def boundary(part: DataFrame, bits: int, before: dict[int, int]) -> dict[int, tuple[int, int]]:
        """Of each class, the range of hashes in which it reaches ``rows`` (or its last one),
        and the rows of the class before that."""
        sums = part.groupBy("y", F.shiftright(order, 64 - bits).alias("b")).agg(F.sum("times").alias("n")).collect()
        out: dict[int, tuple[int, int]] = {}
        reached = {y: (n, False) for y, n in before.items()}
        for y, b, n in sorted(tuple(r) for r in sums):
            passed, done = reached.get(y, (0, False))
            if not done:
                out[y] = (b, passed)
                reached[y] = (passed + n, passed + n >= rows)
        return out

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    coarse = boundary(groups, 12, {})
    inside = groups.where(any_of([(F.col("y") == y) & (F.shiftright(order, 52) == b) for y, (b, _) in coarse.items()]))
    fine = boundary(inside, 24, {y: n for y, (_, n) in coarse.items()})
    upto = any_of([(F.col("y") == y) & (F.shiftright(order, 40) <= b) for y, (b, _) in fine.items()])
    found, place = [], {}
    for r in sorted(groups.where(upto).withColumn("o", order).collect(), key=lambda r: (r.o, r["__cw_id"], r["size"], r.h)):
        for _ in range(min(r.times, rows - place.get(r.y, 0))):
            place[r.y] = place.get(r.y, 0) + 1
            found.append((place[r.y], r.y, r))
    return [r for _, _, r in sorted(found, key=lambda x: x[:2])]


def within(rows: list[tuple[int, int]], most: int) -> list[int]:
    """Places of the rows ``(class, size)`` to take, in order: first as each class's half
    of ``most`` allows, then as the rest does.  A row that does not fit is skipped."""
    taken, used = set(), {}
    for at, (kind, size) in enumerate(rows):
        if used.get(kind, 0) + size <= most // 2:
            used[kind] = used.get(kind, 0) + size
            taken.add(at)
    left = most - sum(used.values())
    for at, (_, size) in enumerate(rows):
        if at not in taken and size <= left:
            left -= size
            taken.add(at)
    return sorted(taken)


def learn_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on the documents of ``docs`` that ``labels`` marks."""
    return fit(*labelled_sample(docs, labels, text, doc_id, label, rows))


def with_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "__cw_toxic") -> DataFrame:
    """Add the score of each whole text (0 to 1)."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.scorer())

    def one(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(texts.to_pylist()))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "double")(F.col(text)))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """Rows that score below ``threshold``; columns unchanged."""
    scored = with_toxicity(docs, model, text)
    return scored.where(F.col("__cw_toxic") < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
