"""Language-model scores from a log-frequency Bloom filter (operator 4).

Counts of words and word pairs over all training texts are quantised on a log scale; a
count at level q is stored as q entries (n-gram, 1) to (n-gram, q).  A lookup probes
level after level until one is missing, which gives the count's level: errors are
one-sided and shrink geometrically.  The filter is cut into segments by n-gram hash, each
sized by its entries; there are as many as the counted tokens ask for, so a segment is
bounded and the filter grows with the training texts, without a cap.

Training n-grams are sent once, added up within about ``UNIT_BYTES`` of text, to the task
that builds their segment; after that only the segments are left.  A filter of up to
``BROADCAST_BYTES`` (it is measured) is broadcast, and each task scores its texts by
probing it.  A larger one stays where it is: the texts' n-gram hashes go to their segments,
and the levels come back.  Both ways probe the same segments and give the same scores.

Smoothing: words mix a Good-Turing share for unknown words (all of them one outcome, as
in the base score) with known counts; pairs add to that with weight ``PRIOR``:
``p(w | v) = (c(v w) + PRIOR * p(w)) / (c(v) + PRIOR)``.  The first word of a text has
no pair.

The base score needs exact counts.  The most frequent words (``TOP_WORDS`` at most) are broadcast
with theirs; all other words of all texts are joined with the count table.

Defined results: null text counts as empty: it has one token, the end.  With no training
texts every token is unknown.  Repeated rows count and are scored each, null ids too.  A
text of any length is scored whole, as a unit of its own.  An empty table gives an empty
result; columns that are not named play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.shared import build_struct, cut, factorize, most_frequent, per_slice, raw, segment_sum, ship_code, slices, struct_type, written

#: The token after the last word; no word is empty.
END = b""
#: Quantisation base: a count c is at level 1 + floor(log_BASE(c)).
BASE = 1.5
BITS_PER_ENTRY, PROBES = 8, 4
PRIOR = 200.0
#: Words broadcast with exact counts, and the longest of them (bytes).
TOP_WORDS, TOP_BYTES = 131_072, 64
#: Words a counting task holds before it sends them on.
HELD_WORDS = 250_000
#: Text of a unit (bytes).  A unit's n-grams are sent and answered together.
UNIT_BYTES = 8 << 20
#: Training tokens of a segment, and the largest filter that is broadcast.
PART_TOKENS = 2 << 20
BROADCAST_BYTES = 96 << 20
#: Text scored at once beside a broadcast filter (bytes).
SCORE_BYTES = 2 << 20

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_LOW, _HALF = np.uint64((1 << 40) - 1), np.uint64((1 << 32) - 1)


def split_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text and the end token."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def single_hash(words: np.ndarray) -> np.ndarray:
    return mix(words + _M3)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _M3 + second)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; 0 for level 0."""
    each = np.arange(int(levels.max(initial=0)) + 1)
    low, high = np.ceil(BASE ** (each - 1.0)), np.ceil(BASE ** each.astype(np.float64)) - 1
    return np.where(each > 0, (low + np.maximum(low, high)) / 2, 0.0)[levels]


def entry_seeds(low: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of an entry's probes, both below 2 ** 32."""
    seed = mix(low + np.uint64(level * int(_M3) & (1 << 64) - 1))
    return seed >> np.uint64(32), (seed & _HALF) | np.uint64(1)


def build_segment(low: np.ndarray, counts: np.ndarray) -> bytes:
    """The segment that holds the n-grams' quantised counts."""
    levels = level_of(counts)
    entries = int(levels.sum())
    size = max(64, -(-entries * BITS_PER_ENTRY // 8))
    if size > 1 << 29:
        raise ValueError("a segment is larger than its probes can address: use more parts")
    bits = np.zeros(size * 8, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        start, step = entry_seeds(low[levels >= level], level)
        for _ in range(PROBES):
            bits[(start * np.uint64(len(bits)) >> np.uint64(32)).astype(np.int64)] = True
            start = (start + step) & _HALF
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class CountFilter:
    """All segments, one after the other; ``starts`` has parts + 1 byte offsets."""

    flags: np.ndarray
    starts: np.ndarray

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Probe level after level until one is missing."""
        out = np.zeros(len(hashes), np.int64)
        part = part_of(hashes, len(self.starts) - 1)
        origin = self.starts[part]
        bits = ((self.starts[part + 1] - origin) * 8).astype(np.uint64)
        live = np.flatnonzero(bits > 0)
        low, origin, bits = (hashes & _LOW)[live], origin[live], bits[live]
        level = 0
        while len(live):
            level += 1
            start, step = entry_seeds(low, level)
            for _ in range(PROBES):
                place = start * bits >> np.uint64(32)
                byte = self.flags[origin + (place >> np.uint64(3)).astype(np.int64)]
                ok = np.flatnonzero(byte >> (place & np.uint64(7)).astype(np.uint8) & 1)
                if len(ok) < len(live):
                    live, low, origin, bits, start, step = (x[ok] for x in (live, low, origin, bits, start, step))
                start = (start + step) & _HALF
            out[live] = level
        return out


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)``: exact counts of all words and ends."""
    ship_code(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(table.keys(), pa.binary()), pa.array(table.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch.column(0)):
                for t in raw(part):
                    table.update(split_words(t))
                if len(table) > HELD_WORDS:
                    yield rows()
                    table = Counter()
        yield rows()

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def merge_counts(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[new], np.add.reduceat(counts, new) if len(new) else counts


def to_planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value: all lowest bytes, all next ones and so on."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(body: bytes, width: int, start: int = 0, size: int | None = None) -> np.ndarray:
    """``size`` values from ``to_planes``; as many as the body holds without it."""
    size = len(body) // width if size is None else size
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :width] = np.frombuffer(body, np.uint8, width * size, start).reshape(width, size).T
    return wide.view("<u8").ravel()


@dataclass
class Unit:
    """Some whole texts: tokens of each, which of them train, each token's word and the
    hashes of the distinct words."""

    sizes: np.ndarray
    learn: np.ndarray
    ids: np.ndarray
    words: np.ndarray

    def pack(self) -> dict[str, bytes]:
        return {"sizes": to_planes(self.sizes, 4), "learn": to_planes(self.learn, 1), "ids": to_planes(self.ids, 4), "words": to_planes(self.words, 8)}

    @staticmethod
    def unpack(sizes: bytes, learn: bytes, ids: bytes, words: bytes) -> Unit:
        return Unit(from_planes(sizes, 4).astype(np.int64), from_planes(learn, 1).astype(bool), from_planes(ids, 4).astype(np.int64), from_planes(words, 8))

    def follows(self) -> np.ndarray:
        """Tokens that are not the first of their text: a pair never crosses texts."""
        out = np.ones(len(self.ids), bool)
        out[np.cumsum(self.sizes) - self.sizes] = False
        return out

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the distinct n-grams; and the place among them of each word,
        then of each token's pair with the token before it."""
        token = self.words[self.ids]
        pairs = pair_hash(token[:-1], token[1:])[self.follows()[1:]]
        grams, place = np.unique(np.concatenate([single_hash(self.words), pairs]), return_inverse=True)
        return grams, place.ravel()

    def counts(self, place: np.ndarray) -> np.ndarray:
        """How often training texts hold each n-gram."""
        learnt = np.repeat(self.learn, self.sizes).astype(np.float64)
        words = np.bincount(self.ids, learnt, len(self.words))
        return np.bincount(place, np.concatenate([words, learnt[self.follows()]])).astype(np.int64)


_UNIT = pa.struct([(name, pa.binary()) for name in ("sizes", "learn", "ids", "words")])
#: Bytes of hash and of count that an n-gram is sent with.
_LOW_BYTES, _COUNT_BYTES = 5, 4


def by_part(grams: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """Part, start and end of each part's share of sorted n-grams."""
    edges = np.searchsorted(part_of(grams, parts), np.arange(parts + 1))
    used = np.flatnonzero(np.diff(edges))
    return list(zip(used.tolist(), edges[used].tolist(), edges[used + 1].tolist()))


def _messages(number: int, shares: list[tuple[int, int, int]], body) -> pa.RecordBatch:
    bodies = [body(a, b) for _, a, b in shares]
    return pa.RecordBatch.from_arrays([pa.array([number] * len(shares), pa.int64()), pa.array([p for p, _, _ in shares], pa.int64()), pa.array(bodies, pa.binary())], ["unit", "part", "body"])


def make_unit(texts: pa.Array, learn: np.ndarray) -> tuple[Unit, list[bytes]]:
    """The unit of some texts, and its distinct words."""
    split = [split_words(t) for t in raw(texts)]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    distinct, ids = factorize(list(chain.from_iterable(split)))
    return Unit(sizes, learn, ids, word_hashes(distinct)), distinct


def segment_of(bodies: list[bytes]) -> bytes:
    """Segment of a part from the n-grams and counts that were sent to it."""
    sizes = [len(b) // (_LOW_BYTES + _COUNT_BYTES) for b in bodies]
    low = np.concatenate([from_planes(b, _LOW_BYTES, 0, n) for b, n in zip(bodies, sizes)])
    counts = np.concatenate([from_planes(b, _COUNT_BYTES, _LOW_BYTES * n, n) for b, n in zip(bodies, sizes)]).astype(np.int64)
    return build_segment(*merge_counts(low, counts))


def filter_segments(learn: DataFrame, parts: int, text: str = "text") -> DataFrame:
    """``(part, segment)`` of the filter over all n-grams of all texts of ``learn``."""
    ship_code(learn.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(0), UNIT_BYTES):
                unit, _ = make_unit(piece, np.ones(len(piece), bool))
                grams, place = unit.grams()
                low, counts = grams & _LOW, unit.counts(place)
                yield _messages(0, by_part(grams, parts), lambda a, b: to_planes(low[a:b], _LOW_BYTES) + to_planes(counts[a:b], _COUNT_BYTES))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "segment": [segment_of(rows["body"].tolist())]})

    sent = learn.select(F.col(text).alias("text")).mapInArrow(send, "unit long, part long, body binary")
    return sent.select("part", "body").groupBy("part").applyInPandas(build, "part long, segment binary")


def gather_filter(segments: DataFrame, parts: int) -> CountFilter:
    """The whole filter; only for one that has been measured.  Segments come one file at a
    time into the one array, so the driver holds it once."""
    sizes = {r.part: r.n for r in segments.select("part", F.octet_length("segment").alias("n")).collect()}
    starts = np.cumsum([0, *(sizes.get(p, 0) for p in range(parts))])
    flags = np.zeros(int(starts[-1]), np.uint8)
    for r in segments.toLocalIterator():
        flags[starts[r.part] : starts[r.part + 1]] = np.frombuffer(r.segment, np.uint8)
    return CountFilter(flags, starts)


def gram_levels(units: DataFrame, segments: DataFrame, parts: int) -> DataFrame:
    """``(unit, part, levels)``: the levels of a unit's n-grams, part after part in the
    order of ``Unit.grams``, probed where the segments are.  ``units``: rows of ``unit`` and
    a packed ``Unit``."""
    ship_code(units.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                number, *packed = (column[at].as_py() for column in batch.columns)
                grams, _ = Unit.unpack(*packed).grams()
                low = grams & _LOW
                yield _messages(number, by_part(grams, parts), lambda a, b: to_planes(low[a:b], _LOW_BYTES))

    def answer(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        segment = bytes(held["segment"].iloc[0]) if len(held) else b""
        one = CountFilter(np.frombuffer(segment, np.uint8), np.array([0, len(segment)]))
        levels = [one.levels(from_planes(bytes(b), _LOW_BYTES)).astype(np.uint8).tobytes() for b in asked["body"]]
        return pd.DataFrame({"unit": asked["unit"], "part": asked["part"], "levels": levels})

    sent = units.select("unit", *_UNIT.names).mapInArrow(send, "unit long, part long, body binary")
    return sent.groupBy("part").cogroup(segments.groupBy("part")).applyInPandas(answer, "unit long, part long, levels binary")


@dataclass
class LanguageModel:
    """The figures that turn the filter's counts into probabilities."""

    tokens: int
    distinct: int
    once: int
    known_total: float
    prior: float = PRIOR

    def word_chance(self, count: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(count))
        unknown = min(max(self.once, 1) / (self.tokens + 1), 0.5)
        return np.where(count > 0, (1 - unknown) * count / self.known_total, unknown)

    def score(self, unit: Unit, place: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """log10 probability of each text, from the levels of the unit's n-grams."""
        words = len(unit.words)
        count = count_of(levels[place[:words]])
        chance = self.word_chance(count)
        value = chance[unit.ids]
        follows = unit.follows()
        seen = count_of(levels[place[words:]])
        before = count[unit.ids[np.flatnonzero(follows) - 1]]
        value[follows] = (np.minimum(seen, before) + self.prior * value[follows]) / (before + self.prior)
        return segment_sum(np.log10(value), np.concatenate([[0], np.cumsum(unit.sizes)]))


RESULT = struct_type(
    n_tokens=pa.int64(), known=pa.int64(), logs=pa.float64(), score=pa.float64(),
    rare=pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())])),
    unit=_UNIT,
)
_DDL = "n_tokens long, known long, logs double, score double, rare array<struct<word binary, n int>>, unit struct<sizes binary, learn binary, ids binary, words binary>"
_TOP: dict[int, dict[bytes, int]] = {}


def score_texts(docs: DataFrame, training: Column, text: str = "text", doc_id: str = "doc_id", extra: dict | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row a text: ``doc_id, n_tokens, n_known, train_tokens, base_score, score`` and
    ``extra``, learned from the rows where ``training`` holds."""
    spark = docs.sparkSession
    ship_code(spark)
    learn = docs.where(training)
    counts = cut(count_words(learn, text))
    level = F.lit(1) + F.floor(F.log(F.col("n")) / F.log(F.lit(BASE)) + F.lit(1e-9))
    per_level = counts.groupBy(level.cast("long").alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")).toPandas()
    total, distinct, once = int(per_level["n"].sum()), int(per_level["words"].sum()), int(per_level["once"].sum())
    known_total = float((count_of(per_level["level"].to_numpy(np.int64)) * per_level["words"].to_numpy()).sum()) if len(per_level) else 1.0
    model = LanguageModel(total, distinct, once, known_total)
    top = most_frequent(counts.where(F.octet_length("word") <= TOP_BYTES), TOP_WORDS).toPandas()
    parts = max(1, -(-total // PART_TOKENS))
    segments = written(filter_segments(learn, parts, text), "lm-filter", compression="none")
    size = segments.agg(F.coalesce(F.sum(F.octet_length("segment")), F.lit(0))).first()[0]
    small = size <= broadcast_bytes
    words_and_filter = ([bytes(w) for w in top["word"]], top["n"].to_numpy(np.int64), gather_filter(segments, parts) if small else None)
    shared = spark.sparkContext.broadcast(words_and_filter)

    def one(texts: pa.Array) -> pa.Array:
        words, exact, held = shared.value
        place = _TOP.get(id(words))
        if place is None:
            _TOP.clear()
            place = _TOP[id(words)] = dict(zip(words, range(len(words))))
        unit, distinct = make_unit(texts, np.zeros(len(texts), bool))
        ids, sizes = unit.ids, unit.sizes
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        at = np.fromiter((place.get(w, -1) for w in distinct), np.int64, len(distinct))
        common = at >= 0
        logs = np.where(common, np.log10(np.append(exact, 0)[at] + 0.1), 0.0)
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        pairs, n = np.unique((doc << 32 | ids)[~common[ids]], return_counts=True)
        edges = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1)).astype(np.int32)
        words_of = pa.array(distinct, pa.binary()).take(pa.array(pairs & 0xFFFFFFFF))
        entries = pa.StructArray.from_arrays([words_of, pa.array(n, pa.int32())], ["word", "n"])
        rare = pa.ListArray.from_arrays(pa.array(edges), entries)
        if held is None:
            score = pa.nulls(len(texts), pa.float64())
            first = pa.array([unit.pack(), *[None] * (len(texts) - 1)], _UNIT)  # on its first text
        else:
            grams, spot = unit.grams()
            score, first = pa.array(model.score(unit, spot, held.levels(grams))), pa.nulls(len(texts), _UNIT)
        return build_struct(RESULT, sizes, segment_sum(common.astype(np.int64)[ids], offsets), segment_sum(logs[ids], offsets), score, rare.cast(RESULT.field("rare").type), first)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, RESULT, SCORE_BYTES if small else UNIT_BYTES)

    def finish(answers: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        first, *fields = packed.iloc[0].tolist()
        unit = Unit.unpack(*fields)
        levels = np.frombuffer(b"".join(answers.sort_values("part")["levels"]), np.uint8)
        score = model.score(unit, unit.grams()[1], levels.astype(np.int64))
        return pd.DataFrame({"row": first + np.arange(len(score)), "score": score})

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    more = [c.alias(n) for n, c in (extra or {}).items()]
    judged = F.arrow_udf(run, _DDL)(F.col(text))
    # numbered as written: all branches below read the same files, and a unit's texts
    # have the numbers from that of its first text on
    scored = written(docs.select(F.col(doc_id).alias("doc_id"), *more, judged.alias("r")).withColumn("row", F.monotonically_increasing_id()), "lm-texts", compression="zstd")
    rare = scored.select("row", F.explode("r.rare").alias("e")).select("row", F.col("e.word").alias("w"), F.col("e.n").alias("times"))
    found = rare.join(counts, F.col("w") == F.col("word"), "left")
    each = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)
    sums = found.groupBy("row").agg(F.sum(each).alias("rare_logs"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    out = scored.select("row", "doc_id", *(extra or {}), "r.n_tokens", "r.known", "r.logs", "r.score").join(sums.withColumnRenamed("row", "row2"), F.col("row") == F.col("row2"), "left")
    if not small:
        units = scored.where(F.col("r.unit").isNotNull()).select(F.col("row").alias("unit"), "r.unit.*")
        levels = gram_levels(units, segments, parts)
        scores = levels.groupBy("unit").cogroup(units.groupBy("unit")).applyInPandas(finish, "row long, score double")
        out = out.drop("score").join(scores.withColumnRenamed("row", "row3"), F.col("row") == F.col("row3"), "left")
    base = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(total + 0.1 * (distinct + 1)))
    return out.select(
        "doc_id", *(extra or {}), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
