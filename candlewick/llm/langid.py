"""Language ID by rank-order profiles (operator 5).

A profile is a list of the most frequent character n-grams (one to three letters, words
padded with a space on each side) in order of frequency.  A language's profile comes
from the n-gram counts of all its training texts.  A document's own profile is compared
with each: an n-gram costs the difference of its two ranks, or the longest possible
difference if the language's profile lacks it.  The language with the smallest sum wins.

Counting is numpy sorting of packed n-gram codes, a slice of texts at a time; Spark
sums the counts by language and n-gram.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and when
there is nothing to learn from.  Equal distances go to the language first in order;
n-grams of equal count are ranked by code.  The score is one minus the distance as a share
of the largest possible one.  Repeated rows count and are judged each.  Long texts
are counted whole, in pieces that end with a word (a run of letters stays in one piece).
An empty table gives an empty result; columns not named play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.shared import build_struct, per_slice, ship_code, slices, struct_type

#: N-grams of a profile.  Profiles on the driver: languages times so many rows.
PROFILE = 400
#: Text counted at once (bytes): the packed n-grams take about a hundred times as much.
SLICE = 1 << 20
UNKNOWN = "und"
#: Texts nearer than this to no language are rejected by the filter.
LEAST_SCORE = 0.2
RESULT = struct_type(lang_pred=pa.string(), score=pa.float64())
_WIDE, _NONE = 21, (1 << 21) - 1  # bits of a code point; "no letter here"


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _bits(n: int) -> int:
    return max(1, int(n - 1).bit_length())


def count_ngrams(texts: list[str], owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram, count) for texts that belong to ``owner``; sorted by owner.

    An n-gram is three 21-bit code points: 0 is a word's edge, all ones is unused.
    """
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, padded), np.int64, len(padded)))
    letters = np.where(_is_letter()[codes], codes, 0)
    keep = letters != 0
    keep[1:] |= (letters[:-1] != 0) | (text[1:] != text[:-1])
    keep[:1] = True
    letters, text = letters[keep], text[keep]
    present = np.zeros(0x110000, bool)
    present[letters] = True
    present[0] = True
    alphabet = np.flatnonzero(present)
    small = np.zeros(0x110000, np.int64)
    small[alphabet] = np.arange(len(alphabet))
    x, who = small[letters], owner[text]
    b = _bits(len(alphabet))
    if _bits(owners) + 3 * b + 2 > 62 and len(texts) > 1:
        raise OverflowError  # the caller halves the slice
    top = who << (3 * b + 2)
    same2, same3 = text[1:] == text[:-1], text[2:] == text[:-2]
    one = x != 0
    two = same2 & ((x[1:] != 0) | (x[:-1] != 0))
    three = same3 & (x[1:-1] != 0)
    keys = np.concatenate(
        [
            (top | x)[one],
            (top[1:] | 1 << 3 * b | x[:-1] << b | x[1:])[two],
            (top[2:] | 2 << 3 * b | x[:-2] << 2 * b | x[1:-1] << b | x[2:])[three],
        ]
    )
    keys.sort()
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, counts = keys[starts], np.diff(np.append(starts, len(keys)))
    who, order = keys >> (3 * b + 2), keys >> 3 * b & 3
    wide = [alphabet[keys >> s * b & (1 << b) - 1] for s in (2, 1, 0)]
    wide[0] = np.where(order < 2, _NONE, wide[0])
    wide[1] = np.where(order < 1, _NONE, wide[1])
    return who, wide[0] << 2 * _WIDE | wide[1] << _WIDE | wide[2], counts


def count_all(texts: list[str], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``count_ngrams``, halving the texts where their alphabet is too large to pack."""
    owners = int(owner.max(initial=0)) + 1
    try:
        return count_ngrams(texts, owner, owners)
    except OverflowError:
        half = len(texts) // 2
        parts = [count_all(texts[:half], owner[:half]), count_all(texts[half:], owner[half:])]
        return added_up(parts)


def added_up(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of several ``count_ngrams`` as one, in the same order: owner, then shorter
    n-grams first, then code points."""
    who, grams, counts = (np.concatenate(x) for x in zip(*parts))
    shorter = -((grams >> 2 * _WIDE == _NONE).astype(np.int8) + (grams >> _WIDE & _NONE == _NONE))
    order = np.lexsort((grams, shorter, who))
    who, grams, counts = who[order], grams[order], counts[order]
    new = np.flatnonzero((np.diff(who, prepend=-1) != 0) | (np.diff(grams, prepend=-1) != 0))
    return who[new], grams[new], np.add.reduceat(counts, new) if len(new) else counts


def ranked(who: np.ndarray, grams: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram, rank) of each owner's ``most`` most frequent n-grams (ties by code)."""
    if not len(who):
        return who, grams, counts
    c, n = _bits(int(counts.max()) + 1), _bits(len(who))
    if _bits(int(who[-1]) + 1) + c + n <= 63:
        # grams come in code order of their slice's alphabet, which is code point order
        packed = who << (c + n) | ((1 << c) - 1 - counts) << n | np.arange(len(who))
        packed.sort()
        order = packed & (1 << n) - 1
    else:
        order = np.lexsort((np.arange(len(who)), -counts, who))
    who, grams = who[order], grams[order]
    first = np.flatnonzero(np.diff(who, prepend=-1))
    rank = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who))))
    ok = rank < most
    return who[ok], grams[ok], rank[ok]


def _breaks(c: str) -> bool:
    """Whether a text may be cut after this character without changing an n-gram."""
    return c.isspace() or c in ",;!?()" or c in "\u3001\u3002\uff0c\uff01\uff1b\uff1f"


def in_pieces(texts: list[str], size: int = SLICE) -> Iterator[tuple[list[str], np.ndarray]]:
    """Runs of (texts, their numbers) of about ``size`` characters.  A longer text is cut
    after a character that ends a word, so its pieces' n-grams are the whole text's; a run
    of letters is never cut, however long."""
    held, owner, total = [], [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t) or at == 0:
            end = min(len(t), at + size)
            while end < len(t) and not _breaks(t[end - 1]):
                end += 1
            held.append(t[at:end])
            owner.append(i)
            total += end - at
            at = max(end, 1)
            if total >= size:
                yield held, np.array(owner)
                held, owner, total = [], [], 0
    if held:
        yield held, np.array(owner)


def count_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``count_all`` of each text, taken a piece at a time."""
    parts = [count_all(held, owner) for held, owner in in_pieces(texts)]
    return parts[0] if len(parts) == 1 else added_up(parts)


@dataclass
class Profiles:
    """The languages' n-grams with their ranks: n-gram ``grams[i]`` has the entries
    ``starts[i]`` to ``starts[i + 1]`` of ``owners`` (languages) and ``ranks``."""

    languages: list[str]
    grams: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    ranks: np.ndarray
    most: int

    def distances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of each text to each language, and its profile's length."""
        total = np.zeros((len(texts), len(self.languages)))
        if not texts or not self.languages:
            return total, np.zeros(len(texts), np.int64)
        who, grams, rank = ranked(*count_pieces(texts), self.most)
        length = np.bincount(who, minlength=len(texts))
        total += (length * self.most)[:, None]  # as if no n-gram was known
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = np.flatnonzero(self.grams[at] == grams)
        first, n = self.starts[at[known]], self.starts[at[known] + 1] - self.starts[at[known]]
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        mine = np.repeat(known, n)
        saved = self.most - np.abs(rank[mine] - self.ranks[entry])
        flat = np.bincount(who[mine] * len(self.languages) + self.owners[entry], saved, total.size)
        return total - flat.reshape(total.shape), length

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        total, length = self.distances(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = total.argmin(axis=1)
        least = total[np.arange(len(texts)), best]
        score = np.where(length > 0, 1 - least / np.maximum(length * self.most, 1), 0.0)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), length.tolist())]
        return names, np.clip(score, 0.0, 1.0)


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = PROFILE) -> Profiles:
    """Profiles of every non-null value of ``lang``, from all n-grams of all its texts."""
    ship_code(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch.column(0), SLICE):
                langs = batch.column(1).slice(done, len(part)).dictionary_encode()
                done += len(part)
                number = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                for texts, owner in in_pieces(part.to_pylist()):
                    who, grams, counts = count_all(texts, number[owner])
                    names = langs.dictionary.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([names.cast(pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Spark keeps the first rows of each language in every task before it gathers them
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = sums.withColumn("place", place).where(F.col("place") <= most).select("lang", "gram", (F.col("place") - 1).alias("rank")).toPandas()
    return make_profiles(top["lang"].to_numpy(object), top["gram"].to_numpy(np.int64), top["rank"].to_numpy(np.int64), most)


def make_profiles(langs: np.ndarray, grams: np.ndarray, ranks: np.ndarray, most: int) -> Profiles:
    """Profiles from one row for each language and n-gram."""
    languages, owners = np.unique(langs.astype(str), return_inverse=True) if len(langs) else (np.zeros(0, str), np.zeros(0, np.int64))
    order = np.lexsort((owners, grams))
    distinct, first = np.unique(grams[order], return_index=True)
    return Profiles(languages.tolist(), distinct, np.append(first, len(order)), owners[order], ranks[order], most)


def with_language(docs: DataFrame, profiles: Profiles, text: str = "text", into: str = "__cw_lang") -> DataFrame:
    """Add a struct ``lang_pred, score`` for each whole text."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def one(texts: pa.Array) -> pa.Array:
        names, score = shared.value.predict([t or "" for t in texts.to_pylist()])
        return build_struct(RESULT, names, score)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, RESULT, SLICE)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "lang_pred string, score double")(F.col(text)))


def keep_known_language(docs: DataFrame, profiles: Profiles, least: float = LEAST_SCORE, text: str = "text") -> DataFrame:
    """Rows whose text has a language and a score of ``least`` or more; columns unchanged."""
    judged = with_language(docs, profiles, text)
    kept: Column = (F.col("__cw_lang.lang_pred") != UNKNOWN) & (F.col("__cw_lang.score") >= least)
    return judged.where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
