"""Byte-level BPE encoding and decoding with a transducer lexicon (operator 9).

The corpus' most frequent words are encoded once and compiled into a minimal acyclic
transducer: states with equal futures are shared, and every transition carries the
number of words it skips, so the outputs along a path add up to the word's place in
the table of id sequences.  Workers memory-map it and walk all distinct words of a
slice of texts together.  Words that it lacks are merged by rank, exactly, all of them
at once in numpy.  The lexicon decides speed only; ids are the same without it.

The tokenizer file is a parameter and is read on the driver; nothing is trained.

Defined results: null text counts as empty (0 ids, the digests of empty strings); the
strings of added tokens in a text become those tokens, as in the tokenizers library.
Texts and words of any length are encoded whole.  Repeated rows are each encoded; words of
equal frequency may or may not be in the lexicon.  An empty table gives an empty result;
columns that are not named play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.shared import build_struct, cut, most_frequent, pack, per_slice, ship_code, slices, struct_type

#: Fixed value: the byte-level pre-tokenizer's pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same words of a text that is ASCII only, for the quicker standard module.
ASCII_WORDS = r" ?(?:[A-Za-z]++|[0-9]++)|'(?:[stmd]|re|ve|ll)| ?[^\t-\r A-Za-z0-9]++|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Words of the lexicon, and the longest word it takes (bytes): this bounds the broadcast.
LEXICON_WORDS, LEXICON_BYTES = 65_536, 64
#: Entries that a worker's memory of words, or a counting task's table, may reach.
MEMORY_WORDS = 250_000
#: Words from this many bytes on are merged one by one, with a heap.
LONG_WORD = 1024


def word_finder() -> Callable[[str], list[str]]:
    """The words of a text, in order."""
    plain, full = re.compile(ASCII_WORDS).findall, regex.compile(WORDS).findall
    return lambda text: plain(text) if text.isascii() else full(text)


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others for 256 and up."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class BpeModel:
    """Merge table, token bytes and added tokens of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        self.token_bytes: dict[int, bytes] = {i: bytes(symbols[c] for c in t) for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.added.items()}
        self.byte_id = np.zeros(256, np.int64)
        for c, b in symbols.items():
            self.byte_id[b] = vocab[c]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.rank_of: dict[int, int] | None = None  # made where a long word needs it

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: merge the pair of least rank until there is none."""
        if any(len(w) >= LONG_WORD for w in words):
            short = iter(self._merge_short([w for w in words if len(w) < LONG_WORD]))
            return [self._merge_long(w) if len(w) >= LONG_WORD else next(short) for w in words]
        return self._merge_short(words)

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word: its pairs wait in a heap, least rank and then leftmost first, so
        the time is about that of sorting its bytes."""
        if self.rank_of is None:
            self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        rank_of = self.rank_of
        merged = self.merged.tolist()
        ids = self.byte_id[np.frombuffer(word, np.uint8)]
        key = ids[:-1] << 20 | ids[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[at] == key)
        heap = np.sort(self.ranks[at[known]] << 32 | known).tolist()  # a sorted list is a heap
        ids, n = ids.tolist(), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            item = heappop(heap)
            rank, left = item >> 32, item & 0xFFFFFFFF
            right = after[left]
            if ids[left] < 0 or right >= n or rank_of.get(ids[left] << 20 | ids[right]) != rank:
                continue  # one of the two was merged meanwhile
            ids[left], ids[right] = merged[rank], -1
            beyond = after[left] = after[right]
            if beyond < n:
                before[beyond] = left
                new = rank_of.get(ids[left] << 20 | ids[beyond])
                if new is not None:
                    heappush(heap, new << 32 | left)
            ahead = before[left]
            if ahead >= 0:
                new = rank_of.get(ids[ahead] << 20 | ids[left])
                if new is not None:
                    heappush(heap, new << 32 | ahead)
        out = np.array(ids, np.int64)
        return out[out >= 0]

    def _merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        data, offsets = pack(words)
        done: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        ids, owner = self.byte_id[data], np.repeat(np.arange(len(words)), np.diff(offsets))
        never = len(self.merged)
        while len(ids):
            key = ids[:-1] << 20 | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), never - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], never)
            rank = np.append(rank, never)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            for s, n in zip(starts[best == never].tolist(), sizes[best == never].tolist()):
                done[owner[s]] = ids[s : s + n]
            live = np.repeat(best < never, sizes)
            if not live.any():
                break
            hit = live & (rank == np.repeat(best, sizes))
            # of touching pairs (a a a) every second one merges, from the left
            place = np.flatnonzero(hit)
            run = np.flatnonzero(np.diff(place, prepend=-2) != 1)
            inside = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
            place = place[inside % 2 == 0]
            ids = ids.copy()
            ids[place] = self.merged[rank[place]]
            live[place + 1] = False
            ids, owner = ids[live], owner[live]
        return done


class Lexicon:
    """Minimal acyclic transducer from words to id sequences, as flat arrays."""

    FIELDS = ("keys", "target", "skip", "final", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, entries: dict[bytes, Iterable[int]]) -> Lexicon:
        words = sorted(entries)
        edges: list[dict[int, int]] = [{}]
        final = [False]
        known: dict[tuple, int] = {}
        path = [0]  # states of the last word, not yet shared

        def share(depth: int, last: bytes) -> None:
            while len(path) - 1 > depth:
                state = path.pop()
                form = (final[state], tuple(edges[state].items()))
                twin = known.setdefault(form, state)
                edges[path[-1]][last[len(path) - 1]] = twin

        last = b""
        for word in words:
            same = next((k for k, (x, y) in enumerate(zip(word, last)) if x != y), min(len(word), len(last)))
            share(same, last)
            for b in word[same:]:
                edges.append({})
                final.append(False)
                edges[path[-1]][b] = len(edges) - 1
                path.append(len(edges) - 1)
            final[path[-1]] = True
            last = word
        share(0, last)
        order, below = [], {}  # states reachable from the root, futures first
        stack = [(0, False)]
        while stack:
            state, ready = stack.pop()
            if state in below:
                continue
            if ready:
                below[state] = final[state] + sum(below[t] for t in edges[state].values())
                order.append(state)
            else:
                stack.append((state, True))
                stack += [(t, False) for t in edges[state].values()]
        name = {s: k for k, s in enumerate(reversed(order))}  # the root is 0
        rows = []
        for state in order:
            skipped = int(final[state])
            for b, t in sorted(edges[state].items()):
                rows.append((name[state] << 8 | b, name[t], skipped))
                skipped += below[t]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        ends = np.zeros(len(name), bool)
        ends[[name[s] for s in order if final[s]]] = True
        sequences = [np.asarray(entries[w], np.int32) for w in words]
        offsets = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(s) for s in sequences], out=offsets[1:])
        ids = np.concatenate(sequences) if sequences else np.zeros(0, np.int32)
        return cls(dict(keys=table[:, 0].copy(), target=table[:, 1].copy(), skip=table[:, 2].copy(), final=ends, offsets=offsets, ids=ids))

    @property
    def states(self) -> int:
        return len(self.final)

    def dump(self) -> tuple[list[tuple], bytes]:
        fields = [(n, getattr(self, n).dtype.str, len(getattr(self, n))) for n in self.FIELDS]
        return fields, b"".join(getattr(self, n).tobytes().ljust(-(-getattr(self, n).nbytes // 8) * 8, b"\0") for n in self.FIELDS)

    @classmethod
    def mapped(cls, fields: list[tuple], body: bytes) -> Lexicon:
        """Open the arrays over a memory-mapped file (gone from the folder once mapped)."""
        with tempfile.TemporaryFile() as f:
            f.write(body or b"\0")
            f.flush()
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        arrays, at = {}, 0
        for name, kind, n in fields:
            arrays[name] = np.frombuffer(view, kind, n, at)
            at += -(-n * np.dtype(kind).itemsize // 8) * 8
        return cls(arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the table of id sequences, or -1."""
        if not len(self.keys):
            return np.full(len(words), -1)
        data, offsets = pack(words)
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts = offsets[:-1][order]
        live = np.searchsorted(-sizes[order], -np.arange(min(sizes.max(initial=0), LEXICON_BYTES + 1)), side="left")
        state, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for at, n in enumerate(live.tolist()):
            key = state[:n] << 8 | data[starts[:n] + at]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[edge] == key) & (state[:n] >= 0)
            state[:n] = np.where(ok, self.target[edge], -1)
            place[:n] += self.skip[edge]
        ok = (state >= 0) & self.final[state] & (sizes[order] <= LEXICON_BYTES)
        out = np.empty(len(words), np.int64)
        out[order] = np.where(ok, place, -1)
        return out


class Encoder:
    """Encodes and decodes texts word by word; remembers words it has seen.

    A full memory forgets all words but those of the lexicon.
    """

    def __init__(self, model: BpeModel, lexicon: Lexicon | None = None):
        self.model, self.lexicon = model, lexicon
        self.words = word_finder()
        self.seen: dict[str, tuple[int, bytes, bytes]] = {}
        self.lasting: dict[str, tuple[int, bytes, bytes]] = {}
        self.decimals = {i: b"%d" % i for i in model.token_bytes}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(model.added, key=len, reverse=True))) + ")") if model.added else None

    def pieces(self, text: str) -> list[str]:
        """Words of a text; an added token is a piece of its own, marked by NUL NUL."""
        if self.split is None or not self.split.search(text):
            return self.words(text)
        out: list[str] = []
        for k, part in enumerate(self.split.split(text)):
            if k % 2:
                out.append("\0\0" + part)
            else:
                out += self.words(part)
        return out

    def entry(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        token, decimals = self.model.token_bytes, self.decimals
        return len(ids), b",".join([decimals[i] for i in ids]), b"".join([token[i] for i in ids])

    def learn(self, words: set[str]) -> None:
        new = words - self.seen.keys()
        if len(self.seen) + len(new) > MEMORY_WORDS:
            self.seen = dict(self.lasting)
            new = words - self.seen.keys()
        plain = []
        for w in new:
            if w[:2] == "\0\0" and w[2:] in self.model.added:
                self.seen[w] = self.entry([self.model.added[w[2:]]])
            else:
                plain.append(w)
        raw = [w.encode() for w in plain]
        place = self.lexicon.find(raw) if self.lexicon else np.full(len(raw), -1)
        for k in np.flatnonzero(place >= 0).tolist():
            start, end = self.lexicon.offsets[place[k] : place[k] + 2]
            self.seen[plain[k]] = self.lasting[plain[k]] = self.entry(self.lexicon.ids[start:end].tolist())
        rest = np.flatnonzero(place < 0).tolist()
        for k, ids in zip(rest, self.model.merge([raw[k] for k in rest])):
            self.seen[plain[k]] = self.entry(ids.tolist())

    def encode(self, texts: list[str | None]) -> Iterator[list[tuple[int, bytes, bytes]]]:
        """For each text its words as (number of ids, ids as decimals, decoded bytes)."""
        split = [self.pieces(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        for words in split:
            yield [self.seen[w] for w in words]


COUNT, DECIMALS, DECODED = itemgetter(0), itemgetter(1), itemgetter(2)
RESULT = struct_type(n_tokens=pa.int64(), ids=pa.binary(), decoded=pa.string())
DIGEST = struct_type(n_tokens=pa.int64(), ids_sha256=pa.string(), decoded_sha256=pa.string())


def frequent_words(docs: DataFrame, text: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words over all texts, at most ``limit``."""
    ship_code(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, table = word_finder(), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch.column(0)):
                for t in part.to_pylist():
                    if t:
                        table.update(find(t))
                if len(table) > MEMORY_WORDS:
                    yield rows()
                    table = Counter()
        yield rows()

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    short = counts.where(F.octet_length("word") <= LEXICON_BYTES)
    sums = cut(short.groupBy("word").agg(F.sum("n").alias("n")))
    return [r.word for r in most_frequent(sums, limit).collect()]


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(shared) -> Encoder:
    """The worker's encoder for a broadcast model, kept from task to task."""
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        model, lexicon = shared.value
        _ENCODERS[key] = Encoder(model, Lexicon.mapped(*lexicon))
    return _ENCODERS[key]


def with_bpe(docs: DataFrame, path: str, text: str = "text", into: str = "__cw_bpe", digest: bool = False, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Add a struct of the encoded text: ``n_tokens``, ``ids`` (decimals joined by
    commas) and ``decoded``; with ``digest`` the SHA-256 of the last two instead."""
    ship_code(docs.sparkSession)
    model = BpeModel(path)
    words = [w for w in frequent_words(docs, text, lexicon_words)]
    entries = dict(zip([w.encode() for w in words], model.merge([w.encode() for w in words])))
    shared = docs.sparkSession.sparkContext.broadcast((model, Lexicon.build(entries).dump()))
    kind = DIGEST if digest else RESULT

    def one(texts: pa.Array) -> pa.Array:
        n, ids, decoded = [], [], []
        for parts in encoder_of(shared).encode(texts.to_pylist()):
            n.append(sum(map(COUNT, parts)))
            number, back = b",".join(filter(None, map(DECIMALS, parts))), b"".join(map(DECODED, parts))
            if digest:
                ids.append(hashlib.sha256(number).hexdigest())
                decoded.append(hashlib.sha256(back.decode("utf-8", "replace").encode()).hexdigest())
            else:
                ids.append(number)
                decoded.append(back.decode("utf-8", "replace"))
        return build_struct(kind, n, ids, decoded)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    ddl = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "n_tokens long, ids binary, decoded string"
    return docs.withColumn(into, F.arrow_udf(run, ddl)(F.col(text)))
