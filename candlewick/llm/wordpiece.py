"""Word-piece lengths by a linear longest-match automaton (operator 3).

The vocabulary becomes a trie with one root for pieces that begin a word and one for
pieces inside it.  Every node has a failure link and the number of pieces that are
popped on following it, so a word is read once, byte by byte, and its greedy
longest-match piece count is a sum: no piece is ever built or looked up.  All distinct
words of a slice of texts walk the automaton together.

A word (run of characters other than ASCII white space) that can't be cut into pieces
counts as one unknown token.

Defined results: null and empty texts have no words and no tokens.  Texts and words of any
length are read whole.  Of several pieces that fit, the longest is taken, so there are no
ties.  Repeated rows are counted each; an empty table gives an empty result; columns that are
not named are kept, whatever their names.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.bpe import byte_symbols
from candlewick.llm.shared import build_struct, factorize, pack, per_slice, raw, segment_sum, ship_code, struct_type

COUNTS = struct_type(n_words=pa.int64(), n_tokens=pa.int64(), n_unknown=pa.int64())


def pieces_of(path: str) -> tuple[list[bytes], list[bytes]]:
    """Word-initial and inner pieces of a byte-level tokenizer file.

    Pieces that start with the mark of a space begin a word, the others continue one.
    """
    symbols = byte_symbols()
    with open(path, encoding="utf-8") as f:
        tokens = [bytes(symbols[c] for c in t) for t in json.load(f)["model"]["vocab"]]
    return [t[1:] for t in tokens if t[:1] == b" " and len(t) > 1], [t for t in tokens if t[:1] != b" "]


class PieceAutomaton:
    """Trie with failure links and popped-piece counts, in flat arrays."""

    BEGIN, INNER, NONE = 0, 1, -1

    def __init__(self, initial: Iterable[bytes], inner: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((self.BEGIN, initial), (self.INNER, inner)):
            for piece in pieces:
                node = root
                for b in piece:
                    if b not in edges[node]:
                        edges.append({})
                        whole.append(False)
                        edges[node][b] = len(edges) - 1
                    node = edges[node][b]
                if piece:
                    whole[node] = True
        fail, pops = [self.NONE] * len(edges), [0] * len(edges)
        todo = deque([self.BEGIN, self.INNER])
        while todo:
            parent = todo.popleft()
            for b, node in edges[parent].items():
                todo.append(node)
                if whole[node]:
                    fail[node], pops[node] = self.INNER, 1
                    continue
                back, popped = fail[parent], pops[parent]
                while back != self.NONE and b not in edges[back]:
                    popped += pops[back]
                    back = fail[back]
                if back != self.NONE:
                    fail[node], pops[node] = edges[back][b], popped
        rows = sorted((n << 8 | b, t) for n, e in enumerate(edges) for b, t in e.items())
        table = np.array(rows, np.int64).reshape(-1, 2)
        # a last entry that no key reaches keeps searches inside the array
        self.keys = np.append(table[:, 0], np.int64(1) << 60)
        self.target = np.append(table[:, 1], 0)
        self.fail, self.pops = np.array(fail, np.int64), np.array(pops, np.int64)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word, or -1 for an unknown one."""
        data, offsets = pack(words)
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts = offsets[:-1][order]
        live = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        node, count = np.full(len(words), self.BEGIN), np.zeros(len(words), np.int64)
        for at, n in enumerate(live.tolist()):
            byte = data[starts[:n] + at]
            todo = np.flatnonzero(node[:n] != self.NONE)
            while len(todo):
                key = node[todo] << 8 | byte[todo]
                edge = np.searchsorted(self.keys, key)
                go = self.keys[edge] == key
                node[todo[go]] = self.target[edge[go]]
                todo = todo[~go]
                count[todo] += self.pops[node[todo]]
                node[todo] = self.fail[node[todo]]
                todo = todo[node[todo] != self.NONE]
        todo = np.flatnonzero((node != self.NONE) & (node != self.INNER) & (sizes[order] > 0))
        while len(todo):  # the end of a word pops what is left
            count[todo] += self.pops[node[todo]]
            node[todo] = self.fail[node[todo]]
            todo = todo[(node[todo] != self.NONE) & (node[todo] != self.INNER)]
        out = np.empty(len(words), np.int64)
        out[order] = np.where(node == self.NONE, -1, count)
        return out


def with_piece_counts(docs: DataFrame, path: str, text: str = "text", into: str = "__cw_pieces") -> DataFrame:
    """Add a struct ``n_words, n_tokens, n_unknown`` for each whole text."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(PieceAutomaton(*pieces_of(path)))

    def one(texts: pa.Array) -> pa.Array:
        split = [(t or b"").split() for t in raw(texts)]
        offsets = np.cumsum([0, *map(len, split)])
        distinct, ids = factorize([w for words in split for w in words])
        size = shared.value.lengths(distinct)
        unknown = (size < 0).astype(np.int64)
        each = np.where(size < 0, 1, size)
        return build_struct(COUNTS, np.diff(offsets), segment_sum(each[ids], offsets), segment_sum(unknown[ids], offsets))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from per_slice(batches, one, COUNTS)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "n_words long, n_tokens long, n_unknown long")(F.col(text)))
