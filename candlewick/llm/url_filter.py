"""URL filters: glob rules run as one bit-parallel wildcard automaton (operator 8).

Rules are globs over a canonical URL, ``host + path + query``: scheme and fragment
dropped, the host's A-Z lower-cased.  Host rules see ``host + path`` only, so a host in
the query fits none.  In a glob ``*`` is any run of bytes other than
``/``, ``**`` is any run of bytes, and every other byte stands for itself.  All globs
are packed one after another into the bits of several 64-bit words (Shift-And with a
carry between words).  A wildcard takes no bit of its own: it is a self-loop on the
bit before it.  One pass over the bytes of a URL moves all globs together, and numpy
moves all URLs of a batch together.

Defined results: a null URL, or one without ``://``, has an empty host and path and
matches no rule.  A URL's verdict does not depend on other rows, so repeated rows get equal
ones.  Of two host rules that fit, the longer wins, of equal ones the first.  A URL of any
length is read whole.  An empty table gives an empty result; other columns are kept, but for
those named like a result (``host, path, rule, verdict, glob``), which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.shared import pack, raw, ship_code

SLASH = ord("/")


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for URLs that fit ``host`` or its subdomains and start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"]


#: The host and path rules of the registered query.
HOST_RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)

#: Globs that block a URL when no host rule decides: spam hosts and download paths.
SPAM_GLOBS = (
    "*casino*/**",
    "*free-bets*/**",
    "*cheap-pills*/**",
    "*spam-farm*/**",
    "*/**.exe",
    "*/**/wp-login.php**",
)


class GlobAutomaton:
    """Multiword Shift-And automaton of many globs."""

    def __init__(self, globs: Sequence[str]):
        literals, loops_any, loops_seg, starts, finals = [], [], [], [], []
        for glob in globs:
            starts.append(len(literals))
            literals.append(None)  # the state before the first byte
            body, i = glob.encode(), 0
            while i < len(body):
                if body[i] == ord("*"):
                    wide = body[i : i + 2] == b"**"
                    (loops_any if wide else loops_seg).append(len(literals) - 1)
                    i += 2 if wide else 1
                else:
                    literals.append(body[i])
                    i += 1
            finals.append(len(literals) - 1)
        self.words = (len(literals) + 63) // 64
        self.finals = np.array(finals, np.int64)
        self.start = self._mask(starts)
        # step[c]: bits that byte c may enter; stay[c]: bits that byte c may keep
        self.step = np.zeros((256, self.words), np.uint64)
        for bit, byte in enumerate(literals):
            if byte is not None:
                self.step[byte, bit >> 6] |= np.uint64(1 << (bit & 63))
        self.stay = np.repeat(self._mask(loops_any + loops_seg)[None], 256, axis=0)
        self.stay[SLASH] = self._mask(loops_any)

    def _mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for bit in bits:
            out[bit >> 6] |= np.uint64(1 << (bit & 63))
        return out

    def match(self, subjects: list[bytes]) -> np.ndarray:
        """Boolean matrix: subject i matches glob j as a whole."""
        data, offsets = pack(subjects)
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        state = np.repeat(self.start[None], len(subjects), axis=0)
        live = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        for at, n in enumerate(live.tolist()):  # the n longest subjects have a byte here
            byte = data[offsets[order[:n]] + at]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.empty((len(subjects), len(self.finals)), bool)
        hit = state[:, self.finals >> 6] >> (self.finals & 63).astype(np.uint64)
        out[order] = (hit & np.uint64(1)).astype(bool)
        return out


def with_url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and the canonical ``__cw_subject`` as plain expressions."""
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    found = df.withColumn("__cw_rest", rest)
    host = F.translate(F.regexp_extract("__cw_rest", r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract("__cw_rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract("__cw_rest", r"(?s)^[^?#]*(\?[^#]*)?", 1)
    return (
        found.withColumn("host", host)
        .withColumn("path", path)
        .withColumn("__cw_subject", F.concat("host", "path", query))
        .drop("__cw_rest")
    )


def judge_urls(
    df: DataFrame,
    host_rules: Sequence[UrlRule] = HOST_RULES,
    block_globs: Sequence[str] = SPAM_GLOBS,
    url: str = "url",
) -> DataFrame:
    """Add ``host, path, rule, verdict, glob`` to ``df``.

    ``rule`` is the longest fitting host rule, which decides.  Without one, the first
    matching glob of ``block_globs`` (column ``glob``) blocks; otherwise the URL is
    allowed.  Columns of these names in ``df`` are replaced.
    """
    ship_code(df.sparkSession)
    by_host = GlobAutomaton([g for r in host_rules for g in r.globs()]) if host_rules else None
    by_glob = GlobAutomaton(block_globs) if block_globs else None
    by_length = sorted(range(len(host_rules)), key=lambda k: (-len(host_rules[k].name), k))
    names = [r.name for r in host_rules]
    verdicts = [r.verdict for r in host_rules]
    first_glob = 2 * len(host_rules)
    kind = pa.struct([("rule", pa.string()), ("verdict", pa.string()), ("glob", pa.string())])

    def judge(hit: np.ndarray) -> dict:
        for k in by_length:
            if hit[2 * k] or hit[2 * k + 1]:
                return {"rule": names[k], "verdict": verdicts[k], "glob": None}
        spam = np.flatnonzero(hit[first_glob:])
        if len(spam):
            return {"rule": None, "verdict": "block", "glob": block_globs[int(spam[0])]}
        return {"rule": None, "verdict": "allow", "glob": None}

    def match(automaton: GlobAutomaton | None, subjects: pa.Array) -> np.ndarray:
        return automaton.match(raw(subjects)) if automaton else np.zeros((len(subjects), 0), bool)

    def decide(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for places, subjects in batches:
            rows = []
            for at in range(0, len(subjects), 4096):
                hits = np.hstack([match(by_host, places.slice(at, 4096)), match(by_glob, subjects.slice(at, 4096))])
                shapes, which = np.unique(hits, axis=0, return_inverse=True)
                found = [judge(x) for x in shapes]
                rows += [found[k] for k in which.ravel().tolist()]
            yield pa.array(rows, kind)

    decide.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    judge_udf = F.arrow_udf(decide, T.StructType.fromDDL("rule string, verdict string, glob string"))
    kept = [c for c in df.columns if c.lower() not in {"host", "path", "rule", "verdict", "glob"}]
    parts = with_url_parts(df.select(*[F.col(f"`{c}`") for c in kept]), url)
    judged = parts.withColumn("__cw_j", judge_udf(F.concat("host", "path"), "__cw_subject"))
    return judged.select(*[F.col(f"`{c}`") for c in kept], "host", "path", "__cw_j.rule", "__cw_j.verdict", "__cw_j.glob")
