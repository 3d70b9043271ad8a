"""Exactly k rows by seeded hash, without sorting rows or listing ids.

Rows are ordered by (hash, key).  A histogram over hash buckets tells in which bucket the
k-th row lies; only that bucket is refined, by single hashes and then, where one hash value
is shared by many rows, by ranges of the key.  What comes back is a threshold, so the rows
are picked by a filter.  Each step is one aggregation whose result is bounded by its number
of buckets, whatever the size of the table, and all picks over the same rows share it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.hashing import RANGE, mix_sql

#: Hash values of one bucket in the first histogram (RANGE / WIDTH = 62,500 buckets).
WIDTH = 16
#: Key ranges of one refinement step.
KEY_BUCKETS = 4096


@dataclass(frozen=True)
class Cutoff:
    """Rows up to (``hash``, ``key``) are picked; ``key`` None takes all of that hash."""

    hash: int = -1
    key: int | None = None

    def sql(self, hash_sql: str, key_sql: str) -> str:
        if self.hash < 0:
            return "false"
        if self.key is None:
            return f"({hash_sql} <= {self.hash})"
        return f"({hash_sql} < {self.hash} OR ({hash_sql} = {self.hash} AND {key_sql} <= {self.key}))"


NOTHING = Cutoff()


@dataclass
class _Search:
    """What is known of one pick: the bucket its k-th row is in, and the rows still to take."""

    index: int
    left: int = 0
    hash_from: int = 0
    hash_to: int = RANGE - 1
    key_from: int | None = None
    key_to: int | None = None
    found: Cutoff | None = None

    def narrow(self, buckets: list) -> None:
        """``buckets``: (first hash, last hash, first key, last key, rows), in order; the keys
        are None while a bucket holds several hashes."""
        for hash_from, hash_to, key_from, key_to, n in buckets:
            if n < self.left:
                self.left -= n
                continue
            whole_hash = self.key_from is None
            if n == self.left:  # the bucket's end is the cutoff
                self.found = Cutoff(hash_to, None if whole_hash else key_to)
            elif key_from is not None and key_from == key_to:  # equal keys stay together
                self.found = Cutoff(hash_to, key_to)
            self.hash_from, self.hash_to, self.key_from, self.key_to = hash_from, hash_to, key_from, key_to
            return


def exact_cutoffs(rows: DataFrame, key: str, salts: dict[str, int], seed: int, wanted: Callable[[str, int], int]) -> tuple[dict[str, Cutoff], int]:
    """Cutoff of each named pick over ``rows``, and the number of rows.

    ``salts`` names the picks and their hash salts; ``wanted(name, rows)`` says how many
    rows each one takes.  ``key`` is a BIGINT column that tells rows apart; rows with equal
    keys are picked or left together, rows without one are neither counted nor picked.
    """
    names = list(salts)
    if not names:
        return {}, 0
    rows = rows.where(F.col(key).isNotNull())
    searches = {name: _Search(i) for i, name in enumerate(names)}
    hashes = {name: mix_sql(f"`{key}`", salts[name], seed, "spark") for name in names}

    def marked(todo: list[str]) -> DataFrame:
        """(p, h, k): each row once for each pick, with its hash for that pick."""
        one = [f"named_struct('p', {searches[x].index}, 'h', {hashes[x]})" for x in todo]
        return rows.selectExpr(f"`{key}` AS k", f"inline(array({', '.join(one)}))")

    def per_pick(table) -> dict[str, list]:
        found: dict[str, list] = {}
        for p, *bucket in sorted(zip(*table.to_pydict().values()), key=lambda r: r[:2]):
            found.setdefault(names[p], []).append(bucket)
        return found

    first = per_pick(marked(names).groupBy("p", F.expr(f"h div {WIDTH}").alias("b")).agg(F.count(F.lit(1)).alias("n")).toArrow())
    total = sum(n for _, n in first.get(names[0], []))
    for x in names:
        searches[x].left = max(0, min(total, wanted(x, total)))
        if searches[x].left == 0:
            searches[x].found = NOTHING
        else:
            searches[x].narrow([(b * WIDTH, (b + 1) * WIDTH - 1, None, None, n) for b, n in first[x]])
    while todo := [x for x in names if searches[x].found is None]:
        cases, inside = [], []
        for x in todo:
            s = searches[x]
            if s.hash_from < s.hash_to:
                bucket, where = "h", f"h BETWEEN {s.hash_from} AND {s.hash_to}"
            else:
                width = -(-(s.key_to - s.key_from + 1) // KEY_BUCKETS)
                bucket, where = f"(k - {s.key_from}) div {width}", f"h = {s.hash_from} AND k BETWEEN {s.key_from} AND {s.key_to}"
            cases.append(f"WHEN p = {s.index} THEN {bucket}")
            inside.append(f"(p = {s.index} AND {where})")
        narrowed = marked(todo).where(" OR ".join(inside)).groupBy("p", F.expr(f"CASE {' '.join(cases)} END").alias("b"))
        found = per_pick(narrowed.agg(F.min("h").alias("h"), F.min("k").alias("k0"), F.max("k").alias("k1"), F.count(F.lit(1)).alias("n")).toArrow())
        for x in todo:
            searches[x].narrow([(h, h, k0, k1, n) for _, h, k0, k1, n in found[x]])
    return {x: searches[x].found for x in names}, total
