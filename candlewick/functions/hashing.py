"""Seeded, engine-portable row selection.

Defects and samples must be repeatable and distributed: a row is picked by a
hash of a stable integer key, never by a sequential random generator.  The
mix below uses only BIGINT +, * and modulo, so any SQL engine computes the
same values.  The formula is rendered as SQL text once and handed to Spark
as a single expression (building it node by node from Python would cost one
JVM round trip per node).
Intermediate values stay below 2^42, far from BIGINT overflow.  Values repeat only
after P1 * P2 (10^12) keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

P1 = 1_000_003
P2 = 999_983
RANGE = 1_000_000  # mix() is uniform-ish on [0, RANGE)


def _offset(salt: int, seed: int) -> int:
    return (salt * 104_729 + seed * 15_485_863) % P1


def _mod(a: str, m: int, dialect: str) -> str:
    # pmod keeps Spark's result non-negative for any key; the SQL twin is
    # only ever given non-negative keys
    return f"pmod({a}, {m})" if dialect == "spark" else f"(({a}) % {m})"


def mix_sql(key_sql: str, salt: int, seed: int, dialect: str = "ansi") -> str:
    """The mix as SQL text (``dialect='spark'`` uses pmod)."""
    divide = "div" if dialect == "spark" else "//"
    turn = _mod(f"({key_sql}) {divide} {P1}", P2, dialect)  # keys above P1 repeat nothing below it
    x1 = _mod(f"{_mod(key_sql, P1, dialect)} * 7919 + {turn} * 611953 + {_offset(salt, seed)}", P1, dialect)
    x2 = _mod(f"{x1} * {x1} + {turn} * {7_001 + 2 * salt} + {12_345 * salt + 1}", P2, dialect)
    return _mod(f"{x2} * 7 + {x1}", RANGE, dialect)


def picked_sql(key_sql: str, rate: float, salt: int, seed: int, dialect: str = "ansi") -> str:
    return f"({mix_sql(key_sql, salt, seed, dialect)} < {int(round(rate * RANGE))})"


def choice_sql(key_sql: str, n: int, salt: int, seed: int, dialect: str = "ansi") -> str:
    """0-based index in [0, n)."""
    return _mod(mix_sql(key_sql, salt, seed, dialect), n, dialect)


def mix(key_sql: str, salt: int, seed: int) -> Column:
    return F.expr(mix_sql(key_sql, salt, seed, "spark"))


def picked(key_sql: str, rate: float, salt: int, seed: int) -> Column:
    return F.expr(picked_sql(key_sql, rate, salt, seed, "spark"))


def choice(key_sql: str, n: int, salt: int, seed: int) -> Column:
    return F.expr(choice_sql(key_sql, n, salt, seed, "spark"))
