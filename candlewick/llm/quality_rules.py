"""Quality rules compiled into one Spark projection (operator 7, native).

``RULES`` is a table of (metric, least, most).  ``quality_verdict`` turns it into a
single boolean expression over ratios of the counts that ``quality_counts`` takes from
a whole text.  No user functions, no shuffle: every count is an expression over one row.

Defined results: a null or empty text has zero counts and fails; equal lines count from
their second appearance; texts of fewer than eight words have no window.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window in the repetition count.
WINDOW = 8
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on are as with his they at be this from or by "
    "der die das und ist nicht ein eine zu den von mit sich auf für im dem des "
    "le la les de et à un une des en que qui dans pour par sur pas plus du "
    "el los las y que en un una por con no para su al es lo como se del"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= metric <= most``; None leaves a side open."""

    metric: str
    least: float | None = None
    most: float | None = None


#: Each metric is a SQL expression over the counts.  Ratios of nothing are null, and a
#: null metric doesn't fail its rule (the word minimum already rejects such texts).
METRICS = {
    "mean_word_chars": "word_chars / nullif(n_words, 0)",
    "symbol_ratio": "n_symbols / nullif(n_words, 0)",
    "stop_ratio": "n_stop_words / nullif(n_words, 0)",
    "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
    "repeat_ratio": "n_repeat_words / nullif(n_words, 0)",
}

RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", most=0.2),
    Rule("stop_ratio", least=0.05),
    Rule("dup_line_ratio", most=0.5),
)


def _is_stop_word(word: Column) -> Column:
    return F.lower(F.rtrim(word, F.lit(",.;:!?"))).isin(*dict.fromkeys(STOP_WORDS))


def _array_words(column: str) -> Column:
    return F.expr(rf"filter(split(coalesce(`{column}`, ''), '[\\x20\\x09-\\x0D]+'), w -> w != '')")


def quality_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of a whole text as columns starting with ``__cw_``.

    Repeated windows: eight word hashes are hashed into one; only texts in which two
    windows hash alike go on to compare the windows themselves, sorted with their
    positions, so the count is exact and costs n log n in the text's words.
    """
    base = df.withColumn("__cw_words", _array_words(text)).withColumn("__cw_n", F.size("__cw_words"))
    base = base.withColumn("__cw_lines", F.expr(rf"filter(split(coalesce(`{text}`, ''), '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    parts = ", ".join(f"__cw_words[i + {k}]" for k in range(WINDOW))
    base = base.withColumn("__cw_hashes", F.expr(f"CASE WHEN __cw_n >= {WINDOW} THEN transform(sequence(0, __cw_n - {WINDOW}), i -> xxhash64({parts})) END"))
    base = base.withColumn("__cw_suspect", F.expr("size(array_distinct(__cw_hashes)) < size(__cw_hashes)"))
    # element by element: slice() would copy the whole array for each window
    window = f"concat_ws(' ', {parts})"
    base = base.withColumn("__cw_sorted", F.expr(f"CASE WHEN __cw_suspect THEN sort_array(transform(sequence(0, __cw_n - {WINDOW}), i -> struct({window} AS w, i AS p))) END"))
    base = base.withColumn(
        "__cw_twice",
        F.expr(
            "CASE WHEN __cw_suspect THEN sort_array(transform(filter(sequence(0, size(__cw_sorted) - 1), k -> "
            "coalesce(__cw_sorted[k].w = get(__cw_sorted, k - 1).w, false) OR coalesce(__cw_sorted[k].w = get(__cw_sorted, k + 1).w, false)), "
            "k -> __cw_sorted[k].p)) END"
        ),
    )
    covered = F.expr(
        f"CASE WHEN __cw_suspect THEN aggregate(__cw_twice, named_struct('n', 0L, 'last', -{WINDOW}), "
        f"(a, p) -> named_struct('n', a.n + least({WINDOW}, p - a.last), 'last', p), a -> a.n) ELSE 0L END"
    )
    symbols = F.length(F.coalesce(F.col(text), F.lit(""))) - F.length(F.translate(F.coalesce(F.col(text), F.lit("")), SYMBOLS, ""))
    counts = F.struct(
        F.col("__cw_n").cast("long").alias("__cw_n_words"),
        F.length(F.array_join("__cw_words", "")).cast("long").alias("__cw_word_chars"),
        symbols.cast("long").alias("__cw_n_symbols"),
        F.size("__cw_lines").cast("long").alias("__cw_n_lines"),
        (F.size("__cw_lines") - F.size(F.array_distinct("__cw_lines"))).cast("long").alias("__cw_n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("__cw_n_repeat_words"),
        F.size(F.filter("__cw_words", _is_stop_word)).cast("long").alias("__cw_n_stop_words"),
    )
    # a generator, so that a later filter on a count is not pushed below it, where the
    # optimizer would write the whole chain of arrays into each of its lambdas
    return base.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array(counts)))


def quality_verdict(rules: Sequence[Rule] = RULES, prefix: str = "") -> Column:
    """The rule table as one expression over the counts."""
    verdict = F.lit(True)
    for rule in rules:
        metric = F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"{prefix}\1", METRICS[rule.metric]))
        if rule.least is not None:
            verdict = verdict & F.coalesce(metric >= rule.least, F.lit(True))
        if rule.most is not None:
            verdict = verdict & F.coalesce(metric <= rule.most, F.lit(True))
    return verdict


def judge_quality(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Add the counts, ``base_failed`` and ``kept``; same-named columns are replaced."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words"]
    kept = [c for c in df.columns if c.lower() not in {*names, "base_failed", "kept"} or c == text]
    counted = quality_counts(df.select(*[F.col(f"`{c}`") for c in kept]), text)
    failed = (F.col("__cw_n_words") < 20) | (100 * F.col("__cw_n_repeat_words") > 30 * F.col("__cw_n_words"))
    return counted.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.col(f"__cw_{n}").alias(n) for n in names],
        failed.alias("base_failed"),
        (~failed & quality_verdict(rules, "__cw_")).alias("kept"),
    )
