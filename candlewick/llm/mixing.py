"""Mix sources to target weights with hash-threshold histograms (operator 10, native).

Every document gets a 36-bit key from the md5 of its id, read as three levels of 12
bits.  Tokens are summed by source and first-level bucket; the running sum finds, for
each source, the bucket in which its budget ends.  Only that boundary bucket is summed
again by the next level, and so on.  The result is one key threshold a source, and the
selection is a plain filter: documents are never sorted and never move by source.

Budgets nest: a document below a smaller threshold is below every larger one, so
raising a source's weight only adds documents.

Defined results: null text has size 0; a null source is a source of its own, sorted
last; documents with the same id share a key and are taken together; a source of size
0 has target 0 and none of its documents is taken.  An empty table gives no rows.  A text of
any length is counted whole; repeated rows share a key and so a fate, as do ties; columns
that are not named are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.shared import WORD, cut

#: Weights by the source's place in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all tokens.
BUDGET = 1.5
#: A source's target is at most so many times its own size.
CEILING = 2
#: Hex digits of a level (12 bits), and levels.
DIGITS, LEVELS = 3, 3
#: Source tables of at most this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: str | Column = "text") -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def document_key(doc_id: str | Column = "doc_id") -> Column:
    """36-bit key as 9 hex digits of md5 of the id (null: empty text)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.substring(F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), 1, DIGITS * LEVELS)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING) -> DataFrame:
    """One row a source: ``source, source_size, target``.

    A source stops at ``ceiling`` times its size; the excess goes to the others by
    weight until none is above.  Sorted by ceiling over weight, the stopped sources are
    a prefix, so the level of the rest follows from running sums.  The windows hold one
    row a source, not one a document.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(place) - 1) % len(weights) + 1)
    per = per.withColumn("weight", pick).withColumn("stop", F.col("source_size") * ceiling)
    by_ratio = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(F.sum("stop").over(before), F.lit(0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level).withColumn("rank", F.row_number().over(by_ratio))
    free = F.when(F.col("stop") >= F.col("level") * F.col("weight"), F.struct("rank", "level"))
    final = F.min(free).over(everything)["level"]
    target = F.least(F.col("stop").cast("double"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def _bucket(key: Column, level: int) -> Column:
    return F.substring(key, 1, DIGITS * (level + 1))


def _small(df: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(df) if sources <= BROADCAST_SOURCES else df


def source_thresholds(sizes: DataFrame, targets: DataFrame, sources: int) -> DataFrame:
    """``source, source_size, target, whole, below``: every document is taken ``whole``
    times, and once more if its key is less than or equal to ``below``.

    ``below`` ends with the key group that brings the source nearest to its target.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = targets.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    edge = cut(rest.withColumn("reached", F.lit(0).cast("long")).withColumn("prefix", F.lit("")).withColumn("below", F.lit("")))
    for level in range(LEVELS):
        inside = edge.where("prefix is not null").select(F.col("source").alias("__cw_s"), "prefix", "need", "reached")
        here = sizes.join(_small(inside, sources), F.col("source").eqNullSafe(F.col("__cw_s")) & F.startswith(F.col("key"), F.col("prefix")))
        sums = here.groupBy("source", _bucket(F.col("key"), level).alias("bucket"), "need", "reached").agg(F.sum("size").alias("tokens"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        run = sums.withColumn("end", F.col("reached") + F.sum("tokens").over(upto)).withColumn("start", F.col("end") - F.col("tokens"))
        last = level == LEVELS - 1
        fits = F.col("end") <= F.col("need")
        if last:  # the boundary group joins when that is nearer
            fits = fits | ((F.col("start") < F.col("need")) & (F.col("end") - F.col("need") < F.col("need") - F.col("start")))
        step = run.groupBy("source").agg(
            F.max(F.when(fits, F.col("bucket"))).alias("full"),
            F.max(F.when(fits, F.col("end"))).alias("full_end"),
            F.min(F.when(~fits, F.col("bucket"))).alias("open"),
        ).withColumnRenamed("source", "__cw_s")
        joined = edge.join(step, F.col("source").eqNullSafe(F.col("__cw_s")), "left")
        edge = cut(
            joined.select(
                "source", "source_size", "target", "whole", "need",
                F.coalesce("full_end", "reached").alias("reached"),
                F.col("open").alias("prefix"),
                # a full bucket takes every key that starts with it
                F.coalesce(F.rpad("full", DIGITS * LEVELS, "f"), F.col("below")).alias("below"),
            )
        )
    return edge.select("source", "source_size", "target", "whole", "below")


def _sizes(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(text).alias("size"),
        document_key(doc_id).alias("key"),
    )


def _with_limits(rows: DataFrame, sizes: DataFrame, source: Column, key: Column, weights, budget, ceiling) -> DataFrame:
    """Join ``rows`` to the thresholds of their source and add ``__cw_n``, the copies taken."""
    targets = cut(source_targets(sizes, weights, budget, ceiling))
    sources = targets.count()
    limits = source_thresholds(sizes, targets, sources)
    limits = _small(limits.select(*[F.col(c).alias(f"__cw_{c}") for c in limits.columns]), sources)
    once = (key <= F.col("__cw_below")).cast("long")
    copies = F.when(F.col("__cw_source_size") == 0, F.lit(0)).otherwise(F.col("__cw_whole") + once).cast("long")
    return rows.join(limits, source.eqNullSafe(F.col("__cw_source"))).withColumn("__cw_n", copies)


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row a document: ``doc_id, source, size, key, source_size, target, copies``.

    ``copies`` runs from 0 to ``ceiling``; the mix takes ``copies * size`` words.
    """
    sizes = cut(_sizes(docs, text, doc_id, source))
    out = _with_limits(sizes, sizes, F.col("source"), F.col("key"), weights, budget, ceiling)
    return out.select("doc_id", "source", "size", "key", F.col("__cw_source_size").alias("source_size"), F.col("__cw_target").alias("target"), F.col("__cw_n").alias("copies"))


def take_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mixed documents: each row as often as it is taken, columns unchanged.

    Texts don't move: each row's key is compared with its source's threshold.
    """
    sizes = cut(_sizes(docs, text, doc_id, source))
    rows = _with_limits(docs, sizes, F.col(source).cast("string"), document_key(doc_id), weights, budget, ceiling)
    again = rows.where("__cw_n > 0").withColumn("__cw_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__cw_n"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])
