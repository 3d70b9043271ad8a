"""Fill-in-the-middle rewriting by one counted-quantifier match (operator 12).

A text is cut into units (a word with the white space before it, or trailing white
space).  ``regexp_count`` gives their number n; two seeded hashes of the key give the
ends a <= b of prefix and middle in units.  A pattern made for each row,
``^((?:unit){a}+)((?:unit){b-a}+)(.*+)$``, captures prefix, middle and suffix in one match.
All quantifiers are possessive: a match never goes back, and takes time linear in the text.

Every step is an expression over one row, in the JVM: no shuffle, no Python worker.

Defined results: a null text counts as empty; empty texts and those that already hold a
sentinel stay plain, with null ``prefix_chars`` and ``middle_chars``; a null key hashes as
an empty one; equal rows (key and text) give equal results; texts of any length are cut
whole; empty tables give empty results; columns of the table that are not named here are
kept as they are (working names start with ``__cw_``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"\x20\x09-\x0D"
#: One unit: white space and the word after it, or white space that ends the text.
UNIT = rf"(?:[{_SPACE}]*+[^{_SPACE}]++|[{_SPACE}]++)"
#: Sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts rewritten, and of those the percent in suffix-first order.
RATE, SUFFIX_FIRST = 50, 80


def key_hashes(key: str, seed: int) -> list[Column]:
    """Four integers of 32 bits from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", into: str = "__cw_fim", seed: int = 42, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """Add a struct ``n, form, prefix_chars, middle_chars, output`` for each text.

    ``form`` is ``plain`` (output is the text), ``psm`` (prefix, suffix, middle) or ``spm``
    (suffix, prefix, middle).
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    body = F.coalesce(F.col(text), F.lit(""))
    marks = "|".join(re.escape(m) for m in (PREFIX, SUFFIX, MIDDLE))
    h1, h2, h3, h4 = key_hashes(key, seed)
    counted = docs.select(*kept, F.struct(body.alias("text"), F.regexp_count(body, F.lit(UNIT)).cast("bigint").alias("n"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4")).alias("__cw_row"))
    c = {x: F.col(f"__cw_row.{x}") for x in ("text", "n", "h1", "h2", "h3", "h4")}
    cuts = [c["h1"] % (c["n"] + 1), c["h2"] % (c["n"] + 1)]
    first, second = F.least(*cuts), F.greatest(*cuts)
    plain = (c["text"] == "") | (c["h3"] % 100 >= rate) | c["text"].rlike(marks)
    pattern = F.concat(
        F.lit(f"^({UNIT}{{"), first.cast("string"), F.lit(f"}}+)({UNIT}{{"), (second - first).cast("string"), F.lit(r"}+)((?s:.*+))\z")
    )
    # no text that gets here holds a sentinel, so one can part the three captures
    captures = F.split(F.regexp_replace(c["text"], pattern, F.lit(f"$1{SUFFIX}$2{SUFFIX}$3")), re.escape(SUFFIX), -1)
    cut = counted.select(*kept, "__cw_row", F.when(~plain, captures).alias("__cw_cut"))
    prefix, middle, suffix = (F.get("__cw_cut", F.lit(i)) for i in range(3))
    form = F.when(F.col("__cw_cut").isNull(), "plain").when(c["h4"] % 100 < suffix_first, "spm").otherwise("psm")
    output = (
        F.when(form == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(c["text"])
    )
    chars = [F.length(x).cast("bigint") for x in (prefix, middle)]
    return cut.select(*kept, F.struct(c["n"].alias("n"), form.alias("form"), chars[0].alias("prefix_chars"), chars[1].alias("middle_chars"), output.alias("output")).alias(into))


def restore_text(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone."""
    parts = F.split(output, "|".join(re.escape(m) for m in (PREFIX, SUFFIX, MIDDLE)), -1)

    def at(*order: int) -> Column:
        return F.concat(*[F.get(parts, F.lit(i)) for i in order])

    # parts[0] is what stands before the first sentinel: nothing
    return F.when(form == "psm", at(1, 3, 2)).when(form == "spm", at(2, 3, 1)).otherwise(output)
