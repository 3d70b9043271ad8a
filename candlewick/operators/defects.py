"""Repeatable defect injection (table -> table), for testing the cleaner.

Defects follow the reference order: drop rows, duplicate rows, blank cells,
text in numeric cells, invalid times, symbol variants, negative volumes.
Each defect takes exactly ``min(rows, max(minimum, int(rows * fraction)))`` rows of
the table as it is at that step (a drop leaves at least one row).  Which ones is told by
a seeded hash of a stable row id (``row_id``), ties by the id; a duplicated row's copy
gets its own defect key, so the two copies can be corrupted differently (exactly like
corrupting after appending copies).

The counts need to be known first: ``plan_defects`` runs a few small aggregations over
the ids (hash histograms, see ``exact_pick``) and returns thresholds.  With these the
injection itself is one narrow map stage: no shuffle, no sort, no list of ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.hashing import choice_sql, mix_sql
from candlewick.functions.scalar import to_iso_text
from candlewick.operators.exact_pick import NOTHING, Cutoff, exact_cutoffs
from candlewick.schema import (
    FIELDNAMES,
    INVALID_TIME_TOKENS,
    NUMERIC_COLS,
    NUMERIC_TEXT_TOKENS,
    TIME_COLS,
    VOLUME_COLS,
)


@dataclass(frozen=True)
class Share:
    """At least ``minimum`` rows, or ``fraction`` of them, as far as there are rows."""

    fraction: float
    minimum: int = 0

    def rows(self, n: int) -> int:
        return min(n, max(self.minimum, int(n * self.fraction)))


# Fraction and least number of rows of each defect.
@dataclass(frozen=True)
class DefectRates:
    drop: Share = Share(0.03, 5)
    duplicate: Share = Share(0.03, 5)
    missing: Share = Share(0.05, 10)
    numeric_text: Share = Share(0.04, 8)
    invalid_time: Share = Share(0.03, 6)
    symbol: Share = Share(0.04, 8)
    negative_volume: Share = Share(0.03, 6)


# hash salts, one per decision
SALT = {
    "drop": 61,
    "missing": 11, "missing_col": 12,
    "text": 21, "text_col": 22, "text_token": 23,
    "time": 31, "time_col": 32, "time_token": 33,
    "symbol": 41, "symbol_variant": 42,
    "negative": 51, "negative_col": 52,
}

# numbers are written with 8 decimals (exchange precision), as plain text
NUMBER_TEXT_TYPE = "decimal(38,8)"
# sign + 30 integer digits + 8 decimals: every DECIMAL(38,8) fits
_PLAIN_FORMAT = "S" + "9" * 29 + "0.00000000"


def plain_decimal_cast(spark) -> bool:
    """Spark prints decimals plainly in a CAST only under ANSI mode."""
    return str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() == "true"


def decimal_text_sql(expr: str, plain_cast: bool = False) -> str:
    """DECIMAL(38,8) -> plain text such as '-12.31000000' or '0.00000000'.

    Under ANSI mode (and in other engines) a CAST prints plainly.  With ANSI
    off Spark's CAST prints '0E-8' for zero, so the text is built with
    to_char instead (a little more work per cell).
    """
    if plain_cast:
        return f"CAST({expr} AS STRING)"
    padded = f"trim(to_char({expr}, '{_PLAIN_FORMAT}'))"
    return f"regexp_replace(regexp_replace({padded}, '^([+-]?)[.]', '$10.'), '^[+]', '')"


def number_text(name: str, plain_cast: bool = False) -> Column:
    return F.expr(decimal_text_sql(f"TRY_CAST(`{name}` AS {NUMBER_TEXT_TYPE.upper()})", plain_cast=plain_cast))


def candles_as_text(candles: DataFrame) -> DataFrame:
    """Typed candles -> the 13 text columns of a landed CSV (+ ``row_id``)."""
    plain = plain_decimal_cast(candles.sparkSession)
    exprs = []
    for name in FIELDNAMES:
        c = F.col(name)
        if name in TIME_COLS:
            exprs.append(to_iso_text(c).alias(name))
        elif name == "trade_count":
            exprs.append(c.cast("bigint").cast("string").alias(name))
        elif name in NUMERIC_COLS:
            exprs.append(number_text(name, plain).alias(name))
        else:
            exprs.append(c.cast("string").alias(name))
    return candles.select(F.col("row_id").cast("bigint").alias("row_id"), *exprs)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _token_sql(tokens: list[str], idx_sql: str) -> str:
    return f"element_at(array({', '.join(_q(t) for t in tokens)}), CAST({idx_sql} + 1 AS INT))"


def _present(cols: set[str]) -> dict[str, list[str]]:
    return {
        "blank": [c for c in NUMERIC_COLS + TIME_COLS if c in cols],
        "num": [c for c in NUMERIC_COLS if c in cols],
        "time": [c for c in TIME_COLS if c in cols],
        "vol": [c for c in VOLUME_COLS if c in cols],
        "symbol": ["symbol"] if "symbol" in cols else [],
    }


def plan_defects(text: DataFrame, seed: int = 42, rates: DefectRates = DefectRates()) -> dict[str, Cutoff]:
    """Which rows each defect takes, as thresholds.

    Dropped rows are the first in order of one hash, duplicated ones the last of the same
    order; the cell defects are chosen among the rows that are then there.  Reads the ids of
    ``text`` twice, more often where a histogram bucket has to be refined; at most some
    thousand counts come to the driver each time."""
    present = _present(set(text.columns))
    ids = text.select("row_id").persist()
    try:
        def rows(name: str, n: int) -> int:
            dropped = max(0, min(rates.drop.rows(n), n - 1))
            return dropped if name == "drop" else n - rates.duplicate.rows(n - dropped)

        plan, _ = exact_cutoffs(ids, "row_id", {"drop": SALT["drop"], "once": SALT["drop"]}, seed, rows)
        kept = ids.where(f"NOT {_chosen('row_id', 'drop', plan, seed)}")
        keys = kept.selectExpr(f"explode(CASE WHEN {_doubled(plan, seed)} THEN array(row_id * 2, row_id * 2 + 1) ELSE array(row_id * 2) END) AS _key")
        shares = {"missing": ("blank", rates.missing), "text": ("num", rates.numeric_text), "time": ("time", rates.invalid_time), "symbol": ("symbol", rates.symbol), "negative": ("vol", rates.negative_volume)}
        shares = {name: share for name, (group, share) in shares.items() if present[group]}
        cells, _ = exact_cutoffs(keys, "_key", {name: SALT[name] for name in shares}, seed, lambda name, n: shares[name].rows(n))
    finally:
        ids.unpersist()
    return {**plan, **cells}


def _chosen(key_sql: str, name: str, plan: dict[str, Cutoff], seed: int) -> str:
    return plan.get(name, NOTHING).sql(mix_sql(key_sql, SALT[name], seed, "spark"), key_sql)


def _doubled(plan: dict[str, Cutoff], seed: int) -> str:
    """Rows behind the last one that comes only once."""
    return f"NOT {plan['once'].sql(mix_sql('row_id', SALT['drop'], seed, 'spark'), 'row_id')}"


def decision_sql(copy: int, seed: int, plan: dict[str, Cutoff], present: dict[str, list[str]]) -> dict[str, str]:
    """Every decision for one copy of a row (defect key = row_id * 2 + copy), as SQL text."""
    k = f"(row_id * 2 + {copy})"

    def n(group: str) -> int:
        return max(len(present[group]), 1)

    def pick_idx(count: int, salt: str) -> str:
        return choice_sql(k, count, SALT[salt], seed, "spark")

    return {
        # M1 blank one numeric or time cell
        f"_m_missing_{copy}": _chosen(k, "missing", plan, seed),
        f"_w_missing_{copy}": pick_idx(n("blank"), "missing_col"),
        # M2 text token in one numeric cell
        f"_m_text_{copy}": _chosen(k, "text", plan, seed),
        f"_w_text_{copy}": pick_idx(n("num"), "text_col"),
        f"_t_text_{copy}": _token_sql(NUMERIC_TEXT_TOKENS, pick_idx(len(NUMERIC_TEXT_TOKENS), "text_token")),
        # M3 invalid token in one time cell
        f"_m_time_{copy}": _chosen(k, "time", plan, seed),
        f"_w_time_{copy}": pick_idx(n("time"), "time_col"),
        f"_t_time_{copy}": _token_sql(INVALID_TIME_TOKENS, pick_idx(len(INVALID_TIME_TOKENS), "time_token")),
        # M4 symbol variant: lower case, blank padded, or BASE/USDT
        f"_m_symbol_{copy}": f"({_chosen(k, 'symbol', plan, seed)} AND symbol IS NOT NULL)" if present["symbol"] else "false",
        f"_w_symbol_{copy}": pick_idx(3, "symbol_variant"),
        # M5 negate one volume cell; text that is not a number becomes -999
        f"_m_negative_{copy}": _chosen(k, "negative", plan, seed),
        f"_w_negative_{copy}": pick_idx(n("vol"), "negative_col"),
    }


def cell_sql(copy: int, c: str, present: dict[str, list[str]], plain_cast: bool = False) -> str:
    """The messy text of column ``c`` for one copy, defects applied in reference order."""

    def d(name: str) -> str:
        return f"{name}_{copy}"

    def hit(group: str, kind: str) -> str:
        return f"({d('_m_' + kind)} AND {d('_w_' + kind)} = {present[group].index(c)})"

    v = f"`{c}`"
    if c in present["blank"]:
        v = f"CASE WHEN {hit('blank', 'missing')} THEN CAST(NULL AS STRING) ELSE {v} END"
    if c in present["num"]:
        v = f"CASE WHEN {hit('num', 'text')} THEN {d('_t_text')} ELSE {v} END"
    if c in present["time"]:
        v = f"CASE WHEN {hit('time', 'time')} THEN {d('_t_time')} ELSE {v} END"
    if c == "symbol":
        w = d("_w_symbol")
        corrupted = f"CASE WHEN {w} = 0 THEN lower({v}) WHEN {w} = 1 THEN concat(' ', {v}, ' ') ELSE replace({v}, 'USDT', '/USDT') END"
        v = f"CASE WHEN {d('_m_symbol')} THEN {corrupted} ELSE {v} END"
    if c in present["vol"]:
        negated = f"coalesce({decimal_text_sql(f'-abs(TRY_CAST({v} AS {NUMBER_TEXT_TYPE.upper()}))', plain_cast)}, '-999')"
        v = f"CASE WHEN {hit('vol', 'negative')} THEN {negated} ELSE {v} END"
    return v


def defect_flags(text: DataFrame, seed: int = 42, rates: DefectRates = DefectRates(), plan: dict[str, Cutoff] | None = None) -> DataFrame:
    """Text candles (+ row_id) -> every output row with its defect flags.

    ``plan`` comes from ``plan_defects``, which is run here without it.

    Adds ``_dropped``, ``_copy`` (0 original, 1 appended duplicate) and one
    boolean per cell defect.  Dropped rows are kept (flagged) so counters can
    be taken in the same pass; ``inject_defects`` filters them.

    All hash decisions for both copies are computed in one projection, and
    the messy cells are built inside the ``explode``: its output columns are
    plain attributes, so filters pushed down from the cleaning steps stop
    there instead of copying the whole defect logic into their predicates.
    """
    cols = set(text.columns)
    fields = [c for c in FIELDNAMES if c in cols]
    present = _present(cols)
    plan = plan_defects(text, seed, rates) if plan is None else plan
    decisions = {
        "_dropped": _chosen("row_id", "drop", plan, seed),
        "_dup": _doubled(plan, seed),
        **decision_sql(0, seed, plan, present),
        **decision_sql(1, seed, plan, present),
    }
    df = text.selectExpr("*", *[f"{sql} AS {name}" for name, sql in decisions.items()])

    plain = plain_decimal_cast(text.sparkSession)

    def row(copy: int) -> str:
        cells = [f"{cell_sql(copy, c, present, plain_cast=plain)} AS `{c}`" for c in fields]
        flags = [f"_m_{kind}_{copy} AS _m_{kind}" for kind in ("missing", "text", "time", "symbol", "negative")]
        return f"named_struct({', '.join(_pairs(cells + [f'{copy} AS _copy'] + flags))})"

    rows = f"CASE WHEN _dup AND NOT _dropped THEN array({row(0)}, {row(1)}) ELSE array({row(0)}) END"
    return df.selectExpr("row_id", "_dropped", f"explode({rows}) AS _r").select("row_id", "_dropped", "_r.*")


def _pairs(aliased: list[str]) -> list[str]:
    """['expr AS `name`', ...] -> ["'name', expr", ...] for named_struct."""
    out = []
    for item in aliased:
        expr, name = item.rsplit(" AS ", 1)
        out.append(f"{_q(name.strip('`'))}, {expr}")
    return out


def inject_into_text(text: DataFrame, seed: int = 42, rates: DefectRates = DefectRates(), plan: dict[str, Cutoff] | None = None) -> DataFrame:
    """Text candles (with ``row_id``) -> messy copy; a cell without a defect keeps its text as it is."""
    fields = [c for c in FIELDNAMES if c in text.columns]
    return defect_flags(text, seed, rates, plan).filter(~F.col("_dropped")).select(*fields)


def inject_defects(candles: DataFrame, seed: int = 42, rates: DefectRates = DefectRates()) -> DataFrame:
    """Typed candles (with ``row_id``) -> messy all-text candle table (13 columns)."""
    return inject_into_text(candles_as_text(candles), seed, rates)


def defect_summary(candles: DataFrame, seed: int = 42, rates: DefectRates = DefectRates()) -> DataFrame:
    """The injector's counters as (metric, value) rows, from one aggregation."""
    return text_defect_summary(candles_as_text(candles), seed, rates)


def text_defect_summary(text: DataFrame, seed: int = 42, rates: DefectRates = DefectRates(), plan: dict[str, Cutoff] | None = None) -> DataFrame:
    f = defect_flags(text, seed, rates, plan)
    kept = ~F.col("_dropped")
    one = f.agg(
        F.count_if(F.col("_copy") == 0).alias("original_rows"),
        F.count_if((F.col("_copy") == 0) & F.col("_dropped")).alias("dropped_rows"),
        F.count_if(F.col("_copy") == 1).alias("duplicated_rows"),
        F.count_if(kept & F.col("_m_missing")).alias("missing_values"),
        F.count_if(kept & F.col("_m_text")).alias("text_in_numeric_columns"),
        F.count_if(kept & F.col("_m_time")).alias("invalid_times"),
        F.count_if(kept & F.col("_m_symbol")).alias("inconsistent_symbols"),
        F.count_if(kept & F.col("_m_negative")).alias("negative_volumes"),
        F.count_if(kept).alias("final_rows"),
    )
    names = one.columns
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("metric"), F.col(n).alias("value")) for i, n in enumerate(names)]))
    )
