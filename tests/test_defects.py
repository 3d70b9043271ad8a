"""Individual defect rules of the injector."""

import pytest
from pyspark.sql import functions as F

from candlewick.operators import defects
from candlewick.schema import FIELDNAMES, INVALID_TIME_TOKENS, NUMERIC_TEXT_TOKENS

N = 3000


@pytest.fixture(scope="module")
def text(spark):
    rows = [
        (i, "BTCUSDT", "1h", "2026-06-01T00:00:00+00:00", "100.00000000", "110.00000000", "90.00000000", "105.00000000",
         "5000.00000000", "2026-06-01T00:59:59.999000+00:00", "500000.00000000", "1000", "2500.00000000", "250000.00000000")
        for i in range(N)
    ]
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"`{c}` string" for c in FIELDNAMES)).cache()


@pytest.fixture(scope="module")
def flagged(text):
    return defects.defect_flags(text, seed=42).cache()


def counters(text, **kw):
    return {r["metric"]: r["value"] for r in defects.text_defect_summary(text, **kw).collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 5, 10, 200, N])
def test_each_defect_takes_its_exact_number_of_rows(text, n):
    got = counters(text.filter(F.col("row_id") < n))
    dropped = max(0, min(max(5, int(n * 0.03)), n - 1))
    kept = n - dropped
    final = kept + min(kept, max(5, int(kept * 0.03)))

    def rows(least, fraction):
        return min(final, max(least, int(final * fraction)))

    assert got == {
        "original_rows": n, "dropped_rows": dropped, "duplicated_rows": final - kept, "missing_values": rows(10, 0.05), "text_in_numeric_columns": rows(8, 0.04),
        "invalid_times": rows(6, 0.03), "inconsistent_symbols": rows(8, 0.04), "negative_volumes": rows(6, 0.03), "final_rows": final,
    }


def test_counts_do_not_depend_on_partitions(text):
    plans = [defects.plan_defects(text.repartition(k), seed=7) for k in (1, 13)]
    assert plans[0] == plans[1]


def test_cutoffs_equal_a_sort_by_hash_and_key(spark, monkeypatch):
    from candlewick.functions.hashing import mix_sql
    from candlewick.operators import exact_pick

    monkeypatch.setattr(exact_pick, "KEY_BUCKETS", 3)
    # many keys share a hash: keys that differ by the period of the mix
    df = spark.range(40).selectExpr("explode(transform(sequence(0, 24), i -> id + i * 1000003L * 999983L)) AS id").unionByName(spark.range(100, 900).toDF("id"))
    salts = {"a": 11, "b": 21}
    keyed = {x: sorted((r[0], r[1]) for r in df.selectExpr(mix_sql("id", s, 42, "spark"), "id").collect()) for x, s in salts.items()}
    assert len({h for h, _ in keyed["a"]}) < 900
    for k in (1, 3, 30, 777, 1799, 1800):
        cutoffs, n = exact_pick.exact_cutoffs(df, "id", salts, 42, lambda _, n: k)
        assert n == 1800
        for x, salt in salts.items():
            picked = df.where(cutoffs[x].sql(mix_sql("id", salt, 42, "spark"), "id"))
            assert sorted(r[0] for r in picked.collect()) == sorted(key for _, key in keyed[x][:k])


def test_tokens_and_variants(flagged):
    kept = flagged.filter(~F.col("_dropped"))
    num_values = {r[0] for c in ("open", "high", "low", "close", "volume", "trade_count") for r in kept.select(c).distinct().collect()}
    assert set(NUMERIC_TEXT_TOKENS) <= num_values
    times = {r[0] for c in ("open_time", "close_time") for r in kept.select(c).distinct().collect()}
    assert set(INVALID_TIME_TOKENS) <= times
    symbols = {r[0] for r in kept.select("symbol").distinct().collect()}
    assert symbols == {"BTCUSDT", "btcusdt", " BTCUSDT ", "BTC/USDT"}


def test_negative_volume_rule(flagged):
    vols = [r[0] for r in flagged.select(F.explode(F.array("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"))).collect()]
    negatives = {v for v in vols if v is not None and v.startswith("-")}
    assert negatives <= {"-5000.00000000", "-500000.00000000", "-2500.00000000", "-250000.00000000", "-999"}
    assert "-5000.00000000" in negatives


def test_copies_are_corrupted_independently(flagged):
    copies = flagged.filter(F.col("_copy") == 1).select("row_id").distinct()
    assert copies.count() > 0
    pairs = flagged.join(copies, "row_id").groupBy("row_id").agg(F.count_distinct(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("<null>")) for c in FIELDNAMES])).alias("variants"))
    assert pairs.filter(F.col("variants") > 1).count() > 0  # some copies differ from their original
    assert flagged.filter(F.col("_dropped") & (F.col("_copy") == 1)).count() == 0  # dropped rows are never copied


def test_column_guards_skip_absent_columns(spark):
    df = spark.createDataFrame([(i, "ETHUSDT", "1") for i in range(200)], "row_id bigint, symbol string, open string")
    out = defects.defect_flags(df, seed=1)
    assert out.filter(F.col("_m_time") | F.col("_m_negative")).count() == 0
    assert set(out.columns) >= {"symbol", "open"}


def test_decisions_do_not_repeat_after_the_modulus(spark):
    from candlewick.functions.hashing import P1, mix

    pairs = spark.range(2000).select(mix("id", 11, 42).alias("a"), mix(f"(id + {P1})", 11, 42).alias("b"))
    assert pairs.filter("a = b").count() < 20
    assert pairs.filter("b < 0 or b >= 1000000").count() == 0
