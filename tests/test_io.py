"""Sources and sinks: CSV round trips, payload decode, batches, ingest checks."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from candlewick.schema import FIELDNAMES, SYMBOLS
from candlewick.sources import files, ingest, klines, sinks


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def _messy_rows():
    return [
        ("btcusdt", "1h", "2026-06-01T00:00:00+00:00", "100", "110", "90", "105", "5000", "2026-06-01T00:59:59.999000+00:00", "500000", "1000", "2500", "250000"),
        ("ETHUSDT", "1h", "not_a_date", "unknown", "11", "9", "10.5", "", "2026-06-01T00:59:59.999000+00:00", "200000", "500", "1", "2"),
    ]


def test_write_csv_round_trip_and_overwrite(spark, tmp):
    df = spark.createDataFrame(_messy_rows(), ", ".join(f"{c} string" for c in FIELDNAMES))
    path = os.path.join(tmp, "out", "messy")
    sinks.write_csv(df, path, single_file=True)
    sinks.write_csv(df, path, single_file=True)  # overwrite, no error
    parts = glob.glob(os.path.join(path, "part-*.csv"))
    assert len(parts) == 1
    with open(parts[0]) as fh:
        assert fh.readline().strip() == ",".join(FIELDNAMES)
    back = files.scan_messy(spark, path)
    assert back.count() == 2
    assert back.filter(F.col("volume").isNull()).count() == 1  # empty field -> NULL


def test_header_only_when_empty(spark, tmp):
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in FIELDNAMES))
    path = os.path.join(tmp, "empty")
    sinks.write_csv(empty, path, single_file=True)
    with pytest.raises(ValueError):
        files.scan_nonempty(spark, path)


def test_scan_cleaned_parses_types(spark, tmp):
    from candlewick.operators.clean import clean_candles

    raw = spark.createDataFrame(_messy_rows(), ", ".join(f"{c} string" for c in FIELDNAMES))
    cleaned = clean_candles(raw)
    path = os.path.join(tmp, "cleaned")
    sinks.write_csv(cleaned, path, single_file=True)
    back = files.scan_cleaned(spark, path)
    assert dict(back.dtypes)["open_time"] == "timestamp_ntz"
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, cleaned.collect()), key=str)


def test_decode_kline_payload_mixed_types(spark):
    payload = json.dumps(
        [
            [1782748800000, "59824.01000000", "59931.98000000", "59710.01000000", "59748.74000000", "198.93068000",
             1782752399999, "11898417.33672800", 69634, "100.5", "6000000.1", "0"],
            [1782752400000, "59748.74", "59800.00", "59700.00", "59790.00", "10.0", 1782755999999, "598000.0", 1200, "5.0", "299000.0", "0"],
        ]
    )
    df = spark.createDataFrame([("BTCUSDT", "1h", payload)], "symbol string, interval string, payload string")
    out = klines.decode_klines(df).orderBy("open_time").collect()
    assert len(out) == 2
    first = out[0]
    assert first["open"] == 59824.01 and first["trade_count"] == 69634 and first["quote_volume"] == 11898417.336728
    assert first["open_time"].isoformat() == "2026-06-29T16:00:00"
    assert first["close_time"].isoformat() == "2026-06-29T16:59:59.999000"


def test_kline_files_and_encode_round_trip(spark, tmp):
    rows = [
        ("ETHUSDT", "1h", "[[0, \"1\", \"2\", \"0.5\", \"1.5\", \"10\", 3599999, \"15\", 3, \"4\", \"6\"]]"),
        ("SOLUSDT", "1h", "[[3600000, 1, 2, 0.5, 1.5, 10, 7199999, 15, 3, 4, 6]]"),
    ]
    for sym, _, payload in rows:
        with open(os.path.join(tmp, f"{sym.lower()}.json"), "w") as fh:
            fh.write(payload)
    landed = klines.scan_kline_files(spark, tmp)
    decoded = klines.decode_klines(landed)
    assert {r["symbol"] for r in decoded.collect()} == {"ETHUSDT", "SOLUSDT"}
    again = klines.decode_klines(klines.encode_klines(decoded))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, decoded.collect()), key=str)


def test_union_batches(spark):
    a = spark.createDataFrame([("A", 1)], "s string, v int")
    b = spark.createDataFrame([(2, "B")], "v int, s string")
    assert sorted(tuple(r) for r in files.union_batches(a, b).collect()) == [("A", 1), ("B", 2)]


def test_record_count_and_ingest_status(spark):
    candles = spark.createDataFrame([("BTCUSDT",)] * 3 + [("ETHUSDT",)] * 2 + [("ZZZUSDT",)], "symbol string")
    check = ingest.record_count_check(candles.filter(F.col("symbol") != "ZZZUSDT"), expected_per_symbol=3, n_symbols=2).first()
    assert (check["records"], check["expected"], check["check"]) == (5, 6, "failed")
    ok = ingest.record_count_check(candles.filter(F.col("symbol") == "BTCUSDT"), expected_per_symbol=3).first()
    assert ok["check"] == "passed"
    expected = ingest.expected_symbols_frame(spark, SYMBOLS[:3])
    status = {r["symbol"]: (r["records"], r["status"]) for r in ingest.ingest_status(candles, expected, 3).collect()}
    assert status["BTCUSDT"] == (3, "ok")
    assert status["ETHUSDT"] == (2, "short")
    assert status["BNBUSDT"] == (0, "missing")
    assert status["ZZZUSDT"] == (1, "unexpected")
    assert ingest.ingest_failures(ingest.ingest_status(candles, expected, 3)).first()["failures"] == 1  # BNBUSDT; a short count is no failure


def _write(tmp, name, text):
    path = os.path.join(tmp, name)
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(text)
    return path


def test_csv_columns_are_bound_by_name(spark, tmp):
    path = _write(tmp, "swapped", "close,symbol,open,note\n2,A,1,x\n4,B,3,y\n")
    df = files.scan_messy(spark, path)
    assert df.columns == ["symbol", "open", "close", "note"]  # absent columns stay absent
    assert sorted(map(tuple, df.collect())) == [("A", "1", "2", "x"), ("B", "3", "4", "y")]


def test_files_with_another_header_raise(spark, tmp):
    path = _write(tmp, "mixed", "symbol,open\nA,1\n")
    with open(os.path.join(path, "part-1.csv"), "w") as fh:
        fh.write("open,symbol\n1,A\n")
    with pytest.raises(Exception, match="header"):
        files.scan_messy(spark, path).collect()


def test_lines_with_other_cell_counts_are_kept_as_rejects(spark, tmp):
    path = _write(tmp, "ragged", "symbol,open\nA,1\nB,2,3,4\nC\n")
    rows = {r["symbol"]: r["line"] for r in files.scan_messy(spark, path, rejects="line").collect()}
    assert rows == {"A": None, "B": "B,2,3,4", "C": "C"}


def test_cleaned_csv_without_derived_columns_gets_them(spark, tmp):
    from candlewick.operators.derive import ensure_derived

    path = _write(tmp, "base", "symbol,high,low,open,close,open_time\nA,5,1,2,3,2026-06-01T00:00:00+00:00\n")
    df = files.scan_cleaned(spark, path)
    assert "price_range" not in df.columns
    row = ensure_derived(df).first()
    assert (row["price_range"], row["price_change"], row["percent_change"]) == (4.0, 1.0, 50.0)


def test_unreadable_payloads_and_records_are_reported(spark):
    whole = [0, "1", "2", "0.5", "1.5", "10", 3599999, "15", 3, "4", "6"]
    rows = [
        ("A", "1h", json.dumps([whole, whole[:5], [*whole[:4], "n/a", *whole[5:]]])),
        ("B", "1h", json.dumps([whole])[:-4]),
        ("C", "1h", "[]"),
        ("D", "1h", None),
    ]
    df = spark.createDataFrame(rows, "symbol string, interval string, payload string")
    decoded = [(r["symbol"], r["open"], r["close"], r["volume"]) for r in klines.decode_klines(df).collect()]
    assert sorted(decoded, key=str) == [("A", 1.0, 1.5, 10.0), ("A", 1.0, 1.5, None), ("A", 1.0, None, 10.0)]
    rejects = sorted((r["symbol"], r["reason"], r["content"]) for r in klines.kline_rejects(df).na.fill("").collect())
    assert [r[:2] for r in rejects] == [("A", "record"), ("A", "record"), ("B", "payload"), ("D", "payload")]
    assert rejects[2][2] == rows[1][2]


ODD_TEXTS = ['say "hi"', "a,b", "two\nlines", "cr\r\nlf", "", None, "  padded  ", '"', "back\\slash", "\\", "#x", '""', "tab\t"]


def test_any_text_goes_through_a_csv_unchanged(spark, tmp):
    df = spark.createDataFrame([(i, t, str(i)) for i, t in enumerate(ODD_TEXTS)], "id int, text string, last string").repartition(3)
    path = os.path.join(tmp, "texts")
    sinks.write_csv(df, path)
    back = files.scan_typed(spark, path, df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(i, t, str(i)) for i, t in enumerate(ODD_TEXTS)]
    empty = os.path.join(tmp, "none")
    sinks.write_csv(df.limit(0), empty)
    assert files.scan_typed(spark, empty, df.schema, multi_line=True).collect() == []


def test_quotes_are_doubled_as_other_csv_readers_expect(spark, tmp):
    import csv

    path = os.path.join(tmp, "quoted")
    sinks.write_csv(spark.createDataFrame([('say "hi"', " BTCUSDT ")], "a string, symbol string"), path, single_file=True)
    with open(glob.glob(os.path.join(path, "part-*.csv"))[0], newline="") as fh:
        assert list(csv.reader(fh)) == [["a", "symbol"], ['say "hi"', " BTCUSDT "]]


def test_one_day_is_replaced_and_read_alone(spark, tmp):
    from candlewick.plans.jobs import read_cleaned

    rows = [("A", f"2026-06-0{d} 0{h}:00:00", d * 10 + h) for d in (1, 2, 3) for h in range(4)] + [("A", None, 0)]
    df = spark.createDataFrame(rows, "symbol string, t string, v int").selectExpr("symbol", "cast(t as timestamp_ntz) open_time", "v")
    path = os.path.join(tmp, "dated")
    sinks.write_by_date(df, path)
    sinks.write_by_date(df.where("v between 20 and 21").selectExpr("symbol", "open_time", "-v as v"), path)
    got = sorted(r.v for r in read_cleaned(spark, path).collect())
    assert got == sorted([0, *range(10, 14), -20, -21, *range(30, 34)])
    day = read_cleaned(spark, path, "2026-06-02", "2026-06-02")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "trade_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.v for r in day.collect()) == [-21, -20]
    assert len(day.inputFiles()) >= 1 and day.count() == 2


def test_replacing_a_view_changes_later_answers_only(spark):
    from candlewick.operators.summary import market_summary
    from candlewick.plans import views
    from candlewick.plans.tables import Stages

    cleaned = Stages(spark, "/root/testdata/sf0.001").cleaned()
    views.register_market_views(spark, cleaned)
    before = views.market_summary_sql(spark)
    whole = {r.symbol: r for r in before.collect()}
    frame = {r.symbol: r for r in market_summary(Stages(spark, "/root/testdata/sf0.001").featured()).collect()}
    assert {s: (r.row_count, r.volatility_rank, r.symbol_activity_rank, r.up_count, r.total_trades) for s, r in whole.items()} == {
        s: (r.row_count, r.volatility_rank, r.symbol_activity_rank, r.up_count, r.total_trades) for s, r in frame.items()
    }
    views.register_market_views(spark, cleaned.where("symbol = 'CLICKUSDT'"))
    assert [r.symbol for r in views.market_summary_sql(spark).collect()] == ["CLICKUSDT"]
    assert before.count() == len(whole)
    assert views.market_summary_sql(spark, least_rows=10**6).count() == 0
    quoted = "x' OR '1'='1"
    assert views.symbol_history_sql(spark, quoted, "2024-01-01", "2024-02-01").count() == 0
