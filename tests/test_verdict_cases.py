"""Inputs on which earlier versions dropped or changed data."""

import pytest
from pyspark.sql import functions as F

from candlewick.functions.scalar import exact_avg, exact_sum
from candlewick.operators.clean import dedup_by_candle_key
from candlewick.operators.requests import in_flight, max_concurrency
from candlewick.plans.tables import Stages
from candlewick.session import checkpoint_dir


@pytest.mark.parametrize(
    "values, total",
    [([1e31, 1.0], 1e31), ([4e-9, 4e-9], 8e-9), ([float("inf"), 1.0], float("inf")), ([0.1, 0.2, None], 0.3), ([None], None)],
)
def test_sums_and_averages_keep_every_value(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    n = sum(v is not None for v in values)
    assert r.s == (None if total is None else pytest.approx(total, rel=1e-12))
    assert r.a == (None if total is None else pytest.approx(total / n, rel=1e-12))


def test_small_trade_values_are_not_rounded_away(spark):
    events = spark.createDataFrame([(1, 0.004), (2, 0.004), (3, 2e16)], "event_id long, value double")
    events = events.selectExpr("event_id", "timestamp_ntz'2026-06-01 00:00:00' ts", "2L user_id", "if(event_id < 3, 'a', 'b') event_type", "value", "'{}' props")
    from candlewick.sources.events import candles_from_events

    got = {r.symbol: r.quote_volume for r in candles_from_events(events).collect()}
    assert got == {"AUSDT": pytest.approx(0.008), "BUSDT": 2e16}


def test_open_requests_and_null_clients_count(spark):
    rows = [("a", 0, None), ("a", 7200, 7300), (None, 5, 9), (None, 6, None), ("b", None, 4)]
    df = spark.createDataFrame(rows, "client string, s long, e long").select("client", F.timestamp_seconds("s").alias("start_ts"), F.timestamp_seconds("e").alias("end_ts"))
    assert {r.client: r.max_concurrency for r in max_concurrency(df).collect()} == {"a": 2, None: 2}
    peak = in_flight(df).groupBy("client").agg(F.max("in_flight").alias("m"))
    assert {r.client: r.m for r in peak.collect()} == {"a": 2, None: 2}


def test_all_rows_with_an_incomplete_key_stay(spark):
    rows = [(None, "1h", 5.0, None), (None, "1h", None, 5.0), (None, "1h", None, 5.0), ("A", "1h", 1.0, 2.0), ("A", "1h", 1.0, None)]
    df = spark.createDataFrame(rows, "symbol string, interval string, open double, high double")
    got = dedup_by_candle_key(df, ("symbol", "interval")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[1], rows[2], rows[3]], key=str)


def test_files_that_land_between_queries_are_seen(spark, tmp_path):
    path = f"{tmp_path}/events.parquet"
    one = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(50)
    one.write.parquet(path)
    assert Stages(spark, str(tmp_path)).events().count() == 50
    one.write.mode("append").parquet(path)
    assert Stages(spark, str(tmp_path)).events().count() == 100


def test_times_do_not_follow_the_session_zone(spark):
    from candlewick.functions.scalar import epoch_ms_to_ts, safe_timestamp

    texts = ["2026-06-01T00:00:00+00:00", "2026-06-01 00:00", "2026-06-01T02:00:00+02:00", "2026-10-25 00:30:00Z", "2026-10-25 01:30:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(safe_timestamp("t").cast("string"))
    ms = spark.range(1).select(epoch_ms_to_ts(F.lit(-1)).cast("string"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got, before = [r[0] for r in df.collect()], ms.first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2026-06-01 00:00:00"] * 3 + ["2026-10-25 00:30:00", "2026-10-25 01:30:00"]
    assert before == "1969-12-31 23:59:59.999"


def test_unknown_symbols_are_counted_before_the_join(spark):
    from candlewick.operators.clean import unknown_symbols

    rows = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "symbol string")
    known = spark.createDataFrame([("A",), (None,)], "symbol string")
    assert {r["symbol"]: r["rows"] for r in unknown_symbols(rows, known).collect()} == {"B": 2, None: 1}


def test_latency_of_a_log_without_ids(spark):
    from candlewick.operators.requests import request_latency
    from candlewick.sources.requestlog import parse_request_log

    day = "2026-07-03T08:"
    log = [
        "00:00Z | Starting clean market data download", "00:01Z | START request symbol=A interval=1h limit=10", "00:04Z | END request symbol=A records=10",
        "10:00Z | Starting clean market data download", "10:01Z | START request symbol=A interval=1h limit=10", "10:03Z | END request symbol=A records=9",
    ]
    lines = spark.createDataFrame([(day + line,) for line in log], "value string").coalesce(1)
    got = request_latency(parse_request_log(lines, with_line_order=True)).collect()
    assert sorted((r["records"], r["latency_seconds"]) for r in got) == [(9, 2.0), (10, 3.0)]


def test_stream_state_needs_a_shared_folder():
    class Session:
        conf = {}

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_times_of_payloads_are_never_lost_silently(spark):
    import json

    from candlewick.sources.klines import decode_klines, kline_rejects

    whole = [0, "1", "2", "0.5", "1.5", "10", 3599999, "15", 3, "4", "6"]
    odd = [["1.5e12", *whole[1:]], ["99999999999999999", *whole[1:]], [*whole[:6], "x", *whole[7:]], [*whole[:8], "2.5", *whole[9:]], whole, [None, *whole[1:]]]
    df = spark.createDataFrame([("A", "1h", json.dumps(odd))], "symbol string, interval string, payload string")
    candles = decode_klines(df).collect()
    assert len(candles) == 3  # a time that the payload leaves out is a NULL cell; none that it holds is lost
    assert sorted(r.open_time is None for r in candles) == [False, False, True] and all(r.close_time is not None for r in candles)
    rejects = {(r.reason, tuple(r.cells)) for r in kline_rejects(df).collect()}
    assert rejects == {("record", ("open_time",)), ("record", ("close_time",)), ("record", ("trade_count",))}
    assert kline_rejects(df).count() == 5


def test_candles_and_rejects_come_from_one_parse(spark):
    from candlewick.sources.klines import decode_tagged

    df = spark.createDataFrame([("A", "1h", "[]")], "symbol string, interval string, payload string")
    plan = decode_tagged(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 1 or plan.count("Generate explode") == 1
    assert plan.count("Generate ") == 1


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e4])
def test_moments_are_the_same_bits_for_any_partitioning(spark, scale):
    import random
    import statistics

    from candlewick.functions.scalar import exact_moments

    rng = random.Random(4)
    values = [round(rng.uniform(90, 110), 2) * scale - round(rng.uniform(80, 90), 2) * scale for _ in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    mean, spread = exact_moments("x")
    got = {tuple(df.repartition(k).agg(mean.alias("m"), spread.alias("s")).first()) for k in (1, 7, 200)}
    assert len(got) == 1
    some = [v for v in values if v is not None]
    assert got.pop() == (pytest.approx(statistics.fmean(some), rel=1e-14), pytest.approx(statistics.stdev(some), rel=1e-12))


@pytest.mark.parametrize("values", [[], [None], [3.25], [1e300, 2.0], [1.0, float("inf")], [-5.5, 5.5, 0.0], [1e-17, 3e-17], [7.1] * 9])
def test_moments_of_odd_groups(spark, values):
    from candlewick.functions.scalar import exact_moments

    df = spark.createDataFrame([(v,) for v in values], "x double")
    mean, spread = exact_moments("x")
    got = df.agg(mean.alias("m"), spread.alias("s"), F.avg("x").alias("am"), F.stddev_samp("x").alias("ss")).first()
    for mine, native in ((got.m, got.am), (got.s, got.ss)):
        assert mine == native or mine == pytest.approx(native, rel=1e-12, abs=1e-14, nan_ok=True)


def test_volatility_ranking_reruns_alike(spark):
    from candlewick.operators.rankings import volatility_ranking

    featured = Stages(spark, "/root/testdata/sf0.001").featured().select("symbol", "price_range")
    rows = [sorted(map(tuple, volatility_ranking(featured.repartition(k)).collect())) for k in (1, 50)]
    assert rows[0] == rows[1]


def test_candle_key_dedup_has_one_scan_and_no_window(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(None, "1h", 5.0, None), ("A", "1h", 1.0, 2.0), ("A", "1h", 1.0, None), ("A", "1h", 0.5, 2.0)]
    spark.createDataFrame(rows, "symbol string, interval string, open double, high double").write.parquet(path)
    deduped = dedup_by_candle_key(spark.read.parquet(path), ("symbol", "interval"))
    assert sorted(map(tuple, deduped.collect()), key=str) == sorted([rows[0], rows[3]], key=str)
    plan = deduped._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1 and "Window" not in plan


def test_batches_merge_by_sketch_as_exactly_as_they_are_told(spark):
    from candlewick.operators.quality import domain_check, domain_sketches, exact_domains, merged_domains

    df = spark.range(60_000).selectExpr("cast(id % 20000 as string) AS many", "if(id % 3 = 0, null, cast(id % 7 as string)) AS few", "id % 5 AS batch")
    got = {r.column_name: r for r in domain_check(exact_domains(df, ["many", "few"]), merged_domains(domain_sketches(df, "batch", ["many", "few"]))).collect()}
    assert got["few"].exact == got["few"].estimate == 7 and got["few"].within
    assert got["many"].exact == 20000 and got["many"].within and abs(got["many"].estimate - 20000) < 1000
