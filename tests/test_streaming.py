"""Streaming ingest equals the batch result for every closed window."""

import os
import shutil

from pyspark.sql import functions as F

from candlewick.sources.events import candles_from_events
from candlewick.streaming.ingest import start_klines_to_parquet, start_to_parquet, stream_candles, stream_klines
from conftest import SF_SMALL


def test_stream_candles_match_batch(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{SF_SMALL}/events.parquet", src / "part-0.parquet")
    out = str(tmp_path / "candles")
    q = start_to_parquet(stream_candles(spark, str(src)), out, f"candles-{os.getpid()}-{tmp_path.name}")
    q.awaitTermination(120)
    streamed = spark.read.parquet(out)
    batch = candles_from_events(spark.read.parquet(str(src)))
    # append mode emits a window once the watermark passes its end: all but the
    # last hour(s) of the file are final
    assert streamed.count() > 0
    cols = batch.columns
    missing = streamed.select(*cols).exceptAll(batch.select(*cols))
    assert missing.count() == 0
    last = batch.agg(F.max("open_time")).first()[0]
    closed = batch.filter(F.col("open_time") < F.lit(last) - F.expr("INTERVAL 1 HOUR"))
    assert closed.select(*cols).exceptAll(streamed.select(*cols)).count() == 0


def test_stream_klines_dedups_redelivered_payload(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    payload = (
        '[[1782748800000, "1", "2", "0.5", "1.5", "10", 1782752399999, "15", 3, "4", "6"],'
        ' [1782752400000, "1", "2", "0.5", "1.5", "10", 1782755999999, "15", 3, "4", "6"]]'
    )
    (land / "ethusdt.json").write_text(payload)
    (land / "ETHUSDT.json.1").write_text(payload)  # the same payload delivered again
    out = str(tmp_path / "decoded")
    q = start_klines_to_parquet(stream_klines(spark, str(land)), out, f"klines-{os.getpid()}-{tmp_path.name}")
    assert q.awaitTermination(120)
    rows = spark.read.parquet(out).filter(F.col("symbol") == "ETHUSDT").collect()
    assert len(rows) == 2


def test_stream_klines_keeps_every_candle_of_a_later_payload(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    out = str(tmp_path / "decoded")

    def deliver(name, hours):
        records = [f'[{1782748800000 + h * 3600000}, "1", "2", "0.5", "1.5", "10", 1, "15", 3, "4", "6"]' for h in hours]
        (land / name).write_text("[" + ", ".join(records) + ', [null, "9"]]')
        q = start_klines_to_parquet(stream_klines(spark, str(land)), out, f"late-{os.getpid()}-{tmp_path.name}")
        assert q.awaitTermination(120)

    deliver("BTCUSDT.json", range(100))
    deliver("ETHUSDT.json", range(100))  # as old as the first, in a later run
    deliver("ETHUSDT.1.json", range(90, 110))  # half of it seen before
    counts = {r["symbol"]: r["count"] for r in spark.read.parquet(out).groupBy("symbol").count().collect()}
    assert counts == {"BTCUSDT": 101, "ETHUSDT": 111}


def test_only_the_dates_of_a_batch_are_read_of_what_is_stored(spark, tmp_path):
    from candlewick.sources.sinks import write_by_date
    from candlewick.streaming.ingest import new_candles

    rows = spark.sql("SELECT 'A' AS symbol, '1h' AS `interval`, timestamp_ntz'2026-06-01 00:00:00' + make_interval(0, 0, 0, id) AS open_time FROM (SELECT cast(id AS int) AS id FROM range(9))")
    from candlewick.schema import FIELDNAMES

    rows = rows.selectExpr("symbol", "`interval`", "open_time", *[f"cast(null as double) AS {c}" for c in FIELDNAMES if c not in ("symbol", "interval", "open_time")])
    write_by_date(rows, str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    batch = rows.where("open_time between timestamp_ntz'2026-06-03 00:00:00' and timestamp_ntz'2026-06-04 00:00:00'").unionByName(rows.limit(1).selectExpr("'B' AS symbol", "* except (symbol)"))
    fresh = new_candles(batch.where("open_time >= timestamp_ntz'2026-06-03 00:00:00' or symbol = 'B'"), stored)
    assert [r.symbol for r in fresh.collect()] == ["B"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert any("trade_date" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
