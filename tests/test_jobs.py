"""The four file-based jobs end to end on payloads landed from the smallest event table."""

import glob
import os

import pytest

from candlewick.plans import jobs
from candlewick.schema import FIELDNAMES
from candlewick.sources.events import candles_from_events
from candlewick.sources.klines import encode_klines
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    candles = candles_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    # one payload file per symbol, like the endpoint's responses (test-sized data)
    for row in encode_klines(candles, limit=10_000).collect():
        with open(root / f"{row['symbol'].lower()}.json", "w") as fh:
            fh.write(row["payload"])
    symbols = sorted(r["symbol"] for r in candles.select("symbol").distinct().collect())
    return str(root), symbols, candles.count()


def test_collect_mess_clean_analyse(spark, landed, tmp_path):
    landing, symbols, n_candles = landed
    out = str(tmp_path)
    jobs.collect(spark, landing, f"{out}/collect", symbols=symbols, limit=1)
    written = spark.read.option("header", True).csv(f"{out}/collect/candles")
    assert written.count() == n_candles
    jobs.mess(spark, f"{out}/collect/candles", f"{out}/mess", seed=42)
    messy = glob.glob(f"{out}/mess/messy/part-*.csv")
    assert messy
    # the smallest table has few candles a symbol; see the next test for a sample that falls short
    jobs.clean_job(spark, f"{out}/mess/messy", f"{out}/clean", sample_size=1)
    report = {r["metric"]: int(r["value"]) for r in spark.read.option("header", True).csv(f"{out}/clean/dq_report").collect()}
    assert report["rows_after"] == spark.read.parquet(f"{out}/clean/cleaned").count()
    jobs.analyse(spark, f"{out}/clean/cleaned", f"{out}/analyse")
    summary = spark.read.option("header", True).csv(f"{out}/analyse/market_summary")
    assert summary.count() == len(symbols)
    assert "interpretation" in summary.columns
    assert os.path.exists(f"{out}/analyse/busiest_hour")
    jobs.analyse(spark, f"{out}/clean/cleaned_csv", f"{out}/analyse_csv", csv=True)
    again = spark.read.option("header", True).csv(f"{out}/analyse_csv/market_summary")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, summary.collect()))


def test_mess_leaves_other_cells_as_they_are(spark, tmp_path):
    path = tmp_path / "candles"
    path.mkdir()
    odd = ["0.0000000012345", "n/a", "1e31", "007"]
    lines = [f"S{i},{v},2026-06-01T00:00:00+00:00" for i, v in enumerate(odd * 25)]
    (path / "part-0.csv").write_text("\n".join(["symbol,open,open_time", *lines]) + "\n")
    jobs.mess(spark, str(path), str(tmp_path / "out"))
    opens = {r["open"] for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "messy")).collect()}
    assert set(odd) <= opens
    assert opens - set(odd) <= {None, "not_available", "error", "missing", "unknown"}


def test_clean_job_raises_for_a_short_sample_after_writing(spark, tmp_path):
    path = tmp_path / "messy"
    path.mkdir()
    (path / "part-0.csv").write_text(",".join(FIELDNAMES) + "\nA,1h,2026-06-01T00:00:00Z,1,2,0.5,1,9,2026-06-01T00:59:59Z,9,3,1,1\n")
    with pytest.raises(ValueError, match="fewer than 5"):
        jobs.clean_job(spark, str(path), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "cleaned")).count() == 1


def test_collect_fails_after_writing_when_symbols_missing(spark, landed, tmp_path):
    landing, _, _ = landed
    with pytest.raises(jobs.IngestFailed):
        jobs.collect(spark, landing, str(tmp_path / "c"))
    status = spark.read.option("header", True).csv(str(tmp_path / "c" / "ingest_status"))
    assert status.filter("status = 'missing'").count() == 10


def test_clean_job_reads_the_csv_once_and_counts_as_the_reports_do(spark, tmp_path):
    from candlewick.operators import clean, quality
    from candlewick.plans.tables import Stages
    from candlewick.sources import files, sinks

    sinks.write_csv(Stages(spark, SF_SMALL).messy(), str(tmp_path / "messy"))
    raw = files.scan_messy(spark, str(tmp_path / "messy"))
    reports = jobs.clean_to(raw, str(tmp_path / "out"))
    wanted = {
        "dq_report": quality.dq_report(raw), "missing_by_column": quality.missing_by_column(raw), "invalid_by_column": quality.invalid_by_column(raw),
        "impossible_counts": quality.impossible_counts(clean.drop_duplicates(clean.coerce_and_normalise(raw))),
    }
    for name, frame in wanted.items():
        assert sorted(map(tuple, reports[name].select(*frame.columns).collect())) == sorted(map(tuple, frame.collect())), name
    # what comes after the typed table reads that table, not the CSV
    files_read = spark.read.parquet(str(tmp_path / "out" / "typed")).inputFiles()
    assert files_read and all("/typed/" in f for f in files_read)


def test_clean_job_of_rows_that_all_go(spark, tmp_path):
    path = tmp_path / "messy"
    path.mkdir()
    (path / "part-0.csv").write_text(",".join(FIELDNAMES) + "\nA,1h,2026-06-01T00:00:00Z,1,2,0.5,1,-9,2026-06-01T00:59:59Z,9,3,1,1\n")
    jobs.clean_job(spark, str(path), str(tmp_path / "out"))
    report = {r["metric"]: int(r["value"]) for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "dq_report")).collect()}
    assert (report["rows_before"], report["rows_after"], report["dropped_impossible"]) == (1, 0, 1)
