"""Request-log parsing and the trailing-window / in-flight operators,
checked against brute force on small fixtures."""

import datetime as dt
import random

import pytest

from candlewick.operators import requests
from candlewick.sources import requestlog

LOG = """2026-07-03T08:59:21Z | Starting serial download for 10 symbols
2026-07-03T08:59:21Z | START request symbol=BTCUSDT interval=1h limit=1000
2026-07-03T08:59:23Z | END request symbol=BTCUSDT records=1000
2026-07-03T08:59:23Z | Downloaded BTCUSDT: 1000 records
2026-07-03T08:59:24Z | RATE_LIMIT wait 12.50s
2026-07-03T08:59:25Z | ERROR request symbol=ETHUSDT: 500 Server Error
2026-07-03T08:59:43Z | WROTE csv=data/clean/clean_market_data.csv records=10000
2026-07-03T08:59:43Z | START request symbol=SOLUSDT interval=1h limit=1000 id=7
2026-07-03T08:59:45Z | END request symbol=SOLUSDT records=999 id=7"""


@pytest.fixture
def parsed(spark):
    lines = spark.createDataFrame([(line,) for line in LOG.splitlines()], "value string")
    return requestlog.parse_request_log(lines)


def test_parse_kinds_and_fields(parsed):
    rows = parsed.collect()
    assert [r["kind"] for r in rows] == ["OTHER", "START", "END", "DOWNLOADED", "RATE_LIMIT", "ERROR", "WROTE", "START", "END"]
    assert rows[0]["ts"] == dt.datetime(2026, 7, 3, 8, 59, 21)
    assert (rows[1]["symbol"], rows[1]["interval"], rows[1]["limit"]) == ("BTCUSDT", "1h", 1000)
    assert (rows[2]["symbol"], rows[2]["records"]) == ("BTCUSDT", 1000)
    assert (rows[3]["symbol"], rows[3]["records"]) == ("BTCUSDT", 1000)
    assert rows[4]["wait_seconds"] == 12.5
    assert (rows[5]["symbol"], rows[5]["error"]) == ("ETHUSDT", "500 Server Error")
    assert (rows[6]["csv"], rows[6]["records"]) == ("data/clean/clean_market_data.csv", 10000)
    assert rows[7]["request_id"] == 7 and rows[1]["request_id"] is None


def test_request_latency_pairs_by_id(parsed):
    out = requests.request_latency(parsed).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["symbol"], r["request_id"], r["records"], r["failed"], r["latency_seconds"]) == ("SOLUSDT", 7, 999, False, 2.0)


def _brute_window(rows, w):
    out = {}
    for i, (c, t) in enumerate(rows):
        out[i] = sum(1 for c2, t2 in rows if c2 == c and t - w < t2 <= t)
    return out


def test_rate_window_limiter_scenarios(spark):
    base = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([(i, "A", base + dt.timedelta(seconds=s)) for i, s in enumerate([0, 1, 2, 3])], "id int, client string, ts timestamp_ntz")
    got = {r["id"]: (r["in_window"], r["over_limit"]) for r in requests.rate_window_counts(df, window_seconds=60, cap=3).collect()}
    # the fourth request within the minute is over the limit
    assert got == {0: (1, False), 1: (2, False), 2: (3, False), 3: (4, True)}
    # the window is (t - 60 s, t]: a request exactly 60 s earlier no longer counts (trap T11)
    df = spark.createDataFrame([(i, "A", base + dt.timedelta(seconds=s)) for i, s in enumerate([0, 1, 2, 62])], "id int, client string, ts timestamp_ntz")
    got = {r["id"]: r["in_window"] for r in requests.rate_window_counts(df, window_seconds=60, cap=3).collect()}
    assert got[3] == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rate_window_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2026, 1, 1)
    rows = [(rnd.choice("ABC"), rnd.randint(0, 600)) for _ in range(300)]  # many ties and bucket edges
    df = spark.createDataFrame(
        [(i, c, base + dt.timedelta(seconds=s)) for i, (c, s) in enumerate(rows)], "id int, client string, ts timestamp_ntz"
    )
    want = _brute_window(rows, 60)
    for bucket in (None, 25, 7):  # one bucket for all, and buckets narrower than the window
        out = requests.rate_window_counts(df, window_seconds=60, cap=5, bucket_seconds=bucket).collect()
        assert {r["id"]: r["in_window"] for r in out} == want


def _brute_concurrency(rows):
    best = {}
    for c in {r[0] for r in rows}:
        ev = sorted([(s, 1) for cc, s, e in rows if cc == c] + [(e, -1) for cc, s, e in rows if cc == c])
        run = peak = 0
        for _, d in ev:
            run += d
            peak = max(peak, run)
        best[c] = peak
    return best


def test_max_concurrency_half_open(spark):
    base = dt.datetime(2026, 1, 1)
    t = lambda s: base + dt.timedelta(seconds=s)
    df = spark.createDataFrame([("A", t(0), t(10)), ("A", t(5), t(15)), ("A", t(10), t(20))], "client string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    assert requests.max_concurrency(df).first()["max_concurrency"] == 2


@pytest.mark.parametrize("seed", [4, 5])
def test_max_concurrency_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2026, 1, 1)
    rows = []
    for _ in range(400):
        s = rnd.randint(0, 3000)
        rows.append((rnd.choice("XYZ"), s, s + rnd.randint(0, 400)))
    df = spark.createDataFrame(
        [(c, base + dt.timedelta(seconds=s), base + dt.timedelta(seconds=e)) for c, s, e in rows],
        "client string, start_ts timestamp_ntz, end_ts timestamp_ntz",
    )
    # small buckets so the offsets of the two-level scan are exercised
    got = {r["client"]: r["max_concurrency"] for r in requests.max_concurrency(df, bucket_seconds=37).collect()}
    assert got == _brute_concurrency(rows)


def test_log_lines_round_trip(spark):
    base = dt.datetime(2026, 1, 1)
    req = spark.createDataFrame(
        [(1, "AUSDT", base, base + dt.timedelta(seconds=90), 10, False), (2, "BUSDT", base, base + dt.timedelta(seconds=5), 3, True)],
        "request_id bigint, client string, start_ts timestamp_ntz, end_ts timestamp_ntz, records bigint, failed boolean",
    )
    lat = {r["request_id"]: (r["latency_seconds"], r["failed"], r["records"]) for r in requests.request_latency(requestlog.parse_request_log(requestlog.log_lines_from_requests(req))).collect()}
    assert lat == {1: (90.0, False, 10), 2: (5.0, True, None)}


RUN_LOG = """2026-07-03T08:59:21Z | Starting serial download for 2 symbols
2026-07-03T08:59:21Z | START request symbol=BTCUSDT interval=1h limit=1000
2026-07-03T08:59:23Z | END request symbol=BTCUSDT records=1000
2026-07-03T08:59:23Z | START request symbol=ETHUSDT interval=1h limit=1000
2026-07-03T08:59:24Z | END request symbol=ETHUSDT records=1000
2026-07-03T08:59:24Z | Starting multithreaded download for 2 symbols
2026-07-03T08:59:24Z | START request symbol=BTCUSDT interval=1h limit=1000
2026-07-03T08:59:24Z | START request symbol=ETHUSDT interval=1h limit=1000
2026-07-03T08:59:26Z | ERROR request symbol=ETHUSDT: 500 Server Error
2026-07-03T08:59:29Z | END request symbol=BTCUSDT records=999"""


def test_latency_by_run_without_ids(spark):
    lines = spark.createDataFrame([(line,) for line in RUN_LOG.splitlines()], "value string").coalesce(1)
    parsed = requestlog.parse_request_log(lines, with_line_order=True)
    runs = requests.assign_runs(parsed, block_lines=2)  # small blocks: offsets carry the count across
    assert [r["run"] for r in runs.orderBy("ts", "line_order").collect()] == [1, 1, 1, 1, 1, 2, 2, 2, 2, 2]
    got = {(r["symbol"], r["request_id"]): (r["latency_seconds"], r["failed"], r["records"]) for r in requests.request_latency(runs).collect()}
    assert got == {
        ("BTCUSDT", 1): (2.0, False, 1000),
        ("ETHUSDT", 1): (1.0, False, 1000),
        ("BTCUSDT", 2): (5.0, False, 999),
        ("ETHUSDT", 2): (2.0, True, None),
    }


TRIES = """2026-07-03T08:00:00Z | Starting multithreaded download for 2 symbols
2026-07-03T08:00:00Z | START request symbol=A interval=1h limit=1000
2026-07-03T08:00:01Z | ERROR request symbol=A: 500 Server Error
2026-07-03T08:00:01Z | RATE_LIMIT wait 1.2.3s
2026-07-03T08:00:05Z | START request symbol=A interval=1h limit=99999999999999999999
2026-07-03T08:00:05Z | START request symbol=B interval=1h limit=1000
2026-07-03T08:00:09Z | END request symbol=A records=7
not a log line
2026-07-03T08:00:09Z | RATE_LIMIT wait 2.50s
2026-07-03T08:00:09Z | WROTE csv=out.csv records=99999999999999999999"""


@pytest.mark.parametrize("block_lines", [1, 3, 1000])
def test_tries_of_one_symbol_in_one_run_stay_apart(spark, block_lines):
    lines = spark.createDataFrame([(line,) for line in TRIES.splitlines()], "value string").coalesce(1)
    log = requestlog.parse_request_log(lines, with_line_order=True)
    got = {(r.run, r.symbol, r.attempt): (r.latency_seconds, r.failed, r.records, r.error) for r in requests.request_runs(log, block_lines).collect()}
    assert got == {(1, "A", 1): (1.0, True, None, "500 Server Error"), (1, "A", 2): (4.0, False, 7, None), (1, "B", 1): (None, False, None, None)}
    assert {(r["symbol"], r["request_id"], r["failed"]) for r in requests.request_latency(log).collect()} == {("A", 1, True), ("A", 1, False), ("B", 1, False)}


def test_unreadable_numbers_and_lines_keep_their_text(spark):
    rows = requestlog.parse_request_log(spark.createDataFrame([(line,) for line in TRIES.splitlines()], "value string")).collect()
    assert (rows[3].kind, rows[3].wait_seconds, rows[3].message) == ("RATE_LIMIT", None, "RATE_LIMIT wait 1.2.3s")
    assert (rows[4].kind, rows[4].limit) == ("START", None)
    assert (rows[7].kind, rows[7].ts, rows[7].message) == ("OTHER", None, "not a log line")
    assert (rows[9].kind, rows[9].records, rows[9].csv) == ("WROTE", None, "out.csv")


def test_runs_follow_file_order_across_files(spark, tmp_path):
    lines = [f"2026-07-03T08:00:00Z | {'Starting serial download for 1 symbols' if k % 10 == 0 else f'line {k}'}" for k in range(95)]
    for part in range(5):  # the stamps are all equal: only the files tell the order
        (tmp_path / f"log-{part}.txt").write_text("".join(f"{line}\n" for line in lines[part * 19 : part * 19 + 19]))
    log = requestlog.parse_request_log(requestlog.read_log_lines(spark, str(tmp_path)), with_line_order=True)
    runs = {r.message: r.run for r in requests.assign_runs(log, block_lines=4).collect() if r.message.startswith("line")}
    assert runs == {f"line {k}": k // 10 + 1 for k in range(95) if k % 10}
    report = {r.run: (r.mode, r.lines) for r in requests.run_report(log).collect()}
    assert report == {k + 1: ("serial", 10 if k < 9 else 5) for k in range(10)}


def test_window_counts_do_not_copy_rows_and_keep_untimed_ones(spark):
    base = dt.datetime(2026, 1, 1)
    rows = [(i, "hot" if i % 3 else None, base + dt.timedelta(seconds=i % 50)) for i in range(300)] + [(999, "hot", None)]
    df = spark.createDataFrame(rows, "id int, client string, ts timestamp_ntz")
    got = {r.id: r.in_window for r in requests.rate_window_counts(df, window_seconds=10, bucket_seconds=2).collect()}
    want = {i: sum(c2 == c and t - dt.timedelta(seconds=10) < t2 <= t for _, c2, t2 in rows[:-1]) for i, c, t in rows[:-1]}
    assert got == {**want, 999: None}
