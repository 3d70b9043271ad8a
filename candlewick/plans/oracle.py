"""SQL twins of the registered queries, for an independent engine (DuckDB).

Each query is written in plain SQL over the driver's views (``events`` ...): the candle
build, the defect injection (rows picked by ``row_number`` over the seeded hash), the
cleaning, and every report.  Of the Spark side only column names, the seed and the
queries' parameters are shared: hash, rates, tokens, patterns and formulas stand here
again.  Where the Spark plan is restructured for scale, the SQL keeps a straightforward
form (windows over the whole table, one subquery a figure), so the comparison checks the
rewrite, not just the arithmetic.
"""

from __future__ import annotations

from candlewick.plans.catalog import EXPECTED_CANDLES_PER_SYMBOL, RATE_CAP, RATE_WINDOW_S
from candlewick.plans.tables import SEED
from candlewick.schema import FIELDNAMES, NUMERIC_COLS, SYMBOLS, TIME_COLS

def qi(name: str) -> str:
    return f'"{name}"'


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NUMBER = r"^\s*([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)\s*$"
STAMP = r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)\s*$"


def safe_double_sql(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, {lit(NUMBER)}, 1), '') AS DOUBLE)"


def safe_ts_sql(x: str) -> str:
    return f"(TRY_CAST(nullif(regexp_extract({x}, {lit(STAMP)}, 1), '') AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"


def normalise_sql(x: str) -> str:
    return f"replace(upper(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')), '/', '')"


def iso_sql(x: str) -> str:
    return (
        f"(CASE WHEN microsecond({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END)"
    )


def xsum(x: str) -> str:
    return f"fsum({x})"  # compensated: plain sums differ in the last digits from run to run


def xavg(x: str) -> str:
    return f"(fsum({x}) / nullif(count({x}), 0))"


def stddev_sql(x: str) -> str:
    return f"stddev_samp({x})"


def score_sql(trades: str, qv: str) -> str:
    return f"({trades} * (CASE WHEN {qv} + 1 > 0 THEN ln({qv} + 1) END))"


def candles_sql(where: str = "") -> str:
    k = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"
    money = "value"
    taker = "(user_id % 2 = 0)"
    return f"""
    SELECT min(event_id) AS row_id,
           upper(event_type) || 'USDT' AS symbol,
           '1h' AS "interval",
           date_trunc('hour', ts) AS open_time,
           arg_min(value, (ts, event_id)) AS open,
           max(value) AS high,
           min(value) AS low,
           arg_max(value, (ts, event_id)) AS close,
           CAST(sum({k}) AS DOUBLE) AS volume,
           date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS close_time,
           CAST(fsum({money}) AS DOUBLE) AS quote_volume,
           count(*) AS trade_count,
           CAST(coalesce(sum(CASE WHEN {taker} THEN {k} END), 0) AS DOUBLE) AS taker_buy_base_volume,
           CAST(coalesce(fsum(CASE WHEN {taker} THEN {money} END), 0) AS DOUBLE) AS taker_buy_quote_volume
    FROM events {where}
    GROUP BY upper(event_type) || 'USDT', date_trunc('hour', ts)"""


def _text_sql() -> str:
    cols = []
    for c in FIELDNAMES:
        if c in TIME_COLS:
            cols.append(f"{iso_sql(qi(c))} AS {qi(c)}")
        elif c == "trade_count":
            cols.append(f"CAST(CAST({qi(c)} AS BIGINT) AS VARCHAR) AS {qi(c)}")
        elif c in NUMERIC_COLS:
            cols.append(f"CAST(TRY_CAST({qi(c)} AS DECIMAL(38,8)) AS VARCHAR) AS {qi(c)}")
        else:
            cols.append(f"CAST({qi(c)} AS VARCHAR) AS {qi(c)}")
    return "SELECT row_id, " + ", ".join(cols) + " FROM candles"


def hash_sql(key: str, salt: int, seed: int = SEED) -> str:
    """The seeded hash of a whole number, 0 to 999,999."""
    high = f"(({key}) // 1000003 % 999983)"
    a = f"((({key}) % 1000003 * 7919 + {high} * 611953 + {(salt * 104729 + seed * 15485863) % 1000003}) % 1000003)"
    return f"((({a} * {a} + {high} * {7001 + 2 * salt} + {12345 * salt + 1}) % 999983 * 7 + {a}) % 1000000)"


def _first(key: str, salt: int, fraction: str, least: int, most: str = "n", way: str = "ASC") -> str:
    """Whether a row is among the first so many in order of hash, then key."""
    many = f"greatest(0, least({most}, greatest({least}, CAST(floor(n * {fraction}::DOUBLE) AS BIGINT))))"
    return f"row_number() OVER (ORDER BY {hash_sql(key, salt)} {way}, {key} {way}) <= {many}"


def _messy_ctes() -> str:
    """CTEs from ``candle_text`` to ``marked`` (one row for each row of the messy copy, the
    defects that hit it, and where) and ``messy_rows`` (its cells)."""
    numbers = ["open", "high", "low", "close", "volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume"]
    times = ["open_time", "close_time"]
    volumes = ["volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]
    cells = []
    for c in FIELDNAMES:
        v = qi(c)
        if c in numbers + times:
            v = f"CASE WHEN blank AND blank_at = {(numbers + times).index(c)} THEN NULL ELSE {v} END"
        if c in numbers:
            v = f"CASE WHEN word AND word_at = {numbers.index(c)} THEN ['not_available', 'error', 'missing', 'unknown'][word_is + 1] ELSE {v} END"
        if c in times:
            v = f"CASE WHEN odd_time AND odd_time_at = {times.index(c)} THEN ['not_a_date', '1900-99-99', 'missing_time'][odd_time_is + 1] ELSE {v} END"
        if c in volumes:
            v = f"CASE WHEN negative AND negative_at = {volumes.index(c)} THEN coalesce(CAST(-abs(TRY_CAST({v} AS DECIMAL(38,8))) AS VARCHAR), '-999') ELSE {v} END"
        if c == "symbol":
            v = "CASE WHEN NOT variant THEN symbol WHEN variant_is = 0 THEN lower(symbol) WHEN variant_is = 1 THEN ' ' || symbol || ' ' ELSE replace(symbol, 'USDT', '/USDT') END"
        cells.append(f"{v} AS {qi(c)}")
    return f"""dropping AS (SELECT *, {_first('row_id', 61, '0.03', 5, 'n - 1')} AS dropped FROM (SELECT *, count(*) OVER () AS n FROM candle_text)),
    staying AS (SELECT * EXCLUDE (n, twice), twice FROM (SELECT *, {_first('row_id', 61, '0.03', 5, way='DESC')} AS twice
                FROM (SELECT * EXCLUDE (n), count(*) OVER () AS n FROM dropping WHERE NOT dropped))),
    doubled AS (SELECT *, row_id * 2 AS k FROM staying UNION ALL SELECT *, row_id * 2 + 1 FROM staying WHERE twice),
    marked AS (
        SELECT *, {_first('k', 11, '0.05', 10)} AS blank, {hash_sql('k', 12)} % 11 AS blank_at,
               {_first('k', 21, '0.04', 8)} AS word, {hash_sql('k', 22)} % 9 AS word_at, {hash_sql('k', 23)} % 4 AS word_is,
               {_first('k', 31, '0.03', 6)} AS odd_time, {hash_sql('k', 32)} % 2 AS odd_time_at, {hash_sql('k', 33)} % 3 AS odd_time_is,
               {_first('k', 41, '0.04', 8)} AND symbol IS NOT NULL AS variant, {hash_sql('k', 42)} % 3 AS variant_is,
               {_first('k', 51, '0.03', 6)} AS negative, {hash_sql('k', 52)} % 4 AS negative_at
        FROM (SELECT *, count(*) OVER () AS n FROM doubled)),
    messy AS (SELECT {', '.join(cells)} FROM marked)"""


def _coerced_sql() -> str:
    cols = []
    for c in FIELDNAMES:
        if c == "symbol":
            cols.append(f"{normalise_sql(qi(c))} AS {qi(c)}")
        elif c in NUMERIC_COLS:
            cols.append(f"{safe_double_sql(qi(c))} AS {qi(c)}")
        elif c in TIME_COLS:
            cols.append(f"{safe_ts_sql(qi(c))} AS {qi(c)}")
        else:
            cols.append(qi(c))
    return "SELECT " + ", ".join(cols) + " FROM messy"


REQUESTS_SQL = """SELECT event_id AS request_id, upper(event_type) || 'USDT' AS client, ts AS start_ts,
           make_timestamp(epoch_us(ts) + CAST(floor(value * 60000000.0) AS BIGINT)) AS end_ts,
           TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS records, event_type = 'error' AS failed
    FROM events"""


def log_sql(interval: str = "1h", limit: int = 1000) -> str:
    fmt = "'%Y-%m-%dT%H:%M:%SZ'"
    start = f"strftime(start_ts, {fmt})"
    end = f"strftime(end_ts, {fmt})"
    rid = "CAST(request_id AS VARCHAR)"
    rec = "CAST(records AS VARCHAR)"
    start_line = f"{start} || ' | START request symbol=' || client || ' interval={interval} limit={limit} id=' || {rid}"
    end_line = f"{end} || ' | END request symbol=' || client || ' records=' || {rec} || ' id=' || {rid}"
    done_line = f"{end} || ' | Downloaded ' || client || ': ' || {rec} || ' records'"
    error_line = f"{end} || ' | ERROR request symbol=' || client || ' id=' || {rid} || ': 500 Server Error'"
    return (
        f"SELECT unnest(CASE WHEN failed THEN [{start_line}, {error_line}] "
        f"ELSE [{start_line}, {end_line}, {done_line}] END) AS value FROM requests"
    )


def parsed_sql() -> str:
    def ex(pattern: str) -> str:
        return f"nullif(regexp_extract(msg, {lit(pattern)}, 1), '')"

    return f"""SELECT try_strptime(nullif(stamp, ''), '%Y-%m-%dT%H:%M:%SZ') AS ts,
           kind, {ex('(?:symbol=|^Downloaded )([^:[:space:]]+)')} AS symbol, {ex('interval=([^[:space:]]+)')} AS "interval",
           TRY_CAST({ex('limit=([0-9]+)')} AS BIGINT) AS "limit",
           CASE WHEN kind IN ('END', 'WROTE', 'DOWNLOADED') THEN TRY_CAST({ex('(?:records=|: )([0-9]+)(?: records)?')} AS BIGINT) END AS records,
           TRY_CAST({ex('^RATE_LIMIT wait ([0-9.]+)s')} AS DOUBLE) AS wait_seconds, {ex('csv=([^[:space:]]+)')} AS csv,
           TRY_CAST({ex('[^A-Za-z0-9_]id=([0-9]+)')} AS BIGINT) AS request_id,
           {ex('^ERROR request symbol=[^:[:space:]]+(?: id=[0-9]+)?: (.*)$')} AS error, msg AS message
    FROM (SELECT *, CASE WHEN stamp = '' THEN 'OTHER' WHEN msg LIKE 'START request %' THEN 'START' WHEN msg LIKE 'END request %' THEN 'END'
                         WHEN msg LIKE 'ERROR request %' THEN 'ERROR' WHEN msg LIKE 'RATE_LIMIT wait %' THEN 'RATE_LIMIT'
                         WHEN msg LIKE 'WROTE %' THEN 'WROTE' WHEN msg LIKE 'Downloaded %' THEN 'DOWNLOADED' ELSE 'OTHER' END AS kind
          FROM (SELECT regexp_extract(value, '^([^[:space:]]+) [|] (.*)$', 1) AS stamp,
                       CASE WHEN regexp_matches(value, '^([^[:space:]]+) [|] (.*)$') THEN regexp_extract(value, '^([^[:space:]]+) [|] (.*)$', 2) ELSE value END AS msg
                FROM log_lines))"""


#: The lines of the log without ids, as typed rows in the order they are written (t, k,
#: seq), numbered over the whole log: run, and place among the starts or ends of a symbol.
RUN_LINES = """day_log AS (
        SELECT CAST(start_ts AS DATE) AS day, request_id AS k, client, failed, epoch(date_trunc('second', start_ts))::BIGINT AS t0,
               least(epoch(date_trunc('second', end_ts))::BIGINT, epoch(CAST(start_ts AS DATE) + INTERVAL 1 DAY)::BIGINT - 2) AS t1,
               CASE WHEN request_id % 101 <> 0 THEN records END AS n, records,
               CASE WHEN request_id % 77 <> 0 THEN (request_id % 6000) / 100.0 END AS wait FROM requests),
    days AS (SELECT day, epoch(day)::BIGINT AS t, sum(records)::BIGINT AS n FROM day_log GROUP BY day),
    run_lines AS (
        SELECT *, count(*) FILTER (kind = 'RUN') OVER (ORDER BY t, k, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM (
            SELECT t, -1 AS k, 0 AS seq, 'RUN' AS kind, NULL AS symbol, NULL::BIGINT AS n, NULL::DOUBLE AS wait,
                   CASE WHEN day(day) % 2 = 1 THEN 'serial' ELSE 'multithreaded' END AS mode FROM days
            UNION ALL SELECT t + 86399, -1, 1, 'WROTE', NULL, n, NULL, NULL FROM days
            UNION ALL SELECT t0, k, 0, 'RATE_LIMIT', NULL, NULL, wait, NULL FROM day_log WHERE k % 7 = 0
            UNION ALL SELECT t0, k, 1, 'START', client, NULL, NULL, NULL FROM day_log
            UNION ALL SELECT t1, k, 2, CASE WHEN failed THEN 'ERROR' ELSE 'END' END, client, CASE WHEN NOT failed THEN n END, NULL, NULL FROM day_log
            UNION ALL SELECT t1, k, 3, 'DOWNLOADED', client, n, NULL, NULL FROM day_log WHERE NOT failed))"""


IMPOSSIBLE = "coalesce(volume < 0 OR trade_count < 0 OR high < low, false)"
DERIVED = """high - low AS price_range,
           close - open AS price_change,
           (CASE WHEN open = 0 THEN NULL ELSE (close - open) / open END) * 100 AS percent_change,
           CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down' ELSE 'flat' END AS candle_direction"""


def base_ctes() -> str:
    return f"""WITH candles AS ({candles_sql()}),
    candle_text AS ({_text_sql()}),
    {_messy_ctes()},
    coerced AS ({_coerced_sql()}),
    deduped AS (SELECT DISTINCT * FROM coerced),
    possible AS (SELECT * FROM deduped WHERE NOT {IMPOSSIBLE}),
    cleaned AS (SELECT *, {DERIVED} FROM possible),
    featured AS (SELECT *, CAST(open_time AS DATE) AS trade_date, CAST(hour(open_time) AS INTEGER) AS trade_hour,
                        strftime(open_time, '%a') AS day_of_week FROM cleaned),
    requests AS ({REQUESTS_SQL}),
    log_lines AS ({log_sql()}),
    parsed AS ({parsed_sql()})
    """


def _q(body: str) -> str:
    return base_ctes() + body


ALL17 = FIELDNAMES + ["price_range", "price_change", "percent_change", "candle_direction"]


def _nulls(cols: list[str]) -> str:
    return " + ".join(f"CAST({qi(c)} IS NULL AS BIGINT)" for c in cols)


def _long(rows: list[tuple[str, str]], name_col: str, value_col: str, src: str) -> str:
    parts = [
        f"SELECT {i} AS position, {lit(n)} AS {name_col}, CAST(({expr}) AS BIGINT) AS {value_col} FROM {src}"
        for i, (n, expr) in enumerate(rows)
    ]
    return " UNION ALL ".join(parts)


def _summary_sql() -> str:
    """CTEs ``vol``, ``act`` and ``summary``.

    The symbols of the summary are those that have a range, a trade row and a move each:
    an intersection of three lists.  Every other figure is a subquery of its own.
    """
    ranged, traded = "price_range IS NOT NULL", "trade_count IS NOT NULL AND quote_volume IS NOT NULL"
    moved = "percent_change IS NOT NULL AND candle_direction IS NOT NULL"
    score = score_sql("total_trades", "total_quote_volume")

    def figure(what: str, where: str = "true") -> str:
        return f"(SELECT {what} FROM featured f WHERE f.symbol = s.symbol AND {where})"

    directions = ", ".join(f"{figure('count(*)', moved + f' AND candle_direction = {lit(d)}')} AS {d}_count" for d in ("up", "down", "flat"))
    own = ["avg_price_range", "min_price_range", "max_price_range", "stddev_price_range", "volatility_rank"]
    acts = ["total_trades", "total_quote_volume", "avg_volume", "symbol_activity_score", "symbol_activity_rank"]
    picked = ", ".join(f"(SELECT {c} FROM vol WHERE vol.symbol = s.symbol) AS {c}" for c in own)
    picked += ", " + ", ".join(f"(SELECT {c} FROM act WHERE act.symbol = s.symbol) AS {c}" for c in acts)
    return f"""vol AS (
        SELECT *, CAST(row_number() OVER (ORDER BY avg_price_range DESC NULLS LAST, symbol ASC NULLS FIRST) AS INTEGER) AS volatility_rank
        FROM (SELECT symbol, {xavg('price_range')} AS avg_price_range, min(price_range) AS min_price_range, max(price_range) AS max_price_range,
                     {stddev_sql('price_range')} AS stddev_price_range
              FROM featured WHERE {ranged} GROUP BY symbol)),
    act AS (
        SELECT *, CAST(row_number() OVER (ORDER BY symbol_activity_score DESC NULLS LAST, symbol ASC NULLS FIRST) AS INTEGER) AS symbol_activity_rank
        FROM (SELECT *, {score} AS symbol_activity_score
              FROM (SELECT symbol, sum(trade_count) AS total_trades, {xsum('quote_volume')} AS total_quote_volume, {xavg('volume')} AS avg_volume
                    FROM featured WHERE {traded} GROUP BY symbol))),
    listed AS (SELECT symbol FROM featured WHERE {ranged} INTERSECT SELECT symbol FROM featured WHERE {traded} INTERSECT SELECT symbol FROM featured WHERE {moved}),
    summary AS (
        SELECT symbol, {figure('count(*)')} AS row_count, {picked}, {figure(xavg('percent_change'), moved)} AS avg_percent_change, {directions}
        FROM listed s WHERE symbol IS NOT NULL)
    """


def _sample_sql(seed: int = SEED, n: int = 5) -> str:
    order = ", ".join(f"{qi(c)} ASC NULLS LAST" for c in ALL17)
    not_null = " AND ".join(f"{qi(c)} IS NOT NULL" for c in ALL17)
    return f"""sample AS (
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY
                        md5(concat_ws('|', '{seed}', symbol, CAST(open_time AS VARCHAR))) ASC, {order}) AS INTEGER) AS sample_rank
            FROM cleaned WHERE {not_null}) WHERE sample_rank <= {n})
    """


def _activity_by(key: str, score_name: str) -> str:
    return f"""SELECT {key}, sum(trade_count) AS total_trades, {xsum('quote_volume')} AS total_quote_volume,
           {score_sql('sum(trade_count)', xsum('quote_volume'))} AS {score_name}
    FROM featured WHERE {key} IS NOT NULL GROUP BY {key}"""


def oracle_sql() -> dict[str, str]:
    c13 = ", ".join(qi(c) for c in FIELDNAMES)
    sql: dict[str, str] = {}

    # ------------------------------------------------------------ sources
    sql["candles"] = _q("SELECT * FROM candles")
    sql["epoch_ms_to_ts"] = _q(
        f"""SELECT row_id, epoch_ms(open_time) AS open_time_ms, epoch_ms(epoch_ms(open_time)) AS open_time_utc,
               {iso_sql('epoch_ms(epoch_ms(open_time))')} AS open_time_iso, {iso_sql('close_time')} AS close_time_iso
        FROM candles"""
    )
    sql["union_batches"] = _q(
        f"""SELECT * FROM ({candles_sql("WHERE ts < TIMESTAMP '2024-01-16 00:00:00'")})
        UNION ALL SELECT * FROM ({candles_sql("WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'")})"""
    )
    sql["decode_klines"] = _q(f"SELECT {c13} FROM candles")
    sql["record_count_check"] = _q(
        f"""SELECT count(*) AS records, CAST(count(DISTINCT symbol) * {EXPECTED_CANDLES_PER_SYMBOL} AS BIGINT) AS expected,
               CASE WHEN count(*) = count(DISTINCT symbol) * {EXPECTED_CANDLES_PER_SYMBOL} THEN 'passed' ELSE 'failed' END AS "check"
        FROM candles"""
    )
    listed = " UNION ".join(f"SELECT {lit(s)} AS symbol" for s in SYMBOLS)
    sql["ingest_status"] = _q(
        f""", expected AS ({listed} UNION SELECT DISTINCT upper(event_type) || 'USDT' FROM events),
        got AS (SELECT symbol, count(*) AS records FROM candles GROUP BY symbol)
        SELECT coalesce(e.symbol, g.symbol) AS symbol, CAST(coalesce(g.records, 0) AS BIGINT) AS records,
               CAST({EXPECTED_CANDLES_PER_SYMBOL} AS BIGINT) AS expected,
               CASE WHEN e.symbol IS NULL THEN 'unexpected' WHEN coalesce(g.records, 0) = 0 THEN 'missing'
                    WHEN coalesce(g.records, 0) < {EXPECTED_CANDLES_PER_SYMBOL} THEN 'short' ELSE 'ok' END AS status
        FROM expected e FULL OUTER JOIN got g ON e.symbol = g.symbol"""
    )
    sql["parse_request_log"] = _q("SELECT * FROM parsed")

    # ------------------------------------------------------------ defects
    sql["inject_defects"] = _q("SELECT * FROM messy")
    counters = {
        "original_rows": "FROM candle_text",
        "dropped_rows": "FROM dropping WHERE dropped",
        "duplicated_rows": "FROM staying WHERE twice",
        "missing_values": "FROM marked WHERE blank",
        "text_in_numeric_columns": "FROM marked WHERE word",
        "invalid_times": "FROM marked WHERE odd_time",
        "inconsistent_symbols": "FROM marked WHERE variant",
        "negative_volumes": "FROM marked WHERE negative",
        "final_rows": "FROM marked",
    }
    sql["defect_summary"] = _q(" UNION ALL ".join(f"SELECT {i} AS position, {lit(m)} AS metric, count(*) AS value {src}" for i, (m, src) in enumerate(counters.items())))

    # how many rows each defect takes follows from the number of rows alone
    sql["guarded_defect_summary"] = _q(
        """, a AS (SELECT count(*) AS n FROM candles),
        b AS (SELECT n, greatest(0, least(n - 1, greatest(5, CAST(floor(n * 0.03::DOUBLE) AS BIGINT)))) AS gone FROM a),
        c AS (SELECT n, gone, least(n - gone, greatest(5, CAST(floor((n - gone) * 0.03::DOUBLE) AS BIGINT))) AS again FROM b),
        d AS (SELECT *, n - gone + again AS m FROM c)
        SELECT unnest(range(9))::INTEGER AS position,
               unnest(['original_rows', 'dropped_rows', 'duplicated_rows', 'missing_values', 'text_in_numeric_columns', 'invalid_times',
                       'inconsistent_symbols', 'negative_volumes', 'final_rows']) AS metric,
               unnest([n, gone, again, least(m, greatest(10, CAST(floor(m * 0.05::DOUBLE) AS BIGINT))), least(m, greatest(8, CAST(floor(m * 0.04::DOUBLE) AS BIGINT))),
                       0, least(m, greatest(8, CAST(floor(m * 0.04::DOUBLE) AS BIGINT))), 0, m]) AS value
        FROM d"""
    )

    # ------------------------------------------------------------ cleaning
    num = ", ".join(
        f"{safe_double_sql(qi(c))} AS {qi(c)}" if c in NUMERIC_COLS else qi(c) for c in FIELDNAMES
    )
    sql["coerce_numeric"] = _q(f"SELECT {num} FROM messy")
    sql["coerce_timestamp"] = _q(
        f"""SELECT symbol, open_time AS open_time_text, close_time AS close_time_text,
               {safe_ts_sql('open_time')} AS open_time, {safe_ts_sql('close_time')} AS close_time FROM messy"""
    )
    sql["normalise_symbol"] = _q(f"SELECT symbol AS symbol_text, {normalise_sql('symbol')} AS symbol FROM messy")
    sql["drop_duplicates"] = _q("SELECT * FROM deduped")
    sql["drop_impossible"] = _q("SELECT * FROM possible")
    sql["clean_candles"] = _q("SELECT * FROM cleaned")
    sql["clean_candles_strict"] = _q("SELECT * FROM cleaned WHERE " + " AND ".join(f"{qi(c)} IS NOT NULL" for c in ALL17))
    sql["drop_subset_null"] = _q("SELECT * FROM cleaned WHERE open IS NOT NULL AND close IS NOT NULL AND open_time IS NOT NULL")
    others = [c for c in ALL17 if c not in ("symbol", "interval", "open_time")]
    order = ", ".join(f"{qi(c)} ASC NULLS LAST" for c in others)
    sql["dedup_by_candle_key"] = _q(
        f"""SELECT {', '.join(qi(c) for c in ALL17)} FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol, "interval", open_time ORDER BY ({_nulls(ALL17)}) ASC, {order}) AS rn
            FROM cleaned)
        WHERE rn = 1 OR symbol IS NULL OR "interval" IS NULL OR open_time IS NULL"""
    )
    sql["unknown_symbols"] = _q(
        """SELECT symbol, count(*) AS rows FROM messy m
        WHERE NOT EXISTS (SELECT 1 FROM candles c WHERE c.symbol = m.symbol) GROUP BY symbol"""
    )

    # ------------------------------------------------------------ derived columns
    sql["derived_columns"] = _q(
        f"SELECT row_id, symbol, open_time, {DERIVED} FROM candles"
    )
    sql["ensure_derived"] = _q(f"SELECT row_id, {DERIVED} FROM candles")
    sql["time_features"] = _q("SELECT symbol, open_time, trade_date, trade_hour, day_of_week FROM featured")

    # ------------------------------------------------------------ data quality
    miss = [(c, f"count(*) FILTER (WHERE {qi(c)} IS NULL)") for c in FIELDNAMES]
    sql["missing_by_column"] = _q(
        f""", long AS ({_long(miss, 'column_name', 'missing_count', 'messy')})
        SELECT column_name, missing_count, position,
               position = first_value(position) OVER (ORDER BY missing_count DESC, position ASC) AS most_affected
        FROM long WHERE missing_count > 0"""
    )
    inv = []
    for c in NUMERIC_COLS + TIME_COLS:
        parsed = safe_double_sql(qi(c)) if c in NUMERIC_COLS else safe_ts_sql(qi(c))
        inv.append((c, f"count(*) FILTER (WHERE {qi(c)} IS NOT NULL AND {parsed} IS NULL)"))
    sql["invalid_by_column"] = _q(
        f""", long AS ({_long(inv, 'column_name', 'invalid_count', 'messy')})
        SELECT position, column_name, invalid_count,
               CASE WHEN column_name IN ('open_time', 'close_time') THEN 'timestamp' ELSE 'numeric' END AS kind FROM long"""
    )
    sql["duplicate_count"] = _q(
        f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT {c13}, count(*) AS n FROM coerced GROUP BY ALL)"
    )
    sql["impossible_counts"] = _q(
        f"""SELECT count(*) FILTER (WHERE volume < 0) AS negative_volume,
               count(*) FILTER (WHERE trade_count < 0) AS negative_trade_count,
               count(*) FILTER (WHERE high < low) AS high_below_low,
               count(*) FILTER (WHERE {IMPOSSIBLE}) AS impossible_rows
        FROM deduped"""
    )
    sql["symbol_domain"] = _q(
        f"SELECT count(DISTINCT symbol) AS symbols_before, count(DISTINCT {normalise_sql('symbol')}) AS symbols_after FROM messy"
    )
    sql["symbol_lists"] = _q(
        f"""SELECT 'before' AS stage, symbol, count(*) AS rows FROM messy WHERE symbol IS NOT NULL GROUP BY symbol
        UNION ALL SELECT 'after', {normalise_sql('symbol')}, count(*) FROM messy WHERE symbol IS NOT NULL GROUP BY {normalise_sql('symbol')}"""
    )
    bad_num = " + ".join(f"CAST({qi(c)} IS NOT NULL AND {safe_double_sql(qi(c))} IS NULL AS BIGINT)" for c in NUMERIC_COLS)
    bad_ts = " + ".join(f"CAST({qi(c)} IS NOT NULL AND {safe_ts_sql(qi(c))} IS NULL AS BIGINT)" for c in TIME_COLS)
    report = [
        ("rows_before", "(SELECT count(*) FROM messy)"),
        ("rows_after", "(SELECT count(*) FROM cleaned)"),
        ("missing_before", f"(SELECT sum({_nulls(FIELDNAMES)}) FROM messy)"),
        ("missing_after", f"(SELECT coalesce(sum({_nulls(ALL17)}), 0) FROM cleaned)"),
        ("duplicates_found", "(SELECT count(*) FROM coerced) - (SELECT count(*) FROM deduped)"),
        ("invalid_numeric_cells", f"(SELECT sum({bad_num}) FROM messy)"),
        ("invalid_timestamp_cells", f"(SELECT sum({bad_ts}) FROM messy)"),
        ("negative_volume", "(SELECT count(*) FROM deduped WHERE volume < 0)"),
        ("dropped_impossible", f"(SELECT count(*) FROM deduped WHERE {IMPOSSIBLE})"),
    ]
    sql["dq_report"] = _q(
        " UNION ALL ".join(
            f"SELECT {i} AS position, {lit(n)} AS metric, CAST({e} AS BIGINT) AS value" for i, (n, e) in enumerate(report)
        )
    )
    sql["table_shape"] = _q(f"SELECT count(*) AS rows, {len(FIELDNAMES)} AS columns FROM messy")
    sql["preview"] = _q("SELECT * FROM candles ORDER BY symbol ASC NULLS FIRST, open_time ASC NULLS FIRST LIMIT 10")
    sql["dup_after"] = _q(
        f"""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT {', '.join(qi(c) for c in ALL17)}, count(*) AS n FROM cleaned GROUP BY ALL)"""
    )

    # ------------------------------------------------------------ analytics
    sql["avg_close_by_symbol"] = _q(f"SELECT symbol, {xavg('close')} AS avg_close FROM featured WHERE close IS NOT NULL GROUP BY symbol")
    sql["avg_volume_by_symbol"] = _q(f"SELECT symbol, {xavg('volume')} AS avg_volume FROM featured WHERE volume IS NOT NULL GROUP BY symbol")
    sql["row_count_by_symbol"] = _q("SELECT symbol, count(*) AS row_count FROM featured GROUP BY symbol")
    sql["volatility_ranking"] = _q(", " + _summary_sql().strip().rstrip(",") + " SELECT * FROM vol")
    sql["activity_ranking"] = _q(", " + _summary_sql().strip() + " SELECT * FROM act")
    sql["activity_by_hour"] = _q(_activity_by("trade_hour", "hour_activity_score"))
    sql["activity_by_date"] = _q(_activity_by("trade_date", "date_activity_score"))
    sql["volatility_ranking_display"] = (
        "SELECT symbol, ROUND(avg_price_range, 2) AS avg_price_range, ROUND(min_price_range, 2) AS min_price_range, "
        "ROUND(max_price_range, 2) AS max_price_range, ROUND(stddev_price_range, 2) AS stddev_price_range, volatility_rank "
        f"FROM ({sql['volatility_ranking']}) t"
    )
    sql["avg_close_ordered"] = (
        "SELECT symbol, ROUND(avg_close, 4) AS avg_close, row_number() OVER (ORDER BY symbol NULLS FIRST) - 1 AS position "
        f"FROM ({sql['avg_close_by_symbol']}) t"
    )
    sql["activity_by_hour_ordered"] = (
        "SELECT *, row_number() OVER (ORDER BY hour_activity_score DESC NULLS LAST, trade_hour) - 1 AS position "
        f"FROM ({sql['activity_by_hour']}) t"
    )
    sql["busiest_hour"] = _q(_activity_by("trade_hour", "hour_activity_score") + " ORDER BY hour_activity_score DESC NULLS LAST, trade_hour LIMIT 1")
    sql["busiest_date"] = _q(_activity_by("trade_date", "date_activity_score") + " ORDER BY date_activity_score DESC NULLS LAST, trade_date LIMIT 1")
    sql["busiest_hour_by_trades"] = _q(_activity_by("trade_hour", "hour_activity_score") + " ORDER BY total_trades DESC NULLS LAST, trade_hour LIMIT 1")
    sql["busiest_hour_by_quote_volume"] = _q(
        _activity_by("trade_hour", "hour_activity_score") + " ORDER BY total_quote_volume DESC NULLS LAST, trade_hour LIMIT 1"
    )
    sql["busiest_date_by_trades"] = _q(_activity_by("trade_date", "date_activity_score") + " ORDER BY total_trades DESC NULLS LAST, trade_date LIMIT 1")
    sql["busiest_date_by_quote_volume"] = _q(
        _activity_by("trade_date", "date_activity_score") + " ORDER BY total_quote_volume DESC NULLS LAST, trade_date LIMIT 1"
    )
    sql["market_summary"] = _q(", " + _summary_sql().strip() + " SELECT * FROM summary")
    sql["summary_with_interpretation"] = _q(
        ", " + _summary_sql().strip()
        + """ SELECT *,
               symbol || ': activity #' || CAST(symbol_activity_rank AS VARCHAR) || ', volatility #' || CAST(volatility_rank AS VARCHAR)
               || CASE WHEN symbol_activity_rank = 1 THEN ' (most active)' ELSE '' END
               || CASE WHEN volatility_rank = 1 THEN ' (most volatile)' ELSE '' END AS interpretation
        FROM summary"""
    )
    sql["summary_interpretation"] = _q(
        ", " + _summary_sql().strip()
        + """ SELECT symbol, symbol_activity_rank, volatility_rank,
               symbol || ': activity #' || CAST(symbol_activity_rank AS VARCHAR) || ', volatility #' || CAST(volatility_rank AS VARCHAR)
               || CASE WHEN symbol_activity_rank = 1 THEN ' (most active)' ELSE '' END
               || CASE WHEN volatility_rank = 1 THEN ' (most volatile)' ELSE '' END AS interpretation
        FROM summary"""
    )
    sql["top_symbols"] = _q(
        ", " + _summary_sql().strip()
        + """ SELECT 'activity' AS ranking, symbol FROM summary WHERE symbol_activity_rank = 1
        UNION ALL SELECT 'volatility' AS ranking, symbol FROM summary WHERE volatility_rank = 1"""
    )

    # ------------------------------------------------------------ sample
    s = ", " + _sample_sql().strip()
    sql["balanced_sample"] = _q(s + " SELECT * FROM sample")
    sql["direction_counts"] = _q(s + " SELECT candle_direction, count(*) AS direction_count FROM sample GROUP BY candle_direction")
    sql["sample_avg_close"] = _q(s + f" SELECT symbol, {xavg('close')} AS avg_close FROM sample WHERE close IS NOT NULL GROUP BY symbol")
    sql["top_avg_volume_symbol"] = _q(
        s + f" SELECT symbol, {xavg('volume')} AS avg_volume FROM sample GROUP BY symbol ORDER BY avg_volume DESC NULLS LAST, symbol ASC NULLS FIRST LIMIT 1"
    )
    sql["widest_candle"] = _q(s + " SELECT * FROM sample ORDER BY price_range DESC NULLS LAST, symbol ASC NULLS FIRST, sample_rank ASC LIMIT 1")
    sql["sample_vs_full"] = _q(
        s
        + f""", sa AS (SELECT symbol, {xavg('close')} AS sample_avg_close, {xavg('volume')} AS sample_avg_volume, count(*) AS sample_rows FROM sample GROUP BY symbol HAVING count(close) > 0),
        fa AS (SELECT symbol, {xavg('close')} AS full_avg_close, {xavg('volume')} AS full_avg_volume, count(*) AS full_rows FROM cleaned GROUP BY symbol HAVING count(close) > 0)
        SELECT fa.symbol, full_avg_close, sample_avg_close, sample_avg_close - full_avg_close AS abs_diff,
               (CASE WHEN full_avg_close = 0 THEN NULL ELSE (sample_avg_close - full_avg_close) / full_avg_close END) * 100 AS pct_diff,
               full_avg_volume, sample_avg_volume, full_rows, sample_rows
        FROM fa JOIN sa ON fa.symbol = sa.symbol"""
    )

    # ------------------------------------------------------------ request log
    w_us = RATE_WINDOW_S * 1_000_000
    sql["rate_window_counts"] = _q(
        f"""SELECT request_id, client, start_ts AS ts,
               count(*) OVER (PARTITION BY client ORDER BY epoch_us(start_ts) RANGE BETWEEN {w_us - 1} PRECEDING AND CURRENT ROW) AS in_window,
               count(*) OVER (PARTITION BY client ORDER BY epoch_us(start_ts) RANGE BETWEEN {w_us - 1} PRECEDING AND CURRENT ROW) > {RATE_CAP} AS over_limit
        FROM requests"""
    )
    sql["rate_window_minute"] = _q(
        """, stamped AS (SELECT request_id, client, start_ts AS ts, epoch_us(start_ts) AS t FROM requests)
        SELECT request_id, client, ts, in_window, in_window > 100 AS over_limit FROM (
            SELECT *, count(*) OVER (PARTITION BY client ORDER BY t RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS in_window FROM stamped)"""
    )
    sql["max_concurrency"] = _q(
        """, ev AS (SELECT client, epoch_us(start_ts) AS t, 1 AS d FROM requests
                 UNION ALL SELECT client, epoch_us(end_ts) AS t, -1 AS d FROM requests)
        SELECT client, CAST(max(running) AS BIGINT) AS max_concurrency FROM (
            SELECT client, sum(d) OVER (PARTITION BY client ORDER BY t, d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
            FROM ev) GROUP BY client"""
    )
    sql["concurrency_breaches"] = _q(
        """, ev AS (SELECT client, epoch_us(start_ts) AS t, 1 AS d FROM requests
                 UNION ALL SELECT client, epoch_us(end_ts) AS t, -1 AS d FROM requests)
        SELECT client, count(*) AS requests, count(*) FILTER (running > 5) AS over_cap FROM (
            SELECT client, d, sum(d) OVER (PARTITION BY client ORDER BY t, d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
            FROM ev) WHERE d = 1 GROUP BY client"""
    )
    sql["request_latency"] = _q(
        """SELECT symbol, request_id,
               min(CASE WHEN kind = 'START' THEN ts END) AS start_ts,
               min(CASE WHEN kind <> 'START' THEN ts END) AS end_ts,
               max(CASE WHEN kind = 'END' THEN records END) AS records,
               count(*) FILTER (WHERE kind = 'ERROR') > 0 AS failed,
               (epoch_us(min(CASE WHEN kind <> 'START' THEN ts END)) - epoch_us(min(CASE WHEN kind = 'START' THEN ts END))) / 1000000.0 AS latency_seconds
        FROM parsed WHERE kind IN ('START', 'END', 'ERROR') AND request_id IS NOT NULL GROUP BY symbol, request_id"""
    )
    sql["request_runs"] = _q(
        f""", {RUN_LINES}, tries AS (
            SELECT *, row_number() OVER (PARTITION BY run, symbol, kind = 'START' ORDER BY t, k, seq) AS attempt
            FROM run_lines WHERE kind IN ('START', 'END', 'ERROR')),
        ends AS (SELECT * FROM tries WHERE kind <> 'START'), starts AS (SELECT * FROM tries WHERE kind = 'START')
        SELECT coalesce(s.run, e.run) AS run, coalesce(s.symbol, e.symbol) AS symbol, coalesce(s.attempt, e.attempt) AS attempt,
               make_timestamp(s.t * 1000000) AS start_ts, make_timestamp(e.t * 1000000) AS end_ts, e.n AS records,
               CASE WHEN e.kind = 'ERROR' THEN '500 Server Error' END AS error, coalesce(e.kind = 'ERROR', false) AS failed,
               CAST(e.t - s.t AS DOUBLE) AS latency_seconds
        FROM starts s FULL OUTER JOIN ends e ON s.run = e.run AND s.symbol = e.symbol AND s.attempt = e.attempt"""
    )
    sql["run_report"] = _q(
        f""", {RUN_LINES}
        SELECT run, max(mode) AS mode, make_timestamp(min(t) * 1000000) AS first_ts, make_timestamp(max(t) * 1000000) AS last_ts, count(*) AS lines,
               count(*) FILTER (kind = 'START') AS started, count(*) FILTER (kind = 'END') AS ended, count(*) FILTER (kind = 'ERROR') AS failed,
               CAST(sum(n) FILTER (kind = 'DOWNLOADED') AS BIGINT) AS downloaded_records, count(*) FILTER (kind = 'RATE_LIMIT') AS rate_limit_waits,
               count(*) FILTER (kind = 'RATE_LIMIT' AND wait IS NULL) AS unread_waits, fsum(wait) AS wait_seconds,
               count(*) FILTER (kind = 'WROTE') AS files_written, CAST(sum(n) FILTER (kind = 'WROTE') AS BIGINT) AS written_records
        FROM run_lines GROUP BY run"""
    )
    # ------------------------------------------------------------ files and hand-offs
    sql["scan_messy"] = _q("SELECT * FROM messy")
    sql["scan_nonempty"] = _q("SELECT * FROM candle_text")
    sql["scan_cleaned"] = _q("SELECT * FROM cleaned")
    sql["write_csv"] = "SELECT doc_id, source, text FROM documents"
    sql["write_summary"] = sql["market_summary"]
    sql["rerun_one_day"] = _q("SELECT * FROM cleaned WHERE open_time IS NULL OR CAST(open_time AS DATE) <> DATE '2024-01-10' OR candle_direction <> 'flat'")
    sql["clean_job_reports"] = (
        f"SELECT 'dq_report' AS report, metric AS name, value FROM ({sql['dq_report']}) a "
        f"UNION ALL SELECT 'missing', column_name, missing_count FROM ({sql['missing_by_column']}) b "
        f"UNION ALL SELECT 'most_affected', column_name, missing_count FROM ({sql['missing_by_column']}) c WHERE most_affected "
        f"UNION ALL SELECT 'invalid', column_name, invalid_count FROM ({sql['invalid_by_column']}) d "
        f"UNION ALL SELECT 'impossible', name, value FROM (UNPIVOT ({sql['impossible_counts']}) ON COLUMNS(*) INTO NAME name VALUE value) e"
    )
    sql["kline_outcomes"] = _q(
        """SELECT symbol, CASE WHEN odd THEN 'cells' ELSE 'whole' END AS tag, CASE WHEN odd THEN 'volume' END AS cells,
               count(*) AS records, count(*) FILTER (NOT odd) AS volumes
        FROM (SELECT *, row_id % 59 = 0 OR row_id % 61 = 0 AS odd FROM candles) GROUP BY symbol, odd"""
    )
    sql["symbol_domain_sketch"] = _q(
        f"""SELECT 'symbol' AS column_name, count(DISTINCT symbol) AS exact, count(DISTINCT symbol) AS estimate, true AS within FROM messy
        UNION ALL SELECT 'normalised', count(DISTINCT {normalise_sql('symbol')}), count(DISTINCT {normalise_sql('symbol')}), true FROM messy"""
    )
    sql["market_summary_sql"] = sql["market_summary"]
    sql["symbol_history_sql"] = _q(
        """SELECT trade_date, count(*) AS candles, min(low) AS low, max(high) AS high, CAST(sum(trade_count) AS BIGINT) AS trades,
               count(*) FILTER (candle_direction = 'up') AS moves
        FROM featured WHERE symbol = 'CLICKUSDT' AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY trade_date"""
    )
    return sql
