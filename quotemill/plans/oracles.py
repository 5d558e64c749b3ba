"""The SQL counterpart of each registered query, on the test tables."""

from __future__ import annotations


def _id(topic: str, partition: str, offset: str) -> str:
    digest = f"md5({topic} || '|' || {partition} || '|' || {offset})"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {start}, {length})" for start, length in cuts)


TRADE_ID = _id("'finnhub_stock'", "0", "event_id")
BAR_ID = _id("'yfinance_stock'", "ascii(symbol)", "(epoch(datetime) // 3600)::BIGINT")

TRADES = f"""trades AS (
  SELECT event_id, {TRADE_ID} AS id, event_type, value AS last_price,
         CAST(user_id AS VARCHAR) AS symbol, date_trunc('millisecond', ts) AS datetime,
         CAST(floor(value) AS INTEGER) AS volume
  FROM events)"""

TYPED_TRADES = f"""trades AS (
  SELECT event_id, {TRADE_ID} AS id, value AS last_price, event_type AS symbol,
         date_trunc('millisecond', ts) AS datetime, CAST(floor(value) AS INTEGER) AS volume
  FROM events)"""

FILLS = """fills AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(l_partkey AS VARCHAR) AS symbol,
         l_shipdate AS datetime, l_extendedprice / l_quantity AS last_price,
         CAST(l_quantity AS INTEGER) AS volume, l_quantity AS quantity
  FROM lineitem)"""


def _bars(name: str, source: str, unit: str, ties: str = "id", where: str = "true") -> str:
    return f"""{name} AS (
  SELECT symbol, date_trunc('{unit}', datetime) AS datetime,
         first(last_price ORDER BY datetime, {ties}) AS open, max(last_price) AS high,
         min(last_price) AS low, last(last_price ORDER BY datetime, {ties}) AS close,
         CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trades
  FROM {source} WHERE {where} GROUP BY ALL)"""


HOURLY = f"WITH {TRADES}, {_bars('bars', 'trades', 'hour')}"
DAILY = f"WITH {TRADES}, {_bars('bars', 'trades', 'day')}"
TYPED_HOURLY = f"WITH {TYPED_TRADES}, {_bars('bars', 'trades', 'hour')}"
PROVIDED = (
    f"WITH {TYPED_TRADES}, "
    + _bars("provided", "trades", "hour", where="volume > 0")
)
FILL_TIES = "order_id, line, last_price, volume"

TRADE_ROW = f"""{TRADE_ID} AS id, event_type AS trade_conditions, CAST(value AS FLOAT) AS last_price,
  CAST(user_id AS VARCHAR) AS symbol, date_trunc('millisecond', ts) AS datetime,
  CAST(floor(value) AS INTEGER) AS volume"""

BAR_ROW = f"""{BAR_ID} AS id, datetime, CAST(open AS FLOAT) AS open, CAST(high AS FLOAT) AS high,
  CAST(low AS FLOAT) AS low, CAST(close AS FLOAT) AS close, CAST(close AS FLOAT) AS adj_close,
  CAST(volume AS INTEGER) AS volume, CAST(0 AS FLOAT) AS dividends, CAST(0 AS FLOAT) AS stock_splits,
  symbol AS ticker"""

OUTCOME = """CASE WHEN event_type = 'error' THEN 'decode_error'
  WHEN event_type = 'purchase' AND event_id % 2 <> 0 THEN 'error'
  WHEN event_type = 'signup' THEN 'invalid'
  WHEN event_type <> 'view' AND floor(value) <= 0 THEN 'invalid'
  ELSE 'valid' END"""

REASON = f"""CASE WHEN {OUTCOME} <> 'valid' THEN {OUTCOME}
  WHEN event_type = 'view' THEN 'volume_lossy'
  WHEN event_type = 'purchase' THEN 'time_unreadable' END"""

STORED_TRADES = f"SELECT {TRADE_ROW} FROM events"
STORED_BY_TYPE = f"SELECT * REPLACE (trade_conditions AS symbol) FROM ({STORED_TRADES})"
STORED_BARS = f"{TYPED_HOURLY} SELECT {BAR_ROW} FROM bars"

SQL = {
    "decode_trades": """SELECT event_id AS "offset", event_type AS c, value AS p,
        CAST(user_id AS VARCHAR) AS s, epoch_us(ts) // 1000 AS t, floor(value) AS v FROM events""",
    "decode_bars": f"""{TYPED_HOURLY} SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') || '+00:00' AS datetime,
        open, high, low, close, close AS adj_close, CAST(volume AS DOUBLE) AS volume,
        CAST(0 AS DOUBLE) AS dividends, CAST(0 AS DOUBLE) AS stock_splits, symbol AS ticker FROM bars""",
    "trade_projection": STORED_TRADES,
    "bar_projection": STORED_BARS,
    "epoch_to_timestamp": """SELECT event_id AS "offset", date_trunc('millisecond', ts) AS "at",
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_second FROM events""",
    "deterministic_id": f'SELECT event_id AS "offset", {TRADE_ID} AS id FROM events',
    "random_ids": "SELECT count(*) AS rows, count(*) AS ids, count(*) AS well_formed FROM events",
    "topic_routing": f"""{TYPED_HOURLY}
        SELECT 'stock_trade' AS table_name, count(*) AS rows, CAST(sum(volume) AS BIGINT) AS volume FROM trades
        UNION ALL SELECT 'stock_data', count(*), CAST(sum(volume) AS BIGINT) FROM bars""",
    "message_outcomes": f'SELECT event_id AS "offset", {OUTCOME} AS outcome FROM events',
    "valid_trades": f"{STORED_TRADES} WHERE floor(value) > 0",
    "valid_bars": f"{STORED_BARS} WHERE volume > 0",
    "accepted_trades": f"{STORED_TRADES} WHERE {REASON} IS NULL",
    "quarantined_trades": f"""SELECT event_id AS "offset", {REASON} AS reason FROM events
        WHERE {REASON} IS NOT NULL""",
    "quarantined_bars": f"""{TYPED_HOURLY} SELECT ascii(symbol) AS partition,
        CAST(epoch(datetime) // 3600 AS BIGINT) AS "offset", 'invalid' AS reason
        FROM bars WHERE volume <= 0""",
    "first_valid_message": f"""SELECT 'finnhub_stock' AS topic, 0 AS partition, event_id AS "offset"
        FROM events WHERE {OUTCOME} = 'valid' ORDER BY event_id LIMIT 1""",
    "ingest_trades_stream": STORED_TRADES,
    "ingest_bars_stream": STORED_BARS,
    "ingest_split_stream": f"SELECT {TRADE_ID} AS id, coalesce({REASON}, 'stored') AS side FROM events",
    "ingest_trades_table": STORED_TRADES,
    "ingest_bars_table": STORED_BARS,
    "g01_encode_messages": """SELECT 'finnhub_stock' AS topic, event_id AS "offset",
        '{"c":["' || event_type || '"],"p":' || value || ',"s":"' || user_id || '","t":' || epoch_us(ts) // 1000
        || ',"v":' || floor(value) || '}' AS message FROM events""",
    "g02_quarantine_counts": f"""SELECT coalesce({REASON}, 'stored') AS side, count(*) AS messages
        FROM events GROUP BY ALL""",
    "g03_unique_trades": f"WITH {TRADES} SELECT id, last_price, symbol, datetime, volume FROM trades",
    "g04_unified_quotes": f"""{TYPED_HOURLY}
        SELECT 'trades' AS feed, id, symbol, datetime, last_price AS price, volume,
          CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low FROM trades
        UNION ALL SELECT 'bars', symbol || '@' || CAST(epoch(datetime) AS BIGINT), symbol, datetime,
          close, volume, open, high, low FROM bars""",
    "g05_ohlcv_bars": f"{HOURLY} SELECT * FROM bars",
    "g05_ohlcv_bars_daily_fills": f"WITH {FILLS}, {_bars('bars', 'fills', 'day', FILL_TIES)} SELECT * FROM bars",
    "g06_sliding_stats": f"""WITH {TRADES}, w AS (
          SELECT *, date_trunc('hour', datetime) AS window_start FROM trades
          UNION ALL SELECT *, date_trunc('hour', datetime) - INTERVAL 1 HOUR FROM trades)
        SELECT symbol, window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS trades,
          round(avg(last_price), 9) AS avg_price,
          min(last_price) AS low, max(last_price) AS high, CAST(sum(volume) AS BIGINT) AS volume
        FROM w GROUP BY symbol, window_start""",
    "g07_sessions": f"""WITH {TRADES}, a AS (
          SELECT *, lag(datetime) OVER (PARTITION BY symbol ORDER BY datetime, id) AS before FROM trades),
        b AS (SELECT *, sum(CASE WHEN before IS NULL OR datetime - before > INTERVAL 3 HOUR THEN 1 ELSE 0 END)
          OVER (PARTITION BY symbol ORDER BY datetime, id) AS nr FROM a)
        SELECT symbol, min(datetime) AS session_start, max(datetime) + INTERVAL 3 HOUR AS session_end,
          count(*) AS trades, CAST(sum(volume) AS BIGINT) AS volume FROM b GROUP BY symbol, nr""",
    "g08_resample_bars": f"{DAILY} SELECT symbol, datetime, open, high, low, close, volume FROM bars",
    "g09_vwap": f"""WITH {TRADES} SELECT symbol,
          round(sum(last_price * volume) / nullif(sum(CAST(volume AS DOUBLE)), 0), 9) AS vwap,
          CAST(sum(volume) AS DOUBLE) AS volume, count(*) AS trades FROM trades GROUP BY symbol""",
    "g09_vwap_fills": f"""WITH {FILLS} SELECT symbol, CAST(datetime AS DATE) AS day,
          round(sum(last_price * volume) / nullif(sum(CAST(volume AS DOUBLE)), 0), 9) AS vwap,
          CAST(sum(volume) AS DOUBLE) AS volume, count(*) AS trades FROM fills GROUP BY ALL""",
    "g10_returns": f"""{HOURLY}, p AS (
          SELECT symbol, datetime, close, volume,
            lag(close) OVER (PARTITION BY symbol ORDER BY datetime) AS before FROM bars)
        SELECT symbol, datetime, close, volume, CASE WHEN before > 0 THEN close / before END - 1 AS simple_return,
          CASE WHEN before > 0 AND close > 0 THEN round(ln(close / before), 9) END AS log_return FROM p""",
    "g11_moving_stats": f"""{HOURLY}
        SELECT symbol, datetime, close, volume,
          round(avg(close) OVER w, 9) AS moving_avg,
          round(stddev_samp(close) OVER w, 6) AS volatility
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "g11_moving_stats_trades": f"""WITH {TYPED_TRADES}
        SELECT id, symbol, datetime, last_price,
          round(avg(last_price) OVER w, 9) AS moving_avg,
          round(stddev_samp(last_price) OVER w, 6) AS volatility
        FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY datetime, id
          ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "g12_running_totals": f"""WITH {TYPED_TRADES}, r AS (
          SELECT id, last_price, symbol, datetime, volume, CAST(datetime AS DATE) AS day,
            CAST(sum(volume) OVER w AS BIGINT) AS cumulative_volume, max(last_price) OVER w AS running_high
          FROM trades WINDOW w AS (PARTITION BY symbol, CAST(datetime AS DATE) ORDER BY datetime, id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT *, last_price / nullif(running_high, 0) - 1 AS drawdown FROM r""",
    "g13_ranks": f"""{DAILY}, m AS (
          SELECT symbol, CAST(datetime AS DATE) AS day, close / open - 1 AS change FROM bars WHERE open > 0)
        SELECT *, rank() OVER (PARTITION BY day ORDER BY change DESC) AS rank,
          dense_rank() OVER (PARTITION BY day ORDER BY change DESC) AS dense_rank,
          row_number() OVER (PARTITION BY day ORDER BY change DESC, symbol DESC) AS row_number FROM m""",
    "g13_top_movers": f"""{DAILY} SELECT symbol, datetime, close / open - 1 AS change FROM bars WHERE open > 0
        ORDER BY change DESC, symbol, datetime LIMIT 25""",
    "g13_top_movers_daily": f"""{DAILY}, m AS (
          SELECT symbol, CAST(datetime AS DATE) AS day, close / open - 1 AS change FROM bars WHERE open > 0)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY change DESC, symbol) AS place FROM m)
        WHERE place <= 5""",
    "g14_latest_quotes": f"""WITH {TRADES} SELECT symbol, id, last_price, datetime, volume FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC, id DESC) AS nr FROM trades)
        WHERE nr = 1""",
    "g15_condition_breakdown": """WITH c AS (
          SELECT CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE event_type END AS condition, value FROM events
          UNION ALL SELECT 'odd_lot', value FROM events WHERE event_type = 'click')
        SELECT condition, count(*) AS trades, CAST(sum(floor(value)) AS BIGINT) AS volume FROM c GROUP BY condition""",
    "g15_with_condition": f"""WITH {TRADES} SELECT id, last_price, symbol, datetime, volume FROM trades
        WHERE event_type = 'purchase'""",
    "g16_rollup_report": f"""WITH {TRADES}, d AS (SELECT *, CAST(datetime AS DATE) AS day FROM trades)
        SELECT symbol, day, CAST(grouping(symbol, day) AS INTEGER) AS level, count(*) AS trades,
          CAST(sum(volume) AS BIGINT) AS volume,
          round(sum(last_price * volume), 4) AS notional
        FROM d GROUP BY ROLLUP (symbol, day)""",
    "g17_distinct_symbols": f"""WITH {TRADES} SELECT CAST(datetime AS DATE) AS day,
          count(DISTINCT symbol) AS symbols FROM trades GROUP BY ALL""",
    "g18_as_of_bar": f"""{PROVIDED} SELECT t.id, t.symbol, t.datetime, t.last_price,
          p.datetime AS bar_datetime, p.close AS bar_close
        FROM trades t ASOF LEFT JOIN provided p ON t.symbol = p.symbol AND t.datetime >= p.datetime""",
    "g19_trades_to_bar": f"""{PROVIDED} SELECT t.id, t.symbol, t.datetime, t.last_price,
          p.datetime AS bar_start, p.open AS bar_open, p.close AS bar_close
        FROM trades t JOIN provided p ON t.symbol = p.symbol
          AND t.datetime >= p.datetime AND t.datetime < p.datetime + INTERVAL 1 HOUR""",
    "g20_reconcile_bars": f"""{PROVIDED}, {_bars('ours', 'trades', 'hour')}
        SELECT coalesce(o.symbol, p.symbol) AS symbol, coalesce(o.datetime, p.datetime) AS datetime,
          CASE WHEN p.symbol IS NULL THEN 'theirs' WHEN o.symbol IS NULL THEN 'ours' END AS missing,
          round(o.open - p.open, 4) AS open_diff, round(o.high - p.high, 4) AS high_diff,
          round(o.low - p.low, 4) AS low_diff, round(o.close - p.close, 4) AS close_diff,
          o.volume - p.volume AS volume_diff
        FROM ours o FULL JOIN provided p ON o.symbol = p.symbol AND o.datetime = p.datetime""",
    "g21_valuation": f"""WITH {FILLS}, {TRADES}, quotes AS (
          SELECT symbol, last(last_price ORDER BY datetime, id) AS price FROM trades GROUP BY symbol),
        held AS (SELECT o_custkey AS holder, symbol, sum(quantity) AS quantity
          FROM fills JOIN orders ON o_orderkey = order_id GROUP BY ALL)
        SELECT holder, count(*) AS positions, count(*) FILTER (price IS NULL) AS unquoted,
          round(sum(quantity * price), 4) AS value
        FROM held LEFT JOIN quotes USING (symbol) GROUP BY holder""",
    "g22_adjusted_closes": f"""WITH {FILLS}, bars AS (
          SELECT symbol, datetime, last(last_price ORDER BY {FILL_TIES}) AS close,
            CASE WHEN max(line) = 7 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS stock_splits,
            CASE WHEN count(*) FILTER (line = 6) > 0 THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS dividends
          FROM fills GROUP BY symbol, datetime),
        p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY datetime) AS before,
            CASE WHEN stock_splits > 0 THEN stock_splits ELSE 1.0::DOUBLE END AS ratio FROM bars),
        f AS (SELECT *, CASE WHEN before > 0 AND dividends > 0 AND dividends < before
            THEN 1 - dividends / before ELSE 1.0::DOUBLE END / ratio AS factor FROM p),
        a AS (SELECT *, coalesce(product(factor) OVER (PARTITION BY symbol ORDER BY datetime DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS adjustment FROM f)
        SELECT symbol, datetime, CAST(adjustment AS FLOAT) AS adjustment,
          CAST(close * adjustment AS FLOAT) AS adjusted_close,
          CAST(CASE WHEN before > 0 THEN (close * ratio + dividends) / before - 1 END AS FLOAT) AS total_return FROM a""",
    "g23_gaps": f"""{HOURLY}, n AS (
          SELECT symbol, datetime, lead(datetime) OVER (PARTITION BY symbol ORDER BY datetime) AS following FROM bars)
        SELECT symbol, datetime + INTERVAL 1 HOUR AS gap_start, following AS gap_end,
          CAST((epoch(following) - epoch(datetime)) // 3600 - 1 AS BIGINT) AS missing_bars
        FROM n WHERE following - datetime > INTERVAL 1 HOUR""",
    "g23_filled_bars": f"""{HOURLY}, spine AS (
          SELECT symbol, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime
          FROM bars GROUP BY symbol)
        SELECT s.symbol, s.datetime,
          last_value(b.close IGNORE NULLS) OVER (PARTITION BY s.symbol ORDER BY s.datetime) AS close,
          coalesce(b.volume, 0) AS volume, b.symbol IS NULL AS filled
        FROM spine s LEFT JOIN bars b ON s.symbol = b.symbol AND s.datetime = b.datetime""",
    "g24_never_traded": f"""WITH {TRADES} SELECT CAST(p_partkey AS VARCHAR) AS symbol FROM part
        EXCEPT SELECT symbol FROM trades""",
    "g24_traded": f"""WITH {TRADES} SELECT CAST(p_partkey AS VARCHAR) AS symbol FROM part
        INTERSECT SELECT symbol FROM trades""",
    "g24_both_sources": f"""WITH {TRADES}, {FILLS} SELECT symbol FROM trades
        INTERSECT SELECT symbol FROM fills""",
    "g24_surplus_rows": f"""WITH {TRADES} SELECT symbol, CAST(datetime AS DATE) AS day FROM trades
        EXCEPT ALL SELECT symbol, CAST(datetime AS DATE) FROM trades WHERE event_type = 'purchase'""",
    # A cut-off document gives an all-null row; a quoted or fractional volume is null.
    "g25_trade_quality": """SELECT count(*) AS rows,
          count(*) FILTER (event_type IN ('error', 'signup')) AS no_symbol,
          count(*) FILTER (event_type = 'error' OR (event_type = 'purchase' AND event_id % 2 = 0)) AS no_time,
          count(*) FILTER (event_type = 'error' OR value <= 0) AS no_positive_price,
          count(*) FILTER (event_type IN ('error', 'view') OR (event_type = 'purchase' AND event_id % 2 <> 0)
            OR floor(value) <= 0) AS no_positive_volume
        FROM events""",
    "g25_bar_quality": f"""{HOURLY} SELECT count(*) AS rows,
          count(*) FILTER (symbol IS NULL OR datetime IS NULL) AS no_key,
          count(*) FILTER (NOT high >= low) AS high_below_low,
          count(*) FILTER (NOT (open BETWEEN low AND high AND close BETWEEN low AND high)) AS outside_range,
          count(*) FILTER (NOT volume > 0) AS no_positive_volume FROM bars""",
    "g26_percentiles": f"""WITH {TYPED_TRADES}, r AS (
          SELECT symbol, last_price, row_number() OVER (PARTITION BY symbol ORDER BY last_price) AS nr,
            count(*) OVER (PARTITION BY symbol) AS n FROM trades)
        SELECT symbol, """ + ", ".join(
        f"min(last_price) FILTER (nr * 100 >= n * {p}) AS p{p}" for p in (1, 25, 50, 95, 99)
    ) + " FROM r GROUP BY symbol",
    "g26_outliers": f"""WITH {TYPED_TRADES}, s AS (
          SELECT symbol, avg(last_price) AS mean,
            stddev_samp(last_price) AS dev FROM trades GROUP BY symbol),
        z AS (SELECT id, symbol, last_price, (last_price - mean) / nullif(dev, 0) AS zscore
          FROM trades JOIN s USING (symbol))
        SELECT id, symbol, last_price, round(zscore, 6) AS zscore FROM z WHERE abs(zscore) > 2.5""",
}

ANY_BARS = (("5 minutes", 0), ("1 hour", 30), ("4 hours", 0), ("1 day", 0))

# Units bought and units sold of each symbol, counted along its fills.
LOTS = f"""WITH {FILLS}, u AS (
  SELECT * REPLACE (round(last_price * quantity, 2) AS last_price), line % 2 = 1 AS buy, round(quantity, 6) AS units,
    sum(round(quantity, 6)) OVER (PARTITION BY symbol, line % 2 ORDER BY datetime, order_id, line) AS upto, upto - units AS since
  FROM fills WHERE quantity > 0)"""


def _exponential(source: str, rows: str, price: str, alpha: float, columns: str, order: str) -> str:
    """Average and volatility, row after row of each symbol."""
    return f"""{source}, n AS (
      SELECT {columns}, {price} AS x, row_number() OVER (PARTITION BY symbol ORDER BY {order}) AS nr FROM {rows}),
    walk AS (
      WITH RECURSIVE w AS (
        SELECT symbol, nr, x AS average, CAST(0 AS DOUBLE) AS variance FROM n WHERE nr = 1
        UNION ALL
        SELECT n.symbol, n.nr, {1 - alpha}::DOUBLE * w.average + {alpha}::DOUBLE * n.x,
          {1 - alpha}::DOUBLE * (w.variance + {alpha}::DOUBLE * (n.x - w.average) * (n.x - w.average))
        FROM w JOIN n ON n.symbol = w.symbol AND n.nr = w.nr + 1)
      SELECT * FROM w)
    SELECT {", ".join(f"n.{c.strip()}" for c in columns.split(","))}, round(average, 7) AS average,
      round(sqrt(variance), 7) AS volatility FROM n JOIN walk USING (symbol, nr)"""


TRADE_TYPES = {
    "id": "string", "trade_conditions": "array<string>", "last_price": "float", "symbol": "string",
    "datetime": "timestamp", "volume": "int",
}
BAR_TYPES = {
    "id": "string", "datetime": "timestamp", "open": "float", "high": "float", "low": "float",
    "close": "float", "adj_close": "float", "volume": "int", "dividends": "float",
    "stock_splits": "float", "ticker": "string",
}


def _contract(table: str, types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS type, count({name}) AS filled "
        f"FROM {table}"
        for name, kind in types.items()
    )


# Rows of the trade table that the flawed messages give.
FLAWED = """flawed AS (
  SELECT CASE WHEN event_type = 'signup' THEN '' WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS symbol,
    CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) END AS last_price,
    CASE WHEN event_type NOT IN ('error', 'view') AND NOT (event_type = 'purchase' AND event_id % 2 <> 0)
      THEN CAST(floor(value) AS INTEGER) END AS volume,
    CASE WHEN event_type <> 'error' AND NOT (event_type = 'purchase' AND event_id % 2 = 0)
      THEN date_trunc('millisecond', ts) END AS datetime
  FROM events)"""

SQL |= {
    "ingest_two_checkpoints": STORED_TRADES,
    "g06_sliding_stats_flawed": f"""WITH {FLAWED}, w AS (
          SELECT *, date_trunc('hour', datetime) AS window_start FROM flawed WHERE datetime IS NOT NULL
          UNION ALL SELECT *, date_trunc('hour', datetime) - INTERVAL 1 HOUR FROM flawed WHERE datetime IS NOT NULL)
        SELECT symbol, window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS trades,
          round(avg(last_price), 9) AS avg_price, CAST(min(last_price) AS FLOAT) AS low,
          CAST(max(last_price) AS FLOAT) AS high, CAST(sum(volume) AS BIGINT) AS volume
        FROM w GROUP BY symbol, window_start""",
    "g09_vwap_flawed": f"""WITH {FLAWED} SELECT symbol,
          round(sum(last_price * volume) / nullif(sum(CAST(volume AS DOUBLE)) FILTER (last_price IS NOT NULL), 0), 9) AS vwap,
          sum(CAST(volume AS DOUBLE)) FILTER (last_price IS NOT NULL) AS volume, count(*) AS trades
        FROM flawed GROUP BY symbol""",
    "g09_vwap_scaled": f"""WITH {TRADES}, s AS (SELECT *, unnest([1e-6, 1e9]::DOUBLE[]) AS scale FROM trades)
        SELECT symbol, scale,
          round(sum(last_price * scale * volume) / nullif(sum(CAST(volume AS DOUBLE)), 0) / scale, 9) AS vwap,
          sum(CAST(volume AS DOUBLE)) AS volume, count(*) AS trades FROM s GROUP BY symbol, scale""",
    "g10_returns_stored": f"""{TYPED_HOURLY}, p AS (
          SELECT symbol AS ticker, datetime, CAST(CAST(close AS FLOAT) AS DOUBLE) AS adj_close FROM bars),
        l AS (SELECT *, lag(adj_close) OVER (PARTITION BY ticker ORDER BY datetime) AS before FROM p)
        SELECT ticker, datetime, round(adj_close, 6) AS adj_close,
          round(CASE WHEN before > 0 THEN adj_close / before END - 1, 6) AS simple_return,
          CASE WHEN before > 0 AND adj_close > 0 THEN round(ln(adj_close / before), 6) END AS log_return FROM l""",
    "g17_approx_distinct_symbols": f"WITH {TRADES} SELECT DISTINCT CAST(datetime AS DATE) AS day, true AS close FROM trades",
    "g19_trades_to_shifted_bar": f"""WITH {TYPED_TRADES}, early AS (
          SELECT * REPLACE (datetime - INTERVAL 30 MINUTE AS datetime) FROM trades),
        {_bars("bars", "early", "hour")}
        SELECT t.id, t.symbol, t.datetime, t.last_price, b.datetime + INTERVAL 30 MINUTE AS bar_start,
          b.open AS bar_open, b.close AS bar_close
        FROM trades t JOIN bars b ON t.symbol = b.symbol AND t.datetime >= b.datetime + INTERVAL 30 MINUTE
          AND t.datetime < b.datetime + INTERVAL 90 MINUTE""",
    "g26_approx_percentiles": f"WITH {TYPED_TRADES} SELECT DISTINCT symbol, true AS close FROM trades",
    "g26_outliers_scaled": f"""WITH {TYPED_TRADES}, s AS (
          SELECT symbol, avg(last_price * 1e-6::DOUBLE) AS mean, stddev_samp(last_price * 1e-6::DOUBLE) AS dev
          FROM trades GROUP BY symbol),
        z AS (SELECT id, symbol, (last_price * 1e-6::DOUBLE - mean) / nullif(dev, 0) AS zscore FROM trades JOIN s USING (symbol))
        SELECT id, symbol, round(zscore, 6) AS zscore FROM z WHERE abs(zscore) > 2.5""",
    "table_contract": f"""{TYPED_HOURLY}, stock_trade AS ({STORED_TRADES}),
        stock_data AS (SELECT {BAR_ROW} FROM bars)
        {_contract("stock_trade", TRADE_TYPES)} UNION ALL {_contract("stock_data", BAR_TYPES)}""",
    "g03_unique_trades_stream": f"SELECT * EXCLUDE (trade_conditions) FROM ({STORED_TRADES})",
    "g05_ohlcv_bars_stream": f"""WITH trades AS ({STORED_TRADES}), {_bars("bars", "trades", "hour")}
        SELECT * FROM bars""",
    # A session is final, and written, once the watermark has passed its end.
    "g07_sessions_stream": f"""SELECT * FROM ({SQL["g07_sessions"]})
        WHERE session_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""",
    "g11_exponential": _exponential(HOURLY, "bars", "close", 0.1837, "symbol, datetime, close, volume", "datetime"),
    "g11_exponential_trades": _exponential(
        f"WITH {TYPED_TRADES}", "trades", "last_price", 0.0613, "id, symbol, datetime, last_price", "datetime, id"),
    "g19_trades_to_any_bar": f"""WITH {TYPED_TRADES}, {", ".join(
        f"""b{n} AS (SELECT symbol, time_bucket(INTERVAL {width}, datetime - INTERVAL {shift} MINUTE,
              TIMESTAMP '2000-01-01') + INTERVAL {shift} MINUTE AS bar_start,
            first(last_price ORDER BY datetime, id) AS bar_open, last(last_price ORDER BY datetime, id) AS bar_close
          FROM trades GROUP BY ALL)""" for n, (width, shift) in enumerate(ANY_BARS))},
        b AS ({" UNION ALL ".join(
        f"SELECT *, bar_start + INTERVAL {width} AS bar_end FROM b{n}" for n, (width, _) in enumerate(ANY_BARS))})
        SELECT t.id, t.symbol, t.datetime, t.last_price, bar_start, bar_end, bar_open, bar_close
        FROM trades t JOIN b ON t.symbol = b.symbol AND t.datetime >= bar_start AND t.datetime < bar_end""",
    "g18_as_of_bar_compacted": f"""{PROVIDED} SELECT t.id, t.symbol, t.datetime, CAST(t.last_price AS FLOAT) AS last_price,
          p.datetime AS bar_datetime, p.close AS bar_close
        FROM trades t ASOF LEFT JOIN provided p ON t.symbol = p.symbol AND t.datetime >= p.datetime""",
    "g21_lots": f"""{LOTS} SELECT b.symbol, b.datetime AS buy_datetime, b.order_id AS buy_order_id, b.line AS buy_line,
          round(b.last_price, 4) AS buy_price, s.datetime AS sale_datetime, s.order_id AS sale_order_id,
          s.line AS sale_line, round(s.last_price, 4) AS sale_price,
          CAST(least(b.upto, s.upto) - greatest(b.since, s.since) AS DOUBLE) AS quantity,
          round(CAST(least(b.upto, s.upto) - greatest(b.since, s.since) AS DOUBLE) * (s.last_price - b.last_price), 4) AS gain
        FROM u b JOIN u s ON b.symbol = s.symbol AND b.buy AND NOT s.buy AND b.since < s.upto AND s.since < b.upto""",
    "g21_gains": f"""{LOTS}, m AS (
          SELECT b.symbol, CAST(least(b.upto, s.upto) - greatest(b.since, s.since) AS DOUBLE) AS q,
            s.last_price - b.last_price AS gain
          FROM u b JOIN u s ON b.symbol = s.symbol AND b.buy AND NOT s.buy AND b.since < s.upto AND s.since < b.upto),
        t AS (SELECT symbol, coalesce(max(upto) FILTER (buy), 0) AS bought, coalesce(max(upto) FILTER (NOT buy), 0) AS sold,
          last(last_price ORDER BY datetime, order_id, line) AS quote FROM u GROUP BY symbol),
        o AS (SELECT symbol, last_price, quote, CASE WHEN buy THEN 1 ELSE -1 END
            * CAST(upto - greatest(since, CASE WHEN buy THEN sold ELSE bought END) AS DOUBLE) AS q
          FROM u JOIN t USING (symbol) WHERE upto > CASE WHEN buy THEN sold ELSE bought END),
        c AS (SELECT symbol, sum(q) AS closed, sum(q * gain) AS realised FROM m GROUP BY symbol),
        p AS (SELECT symbol, sum(q) AS open, sum(q * last_price) AS cost, sum(q * (quote - last_price)) AS open_gain
          FROM o GROUP BY symbol)
        SELECT symbol, closed, round(realised, 3) AS realised, open, round(cost, 3) AS cost, round(open_gain, 3) AS open_gain
        FROM c FULL JOIN p USING (symbol)""",
    "g25_quality_in_flight": """SELECT event_id % 3 AS batch_id, count(*) AS rows,
          count(*) FILTER (event_type IN ('error', 'signup')) AS no_symbol,
          count(*) FILTER (event_type = 'error' OR (event_type = 'purchase' AND event_id % 2 = 0)) AS no_time,
          count(*) FILTER (event_type = 'error' OR value <= 0) AS no_positive_price,
          count(*) FILTER (event_type IN ('error', 'view') OR (event_type = 'purchase' AND event_id % 2 <> 0)
            OR floor(value) <= 0) AS no_positive_volume
        FROM events GROUP BY event_id % 3""",
    "g25_flawed_bars": f"""{HOURLY}, h AS (SELECT *, hour(datetime) AS hr FROM bars),
        f AS (SELECT CASE WHEN hr = 11 THEN NULL ELSE symbol END AS symbol, datetime, low, close,
            CASE WHEN hr % 5 = 0 THEN low - 1 ELSE high END AS high,
            CASE WHEN hr % 7 = 0 THEN high + 1 ELSE open END AS open,
            CASE WHEN hr % 3 = 0 THEN 0 ELSE volume END AS volume FROM h)
        SELECT count(*) AS rows, count(*) FILTER (symbol IS NULL OR datetime IS NULL) AS no_key,
          count(*) FILTER (NOT high >= low) AS high_below_low,
          count(*) FILTER (NOT (open BETWEEN low AND high AND close BETWEEN low AND high)) AS outside_range,
          count(*) FILTER (NOT volume > 0) AS no_positive_volume FROM f""",
    "g16_rollup_incremental": f"""WITH d AS (SELECT *, CAST(datetime AS DATE) AS day FROM ({STORED_TRADES}))
        SELECT symbol, day, CAST(grouping(symbol, day) AS INTEGER) AS level, count(*) AS trades,
          CAST(sum(volume) AS BIGINT) AS volume, round(sum(CAST(last_price AS DOUBLE) * volume), 4) AS notional
        FROM d GROUP BY ROLLUP (symbol, day)""",
    "g17_symbols_by_range": f"""WITH {TRADES}, r AS (
          SELECT CAST(a AS DATE) AS first, CAST(b AS DATE) AS last FROM (VALUES
            ('2024-01-01', '2024-01-03'), ('2024-01-02', '2024-01-20'), ('2024-01-01', '2024-12-31')) AS v (a, b))
        SELECT first, last, count(DISTINCT symbol) AS symbols, count(*) AS trades
        FROM trades JOIN r ON CAST(datetime AS DATE) BETWEEN first AND last GROUP BY first, last""",
    "g24_both_sources_sketch": f"""WITH {TRADES}, {FILLS}, a AS (SELECT DISTINCT symbol FROM trades),
        b AS (SELECT DISTINCT symbol FROM fills)
        SELECT (SELECT count(*) FROM a) AS left_symbols, (SELECT count(*) FROM b) AS right_symbols,
          (SELECT count(*) FROM a JOIN b USING (symbol)) AS both""",
    "g26_range_percentiles": f"""WITH {TYPED_TRADES} SELECT symbol, count(*) AS n, true AS close FROM trades
        WHERE CAST(datetime AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-25' GROUP BY symbol""",
    "g05_bar_ladder_stream": " UNION ALL ".join(f"""
        SELECT * FROM (WITH trades AS ({STORED_BY_TYPE}) SELECT '{width}' AS width, symbol,
          time_bucket(INTERVAL {width}, datetime) AS datetime,
          first(last_price ORDER BY datetime, id) AS open, max(last_price) AS high, min(last_price) AS low,
          last(last_price ORDER BY datetime, id) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trades
        FROM trades GROUP BY ALL)""" for width in ("1 minute", "5 minutes", "1 hour")),
    "g18_as_of_bar_stream": f"""{PROVIDED} SELECT t.id, t.symbol, t.datetime, CAST(t.last_price AS FLOAT) AS last_price,
          p.datetime AS bar_datetime, p.close AS bar_close
        FROM trades t ASOF LEFT JOIN provided p ON t.symbol = p.symbol AND t.datetime >= p.datetime""",
    # Own bars hold stored prices, of single precision; the provider's do not.
    "g20_reconcile_bars_stream": f"""{PROVIDED}, stored AS ({STORED_BY_TYPE}), {_bars('ours', 'stored', 'hour')}
        SELECT coalesce(o.symbol, p.symbol) AS symbol, coalesce(o.datetime, p.datetime) AS datetime,
          CASE WHEN p.symbol IS NULL THEN 'theirs' WHEN o.symbol IS NULL THEN 'ours' END AS missing,
          {", ".join(f"round(CAST(o.{v} AS DOUBLE) - p.{v}, 4) AS {v}_diff" for v in ("open", "high", "low", "close"))},
          o.volume - p.volume AS volume_diff
        FROM ours o FULL JOIN provided p ON o.symbol = p.symbol AND o.datetime = p.datetime""",
    "g19_trades_to_bar_stream": f"""{TYPED_HOURLY} SELECT t.id, t.symbol, t.datetime, t.last_price,
          b.datetime AS bar_start, CAST(b.open AS FLOAT) AS bar_open, CAST(b.close AS FLOAT) AS bar_close
        FROM trades t JOIN bars b ON t.symbol = b.symbol AND date_trunc('hour', t.datetime) = b.datetime""",
}
