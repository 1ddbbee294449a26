"""The registered queries once more, as SQL for an independent engine (DuckDB dialect).

Every statement starts from the ``events`` table and states the rules of the trade
tape and of the operator afresh. Nothing here is used by the Spark side.
"""

from __future__ import annotations

TAPE = """
WITH tape AS (
  SELECT e.event_id, e.event_type, e.user_id, e.value, d.replay,
    1704067200000000 + (epoch_us(e.ts) - 1704067200000000) // 20 AS tape_us,
    CAST(regexp_extract(e.props, '-?[0-9]+') AS BIGINT) AS k,
    CASE WHEN e.event_id % 97 <> 0 THEN
      list_value('AAPL','msft','NVDA','TSLA','amzn','META','GOOGL','JPM','zzzt')[e.user_id % 9 + 1]
    END AS symbol,
    list_value(210, 450, 126, 185, 190, 505, 176, 205, 100)[e.user_id % 9 + 1] AS ref
  FROM events e, (VALUES (0), (1)) AS d(replay)
  WHERE d.replay = 0 OR e.event_id % 20 = 0
),
timed AS (
  SELECT *, tape_us - CASE WHEN event_id % 7 = 0 THEN 150000000 ELSE 0 END AS event_us FROM tape
),
trade AS (
  SELECT 'trades' AS topic, CAST(event_id % 6 AS INTEGER) AS "partition",
    (event_id // 6) * 2 + replay AS "offset",
    make_timestamp(tape_us + 2000000 + replay * 345600000000) AS kafka_timestamp,
    coalesce(symbol, 'UNKNOWN') AS message_key,
    CASE WHEN event_id % 101 <> 0 THEN 'trade-' || (100000 + event_id) END AS trade_id,
    symbol,
    CASE WHEN event_type IN ('click', 'signup') THEN 'BUY'
         WHEN event_type IN ('view', 'purchase') THEN 'SELL'
         WHEN event_id % 5 = 0 THEN 'HOLD' ELSE 'BUY' END AS side,
    CAST(k * CASE WHEN event_id % 37 = 0 THEN 1000 ELSE 10 END AS INTEGER) AS quantity,
    CASE WHEN event_id % 89 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST((ref * (35000 + CAST(floor(value * 100 + 0.5) AS BIGINT))) // 4 AS DOUBLE)
              / CAST(10000 AS DOUBLE) END AS price,
    CASE WHEN event_id % 83 = 0 THEN 'not-a-time'
         ELSE strftime(make_timestamp(event_us), '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS event_time,
    CASE WHEN event_id % 83 <> 0 THEN make_timestamp(event_us) END AS event_ts,
    make_timestamp(event_us + 1000000) AS ingest_ts,
    list_value('NYSE', 'NASDAQ', 'IEX', 'CBOE')[event_id % 4 + 1] AS exchange,
    printf('trader-%04d', user_id) AS trader_id,
    event_id AS sequence, '1.0' AS schema_version, replay
  FROM timed
),
checked AS (
  SELECT *, CASE WHEN trade_id IS NULL THEN 'MISSING_TRADE_ID'
    WHEN symbol IS NULL THEN 'MISSING_SYMBOL'
    WHEN side NOT IN ('BUY', 'SELL') THEN 'INVALID_SIDE'
    WHEN quantity IS NULL OR quantity <= 0 THEN 'INVALID_QUANTITY'
    WHEN price IS NULL OR price <= 0 THEN 'INVALID_PRICE'
    WHEN event_ts IS NULL THEN 'INVALID_EVENT_TIME' END AS validation_error
  FROM trade
),
valid AS (
  SELECT * REPLACE (upper(symbol) AS symbol), quantity * price AS notional
  FROM checked WHERE validation_error IS NULL
  QUALIFY row_number() OVER (
    PARTITION BY trade_id ORDER BY kafka_timestamp, "partition", "offset") = 1
)"""

PRICES = """,
prices(symbol, reference_price) AS (VALUES
  ('AAPL', 210::DOUBLE), ('MSFT', 450), ('NVDA', 126), ('TSLA', 185),
  ('AMZN', 190), ('META', 505), ('GOOGL', 176), ('JPM', 205)
),
priced AS (
  SELECT valid.*, reference_price,
    abs(price - reference_price) / reference_price AS price_move_pct
  FROM valid LEFT JOIN prices USING (symbol)
)"""


def _flagged(quantity: str, notional: str, move: str) -> str:
    return f""",
flagged AS (
  SELECT *, CASE WHEN quantity >= {quantity} THEN 'HIGH_QUANTITY'
      WHEN notional >= {notional} THEN 'HIGH_NOTIONAL'
      WHEN price_move_pct >= {move} THEN 'PRICE_DISLOCATION' ELSE 'NORMAL' END AS anomaly_reason,
    CASE WHEN quantity >= {quantity} OR notional >= {notional} THEN 'high'
      WHEN price_move_pct >= {move} THEN 'medium' ELSE 'none' END AS severity
  FROM priced
)"""


FLAGGED = PRICES + _flagged("25000", "1000000", "0.25")

SUMS = """count(*) AS trade_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
    round(sum(notional), 4) AS total_notional"""
VWAP = "round(sum(notional), 4) / CAST(sum(quantity) AS BIGINT) AS vwap"

TUMBLING = f""",
tumbling AS (
  SELECT symbol, {SUMS},
    CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE 0 END) AS BIGINT) AS buy_quantity,
    CAST(sum(CASE WHEN side = 'SELL' THEN quantity ELSE 0 END) AS BIGINT) AS sell_quantity,
    min(price) AS min_price, max(price) AS max_price, {VWAP},
    date_trunc('minute', event_ts) AS window_start,
    date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end
  FROM valid GROUP BY symbol, date_trunc('minute', event_ts)
)"""

SLIDING = f""",
sliding AS (
  SELECT symbol, {SUMS}, {VWAP}, window_start, window_start + INTERVAL 5 MINUTE AS window_end
  FROM (SELECT *, date_trunc('minute', event_ts) - to_minutes(CAST(back AS INTEGER))
          AS window_start
        FROM valid, range(5) AS shifts(back))
  GROUP BY symbol, window_start
)"""

SESSIONS = f""",
gaps AS (
  SELECT *, CASE WHEN event_ts - lag(event_ts) OVER tape_order <= INTERVAL 3 MINUTE
                 THEN 0 ELSE 1 END AS opens
  FROM valid WINDOW tape_order AS (PARTITION BY symbol ORDER BY event_ts)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY symbol ORDER BY event_ts
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM gaps
),
sessions AS (
  SELECT symbol, {SUMS}, min(event_ts) AS session_start,
    max(event_ts) + INTERVAL 3 MINUTE AS session_end
  FROM numbered GROUP BY symbol, run
)"""

# What one run over everything has closed: watermarks count in whole milliseconds.
CLOSED = """(SELECT date_trunc('milliseconds', max(event_ts)) - INTERVAL 2 MINUTE FROM valid)"""

# Contract texts in field order; the tape cannot break the fields that are left out.
CONTRACT = """,
judged AS (
  SELECT *, [
      CASE WHEN trade_id IS NULL THEN 'trade_id: required string' END,
      CASE WHEN symbol IS NULL THEN 'symbol: required string' END,
      CASE WHEN quantity IS NULL THEN 'quantity: required integer' END,
      CASE WHEN quantity < 1 THEN 'quantity: must be >= 1' END,
      CASE WHEN quantity > 1000000 THEN 'quantity: must be <= 1000000' END,
      CASE WHEN price < 0.000001 THEN 'price: must be >= 0.000001' END,
      CASE WHEN event_ts IS NULL THEN 'event_time: invalid datetime' END,
      CASE WHEN side NOT IN ('BUY', 'SELL') THEN 'side: must be BUY or SELL' END
    ] AS errors
  FROM trade
)"""

# Exact warehouse arithmetic on whole numbers of ten-thousandths.
WAREHOUSE = """,
warehouse AS (
  SELECT trade_id, upper(symbol) AS symbol, side, CAST(quantity AS BIGINT) AS quantity,
    CAST(round(price * 10000) AS BIGINT) AS price_units, event_ts, ingest_ts, exchange, trader_id,
    sequence, "offset" AS source_offset, kafka_timestamp
  FROM trade
  WHERE trade_id IS NOT NULL AND symbol IS NOT NULL AND side IN ('BUY', 'SELL')
    AND quantity > 0 AND round(price) > 0 AND event_ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY "offset", event_ts) = 1
)"""

WAREHOUSE_ROWS = """SELECT trade_id, symbol, side, quantity, price_units / 10000::DOUBLE AS price,
    (quantity * price_units) / 10000::DOUBLE AS notional, event_ts, ingest_ts, exchange, trader_id,
    sequence, source_offset FROM warehouse"""


def _minute_bars(where: str) -> str:
    """Quotient rounded half up to ten digits, then to four, both on whole numbers."""
    return f"""
  SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, symbol, trade_count,
    total_quantity, CAST(units AS DOUBLE) / 10000::DOUBLE AS total_notional,
    CAST(((2 * units * 1000000 + total_quantity) // (2 * total_quantity) + 500000) // 1000000
      AS DOUBLE) / 10000::DOUBLE AS vwap
  FROM (
    SELECT date_trunc('minute', event_ts) AS window_start, symbol, count(*) AS trade_count,
      CAST(sum(quantity) AS BIGINT) AS total_quantity,
      sum(CAST(quantity AS HUGEINT) * price_units) AS units
    FROM warehouse WHERE {where} GROUP BY ALL)"""


RECENT = "event_ts >= date_trunc('minute', (SELECT max(event_ts) FROM warehouse) - INTERVAL 2 HOUR)"
CUT = "TIMESTAMP '2024-01-02 00:00:00'"

SYMBOLS = ("AAPL", "AMZN", "GOOGL", "JPM", "META", "MSFT", "NVDA", "TSLA", "ZZZT")


def _pivot(measure: str) -> str:
    cells = ", ".join(f"{measure} FILTER (WHERE symbol = '{s}') AS \"{s}\"" for s in SYMBOLS)
    return TAPE + TUMBLING + f"SELECT window_start, {cells} FROM tumbling GROUP BY window_start"


def _counts(**layers: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS layer, ({count}) AS row_count" for name, count in layers.items()
    )


VALID_ROWS = "SELECT trade_id, symbol, side, quantity, price, notional, event_ts FROM valid"

KPIS = (
    FLAGGED
    + TUMBLING
    + """SELECT count(*) AS valid_trades, count(DISTINCT symbol) AS symbols,
    count(*) FILTER (WHERE anomaly_reason <> 'NORMAL') AS anomalies,
    (SELECT count(*) FROM tumbling) AS aggregate_windows FROM flagged"""
)

DEAD_LETTERS = """SELECT message_key AS key, validation_error, sequence, topic AS source_topic,
    "partition" AS source_partition, "offset" AS source_offset
    FROM checked WHERE validation_error IS NOT NULL"""

ANOMALY_MESSAGES = (
    FLAGGED
    + """SELECT symbol AS key, trade_id, symbol, side, quantity, price, notional,
    date_trunc('milliseconds', event_ts) AS event_ts, anomaly_reason, severity, reference_price,
    price_move_pct FROM flagged WHERE anomaly_reason <> 'NORMAL'"""
)

BAR_MESSAGES = (
    TUMBLING
    + """SELECT symbol || '|' || strftime(window_start, '%Y-%m-%d %H:%M:%S') AS key, *
    FROM tumbling"""
)

_NUMBER = "CAST(substr(trade_id, 7) AS BIGINT)"

ORACLE: dict[str, str] = {
    "bronze_envelope": TAPE
    + """SELECT topic, "partition", "offset", kafka_timestamp, message_key, sequence, event_time
    FROM trade""",
    "parsed_trades": TAPE
    + """SELECT "partition", "offset", trade_id, symbol, side, quantity, price, exchange, trader_id,
    CAST(sequence AS INTEGER) AS sequence, schema_version, event_ts, ingest_ts FROM trade""",
    "validation_outcome": TAPE
    + """SELECT "partition", "offset", trade_id, validation_error FROM checked""",
    "validation_summary": TAPE
    + """SELECT validation_error, count(*) AS rejected FROM checked
    WHERE validation_error IS NOT NULL GROUP BY validation_error""",
    "invalid_trades": TAPE
    + """SELECT "partition", "offset", message_key, symbol, side, quantity, price, validation_error
    FROM checked WHERE validation_error IS NOT NULL""",
    "valid_trades": TAPE
    + """SELECT trade_id, symbol, side, quantity, price, notional, event_ts, "partition", "offset",
    kafka_timestamp FROM valid""",
    "contract_errors": TAPE
    + CONTRACT
    + """SELECT "partition", "offset", text = '' AS valid, text AS errors,
    CASE WHEN text = '' THEN upper(symbol) END AS symbol,
    CASE WHEN text = '' THEN event_ts END AS event_time,
    CASE WHEN text = '' THEN sequence END AS sequence
    FROM (SELECT *, coalesce(array_to_string(errors, '; '), '') AS text FROM judged)""",
    "contract_error_counts": TAPE
    + CONTRACT
    + """SELECT error, count(*) AS violations
    FROM (SELECT unnest(errors) AS error FROM judged) WHERE error IS NOT NULL GROUP BY error""",
    "trades_with_reference_price": TAPE
    + PRICES
    + "SELECT trade_id, symbol, price, reference_price, price_move_pct FROM priced",
    "anomaly_flags": TAPE + FLAGGED + "SELECT trade_id, symbol, anomaly_reason, severity FROM flagged",
    "anomaly_flags_custom": TAPE
    + PRICES
    + _flagged("5000", "250000", "0.1")
    + """SELECT trade_id, symbol, anomaly_reason <> 'NORMAL' AS is_anomaly, anomaly_reason, severity
    FROM flagged""",
    "anomalies": TAPE
    + FLAGGED
    + """SELECT trade_id, symbol, side, quantity, price, notional, event_ts, reference_price,
    price_move_pct, anomaly_reason, severity FROM flagged WHERE anomaly_reason <> 'NORMAL'""",
    "anomaly_summary": TAPE
    + FLAGGED
    + """SELECT anomaly_reason, severity, count(*) AS trades FROM flagged
    GROUP BY anomaly_reason, severity""",
    "latest_anomalies": TAPE
    + FLAGGED
    + """SELECT event_ts, symbol, side, quantity, price, notional, anomaly_reason, severity
    FROM flagged WHERE anomaly_reason <> 'NORMAL' ORDER BY event_ts DESC, trade_id""",
    "tumbling_1m": TAPE + TUMBLING + "SELECT * FROM tumbling",
    "sliding_5m": TAPE + SLIDING + "SELECT * FROM sliding",
    "symbol_sessions": TAPE + SESSIONS + "SELECT * FROM sessions",
    "daily_symbol_rollup": TAPE
    + f"""SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS trade_day, symbol, {SUMS}
    FROM valid GROUP BY ALL""",
    "dead_letter_payload": TAPE + DEAD_LETTERS,
    "anomaly_payload": TAPE + ANOMALY_MESSAGES,
    "aggregate_payload": TAPE + BAR_MESSAGES,
    "variant_bronze": TAPE
    + """SELECT "partition", "offset", trade_id, symbol, CAST(quantity AS BIGINT) AS quantity, price
    FROM trade""",
    "warehouse_silver_decimal": TAPE + WAREHOUSE + WAREHOUSE_ROWS,
    "warehouse_minute_vwap": TAPE + WAREHOUSE + _minute_bars(RECENT),
    "merge_insert_absent": TAPE + WAREHOUSE + WAREHOUSE_ROWS,
    "merge_upsert_windows": TAPE
    + WAREHOUSE
    + f""",
before_cut AS ({_minute_bars(f"event_ts >= {CUT} - INTERVAL 2 HOUR AND event_ts < {CUT}")}),
now AS ({_minute_bars(RECENT)})
SELECT coalesce(n.window_start, b.window_start) AS window_start,
  coalesce(n.window_end, b.window_end) AS window_end, coalesce(n.symbol, b.symbol) AS symbol,
  coalesce(n.trade_count, b.trade_count) AS trade_count,
  coalesce(n.total_quantity, b.total_quantity) AS total_quantity,
  coalesce(n.total_notional, b.total_notional) AS total_notional, coalesce(n.vwap, b.vwap) AS vwap
FROM now n FULL OUTER JOIN before_cut b
  ON n.window_start = b.window_start AND n.symbol = b.symbol""",
    "recent_windows_for_symbols": TAPE
    + TUMBLING
    + """SELECT * FROM tumbling WHERE symbol IN ('AAPL', 'MSFT')
    AND window_start >= (SELECT max(event_ts) FROM valid) - INTERVAL 5 MINUTE""",
    "vwap_pivot": _pivot("avg(vwap)"),
    "notional_pivot": _pivot("sum(total_notional)"),
    "dashboard_kpis": TAPE + KPIS,
    "newest_files_scan": """SELECT event_type, count(*) AS events,
    CAST(sum(user_id) AS BIGINT) AS user_ids FROM events
    WHERE event_id * 5 // ((SELECT max(event_id) FROM events) + 1) >= 2 GROUP BY event_type""",
    "dashboard_from_tables": TAPE + KPIS,
    "dashboard_vwap_from_tables": _pivot("avg(vwap)"),
    "partition_lag": TAPE
    + f"""SELECT ends.topic, ends."partition", committed_offset, high_watermark,
    greatest(high_watermark - committed_offset, 0) AS lag
    FROM (SELECT topic, "partition", max("offset") + 1 AS high_watermark FROM trade GROUP BY ALL) ends
    LEFT JOIN (SELECT topic, "partition", max("offset") + 1 AS committed_offset FROM trade
      WHERE kafka_timestamp < {CUT} GROUP BY ALL) done
    ON ends.topic = done.topic AND ends."partition" = done."partition"
    """,
    "layer_counts": TAPE
    + """SELECT layer, row_count, CAST(2 AS BIGINT) AS expected, row_count >= 2 AS passed FROM (
    SELECT 'bronze' AS layer, count(*) AS row_count FROM trade WHERE trade_id LIKE 'trade-10%'
    UNION ALL SELECT 'silver', count(*) FROM valid WHERE trade_id LIKE 'trade-10%'
    UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT symbol, date_trunc('minute', event_ts)
      FROM valid WHERE trade_id LIKE 'trade-10%'))""",
    "checksum_drill_down": TAPE
    + f"""SELECT date_trunc('minute', event_ts) AS window_start, symbol, count(*) AS left_rows,
    count(*) FILTER (WHERE {_NUMBER} % 777 <> 0) AS right_rows
    FROM valid GROUP BY ALL HAVING count(*) FILTER (WHERE {_NUMBER} % 777 = 0 OR {_NUMBER} % 500 = 0) > 0""",
    "checksum_rows": TAPE
    + f"""SELECT trade_id, price, CAST(1 AS BIGINT) AS extra FROM valid WHERE {_NUMBER} % 777 = 0 OR {_NUMBER} % 500 = 0
    UNION ALL SELECT trade_id, price + 1, -1 FROM valid WHERE {_NUMBER} % 777 <> 0 AND {_NUMBER} % 500 = 0""",
    "output_presence": TAPE
    + """SELECT t.table_name, t.present, t.present AND EXISTS (SELECT 1 FROM valid) AS has_rows
    FROM (VALUES ('silver', true), ('daily', true), ('unwritten', false)) AS t(table_name, present)""",
    "stream_batch_reconciliation": TAPE
    + f""",
days AS (SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS trade_day, symbol, {SUMS}
  FROM valid GROUP BY ALL),
closed AS (SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS trade_day, symbol, {SUMS}
  FROM valid WHERE date_trunc('minute', event_ts) + INTERVAL 1 MINUTE <= {CLOSED} GROUP BY ALL)
SELECT days.trade_day, days.symbol, days.trade_count AS daily_trades,
  closed.trade_count AS bar_trades, days.total_quantity AS daily_quantity,
  closed.total_quantity AS bar_quantity, days.total_notional AS daily_notional,
  closed.total_notional AS bar_notional,
  days.trade_count IS NOT DISTINCT FROM closed.trade_count AS agrees
FROM days LEFT JOIN closed ON days.trade_day = closed.trade_day AND days.symbol = closed.symbol""",
    "stream_bronze_ingest": TAPE
    + """SELECT topic, "partition", "offset", kafka_timestamp, message_key, sequence, event_time, trade_id
    FROM trade""",
    "stream_silver_valid": TAPE + VALID_ROWS,
    "stream_silver_bounded": TAPE + VALID_ROWS,
    "stream_dead_letters": TAPE + DEAD_LETTERS,
    "stream_anomaly_messages": TAPE + ANOMALY_MESSAGES,
    "stream_bar_messages": TAPE + BAR_MESSAGES + f" WHERE window_end <= {CLOSED}",
    "stream_tumbling_closed": TAPE
    + TUMBLING
    + f"SELECT * FROM tumbling WHERE window_end <= {CLOSED}",
    "stream_limited_backlog": TAPE
    + TUMBLING
    + f"SELECT * FROM tumbling WHERE window_end <= {CLOSED}",
    "stream_sliding_closed": TAPE
    + SLIDING
    + f"SELECT * FROM sliding WHERE window_end <= {CLOSED}",
    "stream_sessions_closed": TAPE
    + SESSIONS
    + f"SELECT * FROM sessions WHERE session_end <= {CLOSED}",
    "stream_bronze_to_silver_incremental": TAPE + WAREHOUSE + WAREHOUSE_ROWS,
    "stream_warehouse_windows": TAPE + WAREHOUSE + _minute_bars(RECENT),
    "packed_warehouse_silver": TAPE + WAREHOUSE + WAREHOUSE_ROWS,
    "packed_warehouse_windows": TAPE + WAREHOUSE + _minute_bars(RECENT),
    "compacted_bars": TAPE + BAR_MESSAGES + " WHERE symbol <> 'ZZZT'",
    "stream_reject_counts": TAPE
    + """SELECT validation_error, count(*) AS rejected FROM checked
    WHERE validation_error IS NOT NULL GROUP BY validation_error""",
    "stream_flag_counts": TAPE
    + FLAGGED
    + """SELECT severity, count(*) AS trades FROM flagged WHERE anomaly_reason <> 'NORMAL' GROUP BY severity""",
    "stream_restart_idempotent": TAPE
    + TUMBLING
    + _counts(
        bronze="SELECT count(*) FROM trade",
        silver="SELECT count(*) FROM valid",
        tumbling=f"SELECT count(*) FROM tumbling WHERE window_end <= {CLOSED}",
    ),
    "stream_late_accounting": TAPE
    + _counts(
        bronze="SELECT count(*) FROM trade",
        dead_letters="SELECT count(*) FROM checked WHERE validation_error IS NOT NULL",
        silver="SELECT count(*) FROM valid",
        dropped_late="SELECT count(*) FROM checked WHERE validation_error IS NULL AND replay = 1"
        f" AND event_ts <= {CLOSED}",
    ),
    "stream_progress": TAPE
    + """SELECT 'bronze' AS query, count(*) AS input_rows, CAST(0 AS BIGINT) AS state_rows,
      CAST(0 AS BIGINT) AS dropped_by_watermark FROM events
    UNION ALL SELECT 'silver', (SELECT count(*) FROM trade), (SELECT count(*) FROM valid), 0
    UNION ALL SELECT 'dead_letters', (SELECT count(*) FROM trade), 0, 0""",
}
