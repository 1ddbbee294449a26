"""Record layouts and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BINARY, VARIANT = T.BinaryType(), T.VariantType()
INSTANT, WALL_CLOCK = T.TimestampType(), T.TimestampNTZType()
WHOLE, MONEY = T.DecimalType(38, 0), T.DecimalType(18, 4)


# Names, types and order of all record layouts below.


def _layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Envelope of one record as a log topic delivers it.
ENVELOPE = _layout(
    topic=STRING,
    partition=INT,
    offset=LONG,
    timestamp=INSTANT,
    key=BINARY,
    value=BINARY,
)

BRONZE = _layout(
    topic=STRING,
    partition=INT,
    offset=LONG,
    kafka_timestamp=INSTANT,
    message_key=STRING,
    raw_payload=STRING,
    bronze_ingested_at=INSTANT,
)

# JSON payload of one trade.
TRADE = _layout(
    trade_id=STRING,
    symbol=STRING,
    side=STRING,
    quantity=INT,
    price=DOUBLE,
    event_time=STRING,
    ingest_time=STRING,
    exchange=STRING,
    trader_id=STRING,
    sequence=INT,
    schema_version=STRING,
)

CHECKED = T.StructType(
    BRONZE.fields
    + TRADE.fields
    + _layout(event_ts=INSTANT, ingest_ts=INSTANT, validation_error=STRING).fields
)

SILVER = T.StructType(CHECKED.fields + _layout(notional=DOUBLE).fields)

ANOMALY = T.StructType(
    SILVER.fields
    + _layout(
        reference_price=DOUBLE, price_move_pct=DOUBLE, anomaly_reason=STRING, severity=STRING
    ).fields
)

TUMBLING = _layout(
    symbol=STRING,
    trade_count=LONG,
    total_quantity=LONG,
    total_notional=DOUBLE,
    buy_quantity=LONG,
    sell_quantity=LONG,
    min_price=DOUBLE,
    max_price=DOUBLE,
    vwap=DOUBLE,
    window_start=INSTANT,
    window_end=INSTANT,
)

SLIDING = _layout(
    symbol=STRING,
    trade_count=LONG,
    total_quantity=LONG,
    total_notional=DOUBLE,
    vwap=DOUBLE,
    window_start=INSTANT,
    window_end=INSTANT,
)

SESSIONS = _layout(
    symbol=STRING,
    trade_count=LONG,
    total_quantity=LONG,
    total_notional=DOUBLE,
    session_start=INSTANT,
    session_end=INSTANT,
)

DAILY = _layout(
    trade_day=INSTANT,
    symbol=STRING,
    trade_count=LONG,
    total_quantity=LONG,
    total_notional=DOUBLE,
)

MESSAGE = _layout(key=STRING, value=STRING)

# Warehouse side: semi-structured bronze, decimal silver and gold.
VARIANT_BRONZE = _layout(
    record_content=VARIANT,
    record_metadata=VARIANT,
    kafka_received_at=WALL_CLOCK,
)

# Records that the warehouse refuses, with the reason.
VARIANT_REJECTS = _layout(
    record_content=VARIANT,
    record_metadata=VARIANT,
    error_reason=STRING,
    kafka_received_at=WALL_CLOCK,
)

WAREHOUSE_SILVER = _layout(
    trade_id=STRING,
    symbol=STRING,
    side=STRING,
    quantity=WHOLE,
    price=MONEY,
    notional=MONEY,
    event_ts=INSTANT,
    ingest_ts=INSTANT,
    exchange=STRING,
    trader_id=STRING,
    sequence=WHOLE,
    source_offset=WHOLE,
    loaded_at=WALL_CLOCK,
)

# Layout of the warehouse anomaly table; declared for producers, no job fills it.
WAREHOUSE_ANOMALY = _layout(
    trade_id=STRING,
    symbol=STRING,
    side=STRING,
    quantity=WHOLE,
    price=MONEY,
    notional=MONEY,
    event_ts=INSTANT,
    anomaly_reason=STRING,
    severity=STRING,
    loaded_at=WALL_CLOCK,
)

WAREHOUSE_WINDOWS = _layout(
    window_start=INSTANT,
    window_end=INSTANT,
    symbol=STRING,
    trade_count=WHOLE,
    total_quantity=WHOLE,
    total_notional=MONEY,
    vwap=MONEY,
    loaded_at=WALL_CLOCK,
)

# Partition column of stored trades, so that a time range prunes folders.
EVENT_DATE = "event_date"


def dated(layout: T.StructType) -> T.StructType:
    return T.StructType(layout.fields + [T.StructField(EVENT_DATE, T.DateType())])


# Reference price per symbol.
REFERENCE_PRICES = {
    "AAPL": 210.0,
    "MSFT": 450.0,
    "NVDA": 126.0,
    "TSLA": 185.0,
    "AMZN": 190.0,
    "META": 505.0,
    "GOOGL": 176.0,
    "JPM": 205.0,
}


def reference_prices(spark: SparkSession) -> DataFrame:
    """The fixed prices as a relation whose exact size the planner knows."""
    rows = ", ".join(f"('{symbol}', {price}D)" for symbol, price in REFERENCE_PRICES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS prices(symbol, reference_price)")
