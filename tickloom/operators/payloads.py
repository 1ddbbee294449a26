"""Key and JSON value of the messages sent to downstream topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of each message in order.
ANOMALY_FIELDS = (
    "trade_id",
    "symbol",
    "side",
    "quantity",
    "price",
    "notional",
    "event_ts",
    "anomaly_reason",
    "severity",
    "reference_price",
    "price_move_pct",
)

BAR_FIELDS = (
    "symbol",
    "window_start",
    "window_end",
    "trade_count",
    "total_quantity",
    "total_notional",
    "buy_quantity",
    "sell_quantity",
    "min_price",
    "max_price",
    "vwap",
)


def _message(df: DataFrame, key: Column, *fields: str | Column) -> DataFrame:
    """``to_json`` leaves null fields out of the document."""
    return df.select(key.alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def dead_letters(rejected: DataFrame) -> DataFrame:
    # The fields of the message in order.
    return _message(
        rejected,
        F.col("message_key"),
        "validation_error",
        "raw_payload",
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        "bronze_ingested_at",
    )


def anomaly_messages(anomalies: DataFrame) -> DataFrame:
    return _message(anomalies, F.col("symbol"), *ANOMALY_FIELDS)


def bar_messages(bars: DataFrame) -> DataFrame:
    """The key identifies the bar, so a compacted topic keeps its latest value."""
    key = F.concat_ws("|", F.col("symbol"), F.col("window_start").cast("string"))
    return _message(bars, key, *BAR_FIELDS)
