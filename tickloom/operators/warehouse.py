"""The semi-structured path: variant bronze, decimal silver, minute bars over a trailing span."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import EVENT_DATE, VARIANT_REJECTS

WHOLE = "decimal(38,0)"
MONEY = "decimal(18,4)"


def to_variant(bronze: DataFrame) -> DataFrame:
    """Payload and delivery details as variants; unreadable JSON becomes null."""
    return bronze.select(
        F.try_parse_json("raw_payload").alias("record_content"),
        F.to_variant_object(F.struct("topic", "partition", "offset")).alias("record_metadata"),
        F.current_timestamp().cast("timestamp_ntz").alias("kafka_received_at"),
    )


# Checks in order: reason, and what must hold. The last one refuses trades whose value no
# column can hold, so that a quantity never counts without its notional.
CHECKS = (
    ("MISSING_TRADE_ID", "trade_id IS NOT NULL"),
    ("MISSING_SYMBOL", "symbol IS NOT NULL"),
    ("INVALID_SIDE", "side IN ('BUY', 'SELL')"),
    ("INVALID_QUANTITY", "quantity > 0"),
    ("INVALID_PRICE", "whole_price > 0"),
    ("INVALID_EVENT_TIME", "event_ts IS NOT NULL"),
    ("NOTIONAL_OUT_OF_RANGE", "notional IS NOT NULL"),
)


def _checked_variants(variants: DataFrame) -> DataFrame:
    """The variants, the typed trade and ``error_reason``: the first check that does not hold."""

    def content(field: str, kind: str) -> Column:
        return F.try_variant_get("record_content", f"$.{field}", kind)

    offset = F.try_variant_get("record_metadata", "$.offset", WHOLE)
    typed = F.struct(
        content("trade_id", "string").alias("trade_id"),
        F.upper(content("symbol", "string")).alias("symbol"),
        content("side", "string").alias("side"),
        content("quantity", WHOLE).alias("quantity"),
        content("price", MONEY).alias("price"),
        content("price", WHOLE).alias("whole_price"),
        F.try_to_timestamp(content("event_time", "string")).alias("event_ts"),
        F.try_to_timestamp(content("ingest_time", "string")).alias("ingest_ts"),
        content("exchange", "string").alias("exchange"),
        content("trader_id", "string").alias("trader_id"),
        content("sequence", WHOLE).alias("sequence"),
        offset.alias("source_offset"),
    )
    notional = F.try_multiply(F.col("quantity"), F.col("price")).try_cast(MONEY)
    reason = F.coalesce(*[F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in CHECKS])
    opened = variants.select("*", F.inline(F.array(typed)))
    return opened.withColumn("notional", notional).withColumn("error_reason", reason)


def variant_silver(variants: DataFrame) -> DataFrame:
    """Typed trades that pass the warehouse checks, with exact decimal prices.

    Numbers are rounded to their column's scale, and the positive-price check looks
    at the price as a whole number, so a price below one half is refused. A trade whose
    notional does not fit its column is refused too; see :func:`variant_rejects`.
    """
    return _checked_variants(variants).filter(F.col("error_reason").isNull()).select(
        "trade_id",
        "symbol",
        "side",
        "quantity",
        "price",
        "notional",
        "event_ts",
        "ingest_ts",
        "exchange",
        "trader_id",
        "sequence",
        "source_offset",
    )


def variant_rejects(variants: DataFrame) -> DataFrame:
    """The records that :func:`variant_silver` refuses, as they came, with the first reason."""
    columns = VARIANT_REJECTS.fieldNames()
    return _checked_variants(variants).filter(F.col("error_reason").isNotNull()).select(*columns)


def _of_touched_bars(silver: DataFrame, touched: DataFrame, start: Column) -> DataFrame:
    first, last = touched.agg(F.min(start)).scalar(), touched.agg(F.max(start)).scalar()
    if EVENT_DATE in silver.columns:
        silver = silver.filter(F.col(EVENT_DATE).between(F.to_date(first), F.to_date(last)))
    silver = silver.filter((F.col("event_ts") >= first) & (F.col("event_ts") < last + F.expr("INTERVAL 1 MINUTE")))
    bars = touched.select(start.alias("touched_start"), F.col("symbol").alias("touched_symbol")).distinct()
    return silver.join(bars, (start == F.col("touched_start")) & (F.col("symbol") == F.col("touched_symbol")), "left_semi")


def minute_vwap(
    silver: DataFrame,
    as_of: Column | None = None,
    lookback: timedelta = timedelta(hours=2),
    align_cutoff: bool = True,
    touched: DataFrame | None = None,
) -> DataFrame:
    """Minute bars of the trades since ``as_of - lookback``, in decimals.

    With ``touched``, some trades of the table, only the bars of their minutes and symbols are totalled, and only
    the dates and times between the first and the last of them are read.

    An unaligned cutoff recomputes its first minute from a part of that minute's
    trades, and a later upsert would replace the full total by the partial one; by
    default the cutoff is therefore moved back to the start of its minute. A table that
    is partitioned by event date is read from the cutoff's date on. A total beyond its column is null.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    cutoff = as_of - F.expr(f"INTERVAL {lookback // timedelta(microseconds=1)} MICROSECONDS")
    if align_cutoff:
        cutoff = F.date_trunc("minute", cutoff)
    if EVENT_DATE in silver.columns:
        silver = silver.filter(F.col(EVENT_DATE) >= F.to_date(cutoff))
    start = F.date_trunc("minute", "event_ts")
    since = silver.filter(F.col("event_ts") >= cutoff)
    if touched is not None:
        since = _of_touched_bars(since, touched, start)
    totals = (
        since.groupBy(start.alias("window_start"), "symbol")
        .agg(
            F.count("*").alias("trade_count"),
            F.try_sum("quantity").alias("total_quantity"),
            F.try_sum("notional").alias("total_notional"),
        )
    )
    # Ten fractional digits in the quotient, then rounded to the column's four.
    quotient = F.try_divide(
        F.col("total_notional").try_cast("decimal(38,10)"), F.col("total_quantity").cast(WHOLE)
    )
    return totals.select(
        "window_start",
        (F.col("window_start") + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
        "symbol",
        F.col("trade_count").cast(WHOLE).alias("trade_count"),
        F.col("total_quantity").cast(WHOLE).alias("total_quantity"),
        F.col("total_notional").try_cast(MONEY).alias("total_notional"),
        quotient.try_cast(MONEY).alias("vwap"),
    )
