"""Tables behind the monitoring page."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import EVENT_DATE

# The columns shown for an anomaly, in order; the first one sorts.
ANOMALY_DISPLAY = (
    "event_ts",
    "symbol",
    "side",
    "quantity",
    "price",
    "notional",
    "anomaly_reason",
    "severity",
)


def kpis(flagged: DataFrame) -> DataFrame:
    """One row from the flagged trades: trades, anomalies, minute bars, distinct symbols.

    One pass: trades are counted by minute and symbol, and those few rows are counted again.
    """
    by_bar = flagged.groupBy(F.date_trunc("minute", "event_ts").alias("minute"), "symbol").agg(
        F.count("*").alias("trades"),
        F.count_if(F.col("anomaly_reason") != "NORMAL").alias("anomalies"),
    )
    none = F.lit(0).cast("bigint")
    return by_bar.agg(
        F.coalesce(F.sum("trades"), none).alias("valid_trades"),
        F.count_distinct("symbol").alias("symbols"),
        F.coalesce(F.sum("anomalies"), none).alias("anomalies"),
        F.count("*").alias("aggregate_windows"),
    ).select("valid_trades", "anomalies", "aggregate_windows", "symbols")


def kpis_of_tables(trades: DataFrame, anomalies: DataFrame, bars: DataFrame) -> DataFrame:
    """The same row from three stored tables."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    return trades.agg(
        F.count("*").alias("valid_trades"), F.count_distinct("symbol").alias("symbols")
    ).select(
        "valid_trades",
        rows(anomalies).alias("anomalies"),
        rows(bars).alias("aggregate_windows"),
        "symbols",
    )


def pivot_by_symbol(
    bars: DataFrame,
    value: str,
    how: str,
    symbols: Sequence[str] | None = None,
    index: str = "window_start",
) -> DataFrame:
    """One row per time, one column per symbol, ``avg`` or ``sum`` of ``value``, in time order.

    A cell without bars is null. Without ``symbols`` Spark looks them up first and
    refuses more than ``spark.sql.pivotMaxValues`` of them; with them, a bar of a symbol that is not
    listed fails the job, so that none goes missing.
    """
    measure = {"avg": F.avg, "sum": F.sum}[how]
    if symbols:
        unlisted = F.raise_error(F.concat(F.lit("symbol without a column: "), F.col("symbol")))
        listed = F.col("symbol").isNull() | F.col("symbol").isin(*symbols)
        bars = bars.withColumn("symbol", F.when(listed, F.col("symbol")).otherwise(unlisted))
    pivoted = bars.groupBy(index).pivot("symbol", list(symbols) if symbols else None)
    return pivoted.agg(measure(value)).orderBy(index)


def latest(df: DataFrame, columns: Sequence[str] = ANOMALY_DISPLAY) -> DataFrame:
    """The wanted columns that exist, sorted by the first of them, newest first."""
    present = [name for name in columns if name in df.columns]
    ties = [F.asc("trade_id")] if "trade_id" in df.columns else []
    return df.orderBy(F.desc(present[0]), *ties).select(*present)


def recent_bars(
    bars: DataFrame,
    symbols: Sequence[str],
    as_of: Column | None = None,
    span: timedelta = timedelta(minutes=5),
) -> DataFrame:
    """Bars of the listed symbols that start no earlier than ``as_of - span``."""
    as_of = F.current_timestamp() if as_of is None else as_of
    since = as_of - F.expr(f"INTERVAL {span // timedelta(microseconds=1)} MICROSECONDS")
    return bars.filter((F.col("window_start") >= since) & F.col("symbol").isin(*symbols))


def trades_of_recent_bars(
    trades: DataFrame,
    symbols: Sequence[str],
    as_of: Column,
    span: timedelta = timedelta(minutes=5),
) -> DataFrame:
    """The trades that :func:`recent_bars` of their bars rests on: whole minutes, listed symbols.

    Taken before the aggregation, so that only these trades are read; a table partitioned by event
    date is read from the span's first date on.
    """
    since = as_of - F.expr(f"INTERVAL {span // timedelta(microseconds=1)} MICROSECONDS")
    first = F.date_trunc("minute", since)
    if EVENT_DATE in trades.columns:
        trades = trades.filter(F.col(EVENT_DATE) >= F.to_date(first))
    return trades.filter((F.col("event_ts") >= first) & F.col("symbol").isin(*symbols))
