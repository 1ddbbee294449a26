"""Time-bucketed measures per symbol: tumbling, sliding, sessions, days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASE = ("trade_count", "total_quantity", "total_notional")
TRADED = (*BASE, "buy_quantity", "sell_quantity", "min_price", "max_price")

_MICROSECOND = timedelta(microseconds=1)


def _side_quantity(side: str) -> Column:
    return F.sum(F.when(F.col("side") == side, F.col("quantity")).otherwise(0))


def _measure(name: str) -> Column:
    return {
        "trade_count": lambda: F.count("*"),
        "total_quantity": lambda: F.sum("quantity"),
        "total_notional": lambda: F.sum("notional"),
        "buy_quantity": lambda: _side_quantity("BUY"),
        "sell_quantity": lambda: _side_quantity("SELL"),
        "min_price": lambda: F.min("price"),
        "max_price": lambda: F.max("price"),
    }[name]().alias(name)


def _remeasure(name: str) -> Column:
    """Combine a measure that already holds partial results."""
    merge = {"min_price": F.min, "max_price": F.max}.get(name, F.sum)
    return merge(name).alias(name)


def vwap() -> Column:
    return F.try_divide("total_notional", "total_quantity").alias("vwap")


def _interval(length: timedelta) -> str:
    return f"{length // _MICROSECOND} microseconds"


def tumbling(
    trades: DataFrame,
    size: timedelta = timedelta(minutes=1),
    measures: Sequence[str] = TRADED,
) -> DataFrame:
    bucket = F.window("event_ts", _interval(size)).alias("bucket")
    totals = trades.groupBy(bucket, "symbol").agg(*map(_measure, measures))
    return totals.select(
        "symbol",
        *measures,
        vwap(),
        F.col("bucket.start").alias("window_start"),
        F.col("bucket.end").alias("window_end"),
    )


def sliding(
    trades: DataFrame,
    size: timedelta = timedelta(minutes=5),
    slide: timedelta = timedelta(minutes=1),
    measures: Sequence[str] = BASE,
) -> DataFrame:
    """Overlapping windows.

    Each trade is first totalled once, into panes as wide as the greatest common
    divisor of size and slide; only the panes are then copied into their windows. On a stream
    that is a chain of two stateful operators: a pane is closed by the watermark and handed on within the same
    micro-batch, so windows close when they would without panes.
    """
    pane = gcd(size // _MICROSECOND, slide // _MICROSECOND) * _MICROSECOND
    panes = trades.groupBy(F.window("event_ts", _interval(pane)).alias("pane"), "symbol").agg(*map(_measure, measures))
    window = F.window(F.window_time("pane"), _interval(size), _interval(slide)).alias("bucket")
    totals = panes.groupBy(window, "symbol").agg(*map(_remeasure, measures))
    return totals.select(
        "symbol",
        *measures,
        vwap(),
        F.col("bucket.start").alias("window_start"),
        F.col("bucket.end").alias("window_end"),
    )


def sessions(
    trades: DataFrame,
    gap: timedelta = timedelta(minutes=3),
    measures: Sequence[str] = BASE,
) -> DataFrame:
    """Runs of trades of one symbol no more than ``gap`` apart; the end is last trade + gap."""
    if trades.isStreaming:
        run = F.session_window("event_ts", _interval(gap)).alias("run")
        return (
            trades.groupBy(run, "symbol")
            .agg(*map(_measure, measures))
            .select(
                "symbol",
                *measures,
                F.col("run.start").alias("session_start"),
                F.col("run.end").alias("session_end"),
            )
        )
    return _batch_sessions(trades, gap, measures)


def _batch_sessions(trades: DataFrame, gap: timedelta, measures: Sequence[str]) -> DataFrame:
    """Sessions from slots of one gap's width.

    Two trades in one slot are less than a gap apart, so a slot never spans two
    sessions and can be totalled before any ordering. What is left to order per
    symbol is bounded by elapsed time / gap, however many trades a symbol has.
    """
    slots = trades.groupBy("symbol", F.window("event_ts", _interval(gap)).alias("slot")).agg(
        *map(_measure, measures),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )
    by_time = Window.partitionBy("symbol").orderBy("first_ts")
    before = F.lag("last_ts").over(by_time)
    starts = before.isNull() | (F.col("first_ts") > before + F.expr(f"INTERVAL {_interval(gap)}"))
    numbered = slots.withColumn("starts", starts.cast("int")).withColumn(
        "run", F.sum("starts").over(by_time)
    )
    return (
        numbered.groupBy("symbol", "run")
        .agg(
            *map(_remeasure, measures),
            F.min("first_ts").alias("session_start"),
            (F.max("last_ts") + F.expr(f"INTERVAL {_interval(gap)}")).alias("session_end"),
        )
        .select("symbol", *measures, "session_start", "session_end")
    )


def daily(trades: DataFrame) -> DataFrame:
    day = F.date_trunc("day", "event_ts").alias("trade_day")
    return trades.groupBy(day, "symbol").agg(*map(_measure, BASE))
