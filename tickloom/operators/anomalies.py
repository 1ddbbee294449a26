"""Reference prices and anomaly rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import Thresholds, anomaly_rules, first_label, first_severity
from tickloom.schemas import reference_prices


def with_reference_price(trades: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Add ``reference_price`` and ``price_move_pct``; both null for unlisted symbols.

    The default prices are a handful of fixed rows whose size the planner knows. A
    caller's own table is not hinted either: it is broadcast only when its statistics
    are below ``spark.sql.autoBroadcastJoinThreshold``, and joined by shuffle with
    adaptive skew splitting otherwise. A symbol with several rows in it fails the job, as it
    would multiply trades.
    """
    if prices is None:
        prices = reference_prices(trades.sparkSession)
    else:
        doubled = F.raise_error(F.concat(F.lit("several prices of "), F.col("symbol")))
        price = F.when(F.count("*") == 1, F.min("reference_price")).otherwise(doubled)
        prices = prices.groupBy("symbol").agg(price.alias("reference_price"))
    priced = trades.join(prices.select("symbol", "reference_price"), "symbol", "left")
    move = F.try_divide(
        F.abs(F.col("price") - F.col("reference_price")), F.col("reference_price")
    )
    return priced.select(*trades.columns, "reference_price", move.alias("price_move_pct"))


def flag(
    trades: DataFrame,
    prices: DataFrame | None = None,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Add price columns, ``anomaly_reason`` and ``severity`` (first rule wins)."""
    rules = anomaly_rules(thresholds)
    return with_reference_price(trades, prices).withColumns(
        {
            "anomaly_reason": F.coalesce(first_label(rules), F.lit("NORMAL")),
            "severity": F.coalesce(first_severity(rules), F.lit("none")),
        }
    )


def decide(
    trades: DataFrame,
    prices: DataFrame | None = None,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """:func:`flag` plus the boolean ``is_anomaly``."""
    return flag(trades, prices, thresholds).withColumn(
        "is_anomaly", F.col("anomaly_reason") != "NORMAL"
    )


def only_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("anomaly_reason") != "NORMAL")
