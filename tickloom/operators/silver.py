"""Validation, the two branches, normalisation and removal of repeated trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rules import Rule, first_label, validation_rules

ARRIVAL = ("kafka_timestamp", "partition", "offset")


def classify(parsed: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``validation_error``: the first broken rule, or null."""
    return parsed.withColumn("validation_error", first_label(rules or validation_rules()))


def reject(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("validation_error").isNotNull())


def accept(checked: DataFrame) -> DataFrame:
    """Rows without an error, symbol in capitals, with their notional."""
    return checked.filter(F.col("validation_error").isNull()).withColumns(
        {
            "symbol": F.upper("symbol"),
            "notional": F.col("quantity") * F.col("price"),
        }
    )


def first_arrival(
    df: DataFrame, keys: Sequence[str] = ("trade_id",), order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """One row per key, the earliest by arrival.

    Spark keeps only the leading row of each key per task before the shuffle
    (``WindowGroupLimit``), so a key that is repeated in a third of the rows sends
    at most one row per task across the network.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def dedup(valid: DataFrame, watermark: str = "2 minutes", mode: str = "exact") -> DataFrame:
    """Remove repeated trade ids from a batch or a stream.

    ``exact`` remembers every id for ever. ``bounded`` forgets an id once the
    watermark has passed it, so its state stays small, but an id that comes back
    later is emitted again. On a batch both mean first arrival. On a stream the rows of one id
    in one micro-batch meet in one task, which reads them one by one and holds only the id; how many
    they are is bounded by the rate limit of the source alone.
    """
    if mode not in ("exact", "bounded"):
        raise ValueError(f"unknown dedup mode {mode!r}")
    if not valid.isStreaming:
        return first_arrival(valid)
    marked = valid.withWatermark("event_ts", watermark)
    if mode == "bounded":
        return marked.dropDuplicatesWithinWatermark(["trade_id"])
    return marked.dropDuplicates(["trade_id"])


def valid_trades(
    parsed: DataFrame,
    rules: Sequence[Rule] | None = None,
    watermark: str = "2 minutes",
    mode: str = "exact",
) -> DataFrame:
    return dedup(accept(classify(parsed, rules)), watermark, mode)
