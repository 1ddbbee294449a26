"""Envelope to bronze, bronze to parsed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import TRADE

# The fields that the validation rules look at.
RULE_FIELDS = ("trade_id", "symbol", "side", "quantity", "price", "event_time")


# Names and types of the envelope's columns in bronze.
def to_bronze(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_payload"),
        F.current_timestamp().alias("bronze_ingested_at"),
    )


def parse(bronze: DataFrame, fields: Iterable[str] | None = None) -> DataFrame:
    """Bronze columns plus the declared payload fields and their times as timestamps.

    With ``fields`` only those are read from the JSON; the text is still checked to its end.

    The JSON is read by a generator. Predicates on its output stay above it, whereas
    a projection would let the optimizer copy ``from_json`` into the filter once per
    field the rules mention.
    """
    wanted = set(TRADE.fieldNames() if fields is None else fields)
    unknown = wanted - set(TRADE.fieldNames())
    if unknown:
        raise ValueError(f"no such payload fields: {sorted(unknown)}")
    document = F.from_json("raw_payload", T.StructType([f for f in TRADE.fields if f.name in wanted]))
    times = {"event_ts": "event_time", "ingest_ts": "ingest_time"}
    return bronze.select("*", F.inline(F.array(document))).withColumns(
        {name: F.try_to_timestamp(text) for name, text in times.items() if text in wanted}
    )
