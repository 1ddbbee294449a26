"""The layers of the trade tape over a data folder, shared by the registered queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import bars, bronze, silver
from tickloom.schemas import EVENT_DATE
from tickloom.session import prepare, shared_folder, stream_session
from tickloom.sources.event_tape import read_events, to_envelopes
from tickloom.streaming.graph import TradeStreams

# Every symbol of the tape after normalisation, so that pivots have a fixed layout.
SYMBOLS = ("AAPL", "AMZN", "GOOGL", "JPM", "META", "MSFT", "NVDA", "TSLA", "ZZZT")

# Where the batch merges split the tape into an existing table and an increment.
CUT = "2024-01-02 00:00:00"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.to_bronze(to_envelopes(read_events(prepare(spark), sf_dir)))


def checked(spark: SparkSession, sf_dir: str, fields: Iterable[str] | None = None) -> DataFrame:
    return silver.classify(bronze.parse(raw(spark, sf_dir), fields))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedup(silver.accept(checked(spark, sf_dir)))


def stored(spark: SparkSession, df: DataFrame, label: str, by_date: bool = False) -> DataFrame:
    """Write a layer that several consumers share to the cluster's folder and read it back.

    With ``by_date`` it is laid out in folders by event date, which time ranges prune.
    """
    path = shared_folder(spark, label)
    if by_date:
        df = df.withColumn(EVENT_DATE, F.to_date("event_ts")).hint("rebalance", EVENT_DATE)
        df.write.partitionBy(EVENT_DATE).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_valid(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """Silver without the raw payload and other columns no summary needs."""
    columns = ("trade_id", "symbol", "side", "quantity", "price", "notional", "event_ts")
    return stored(spark, valid(spark, sf_dir).select(*columns), "silver", by_date)


def streams(spark: SparkSession, sf_dir: str, **settings) -> TradeStreams:
    """The stream graph over the events table, with fresh tables and checkpoints."""
    session = stream_session(prepare(spark))
    folder = shared_folder(spark, "streams")
    events = read_events(session, sf_dir, stream=True)
    return TradeStreams(session, to_envelopes(events), f"{folder}/tables", f"{folder}/checkpoints", **settings)


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, the form the SQL oracle has."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


def settled(df: DataFrame) -> DataFrame:
    """Round the order-dependent double sum before comparing, and the VWAP that rests on it."""
    rounded = df.withColumn("total_notional", F.round("total_notional", 4))
    if "vwap" in df.columns:
        rounded = rounded.withColumn("vwap", bars.vwap())
    return plain_times(rounded)
