"""Trade envelopes derived from a generic ``events`` table.

Every event becomes one envelope, and one in twenty is delivered a second time at
the end. The modulo terms below choose which *defect* a row carries (missing id,
zero price, late time and so on); none of them drops a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.envelopes import MAX_FILE_AGE

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

TOPIC = "trades"
EPOCH_US = 1_704_067_200_000_000  # 2024-01-01 00:00 UTC
DENSER = 20
REPLAY_DELAY_US = 345_600_000_000  # four days: after the last original

# Symbol as sent and its whole-number reference price, by user_id % 9.
LISTINGS = (
    ("AAPL", 210),
    ("msft", 450),
    ("NVDA", 126),
    ("TSLA", 185),
    ("amzn", 190),
    ("META", 505),
    ("GOOGL", 176),
    ("JPM", 205),
    ("zzzt", 100),
)

# Fixed values of the tape: venue by event_id % 4.
VENUES = ("NYSE", "NASDAQ", "IEX", "CBOE")


def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def read_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events table, as a batch or as a stream.

    Deriving JSON from events costs far more than reading them, so the events are dealt over the
    session's shuffle partitions first, whatever the number of files they come in.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if stream:
        # As a pattern the path may be one file or a folder; a plain file is no stream source.
        events = spark.readStream.schema(EVENTS).option("maxFileAge", MAX_FILE_AGE)
        return events.parquet(f"{sf_dir}/events.parque[t]").repartition(partitions, "event_id")
    return _stored_events(spark, sf_dir).repartition(partitions, "event_id")


def _pick(values, index: str):
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"CAST({index} AS INT) + 1"))


def to_envelopes(events: DataFrame, replays: bool = True, originals: bool = True) -> DataFrame:
    """Envelope rows (topic, partition, offset, timestamp, key, value) for a batch or a stream.

    Replays come from the same scan by exploding a delivery number, so a stream
    needs no union of two sources.
    """
    deliveries = []
    if originals:
        deliveries.append(F.lit(0))
    if replays:
        deliveries.append(F.when(F.col("event_id") % 20 == 0, F.lit(1)))
    delivered = events.select(
        "*", F.explode(F.array_compact(F.array(*deliveries))).alias("replay")
    )

    tape_us = F.expr(
        f"{EPOCH_US} + (unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH_US}) DIV {DENSER}"
    )
    late_us = F.expr("IF(event_id % 7 = 0, 150000000, 0)")
    lots = F.expr("TRY_CAST(get_json_object(props, '$.k') AS INT)")
    staged = delivered.select(
        "event_id",
        "event_type",
        "user_id",
        "replay",
        "value",
        tape_us.alias("tape_us"),
        (tape_us - late_us).alias("event_us"),
        lots.alias("lots"),
        F.when(F.col("event_id") % 97 != 0, _pick([s for s, _ in LISTINGS], "user_id % 9")).alias(
            "symbol"
        ),
        _pick([p for _, p in LISTINGS], "user_id % 9").alias("ref"),
    )

    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
    payload = F.struct(
        F.expr(
            "IF(event_id % 101 = 0, NULL, concat('trade-', CAST(100000 + event_id AS STRING)))"
        ).alias("trade_id"),
        F.col("symbol"),
        F.expr(
            "CASE WHEN event_type IN ('click', 'signup') THEN 'BUY' "
            "WHEN event_type IN ('view', 'purchase') THEN 'SELL' "
            "WHEN event_id % 5 = 0 THEN 'HOLD' ELSE 'BUY' END"
        ).alias("side"),
        F.expr("lots * IF(event_id % 37 = 0, 1000, 10)").alias("quantity"),
        F.expr(
            "IF(event_id % 89 = 0, 0D, "
            "CAST((ref * (35000 + floor(value * 100 + 0.5D))) DIV 4 AS DOUBLE) / 10000D)"
        ).alias("price"),
        F.when(F.col("event_id") % 83 == 0, F.lit("not-a-time"))
        .otherwise(F.date_format(F.timestamp_micros("event_us"), iso))
        .alias("event_time"),
        F.date_format(F.timestamp_micros(F.col("event_us") + 1_000_000), iso).alias("ingest_time"),
        _pick(VENUES, "event_id % 4").alias("exchange"),
        F.format_string("trader-%04d", F.col("user_id")).alias("trader_id"),
        F.col("event_id").alias("sequence"),
        F.lit("1.0").alias("schema_version"),
    )
    return staged.select(
        F.lit(TOPIC).alias("topic"),
        F.expr("CAST(event_id % 6 AS INT)").alias("partition"),
        F.expr("(event_id DIV 6) * 2 + replay").alias("offset"),
        F.timestamp_micros(
            F.col("tape_us") + 2_000_000 + F.col("replay") * F.lit(REPLAY_DELAY_US)
        ).alias("timestamp"),
        F.coalesce("symbol", F.lit("UNKNOWN")).cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
    )
