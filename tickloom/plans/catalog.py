"""The registered queries: name to a function of (session, data folder)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions.contract import contract_errors
from tickloom.functions.rules import Thresholds
from tickloom.operators import (
    anomalies,
    bars,
    bronze,
    checksums,
    merge,
    payloads,
    quality,
    serving,
    silver,
    warehouse,
)
from tickloom.plans.jobs import rewrite_daily
from tickloom.plans.stages import (
    CUT,
    SYMBOLS,
    checked,
    plain_times,
    raw,
    settled,
    stored,
    stored_valid,
    streams,
    valid,
)
from tickloom.session import prepare, shared_folder, stream_session
from tickloom.sources.envelopes import read_envelopes
from tickloom.sources.event_tape import EVENTS, read_events, to_envelopes
from tickloom.sources.newest_files import newest_files
from tickloom.streaming.compacted import CompactedTopic
from tickloom.streaming.graph import TradeStreams
from tickloom.streaming.increments import ORDER, WarehouseIncrements, latest_event
from tickloom.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALL_FILES = 1_000_000
TRADE_COLUMNS = ("trade_id", "symbol", "side", "quantity", "price", "notional", "event_ts")
CUSTOM = Thresholds(quantity=5_000, notional=250_000.0, price_move=0.1)


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a name clash.

    Registered queries run in a session with the batch settings, whatever the caller's has.
    """

    @functools.wraps(function)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__.rstrip("_")] = prepared
    return function


def _json_fields(messages: DataFrame, ddl: str) -> DataFrame:
    """Message key plus the fields read back from its JSON value."""
    document = F.from_json("value", T.StructType.fromDDL(ddl))
    return messages.select("key", F.inline(F.array(document)))


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals in the form the oracle has: whole numbers as bigint, money as double."""
    decimals = {
        f.name: F.col(f.name).cast("bigint" if f.dataType.scale == 0 else "double")
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    return plain_times(df.withColumns(decimals))


# Bronze and parsing


@query
def bronze_envelope(spark, sf_dir):
    return plain_times(
        raw(spark, sf_dir).select(
            "topic",
            "partition",
            "offset",
            "kafka_timestamp",
            "message_key",
            F.get_json_object("raw_payload", "$.sequence").cast("bigint").alias("sequence"),
            F.get_json_object("raw_payload", "$.event_time").alias("event_time"),
        )
    )


@query
def parsed_trades(spark, sf_dir):
    wanted = [n for n in schemas.TRADE.fieldNames() if n not in ("event_time", "ingest_time")]
    parsed = bronze.parse(raw(spark, sf_dir))
    return plain_times(parsed.select("partition", "offset", *wanted, "event_ts", "ingest_ts"))


# Validation


@query
def validation_outcome(spark, sf_dir):
    return checked(spark, sf_dir).select("partition", "offset", "trade_id", "validation_error")


@query
def validation_summary(spark, sf_dir):
    return quality.validation_summary(checked(spark, sf_dir, bronze.RULE_FIELDS))


@query
def invalid_trades(spark, sf_dir):
    return silver.reject(checked(spark, sf_dir, bronze.RULE_FIELDS)).select(
        "partition", "offset", "message_key", "symbol", "side", "quantity", "price",
        "validation_error",
    )


@query
def valid_trades(spark, sf_dir):
    return plain_times(
        valid(spark, sf_dir).select(*TRADE_COLUMNS, "partition", "offset", "kafka_timestamp")
    )


@query
def contract_errors_(spark, sf_dir):
    judged = contract_errors(raw(spark, sf_dir))
    return plain_times(
        judged.select(
            "partition",
            "offset",
            "valid",
            F.array_join("errors", "; ").alias("errors"),
            F.col("trade.symbol").alias("symbol"),
            F.col("trade.event_time").alias("event_time"),
            F.col("trade.sequence").cast("bigint").alias("sequence"),
        )
    )


@query
def contract_error_counts(spark, sf_dir):
    return quality.contract_error_counts(contract_errors(raw(spark, sf_dir)))


# Anomalies


@query
def trades_with_reference_price(spark, sf_dir):
    priced = anomalies.with_reference_price(valid(spark, sf_dir))
    return priced.select("trade_id", "symbol", "price", "reference_price", "price_move_pct")


@query
def anomaly_flags(spark, sf_dir):
    flagged = anomalies.flag(valid(spark, sf_dir))
    return flagged.select("trade_id", "symbol", "anomaly_reason", "severity")


@query
def anomaly_flags_custom(spark, sf_dir):
    decided = anomalies.decide(valid(spark, sf_dir), thresholds=CUSTOM)
    return decided.select("trade_id", "symbol", "is_anomaly", "anomaly_reason", "severity")


@query
def anomalies_(spark, sf_dir):
    found = anomalies.only_anomalies(anomalies.flag(valid(spark, sf_dir)))
    return plain_times(
        found.select(
            *TRADE_COLUMNS, "reference_price", "price_move_pct", "anomaly_reason", "severity"
        )
    )


@query
def anomaly_summary(spark, sf_dir):
    return quality.anomaly_summary(anomalies.flag(valid(spark, sf_dir)))


@query
def latest_anomalies(spark, sf_dir):
    found = anomalies.only_anomalies(anomalies.flag(valid(spark, sf_dir)))
    return plain_times(serving.latest(found))


# Bars


@query
def tumbling_1m(spark, sf_dir):
    return settled(bars.tumbling(valid(spark, sf_dir)))


@query
def sliding_5m(spark, sf_dir):
    return settled(bars.sliding(valid(spark, sf_dir)))


@query
def symbol_sessions(spark, sf_dir):
    return settled(bars.sessions(valid(spark, sf_dir)))


@query
def daily_symbol_rollup(spark, sf_dir):
    """Replaces the daily table from the silver table, then reads it."""
    folder = shared_folder(prepare(spark), "daily")
    valid(spark, sf_dir).select(*TRADE_COLUMNS).write.parquet(f"{folder}/silver")
    rewrite_daily(spark, f"{folder}/silver", f"{folder}/daily")
    return settled(spark.read.schema(schemas.DAILY).parquet(f"{folder}/daily"))


# Messages


def _dead_letter_fields(messages):
    return _json_fields(
        messages,
        "validation_error STRING, raw_payload STRING, source_topic STRING, "
        "source_partition INT, source_offset BIGINT",
    ).select(
        "key",
        "validation_error",
        F.get_json_object("raw_payload", "$.sequence").cast("bigint").alias("sequence"),
        "source_topic",
        "source_partition",
        "source_offset",
    )


def _anomaly_fields(messages):
    return plain_times(
        _json_fields(
            messages,
            "trade_id STRING, symbol STRING, side STRING, quantity INT, price DOUBLE, "
            "notional DOUBLE, event_ts TIMESTAMP, anomaly_reason STRING, severity STRING, "
            "reference_price DOUBLE, price_move_pct DOUBLE",
        )
    )


@query
def dead_letter_payload(spark, sf_dir):
    return _dead_letter_fields(payloads.dead_letters(silver.reject(checked(spark, sf_dir))))


@query
def anomaly_payload(spark, sf_dir):
    found = anomalies.only_anomalies(anomalies.flag(valid(spark, sf_dir)))
    return _anomaly_fields(payloads.anomaly_messages(found))


@query
def aggregate_payload(spark, sf_dir):
    messages = payloads.bar_messages(bars.tumbling(valid(spark, sf_dir)))
    return settled(_json_fields(messages, schemas.TUMBLING.toDDL()))


# Warehouse


def _variants(spark, sf_dir):
    return warehouse.to_variant(raw(spark, sf_dir))


def _warehouse_silver(spark, sf_dir):
    return silver.first_arrival(
        warehouse.variant_silver(_variants(spark, sf_dir)), ("trade_id",), ORDER
    )


@query
def variant_bronze(spark, sf_dir):
    def content(field, kind):
        return F.try_variant_get("record_content", f"$.{field}", kind).alias(field)

    def metadata(field, kind):
        return F.try_variant_get("record_metadata", f"$.{field}", kind).alias(field)

    return _variants(spark, sf_dir).select(
        metadata("partition", "int"),
        metadata("offset", "bigint"),
        content("trade_id", "string"),
        content("symbol", "string"),
        content("quantity", "bigint"),
        content("price", "double"),
    )


@query
def warehouse_silver_decimal(spark, sf_dir):
    return _doubles(_warehouse_silver(spark, sf_dir))


@query
def warehouse_minute_vwap(spark, sf_dir):
    silver_table = stored(spark, _warehouse_silver(spark, sf_dir), "warehouse-silver", by_date=True)
    return _doubles(warehouse.minute_vwap(silver_table, latest_event(silver_table)))


def _split_trades(spark, sf_dir):
    """A stored table of the trades delivered before the cut, and those after it with repeats."""
    envelopes = raw(spark, sf_dir)
    late = F.col("kafka_timestamp") >= F.lit(CUT).cast("timestamp")
    before, after = (
        warehouse.variant_silver(warehouse.to_variant(envelopes.filter(part)))
        for part in (~late, late)
    )
    current = silver.first_arrival(before, ("trade_id",), ORDER)
    return stored(spark, current, "warehouse-current"), after


@query
def merge_insert_absent(spark, sf_dir):
    current, incoming = _split_trades(spark, sf_dir)
    return _doubles(merge.insert_absent(current, incoming, ("trade_id",), ORDER))


@query
def merge_upsert_windows(spark, sf_dir):
    current, incoming = _split_trades(spark, sf_dir)
    merged = stored(
        spark, merge.insert_absent(current, incoming, ("trade_id",), ORDER), "warehouse-merged", by_date=True
    )
    cut = F.lit(CUT).cast("timestamp")
    newest = F.lit(merged.agg(F.max("event_ts")).first()[0])
    bars_before = warehouse.minute_vwap(merged.filter(F.col("event_ts") < cut), cut)
    return _doubles(merge.upsert(bars_before, warehouse.minute_vwap(merged, newest)))


@query
def recent_windows_for_symbols(spark, sf_dir):
    trades = stored_valid(spark, sf_dir, by_date=True)
    wanted, as_of = ("AAPL", "MSFT"), latest_event(trades)
    recent = serving.trades_of_recent_bars(trades, wanted, as_of)
    return settled(serving.recent_bars(bars.tumbling(recent), wanted, as_of))


# Serving


@query
def vwap_pivot(spark, sf_dir):
    minute = settled(bars.tumbling(valid(spark, sf_dir)))
    return serving.pivot_by_symbol(minute, "vwap", "avg", SYMBOLS)


@query
def notional_pivot(spark, sf_dir):
    minute = settled(bars.tumbling(valid(spark, sf_dir)))
    return serving.pivot_by_symbol(minute, "total_notional", "sum", SYMBOLS)


@query
def dashboard_kpis(spark, sf_dir):
    return serving.kpis(anomalies.flag(valid(spark, sf_dir)))


def _landed_events(spark, sf_dir, files):
    """The events as that many files, ever newer ones: the n-th holds the n-th range of ids."""
    folder = shared_folder(spark, "newest")
    events = read_events(spark, sf_dir)
    share = F.floor(F.col("event_id") * files / (F.lit(events.agg(F.max("event_id")).first()[0]) + 1))
    numbered = events.withColumn("n", share).repartitionByRange(files, "n")
    for n in range(files):
        numbered.filter(F.col("n") == n).drop("n").coalesce(1).write.mode("append").parquet(f"{folder}/{n}")
    return folder


@query
def newest_files_scan(spark, sf_dir):
    """Rows in the newest three of five files; file times have milliseconds, so five suffice."""
    found = newest_files(spark, _landed_events(spark, sf_dir, 5), EVENTS, 3)
    return found.rows.groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum("user_id").alias("user_ids")
    )


def _dashboard(spark, sf_dir):
    """Silver, anomalies and bars as written tables, each read through its newest files."""
    folder = shared_folder(spark, "dashboard")
    # Derived once: the three layers start from the stored one.
    flagged = anomalies.flag(stored_valid(spark, sf_dir))
    layers = {
        "silver": flagged.select(*TRADE_COLUMNS),
        "anomalies": anomalies.only_anomalies(flagged).select("trade_id", "anomaly_reason"),
        "bars": settled(bars.tumbling(flagged)),
    }
    read = {}
    for name, rows in layers.items():
        rows.hint("rebalance").write.parquet(f"{folder}/{name}")
        # The newest files are all there are here, however many a large tape takes.
        read[name] = newest_files(spark, f"{folder}/{name}", rows.schema, ALL_FILES).rows
    return read


@query
def dashboard_from_tables(spark, sf_dir):
    tables = _dashboard(spark, sf_dir)
    return serving.kpis_of_tables(tables["silver"], tables["anomalies"], tables["bars"])


@query
def dashboard_vwap_from_tables(spark, sf_dir):
    return serving.pivot_by_symbol(_dashboard(spark, sf_dir)["bars"], "vwap", "avg", SYMBOLS)


# Quality


@query
def partition_lag(spark, sf_dir):
    """Lag of a consumer that has read every record delivered before the cut."""
    envelopes = raw(spark, sf_dir)
    consumed = envelopes.filter(F.col("kafka_timestamp") < F.lit(CUT).cast("timestamp"))
    committed = quality.end_offsets(consumed).withColumnRenamed(
        "high_watermark", "committed_offset"
    )
    return quality.partition_lag(quality.end_offsets(envelopes), committed)


@query
def layer_counts(spark, sf_dir):
    """Rows of one id prefix in bronze and silver, and their minute bars."""
    prefix = "trade-10"
    bronze_rows = quality.with_prefix(
        raw(spark, sf_dir), prefix, F.get_json_object("raw_payload", "$.trade_id")
    )
    silver_rows = quality.with_prefix(stored_valid(spark, sf_dir), prefix)
    layers = {"bronze": bronze_rows, "silver": silver_rows, "gold": bars.tumbling(silver_rows)}
    return quality.layer_counts(layers, {"bronze": 2, "silver": 2, "gold": 2})


@query
def checksum_drill_down(spark, sf_dir):
    """Bars in which a copy of silver differs: some trades have another price, some are missing."""
    trades = stored_valid(spark, sf_dir, by_date=True)
    number = F.substring("trade_id", 7, 20).cast("bigint")
    copy = trades.where(number % 777 != 0).withColumn("price", F.when(number % 500 == 0, F.col("price") + 1).otherwise(F.col("price")))
    return plain_times(checksums.differing_bars(trades, copy, TRADE_COLUMNS))


@query
def checksum_rows(spark, sf_dir):
    """The trades that differ, found through their bars."""
    trades = stored_valid(spark, sf_dir, by_date=True)
    number = F.substring("trade_id", 7, 20).cast("bigint")
    copy = trades.where(number % 777 != 0).withColumn("price", F.when(number % 500 == 0, F.col("price") + 1).otherwise(F.col("price")))
    return checksums.differing_rows(trades, copy, ("trade_id", "symbol", "event_ts", "price")).select("trade_id", "price", "extra")


@query
def output_presence(spark, sf_dir):
    """Writes silver and the daily table, then checks both and a table that is not there."""
    folder = shared_folder(prepare(spark), "presence")
    paths = {name: f"{folder}/{name}" for name in ("silver", "daily", "unwritten")}
    valid(spark, sf_dir).select(*TRADE_COLUMNS).write.parquet(paths["silver"])
    rewrite_daily(spark, paths["silver"], paths["daily"])
    return quality.output_presence(spark, paths)


@query
def stream_batch_reconciliation(spark, sf_dir):
    """Bars a stream has closed so far, added up by day, against the batch rollup of its silver."""
    graph = streams(spark, sf_dir)
    graph.run_available(["tumbling"])
    spark = graph.spark
    return plain_times(
        quality.reconcile(graph.table("tumbling"), bars.daily(graph.table("silver")))
    )


# Streams


@query
def stream_bronze_ingest(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["bronze"])
    return plain_times(
        graph.table("bronze").select(
            "topic",
            "partition",
            "offset",
            "kafka_timestamp",
            "message_key",
            F.get_json_object("raw_payload", "$.sequence").cast("bigint").alias("sequence"),
            F.get_json_object("raw_payload", "$.event_time").alias("event_time"),
            F.get_json_object("raw_payload", "$.trade_id").alias("trade_id"),
        )
    )


def _stream_silver(spark, sf_dir, mode):
    graph = streams(spark, sf_dir, dedup=mode)
    graph.run_available(["silver"])
    return plain_times(graph.table("silver").select(*TRADE_COLUMNS))


@query
def stream_silver_valid(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "exact")


@query
def stream_silver_bounded(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "bounded")


@query
def stream_dead_letters(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["dead_letters"])
    return _dead_letter_fields(graph.table("dead_letters"))


@query
def stream_anomaly_messages(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["anomaly_messages"])
    return _anomaly_fields(graph.table("anomaly_messages"))


@query
def stream_bar_messages(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["bar_messages"])
    return settled(_json_fields(graph.table("bar_messages"), schemas.TUMBLING.toDDL()))


@query
def stream_tumbling_closed(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["tumbling"])
    return settled(graph.table("tumbling"))


@query
def stream_limited_backlog(spark, sf_dir):
    """Closed bars of a graph that takes one file of a table at a time, as of one without limits."""
    graph = streams(spark, sf_dir, hand_over=3, read_options={"maxFilesPerTrigger": "1"})
    graph.run_available(["tumbling"])
    return settled(graph.table("tumbling"))


@query
def stream_sliding_closed(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["sliding"])
    return settled(graph.table("sliding"))


@query
def stream_sessions_closed(spark, sf_dir):
    graph = streams(spark, sf_dir)
    graph.run_available(["sessions"])
    return settled(graph.table("sessions"))


def _two_deliveries(spark, sf_dir):
    """Land the first deliveries, and return a function that lands the repeats."""
    folder = shared_folder(prepare(spark), "deliveries")
    events = read_events(spark, sf_dir)

    def land(**which):
        to_envelopes(events, **which).write.mode("append").parquet(f"{folder}/landing")

    land(replays=False)
    return folder, lambda: land(originals=False)


def _increments(spark, sf_dir, deliveries):
    """A warehouse after the given deliveries, each in a run of its own.

    From the third one on, the runs have a new checkpoint and see all of bronze again.
    """
    folder = shared_folder(spark, "increments")
    events = read_events(spark, sf_dir)
    increments = None
    for number, delivery in enumerate(deliveries):
        increments = WarehouseIncrements(
            stream_session(spark),
            f"{folder}/variants",
            f"{folder}/warehouse",
            f"{folder}/checkpoints-{number // 2}",
            as_of=latest_event,
        )
        rows = warehouse.to_variant(bronze.to_bronze(to_envelopes(events, **delivery)))
        rows.write.mode("append").parquet(increments.bronze)
        increments.run_available()
    return increments


@query
def stream_bronze_to_silver_incremental(spark, sf_dir):
    """The originals, their repeats, and the repeats again through a new checkpoint: as one batch merge."""
    repeats = {"originals": False}
    found = _increments(spark, sf_dir, [{"replays": False}, repeats, repeats])
    return _doubles(found.silver().drop("loaded_at"))


@query
def stream_warehouse_windows(spark, sf_dir):
    """Minute bars after two deliveries: those of the trailing span of either, the newer one of each."""
    found = _increments(spark, sf_dir, [{"replays": False}, {"originals": False}])
    return _doubles(found.windows().drop("loaded_at"))


@query
def packed_warehouse_silver(spark, sf_dir):
    """The silver of three deliveries after their loads were packed and the former ones removed."""
    repeats = {"originals": False}
    found = _increments(spark, sf_dir, [{"replays": False}, repeats, repeats])
    found.pack(least=2, keep_seconds=0)
    return _doubles(found.silver().drop("loaded_at"))


@query
def packed_warehouse_windows(spark, sf_dir):
    """The minute bars of two deliveries after packing, folding and one more delivery of known trades."""
    repeats = {"originals": False}
    found = _increments(spark, sf_dir, [{"replays": False}, repeats])
    found.pack(least=2, keep_seconds=0)
    found.fold_windows()
    found.apply(warehouse.to_variant(bronze.to_bronze(to_envelopes(read_events(spark, sf_dir), **repeats))), 99)
    return _doubles(found.windows().drop("loaded_at"))


def _bar_envelopes(messages, offset, delivered):
    """Bar messages as records of a topic with three partitions, one offset for each delivery of a key."""
    key = F.col("key").cast("binary")
    return messages.select(
        F.lit("trade-aggregates").alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(3)).cast("int").alias("partition"),
        F.lit(offset).cast("bigint").alias("offset"),
        F.lit(delivered).cast("timestamp").alias("timestamp"),
        key.alias("key"),
        F.col("value").cast("binary").alias("value"),
    )


@query
def compacted_bars(spark, sf_dir):
    """Newest value of each bar from a topic that delivers final bars first, drafts of them later, and all final ones
    twice; one symbol's bars are deleted at last."""
    folder = shared_folder(prepare(spark), "compacted")
    session = stream_session(prepare(spark))
    final = stored(spark, payloads.bar_messages(bars.tumbling(valid(spark, sf_dir))), "bar-messages")
    drafts = final.withColumn("value", F.lit('{"symbol": "draft"}'))
    gone = final.where(F.col("key").startswith("ZZZT|")).withColumn("value", F.lit(None).cast("string"))
    topic = CompactedTopic(session, f"{folder}/view", f"{folder}/checkpoint")
    deliveries = (
        _bar_envelopes(final, 7, "2024-02-01 00:00:07"),
        _bar_envelopes(drafts, 3, "2024-02-01 00:00:09").unionByName(_bar_envelopes(gone, 8, "2024-02-01 00:00:08")),
        _bar_envelopes(final, 7, "2024-02-01 00:00:07"),
    )
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{folder}/landing")
        topic.start(read_envelopes(session, "parquet", path=f"{folder}/landing")).awaitTermination()
    topic.pack(least=2, keep_seconds=0)
    messages = topic.view().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    return settled(_json_fields(messages, schemas.TUMBLING.toDDL()))


def _landed_streams(spark, folder):
    session = stream_session(spark)
    source = read_envelopes(session, "parquet", path=f"{folder}/landing")
    return TradeStreams(session, source, f"{folder}/tables", f"{folder}/checkpoints")


@query
def stream_restart_idempotent(spark, sf_dir):
    """A second run on unchanged input adds nothing to any table."""
    graph = streams(spark, sf_dir)
    graph.run_available(["tumbling"])
    graph.run_available(["tumbling"])
    counts = {name: graph.table(name) for name in ("bronze", "silver", "tumbling")}
    return quality.layer_counts(counts, dict.fromkeys(counts, 1)).select("layer", "row_count")


def _progress_log(graph):
    log = ProgressLog(graph.spark, shared_folder(graph.spark, "progress"))
    graph.spark.streams.addListener(log)
    return log


@query
def stream_late_accounting(spark, sf_dir):
    """Where the rows go when all repeats arrive after the watermark has moved on."""
    folder, land_repeats = _two_deliveries(spark, sf_dir)
    graph = _landed_streams(spark, folder)
    log = _progress_log(graph)
    finished = list(graph.run_available(["silver", "dead_letters"]).values())
    land_repeats()
    finished += graph.run_available(["silver", "dead_letters"]).values()
    log.wait(finished)
    graph.spark.streams.removeListener(log)
    late = log.table().filter("query = 'silver'").agg(F.sum("dropped_by_watermark"))
    counts = {name: graph.table(name) for name in ("bronze", "dead_letters", "silver")}
    layers = quality.layer_counts(counts, dict.fromkeys(counts, 0)).select("layer", "row_count")
    dropped = late.toDF("row_count").select(F.lit("dropped_late").alias("layer"), "row_count")
    return layers.unionByName(dropped)


@query
def stream_reject_counts(spark, sf_dir):
    """Rejects by reason, counted by the stream itself while the rows pass."""
    graph = streams(spark, sf_dir)
    log = _progress_log(graph)
    log.wait(graph.run_available(["dead_letters"]).values())
    graph.spark.streams.removeListener(log)
    reason = F.substring_index("metric", ".", -1).alias("validation_error")
    counted = log.observed().where("query = 'dead_letters' AND metric <> 'rejects.rows' AND total > 0")
    return counted.select(reason, F.col("total").alias("rejected"))


@query
def stream_flag_counts(spark, sf_dir):
    """Flagged trades by severity, counted by the stream itself while the rows pass."""
    graph = streams(spark, sf_dir)
    log = _progress_log(graph)
    log.wait(graph.run_available(["anomalies"]).values())
    graph.spark.streams.removeListener(log)
    severity = F.substring_index("metric", ".", -1).alias("severity")
    return log.observed().where("query = 'anomalies' AND metric <> 'flags.rows'").select(severity, F.col("total").alias("trades"))


@query
def stream_progress(spark, sf_dir):
    graph = streams(spark, sf_dir)
    log = _progress_log(graph)
    log.wait(graph.run_available(["silver", "dead_letters"]).values())
    graph.spark.streams.removeListener(log)
    return (
        log.table()
        .groupBy("query")
        .agg(
            F.sum("input_rows").alias("input_rows"),
            F.max("state_rows").alias("state_rows"),
            F.sum("dropped_by_watermark").alias("dropped_by_watermark"),
        )
    )
