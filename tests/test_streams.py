"""Scripted micro-batches: one JSON file per batch, symbol A, quantity 1, watermark 2 minutes."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.rules import Thresholds, validation_rules
from tickloom.operators import bars, silver, warehouse
from tickloom.programs import daily_rollup, trade_streams, warehouse_increments
from tickloom.session import shared_folder, stream_session
from tickloom.sources.envelopes import read_envelopes, topic_options
from tickloom.streaming.graph import STEPS, TradeStreams
from tickloom.streaming.increments import WarehouseIncrements, latest_event
from tickloom.streaming.progress import ProgressLog
from tickloom.streaming.sinks import AVAILABLE_NOW, write_stream

SCRIPT = [
    [("a", "00:00:10"), ("b", "00:00:50")],
    [("a", "00:00:10"), ("c", "00:05:00")],
    [("d", "00:10:00")],
    [("late", "00:00:20"), ("a", "00:11:00"), ("edge", "00:03:00"), ("edge2", "00:03:00.001")],
    [("a", "01:30:00"), ("a", "00:28:00"), ("g", "01:30:00")],
]
TRADE = (
    "trade_id STRING, event_ts TIMESTAMP, symbol STRING, side STRING, quantity INT, "
    "price DOUBLE, notional DOUBLE"
)


def land(folder, batches, first=0):
    os.makedirs(folder, exist_ok=True)
    for number, batch in enumerate(batches, first):
        path = f"{folder}/batch-{number:03}.json"
        with open(path, "w") as out:
            for trade_id, time in batch:
                row = {"trade_id": trade_id, "event_ts": f"2024-01-01T{time}Z", "symbol": "A"}
                out.write(json.dumps({**row, "side": "BUY", "quantity": 1, "price": 1.0, "notional": 1.0}))
                out.write("\n")
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.fixture(scope="module")
def session(spark):
    return stream_session(spark, state_partitions=2)


def run(session, batches, build, mode="exact"):
    """Output rows and the finished query of one run over the scripted files."""
    folder = shared_folder(session, "scripted")
    land(f"{folder}/in", batches)
    source = (
        session.readStream.schema(TRADE).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    )
    output = build(silver.dedup(source, "2 minutes", mode))
    query = write_stream(output, "scripted", f"{folder}/out", f"{folder}/ck", trigger=AVAILABLE_NOW)
    query.awaitTermination()
    return session.read.parquet(f"{folder}/out").collect(), query


def clock(moment):
    return moment.strftime("%H:%M:%S")


def test_exact_dedup_never_forgets_and_drops_late_rows(session):
    rows, query = run(session, SCRIPT, lambda df: df.select("trade_id", "event_ts"))
    assert sorted(r.trade_id for r in rows) == ["a", "b", "c", "d", "edge2", "g"]
    states = [state for report in query.recentProgress for state in report.stateOperators]
    assert sum(state.numRowsDroppedByWatermark for state in states) == 2
    assert max(state.numRowsTotal for state in states) == 6


def test_bounded_dedup_emits_an_old_id_again(session):
    rows, _ = run(session, SCRIPT, lambda df: df.select("trade_id", "event_ts"), "bounded")
    found = sorted((r.trade_id, clock(r.event_ts)) for r in rows)
    assert ("a", "00:00:10") in found and ("a", "00:11:00") in found
    assert len(found) == 7


def test_late_filter_uses_the_watermark_of_the_batch_before(session):
    moved = [list(batch) for batch in SCRIPT]
    moved[2].append(moved[3].pop(0))
    rows, _ = run(session, moved, lambda df: df.select("trade_id"))
    assert "late" in {r.trade_id for r in rows}


def test_tumbling_after_dedup_emits_closed_windows_once(session):
    rows, _ = run(session, SCRIPT, bars.tumbling)
    assert sorted((clock(r.window_start), r.trade_count) for r in rows) == [
        ("00:00:00", 2),
        ("00:03:00", 1),
        ("00:05:00", 1),
        ("00:10:00", 1),
    ]


def test_sessions_after_dedup(session):
    rows, _ = run(session, SCRIPT, bars.sessions)
    assert sorted((clock(r.session_start), clock(r.session_end), r.trade_count) for r in rows) == [
        ("00:00:10", "00:08:00", 4),
        ("00:10:00", "00:13:00", 1),
    ]


def test_a_window_that_ends_at_the_watermark_is_closed(session):
    rows, _ = run(session, [[("A", "00:00:00")], [("B", "00:05:00")]], bars.sessions)
    assert [(clock(r.session_start), clock(r.session_end)) for r in rows] == [("00:00:00", "00:03:00")]


def _envelopes(session, folder, trades):
    rows = [
        ("trades", 0, n, datetime(2024, 1, 1), "A", json.dumps(trade)) for n, trade in enumerate(trades)
    ]
    layout = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key STRING, value STRING"
    df = session.createDataFrame(rows, layout)
    df = df.withColumns({"key": df.key.cast("binary"), "value": df.value.cast("binary")})
    df.coalesce(1).write.mode("append").parquet(folder)


def _trade(trade_id, time, **more):
    base = {"trade_id": trade_id, "symbol": "aapl", "side": "BUY", "quantity": 10, "price": 210.0}
    return {**base, "event_time": f"2024-01-01T{time}Z", **more}


def test_graph_continues_after_a_stop_and_splits_the_rows(session):
    folder = shared_folder(session, "graph")
    _envelopes(session, f"{folder}/in", [_trade("t1", "00:00:10"), _trade("t1", "00:00:10")])
    source = session.readStream.schema(schemas.ENVELOPE).parquet(f"{folder}/in")
    graph = TradeStreams(session, source, f"{folder}/tables", f"{folder}/ck")
    graph.run_available()
    assert {n: graph.table(n).count() for n in ("bronze", "silver", "tumbling")} == {
        "bronze": 2,
        "silver": 1,
        "tumbling": 0,
    }
    more = [_trade("t1", "00:00:20"), _trade("t2", "00:09:00", quantity=30_000), _trade("t3", "00:10:00", side="HOLD")]
    _envelopes(session, f"{folder}/in", more)
    graph.run_available()
    graph.run_available()
    counts = {name: graph.table(name).count() for name in STEPS}
    assert counts == {
        "bronze": 5,
        "silver": 2,
        "dead_letters": 1,
        "anomalies": 1,
        "tumbling": 1,
        "sliding": 5,
        "sessions": 1,
        "anomaly_messages": 1,
        "bar_messages": 1,
    }
    assert graph.table("bar_messages").first().key == "AAPL|2024-01-01 00:00:00"
    assert graph.table("silver").drop(schemas.EVENT_DATE).columns == schemas.SILVER.fieldNames()
    assert graph.table("anomalies").columns == schemas.ANOMALY.fieldNames()


def test_continuous_trigger_starts_every_query(session):
    folder = shared_folder(session, "continuous")
    _envelopes(session, f"{folder}/in", [_trade("t1", "00:00:10", quantity=30_000)])
    source = session.readStream.schema(schemas.ENVELOPE).parquet(f"{folder}/in")
    graph = TradeStreams(session, source, f"{folder}/tables", f"{folder}/ck")
    queries = graph.start_all("1 second")
    try:
        assert [q.name for q in queries] == list(STEPS)
        for query in queries:
            query.processAllAvailable()
        assert graph.table("anomaly_messages").count() == 1
    finally:
        for query in queries:
            query.stop()


def _bronze_variants(session, folder, trades):
    rows = [("trades", 0, n, json.dumps(trade)) for n, trade in enumerate(trades)]
    layout = "topic STRING, partition INT, offset BIGINT, raw_payload STRING"
    variants = warehouse.to_variant(session.createDataFrame(rows, layout))
    variants.coalesce(1).write.mode("append").parquet(folder)


def test_increments_merge_and_a_repeated_batch_changes_nothing(session):
    folder = shared_folder(session, "increments")
    job = WarehouseIncrements(session, f"{folder}/in", f"{folder}/wh", f"{folder}/ck", latest_event)
    _bronze_variants(session, f"{folder}/in", [_trade("t1", "00:00:10"), _trade("t2", "00:01:10")])
    job.run_available()
    _bronze_variants(
        session,
        f"{folder}/in",
        [_trade("t1", "00:00:10", price=999.0), _trade("t3", "00:01:20"), _trade("t3", "00:01:20")],
    )
    job.run_available()
    job.run_available()
    assert sorted((r.trade_id, int(r.price)) for r in job.silver().collect()) == [
        ("t1", 210),
        ("t2", 210),
        ("t3", 210),
    ]
    found = {clock(r.window_start): int(r.trade_count) for r in job.windows().collect()}
    assert found == {"00:00:00": 1, "00:01:00": 2}
    assert job.silver().columns == schemas.WAREHOUSE_SILVER.fieldNames()

    again = session.read.schema(schemas.VARIANT_BRONZE).parquet(f"{folder}/in")
    job.apply(again, 1)
    assert job.silver().count() == 3
    assert {clock(r.window_start): int(r.trade_count) for r in job.windows().collect()} == found


def test_a_new_checkpoint_over_a_filled_table_loses_and_doubles_nothing(session):
    folder = shared_folder(session, "recovery")

    def job(checkpoint):
        return WarehouseIncrements(session, f"{folder}/in", f"{folder}/wh", f"{folder}/{checkpoint}", latest_event)

    _bronze_variants(session, f"{folder}/in", [_trade("a", "00:00:10"), _trade("b", "00:01:10")])
    job("one").run_available()
    _bronze_variants(session, f"{folder}/in", [_trade("c", "00:01:20")])
    job("one").run_available()
    bars = {(clock(r.window_start), int(r.trade_count)) for r in job("one").windows().collect()}
    _bronze_variants(session, f"{folder}/in", [_trade("c", "00:01:20"), _trade("d", "00:02:20")])
    again = job("two")
    again.run_available()
    assert sorted(r.trade_id for r in again.silver().collect()) == ["a", "b", "c", "d"]
    bars.add(("00:02:00", 1))
    found = lambda: {(clock(r.window_start), int(r.trade_count)) for r in again.windows().collect()}
    assert found() == bars
    again.fold_windows()
    assert found() == bars
    assert again.window_table.read().select("load").distinct().count() == 1 and len(again.window_table.names()) == 1
    _bronze_variants(session, f"{folder}/in", [_trade("e", "00:02:30")])
    again.run_available()
    assert found() == (bars - {("00:02:00", 1)}) | {("00:02:00", 2)}


def test_a_crash_between_the_two_writes_changes_nothing(session, monkeypatch):
    folder = shared_folder(session, "crash")
    job = WarehouseIncrements(session, f"{folder}/in", f"{folder}/wh", f"{folder}/ck", latest_event)
    _bronze_variants(session, f"{folder}/in", [_trade("a", "00:00:10")])
    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "minute_vwap", lambda *_, **__: 1 / 0)
        with pytest.raises(Exception, match="division"):
            job.run_available()
    assert [r.trade_id for r in job.silver().collect()] == ["a"]
    job.run_available()
    assert [r.trade_id for r in job.silver().collect()] == ["a"]
    assert [int(r.trade_count) for r in job.windows().collect()] == [1]


def test_what_no_column_can_hold_is_refused_and_the_stream_goes_on(session):
    folder = shared_folder(session, "overflow")
    job = WarehouseIncrements(session, f"{folder}/in", f"{folder}/wh", f"{folder}/ck", latest_event)
    good = [_trade("a", "00:00:10", quantity=10, price=100.0), _trade("b", "00:00:20", quantity=30, price=200.0)]
    bad = [_trade("c", "00:00:30", quantity=10**13, price=100.0), _trade("d", "00:00:40", quantity=10**37, price=1000.0)]
    _bronze_variants(session, f"{folder}/in", good + bad + [_trade("e", "00:00:50", side="HOLD")])
    job.run_available()
    assert [(int(r.total_quantity), float(r.vwap)) for r in job.windows().collect()] == [(40, 175.0)]
    reasons = sorted(r.error_reason for r in job.rejects().collect())
    assert reasons == ["INVALID_SIDE", "NOTIONAL_OUT_OF_RANGE", "NOTIONAL_OUT_OF_RANGE"]
    assert job.rejects().columns == schemas.VARIANT_REJECTS.fieldNames()


def test_progress_log_keeps_every_report(session):
    folder = shared_folder(session, "progress")
    limited = session.newSession()
    limited.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    for n in range(12):
        limited.range(n, n + 1).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    log = ProgressLog(limited, f"{folder}/log", flush_every=4)
    limited.streams.addListener(log)
    rows = limited.readStream.schema("id BIGINT").option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    query = write_stream(rows, "copy", f"{folder}/out", f"{folder}/ck", trigger="available-now")
    query.awaitTermination()
    log.wait([query])
    limited.streams.removeListener(log)
    assert len(query.recentProgress) <= 5
    assert log.table().agg(F.sum("input_rows")).first()[0] == 12


def test_rules_thresholds_prices_and_rates_reach_the_stream(session):
    folder = shared_folder(session, "settings")
    trades = [_trade("a", "00:00:10", side=None), _trade("b", "00:00:20", quantity=50, price=30.0)]
    _envelopes(session, f"{folder}/in", trades)
    _envelopes(session, f"{folder}/in", [_trade("c", "00:00:30")])
    prices = session.createDataFrame([("AAPL", 20.0)], "symbol STRING, reference_price DOUBLE")
    graph = TradeStreams(
        session, read_envelopes(session, "parquet", {"maxFilesPerTrigger": "1"}, f"{folder}/in"), f"{folder}/t", f"{folder}/c",
        rules=validation_rules(strict=False), prices=prices, thresholds=Thresholds(quantity=40),
        step_options={"silver": {"maxFilesPerTrigger": "1"}},
    )
    finished = graph.run_available(["anomalies", "dead_letters"])
    assert graph.table("silver").count() == 3 and graph.table("dead_letters").count() == 0
    found = {r.trade_id: r.anomaly_reason for r in graph.table("anomalies").collect()}
    assert found["b"] == "HIGH_QUANTITY" and found["c"] == "PRICE_DISLOCATION"
    batches = [p for p in finished["silver"].recentProgress if p.numInputRows]
    assert len(batches) >= 2  # the backlog was taken in parts


def test_an_id_in_a_third_of_the_rows(session):
    folder = shared_folder(session, "hot-id")
    trades = [_trade("hot" if n % 3 == 0 else f"t{n}", "00:00:10") for n in range(300)]
    _envelopes(session, f"{folder}/in", trades)
    graph = TradeStreams(session, read_envelopes(session, "parquet", path=f"{folder}/in"), f"{folder}/t", f"{folder}/c")
    graph.run_available(["silver"])
    assert graph.table("silver").count() == 201


def test_programs(session):
    folder = shared_folder(session, "programs")
    _envelopes(session, f"{folder}/in", [_trade("a", "00:00:10"), _trade("b", "00:05:10"), _trade("x", "00:00:20", side="HOLD")])
    trade_streams.main(
        ["--source", f"{folder}/in", "--tables", f"{folder}/t", "--checkpoints", f"{folder}/c", "--trigger", "available-now",
         "--state-partitions", "2", "--progress", f"{folder}/p"], session,
    )
    assert session.read.parquet(f"{folder}/t/silver/valid_trades").count() == 2
    assert session.read.parquet(f"{folder}/t/topics/dead_letters").count() == 1
    assert session.read.parquet(f"{folder}/p").select("query").distinct().count() == len(STEPS)
    warehouse_increments.main(
        ["--source", f"{folder}/in", "--bronze", f"{folder}/b", "--warehouse", f"{folder}/w", "--checkpoints", f"{folder}/wc", "--fold"], session
    )
    assert session.read.parquet(f"{folder}/w/silver_valid_trades").count() == 2
    daily_rollup.main(["--silver", f"{folder}/t/silver/valid_trades", "--daily", f"{folder}/d"], session)
    assert session.read.parquet(f"{folder}/d").first().trade_count == 2


def test_topic_source_options():
    assert topic_options("broker:9092", "trades") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "trades",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5000",
    }
