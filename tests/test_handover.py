"""Steps that take a backlog in parts lose nothing when files follow event time; chained windows."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars, silver
from tickloom.session import shared_folder, stream_session
from tickloom.sources.envelopes import read_envelopes
from tickloom.streaming.graph import TradeStreams
from tickloom.streaming.handover import TimeOrderedTable


@pytest.fixture(scope="module")
def session(spark):
    return stream_session(spark, state_partitions=2)


def _backlog(session, folder, count=240):
    """Trades over two hours, shuffled, repeated, with bad times and another side among them."""
    trades = []
    for n in (n - 1 if n % 11 == 5 else n for n in range(count)):
        minute = n * 37 % 120
        time = "no time" if n % 40 == 7 else f"2024-01-01T{minute // 60:02}:{minute % 60:02}:{n % 60:02}Z"
        side = "HOLD" if n % 30 == 3 else "BUY"
        trades.append({"trade_id": f"t{n}", "symbol": "aapl", "side": side, "quantity": 10, "price": 210.0, "event_time": time})
    rows = [("trades", 0, n, datetime(2024, 1, 1), "A", json.dumps(t)) for n, t in enumerate(trades)]
    df = session.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key STRING, value STRING")
    df.withColumns({"key": df.key.cast("binary"), "value": df.value.cast("binary")}).repartition(4).write.mode("append").parquet(f"{folder}/in")


def _graph(session, folder, label, **settings):
    return TradeStreams(session, read_envelopes(session, "parquet", path=f"{folder}/in"), f"{folder}/{label}/t", f"{folder}/{label}/c", **settings)


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


BAR = ("symbol", "window_start", "window_end", "trade_count", "total_quantity")


def test_a_limit_below_one_batch_gives_what_no_limit_gives(session):
    folder = shared_folder(session, "limits")
    _backlog(session, folder)
    whole = _graph(session, folder, "whole")
    parts = _graph(session, folder, "parts", hand_over=5, read_options={"maxFilesPerTrigger": "1"})
    wanted = ["dead_letters", "tumbling", "sessions"]
    whole.run_available(wanted)
    finished = parts.run_available(wanted)
    assert sum(p.numInputRows > 0 for p in finished["silver"].recentProgress) == 5
    assert sum(s.numRowsDroppedByWatermark for p in finished["silver"].recentProgress for s in p.stateOperators) == 0
    assert whole.table("bronze").count() == parts.table("bronze").count() == 240
    assert _rows(whole.table("silver"), "trade_id") == _rows(parts.table("silver"), "trade_id")
    assert _rows(whole.table("tumbling"), *BAR) == _rows(parts.table("tumbling"), *BAR) != []
    assert whole.table("dead_letters").count() == parts.table("dead_letters").count()
    ends = ("symbol", "session_start", "session_end", "trade_count")
    assert _rows(whole.table("sessions"), *ends) == _rows(parts.table("sessions"), *ends)


def test_the_same_limit_without_hand_over_loses_rows(session):
    """What the hand-over is for: should this ever hold without it, it can go."""
    folder = shared_folder(session, "loss")
    _backlog(session, folder)
    parts = _graph(session, folder, "parts", read_options={"maxFilesPerTrigger": "1"})
    finished = parts.run_available(["silver"])
    assert sum(s.numRowsDroppedByWatermark for p in finished["silver"].recentProgress for s in p.stateOperators) > 0


def test_a_batch_that_stopped_while_moving_goes_on(session, monkeypatch):
    uri = shared_folder(session, "moving")
    table = TimeOrderedTable(session, uri, f"{uri}/ck", F.col("event_ts"), files=4)
    rows = session.range(100).select(F.timestamp_seconds(F.col("id") * 61 % 100).alias("event_ts"), "id")
    path, calls = TimeOrderedTable._path, []

    def stop(self, target):
        calls.append(target)
        if sum(c.endswith(".parquet") and "_handover" not in c for c in calls) == 3:
            raise KeyboardInterrupt
        return path(self, target)

    with monkeypatch.context() as killed:
        killed.setattr(TimeOrderedTable, "_path", stop)
        with pytest.raises(KeyboardInterrupt):
            table.add(rows, 0)
    # What has moved so far is a prefix in time.
    seen = session.read.parquet(uri)
    assert 0 < seen.count() < 100 and seen.agg(F.max("event_ts").cast("long")).first()[0] == seen.count() - 1
    table.add(rows, 0)
    table.add(rows.limit(0), 1)
    found = session.read.schema("event_ts TIMESTAMP, id BIGINT").parquet(uri)
    assert found.count() == found.distinct().count() == 100
    names = sorted((f for f in os.listdir(uri) if f.endswith(".parquet") and f.startswith("0" * 12)))
    times = [os.path.getmtime(f"{uri}/{f}") for f in names]
    assert len(names) == 4 and times == sorted(times) and len(set(times)) == 4
    assert table.add(rows, 0) is None and session.read.parquet(uri).count() == 100  # run again once more


def test_sliding_windows_are_a_chain_over_panes(session):
    """One state row for each pane in place of five for each trade; closed windows are those of single trades."""
    folder = shared_folder(session, "chain")
    layout = "trade_id STRING, event_ts TIMESTAMP, symbol STRING, side STRING, quantity INT, price DOUBLE, notional DOUBLE"
    for n, minutes in enumerate(([0, 0, 0, 1, 4], [2, 6, 9], [9, 12], [40])):
        rows = [(f"{n}-{i}", datetime(2024, 1, 1, 0, m, 10 * i), "A", "BUY", 1, 1.0, 1.0) for i, m in enumerate(minutes)]
        session.createDataFrame(rows, layout).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = session.readStream.schema(layout).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = bars.sliding(silver.dedup(source)).writeStream.format("parquet").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start(f"{folder}/out")
    query.awaitTermination()
    assert [s.operatorName for s in query.lastProgress.stateOperators].count("stateStoreSave") == 2
    batch = bars.sliding(session.read.schema(layout).parquet(f"{folder}/in")).where("window_end <= timestamp'2024-01-01 00:38:00'")
    columns = ("window_start", "symbol", "trade_count", "total_notional")
    assert _rows(session.read.parquet(f"{folder}/out"), *columns) == _rows(batch, *columns)
