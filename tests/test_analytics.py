"""Anomaly rules, bars, warehouse path, merges, serving and quality on small inputs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.functions.rules import Thresholds
from tickloom.operators import (
    anomalies,
    bars,
    bronze,
    merge,
    payloads,
    quality,
    serving,
    silver,
    warehouse,
)
from tickloom.plans.stages import valid
from trades import payload


def trades_of(spark, rows):
    return spark.createDataFrame(rows, "symbol STRING, quantity INT, price DOUBLE").withColumn(
        "notional", F.col("quantity") * F.col("price")
    )


@pytest.mark.parametrize(
    ("symbol", "quantity", "price", "reason", "severity"),
    [
        ("AAPL", 100, 210.0, "NORMAL", "none"),
        ("AAPL", 30_000, 210.0, "HIGH_QUANTITY", "high"),
        ("AAPL", 25_000, 1.0, "HIGH_QUANTITY", "high"),
        ("ZZZT", 10_000, 100.0, "HIGH_NOTIONAL", "high"),
        ("AAPL", 100, 350.0, "PRICE_DISLOCATION", "medium"),
        ("AAPL", 100, 262.5, "PRICE_DISLOCATION", "medium"),
        ("AAPL", 100, 262.49, "NORMAL", "none"),
        ("ZZZT", 100, 9_000.0, "NORMAL", "none"),
    ],
)
def test_anomaly_rules(spark, symbol, quantity, price, reason, severity):
    row = anomalies.decide(trades_of(spark, [(symbol, quantity, price)])).first()
    assert (row.anomaly_reason, row.severity) == (reason, severity)
    assert row.is_anomaly == (reason != "NORMAL")


def test_thresholds_and_prices_of_the_caller(spark):
    prices = spark.sql("SELECT 'ZZZT' AS symbol, 100D AS reference_price UNION ALL SELECT 'NIL', 0D")
    trades = trades_of(spark, [("ZZZT", 10, 111.0), ("NIL", 10, 1.0)])
    found = anomalies.flag(trades, prices, Thresholds(50, 5_000.0, 0.1)).collect()
    assert {r.symbol: r.anomaly_reason for r in found} == {
        "ZZZT": "PRICE_DISLOCATION",
        "NIL": "NORMAL",
    }


def test_unlisted_symbol_leaves_price_out_of_the_message(spark):
    trade = spark.sql(
        "SELECT 't' AS trade_id, 'ZZZT' AS symbol, 'BUY' AS side, 30000 AS quantity, 1D AS price,"
        " 30000D AS notional, TIMESTAMP '2026-06-30 12:00:00' AS event_ts"
    )
    value = payloads.anomaly_messages(anomalies.flag(trade)).first().value
    assert "reference_price" not in value and '"severity":"high"' in value


def at(spark, times, symbol="A"):
    rows = [(f"t{i}", symbol, "BUY", 1, 1.0, 1.0, t) for i, t in enumerate(times)]
    return spark.createDataFrame(
        rows,
        "trade_id STRING, symbol STRING, side STRING, quantity INT, price DOUBLE, "
        "notional DOUBLE, event_ts TIMESTAMP",
    )


def test_session_edge_is_inclusive(spark):
    day = datetime(2024, 1, 1)
    times = [
        day,
        day + timedelta(minutes=3),
        day + timedelta(minutes=6, microseconds=1),
        day + timedelta(minutes=8),
    ]
    found = bars.sessions(at(spark, times)).orderBy("session_start").collect()
    assert [(r.session_start, r.session_end, r.trade_count) for r in found] == [
        (day, day + timedelta(minutes=6), 2),
        (day + timedelta(minutes=6, microseconds=1), day + timedelta(minutes=11), 2),
    ]


def test_sessions_equal_the_built_in_window_with_a_hot_symbol(spark):
    trades = valid(spark, "/root/testdata/sf0.001").withColumn(
        "symbol", F.when(F.xxhash64("trade_id") % 3 == 0, "HOT").otherwise(F.col("symbol"))
    )
    for gap in (timedelta(minutes=3), timedelta(seconds=40), timedelta(hours=5)):
        window = F.session_window("event_ts", f"{gap.seconds} seconds")
        expected = trades.groupBy(window.alias("w"), "symbol").agg(
            F.count("*").alias("trade_count"), F.sum("quantity").alias("total_quantity")
        ).select("symbol", "trade_count", "total_quantity", "w.start", "w.end")
        found = bars.sessions(trades, gap).select(
            "symbol", "trade_count", "total_quantity", "session_start", "session_end"
        )
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize(("size", "slide"), [(5, 1), (5, 2), (4, 4), (6, 4)])
def test_panes_equal_the_built_in_sliding_window(spark, size, slide):
    trades = valid(spark, "/root/testdata/sf0.001")
    expected = trades.groupBy(
        F.window("event_ts", f"{size} minutes", f"{slide} minutes").alias("w"), "symbol"
    ).agg(F.count("*").alias("trade_count"), F.sum("quantity").alias("total_quantity")).select(
        "symbol", "trade_count", "total_quantity", "w.start", "w.end"
    )
    found = bars.sliding(trades, timedelta(minutes=size), timedelta(minutes=slide)).select(
        "symbol", "trade_count", "total_quantity", "window_start", "window_end"
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_totals_agree_across_layers(spark):
    trades = valid(spark, "/root/testdata/sf0.001")

    def total(df):
        return df.agg(F.sum("trade_count"), F.sum("total_quantity")).first()

    rows = trades.agg(F.count("*"), F.sum("quantity")).first()
    assert total(bars.tumbling(trades)) == rows
    assert total(bars.sessions(trades)) == rows
    assert total(bars.daily(trades)) == rows
    assert tuple(total(bars.sliding(trades))) == tuple(5 * n for n in rows)
    assert quality.reconcile(bars.tumbling(trades), bars.daily(trades)).filter("NOT agrees").count() == 0


def test_a_trade_without_side_counts_but_joins_no_side_sum(spark):
    trade = at(spark, [datetime(2024, 1, 1)]).withColumn("side", F.lit(None).cast("string"))
    row = bars.tumbling(trade).first()
    assert (row.trade_count, row.buy_quantity, row.sell_quantity, row.vwap) == (1, 0, 0, 1.0)


def silver_of(bronze_of, payloads_):
    return warehouse.variant_silver(
        warehouse.to_variant(bronze_of(payloads_).withColumn("partition", F.lit(0)))
    )


def test_warehouse_rounds_to_its_columns(bronze_of):
    found = silver_of(
        bronze_of,
        [
            payload(trade_id="text", quantity="100", price="1.23456"),
            payload(trade_id="rounds", quantity=100.5, price=0.5),
            payload(trade_id="below", price=0.4),
            payload(trade_id="side", side=None),
            payload(trade_id="time", event_time="bad"),
            payload(trade_id=None),
            "not json",
        ],
    ).collect()
    assert {r.trade_id: (int(r.quantity), str(r.price), str(r.notional)) for r in found} == {
        "text": (100, "1.2346", "123.4600"),
        "rounds": (101, "0.5000", "50.5000"),
    }


def test_validation_batch_reaches_every_layer(bronze_of):
    batch = bronze_of(
        [
            payload(trade_id="batch-aapl", symbol="AAPL", quantity=125, price=211.25),
            payload(trade_id="batch-msft", symbol="MSFT", side="SELL", quantity=80, price=452.75),
        ]
    )
    variants = warehouse.to_variant(batch)
    trades = warehouse.variant_silver(variants)
    gold = warehouse.minute_vwap(trades, F.lit("2025-03-14 09:40:00").cast("timestamp"))
    assert {r.symbol: str(r.total_notional) for r in gold.collect()} == {
        "AAPL": "26406.2500",
        "MSFT": "36220.0000",
    }
    layers = {
        "bronze": variants,
        "silver": quality.with_prefix(trades, "batch-"),
        "gold": gold,
        "short": gold.filter("symbol = 'AAPL'"),
    }
    found = quality.layer_counts(layers, dict.fromkeys(layers, 2)).collect()
    assert [(r.layer, r.row_count, r.passed) for r in found] == [
        ("bronze", 2, True),
        ("silver", 2, True),
        ("gold", 2, True),
        ("short", 1, False),
    ]


def test_unaligned_cutoff_cuts_the_oldest_minute(bronze_of):
    trades = silver_of(
        bronze_of,
        [
            payload(trade_id="first", event_time="2026-06-30T12:00:10Z"),
            payload(trade_id="second", event_time="2026-06-30T12:00:50Z"),
        ],
    )
    as_of = F.lit("2026-06-30 14:00:30").cast("timestamp")
    assert warehouse.minute_vwap(trades, as_of).first().trade_count == 2
    assert warehouse.minute_vwap(trades, as_of, align_cutoff=False).first().trade_count == 1


def test_insert_absent_keeps_existing_rows_and_removes_repeats(spark):
    layout = "trade_id STRING, source_offset BIGINT, price DOUBLE"
    current = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 1.0)], layout)
    incoming = spark.createDataFrame(
        [("b", 3, 9.0), ("c", 5, 9.0), ("c", 4, 2.0), ("d", 6, 3.0)], layout
    )
    merged = merge.insert_absent(current, incoming)
    assert sorted(map(tuple, merged.collect())) == [
        ("a", 1, 1.0),
        ("b", 2, 1.0),
        ("c", 4, 2.0),
        ("d", 6, 3.0),
    ]


def test_upsert_and_latest_version_agree(spark):
    layout = "window_start STRING, symbol STRING, trade_count INT"
    current = spark.createDataFrame([("12:00", "A", 1), ("12:01", "A", 2)], layout)
    incoming = spark.createDataFrame([("12:01", "A", 5), ("12:01", "B", 1)], layout)
    expected = [("12:00", "A", 1), ("12:01", "A", 5), ("12:01", "B", 1)]
    assert sorted(map(tuple, merge.upsert(current, incoming).collect())) == expected
    loads = current.withColumn("load", F.lit(0)).unionByName(incoming.withColumn("load", F.lit(1)))
    view = merge.latest_version(loads, ("window_start", "symbol"), "load")
    assert sorted(map(tuple, view.collect())) == expected


def test_lag_never_negative_and_null_without_commit(spark):
    ends = spark.createDataFrame(
        [("t", 0, 10), ("t", 1, 10), ("t", 2, 10), ("t", 3, 10)],
        "topic STRING, partition INT, high_watermark BIGINT",
    )
    committed = spark.createDataFrame(
        [("t", 0, 4), ("t", 1, 12), ("t", 2, -1001)],
        "topic STRING, partition INT, committed_offset BIGINT",
    )
    rows = quality.partition_lag(ends, committed).collect()
    assert [(r.partition, r.committed_offset, r.lag) for r in rows] == [
        (0, 4, 6),
        (1, 12, 0),
        (2, None, None),
        (3, None, None),
    ]


def test_pivot_averages_bars_and_leaves_gaps_null(spark):
    rows = spark.createDataFrame(
        [("12:00", "A", 1.0), ("12:00", "A", 3.0), ("12:01", "B", 5.0)],
        "window_start STRING, symbol STRING, vwap DOUBLE",
    )
    for symbols in (["A", "B"], None):
        found = serving.pivot_by_symbol(rows, "vwap", "avg", symbols).collect()
        assert [tuple(r) for r in found] == [("12:00", 2.0, None), ("12:01", None, 5.0)]


def test_latest_shows_the_columns_that_exist(spark):
    trades = at(spark, [datetime(2024, 1, 1), datetime(2024, 1, 2)])
    found = serving.latest(trades)
    assert found.columns == ["event_ts", "symbol", "side", "quantity", "price", "notional"]
    assert found.first().event_ts == datetime(2024, 1, 2)


def test_daily_layout(spark):
    trades = at(spark, [datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2)])
    assert bars.daily(trades).columns == [
        "trade_day",
        "symbol",
        "trade_count",
        "total_quantity",
        "total_notional",
    ]
    assert bars.daily(trades).count() == 2


def test_dedup_mode_is_checked(spark):
    with pytest.raises(ValueError):
        silver.dedup(at(spark, [datetime(2024, 1, 1)]), mode="other")


def test_parse_reads_each_document_once(bronze_of):
    valid_rows = silver.accept(silver.classify(bronze.parse(bronze_of([payload()]))))
    plan = valid_rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
