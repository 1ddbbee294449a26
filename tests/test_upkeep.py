"""Checksum drill-down, compacted topics, safe replacement, empty files, wanted fields, observed counts."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from trades import payload

from tickloom import schemas
from tickloom.operators import bronze, checksums, quality, silver
from tickloom.plans import jobs, stages
from tickloom.session import shared_folder, stream_session
from tickloom.sources.newest_files import newest_files
from tickloom.streaming.compacted import CompactedTopic, current_view
from tickloom.streaming.graph import TradeStreams
from tickloom.streaming.progress import ProgressLog

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ("trade_id", "symbol", "quantity", "price", "event_ts")


# Checksums


def test_one_altered_trade_is_found_with_its_bar(spark):
    trades = stages.stored_valid(spark, SF_DIR, by_date=True)
    chosen = trades.orderBy(F.desc("event_ts"), "trade_id").first()
    altered = trades.withColumn("price", F.when(F.col("trade_id") == chosen.trade_id, F.col("price") + 0.25).otherwise(F.col("price")))
    assert checksums.differing_bars(trades, trades.repartition(5), COLUMNS).collect() == []
    found = checksums.differing_bars(trades, altered, COLUMNS).collect()
    minute = chosen.event_ts.replace(second=0, microsecond=0)
    assert [(r.window_start, r.symbol) for r in found] == [(minute, chosen.symbol)] and found[0].left_rows == found[0].right_rows >= 1
    rows = checksums.differing_rows(trades, altered, COLUMNS).collect()
    assert sorted((r.trade_id, r.extra) for r in rows) == [(chosen.trade_id, -1), (chosen.trade_id, 1)]


def test_missing_repeated_and_null_rows(spark):
    layout = "trade_id STRING, symbol STRING, event_ts TIMESTAMP"
    one = datetime(2024, 1, 1, 0, 0, 10)
    left = spark.createDataFrame([("a", "X", one), ("b", "X", one), ("b", "X", one), ("c", None, None)], layout)
    right = spark.createDataFrame([("a", "X", one), ("b", "X", one), ("d", "Y", datetime(2024, 1, 2))], layout)
    columns = ["trade_id", "symbol", "event_ts"]
    found = {(r.window_start, r.symbol): (r.left_rows, r.right_rows) for r in checksums.differing_bars(left, right, columns).collect()}
    assert found == {(datetime(2024, 1, 1), "X"): (3, 2), (None, None): (1, 0), (datetime(2024, 1, 2), "Y"): (0, 1)}
    rows = {r.trade_id: r.extra for r in checksums.differing_rows(left, right, columns).collect()}
    assert rows == {"b": 1, "c": 1, "d": -1}
    empty = left.limit(0)
    assert checksums.differing_bars(empty, empty, columns).collect() == [] and checksums.differing_rows(empty, right, columns).count() == 3


@pytest.mark.parametrize("literal_days", [1000, 0])
def test_days_that_agree_are_not_opened(spark, literal_days, monkeypatch):
    monkeypatch.setattr(checksums, "LITERAL_DAYS", literal_days)
    trades = stages.stored_valid(spark, SF_DIR, by_date=True)
    days = [r[0] for r in trades.select("event_date").distinct().orderBy("event_date").collect()]
    altered = trades.where(~((F.col("event_date") == days[-1]) & (F.col("symbol") == "AAPL")))
    found = checksums.differing_bars(trades, altered, COLUMNS)
    assert {r.window_start.date() for r in found.collect()} == {days[-1]}
    if literal_days:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert isinstance(days[0], date) and plan.count("event_date") >= 2
        kept = checksums._of_days(trades, spark.createDataFrame([(days[-1],)], "day DATE"))
        assert set(kept.inputFiles()) == set(trades.inputFiles())  # what is named, before pruning
        assert "PartitionFilters: [isnotnull(event_date" in kept._jdf.queryExecution().executedPlan().toString()


# Compacted topics


def _messages(spark, rows):
    layout = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key STRING, value STRING"
    df = spark.createDataFrame([("bars", p, o, datetime(2024, 1, 1, 0, t), k, v) for p, o, t, k, v in rows], layout)
    return df.withColumns({"key": df.key.cast("binary"), "value": df.value.cast("binary")}).select(*schemas.ENVELOPE.fieldNames())


SCRIPT = [
    (0, 1, 0, "a", "a1"), (0, 2, 1, "b", "b1"), (0, 3, 2, "a", "a2"), (1, 1, 3, "c", "c1"), (0, 5, 4, "b", None),
    (0, 9, 0, "d", "late clock"), (0, 8, 9, "d", "early offset"), (1, 7, 20, "e", "moved here"), (0, 90, 10, "e", "from there"), (0, 4, 5, None, "no key"),
]
WANTED = {"a": "a2", "c": "c1", "d": "late clock", "e": "moved here"}


def _view(df):
    return {bytes(r.key).decode(): bytes(r.value).decode() for r in df.collect()}


def test_the_newest_value_of_each_key(spark):
    assert _view(current_view(_messages(spark, SCRIPT))) == WANTED
    assert _view(current_view(_messages(spark, SCRIPT[::-1] + SCRIPT))) == WANTED
    assert _view(current_view(_messages(spark, SCRIPT[:0]))) == {}


def test_repeated_and_reordered_delivery_as_a_stream(spark):
    session = stream_session(spark, state_partitions=2)
    folder = shared_folder(session, "compacted")
    topic = CompactedTopic(session, f"{folder}/view", f"{folder}/ck")

    def run(job, rows):
        _messages(session, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        job.start(session.readStream.schema(schemas.ENVELOPE).parquet(f"{folder}/in")).awaitTermination()

    run(topic, SCRIPT[5:])
    run(topic, SCRIPT[2:7])
    run(topic, SCRIPT[:4])
    assert _view(topic.view()) == WANTED
    assert topic.pack(least=2, keep_seconds=0) and len(topic.table.names()) == 1
    assert _view(topic.view()) == WANTED
    # A new checkpoint delivers everything once more; a deletion stays one after packing.
    run(CompactedTopic(session, f"{folder}/view", f"{folder}/other"), [(0, 2, 1, "b", "b1"), (1, 30, 40, "c", "c2")])
    assert _view(topic.view()) == WANTED | {"c": "c2"}


# Replacement of a table


def test_a_killed_rewrite_leaves_the_old_table(spark, monkeypatch):
    folder = shared_folder(spark, "replace")
    target = f"{folder}/daily"
    jobs.replace_folder(spark.range(3), target)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        jobs.replace_folder(broken, target)
    assert spark.read.parquet(target).count() == 3

    # Killed between the two renames: the next run, or a reader's repair, finds the old table again.
    rename, calls = jobs._rename, []

    def once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        rename(*args)

    with monkeypatch.context() as killed:
        killed.setattr(jobs, "_rename", once)
        with pytest.raises(KeyboardInterrupt):
            jobs.replace_folder(spark.range(7), target)
    jobs.restore_folder(spark, target)
    assert spark.read.parquet(target).count() == 3 and os.listdir(folder) == ["daily"]

    jobs.replace_folder(spark.range(4).withColumn("more", F.lit("new column")), target)
    assert spark.read.parquet(target).columns == ["id", "more"] and os.listdir(folder) == ["daily"]


# Files without rows


def test_an_empty_file_is_not_unreadable(spark):
    folder = shared_folder(spark, "empties")
    layout = spark.createDataFrame([], "n BIGINT, label STRING").schema
    for name, rows in (("a", 2), ("b", 0)):
        spark.range(rows).toDF("n").coalesce(1).write.parquet(f"{folder}/{name}")
    found = newest_files(spark, folder, layout)
    assert (found.total, found.loaded, found.unreadable, found.rows.count()) == (2, 2, [], 2)
    for name in ("x", "y"):
        with open(f"{folder}/a/{name}.parquet", "w") as out:
            out.write("this is no parquet file")
    spark.range(0).toDF("n").coalesce(1).write.parquet(f"{folder}/c")
    found = newest_files(spark, folder, layout)
    assert sorted(os.path.basename(f) for f in found.unreadable) == ["x.parquet", "y.parquet"] and found.rows.count() == 2
    only_empty = newest_files(spark, f"{folder}/b", layout)
    assert only_empty.unreadable == [] and only_empty.rows.collect() == []


# Wanted fields


def test_only_wanted_fields_are_parsed(spark, bronze_of):
    texts = [payload(), payload(quantity="x"), "not json", '{"trade_id":"e","price":1', payload(ingest_time=5, trader_id=[1]), "[]", None, payload(side=...)]
    raw = bronze_of(texts)
    some = bronze.parse(raw, bronze.RULE_FIELDS)
    assert "ingest_ts" not in some.columns and "sequence" not in some.columns
    judged = [silver.classify(df).select("offset", "validation_error", *bronze.RULE_FIELDS, "event_ts").collect() for df in (some, bronze.parse(raw))]
    assert sorted(judged[0]) == sorted(judged[1])
    with pytest.raises(ValueError, match="no such"):
        bronze.parse(raw, ["side", "colour"])
    plan = quality.validation_summary(silver.classify(some))._jdf.queryExecution().optimizedPlan().toString()
    assert "exchange" not in plan


# Reports and observed counts


def test_a_failed_write_keeps_the_reports(spark):
    folder = shared_folder(spark, "flush")
    log = ProgressLog(spark, f"{folder}/log")
    log._held = [("q", 1, 2, 0.0, 0.0, 3, None, 0, 0, 0, {"rejects.rows": 4})]
    with open(f"{os.path.dirname(folder)}/blocked", "w"):
        pass
    log._uri = f"{os.path.dirname(folder)}/blocked/log"
    with pytest.raises(Exception):  # noqa: B017
        log.flush()
    log._uri = f"{folder}/log"
    assert log.table().count() == 1 and log._held == []
    assert [tuple(r) for r in log.observed().collect()] == [("q", "rejects.rows", 4)]


def test_observed_counts_follow_the_rules_of_the_graph(spark):
    session = stream_session(spark, state_partitions=2)
    folder = shared_folder(session, "observed")
    graph = stages.streams(session, SF_DIR)
    assert isinstance(graph, TradeStreams)
    log = ProgressLog(graph.spark, f"{folder}/log")
    graph.spark.streams.addListener(log)
    log.wait(graph.run_available(["dead_letters", "anomalies"]).values())
    graph.spark.streams.removeListener(log)
    found = {(r.query, r.metric): r.total for r in log.observed().collect()}
    assert found["dead_letters", "rejects.rows"] == graph.table("bronze").count()
    assert sum(n for (q, m), n in found.items() if m.startswith("rejects.") and m != "rejects.rows") == graph.table("dead_letters").count()
    assert found["anomalies", "flags.rows"] == graph.table("silver").count()
    assert found["anomalies", "flags.high"] + found["anomalies", "flags.medium"] == graph.table("anomalies").count()
