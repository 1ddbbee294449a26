"""Newest files, presence, layouts, and the shape of the plans."""

import os
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import anomalies, bars, merge, quality, serving
from tickloom.plans import stages
from tickloom.plans.catalog import QUERIES
from tickloom.plans.jobs import rewrite_daily
from tickloom.session import SHARED_DIR, prepare, shared_folder, stream_session
from tickloom.sources.event_tape import EVENTS, read_events
from tickloom.sources.newest_files import newest_files

SF_DIR = "/root/testdata/sf0.001"
LAYOUT = "n BIGINT, label STRING"


def _files(spark, folder, count):
    for n in range(count):
        spark.range(n, n + 1, 1, 1).toDF("n").write.parquet(f"{folder}/part={n}")
        for name in os.listdir(f"{folder}/part={n}"):
            os.utime(f"{folder}/part={n}/{name}", (1_700_000_000 + n, 1_700_000_000 + n))


def test_only_the_newest_files_are_read(spark):
    folder = shared_folder(spark, "newest")
    _files(spark, folder, 5)
    layout = spark.createDataFrame([], LAYOUT).schema
    found = newest_files(spark, folder, layout, 2)
    assert (found.total, found.loaded) == (5, 2)
    assert sorted(r.n for r in found.rows.collect()) == [3, 4]
    assert found.rows.first().label is None
    assert found.skipped().count() == 0


def test_an_unreadable_file_is_skipped_and_named(spark):
    folder = shared_folder(spark, "corrupt")
    _files(spark, folder, 2)
    with open(f"{folder}/part=1/broken.parquet", "w") as out:
        out.write("this is no parquet file")
    os.makedirs(f"{folder}/_delta_log")
    with open(f"{folder}/_delta_log/checkpoint.parquet", "w") as out:
        out.write("neither is this")
    found = newest_files(spark, folder, spark.createDataFrame([], LAYOUT).schema, 40)
    assert found.total == 3
    assert sorted(r.n for r in found.rows.collect()) == [0, 1]
    assert [os.path.basename(r.file) for r in found.skipped().collect()] == ["broken.parquet"]


def test_a_missing_folder_is_empty(spark):
    found = newest_files(spark, shared_folder(spark, "missing"), EVENTS)
    assert (found.rows.count(), found.total, found.loaded) == (0, 0, 0)
    assert found.rows.schema == EVENTS


def test_presence_tells_missing_from_empty(spark):
    folder = shared_folder(spark, "presence")
    spark.range(0).write.parquet(f"{folder}/empty")
    spark.range(1).write.parquet(f"{folder}/full")
    paths = {name: f"{folder}/{name}" for name in ("empty", "full", "absent")}
    rows = quality.output_presence(spark, paths).collect()
    assert {r.table_name: (r.present, r.has_rows) for r in rows} == {
        "empty": (True, False),
        "full": (True, True),
        "absent": (False, False),
    }


def test_layouts(spark):
    trades = stages.valid(spark, SF_DIR)
    assert trades.columns == schemas.SILVER.fieldNames()
    assert anomalies.flag(trades).columns == schemas.ANOMALY.fieldNames()
    assert bars.tumbling(trades).columns == schemas.TUMBLING.fieldNames()
    assert bars.sliding(trades).columns == schemas.SLIDING.fieldNames()
    assert bars.sessions(trades).columns == schemas.SESSIONS.fieldNames()
    assert len(schemas.BRONZE) == 7 and len(schemas.SILVER) == 22 and len(schemas.ANOMALY) == 26


def test_daily_table_is_replaced(spark):
    silver, target = _silver_folder(spark), shared_folder(spark, "daily")
    spark.range(3).write.parquet(target)
    for _ in range(2):
        rewrite_daily(spark, silver, target)
    daily = spark.read.parquet(target)
    assert daily.columns == schemas.DAILY.fieldNames()
    assert daily.count() == 18


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_prices_are_broadcast_by_their_known_size(spark):
    found = plan(anomalies.flag(stages.valid(spark, SF_DIR)))
    assert "BroadcastHashJoin" in found and "LocalTableScan" in found


def test_an_unbounded_price_table_is_not_broadcast(spark):
    trades = spark.read.schema(schemas.SILVER).parquet(_silver_folder(spark))
    prices = trades.groupBy("symbol").agg(F.max("price").alias("reference_price"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(anomalies.flag(trades, prices))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _silver_folder(spark):
    path = shared_folder(spark, "silver")
    stages.valid(spark, SF_DIR).write.parquet(path)
    return path


def test_bars_over_a_silver_table_read_only_their_columns(spark):
    trades = spark.read.schema(schemas.SILVER).parquet(_silver_folder(spark))
    daily = plan(bars.daily(trades))
    assert "ReadSchema: struct<symbol:string,quantity:int,event_ts:timestamp,notional:double>" in daily
    assert daily.count("Exchange hashpartitioning") == 1
    # Slots are shuffled by symbol and time first; per symbol only totalled slots are left.
    sessions = plan(bars.sessions(trades))
    assert sessions.count("Exchange hashpartitioning") == 2
    assert "partial_count" in sessions.split("Exchange hashpartitioning(symbol")[2]


def test_no_python_workers(spark):
    for build in (bars.tumbling, bars.sliding, bars.sessions, anomalies.flag):
        assert "Python" not in plan(build(stages.valid(spark, SF_DIR)))


def test_the_plan_of_the_tape_does_not_depend_on_its_size(spark):
    assert "RepartitionByExpression [event_id" in read_events(spark, SF_DIR)._jdf.queryExecution().analyzed().toString()


def test_a_partly_broken_file_gives_none_of_its_rows(spark):
    folder = shared_folder(spark, "half")
    schema = spark.createDataFrame([], LAYOUT).schema
    os.makedirs(folder)
    for name, first in (("good", 0), ("half", 40_000)):
        rows = pa.table({"n": pa.array(range(first, first + 40_000), pa.int64()), "label": [f"label-{i * 7919 % 40_000}" for i in range(40_000)]})
        pq.write_table(rows, f"{folder}/{name}.parquet", row_group_size=10_000, compression="snappy")
    third = pq.ParquetFile(f"{folder}/half.parquet").metadata.row_group(2).column(1)
    with open(f"{folder}/half.parquet", "r+b") as out:
        out.seek(third.dictionary_page_offset or third.data_page_offset)
        out.write(b"\xff" * 400)
    found = newest_files(spark, folder, schema, 40)
    assert found.rows.agg(F.min("n"), F.max("n"), F.count("*")).first() == (0, 39_999, 40_000)
    assert [os.path.basename(r.file) for r in found.skipped().collect()] == ["half.parquet"]


def test_an_unlisted_symbol_does_not_vanish(spark):
    rows = spark.createDataFrame([(1, "AAPL", 2.0), (1, "NEW", 3.0)], "window_start INT, symbol STRING, vwap DOUBLE")
    with pytest.raises(Exception, match="symbol without a column: NEW"):
        serving.pivot_by_symbol(rows, "vwap", "avg", ("AAPL",)).collect()
    assert serving.pivot_by_symbol(rows, "vwap", "avg").first()["NEW"] == 3.0


def test_a_doubled_price_is_refused(spark):
    trades = spark.createDataFrame([("t", "AAPL", 1.0)], "trade_id STRING, symbol STRING, price DOUBLE")
    prices = spark.createDataFrame([("AAPL", 1.0), ("AAPL", 2.0)], "symbol STRING, reference_price DOUBLE")
    with pytest.raises(Exception, match="several prices of AAPL"):
        anomalies.with_reference_price(trades, prices).collect()


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_kpis_scan_once_and_the_upsert_scans_each_side_once(spark):
    folder = shared_folder(spark, "plans")
    columns = "trade_id STRING, symbol STRING, anomaly_reason STRING, event_ts TIMESTAMP"
    spark.createDataFrame([("t", "A", "NORMAL", None)], columns).write.parquet(f"{folder}/flagged")
    assert _final_plan(serving.kpis(spark.read.parquet(f"{folder}/flagged"))).count("FileScan") == 1
    for name in ("now", "new"):
        spark.createDataFrame([(1, "A", name)], "window_start INT, symbol STRING, vwap STRING").write.parquet(f"{folder}/{name}")
    merged = merge.upsert(spark.read.parquet(f"{folder}/now"), spark.read.parquet(f"{folder}/new"))
    assert [tuple(r) for r in merged.collect()] == [(1, "A", "new")]
    assert _final_plan(merged).count("FileScan") == 2


def test_the_lookback_prunes_dates(spark):
    trades = stages.stored_valid(spark, SF_DIR, by_date=True)
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    plan_text = _final_plan(bars.tumbling(serving.trades_of_recent_bars(trades, ("AAPL",), as_of)))
    assert "PartitionFilters: [isnotnull(event_date" in plan_text


def test_a_session_of_another_zone_stays_as_it_is(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    own = prepare(other)
    assert (own.conf.get("spark.sql.session.timeZone"), own.conf.get("spark.sql.shuffle.partitions")) == ("UTC", "3")
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert stream_session(other).conf.get("spark.sql.shuffle.partitions") == "3"
    assert QUERIES["validation_summary"](other, SF_DIR).count() == QUERIES["validation_summary"](spark, SF_DIR).count()


class Session:
    """The few attributes of a session that the shared folder depends on."""

    def __init__(self, master, folder=None):
        self.conf = {SHARED_DIR: folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_shared_folder_follows_the_session_setting():
    cluster = Session("spark://host:7077", "s3a://bucket/checkpoints/")
    assert shared_folder(cluster, "silver").startswith("s3a://bucket/checkpoints/silver-")


def test_only_a_local_master_may_go_without_a_shared_folder():
    with pytest.raises(ValueError, match=SHARED_DIR):
        shared_folder(Session("spark://host:7077"), "silver")
    first, second = (shared_folder(Session("local[2]"), "a") for _ in range(2))
    assert first != second
    assert os.path.dirname(first) == os.path.dirname(second)
    assert os.path.isdir(os.path.dirname(first))
