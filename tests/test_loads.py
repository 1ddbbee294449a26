"""Tables of loads: packing, cleaning, id lookups that open few rows, bars of what a batch touched."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import id_lookup, warehouse
from tickloom.session import shared_folder, stream_session
from tickloom.streaming.increments import WarehouseIncrements, latest_event
from tickloom.streaming.loads import LOAD, Loads


@pytest.fixture(scope="module")
def session(spark):
    return stream_session(spark, state_partitions=2)


def _variants(session, trades):
    rows = [("trades", 0, n, json.dumps({"symbol": "aapl", "side": "BUY", "quantity": 10, "price": 210.0, **t})) for n, t in enumerate(trades)]
    return warehouse.to_variant(session.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, raw_payload STRING"))


def _trade(trade_id, time, **more):
    return {"trade_id": trade_id, "event_time": f"2024-01-01T{time}Z", **more}


def _job(session, label):
    folder = shared_folder(session, label)
    return WarehouseIncrements(session, f"{folder}/in", f"{folder}/wh", f"{folder}/ck", latest_event)


def _files(uri):
    return [f for _, _, names in os.walk(uri) for f in names if f.endswith(".parquet")]


def test_fifty_batches_leave_few_files_and_no_empty_folder(session):
    """Files and folders after 50 micro-batches, of which every seventh brings no row."""
    layout = session.createDataFrame([], "id BIGINT, event_date DATE").schema
    table = Loads(session, shared_folder(session, "fifty"), layout, ("event_date",), ("id",))
    for n in range(50):
        rows = session.range(n * 100, n * 100 + (0 if n % 7 == 6 else 100), 1, 1)
        table.write(rows.select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 2).alias("event_date")), f"query-{n}")
    ids = sorted(r.id for r in table.read().collect())
    assert len(ids) == 4300 and len(_files(table.uri)) == 86 and len(table.names()) == 50
    for n in range(3):  # a second and a third run find nothing more to do
        table.pack(spare={"query-49"})
        table.clean(0)
        assert sum(name.startswith("pack-") for name in table.names()) == 1 and len(table.names()) == 2
        assert len(_files(table.uri)) == 4 and all(_files(f"{table.uri}/load={name}") for name in table.names())
        assert sorted(r.id for r in table.read().collect()) == ids
    assert os.listdir(f"{table.uri}.packs") != [] and len(table.read().select(LOAD).distinct().collect()) == 2


def test_packing_beside_the_stream(session, monkeypatch):
    job = _job(session, "packing")
    for n in range(7):
        # One batch brings nothing new, so its load of silver has no file.
        trades = [_trade(f"t{n}", f"00:{n:02}:10"), _trade(f"x{n}", "00:00:01", side="HOLD")]
        job.apply(_variants(session, trades if n != 5 else [_trade("t4", "00:00:00")]), n)
    wanted = sorted(r.trade_id for r in job.silver().collect())
    bars = sorted((r.window_start, r.symbol, r.trade_count) for r in job.windows().collect())
    rejected = job.rejects().count()
    assert wanted == ["t0", "t1", "t2", "t3", "t4", "t6"]

    held = [job.silver(), job.windows()]  # a reader that has listed the old loads
    # A packer that dies before the ledger names its pack changes nothing.
    with monkeypatch.context() as broken:
        broken.setattr(Loads, "_list_pack", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.pack(least=2)
    assert sorted(r.trade_id for r in job.silver().collect()) == wanted
    assert len(job.pack(least=2)) == 3
    for silver, windows in ((job.silver(), job.windows()), held):
        assert sorted(r.trade_id for r in silver.collect()) == wanted
        assert sorted((r.window_start, r.symbol, r.trade_count) for r in windows.collect()) == bars
    assert job.rejects().count() == rejected

    job.pack(least=2, keep_seconds=0)
    for table in (job.silver_table, job.window_table, job.reject_table):
        # One pack and the newest load, which a failed batch would replace; no folder is empty.
        assert len(table.names()) == 2 and sum(n.startswith("pack-") for n in table.names()) == 1
        assert all(_files(f"{table.uri}/load={n}") for n in table.names())
    assert sorted(r.trade_id for r in job.silver().collect()) == wanted and job.rejects().count() == rejected
    assert sorted((r.window_start, r.symbol, r.trade_count) for r in job.windows().collect()) == bars

    # The stream goes on over packed tables: known ids stay known, bars get newer versions.
    job.apply(_variants(session, [_trade("t0", "00:00:00"), _trade("new", "00:00:30")]), 7)
    assert sorted(r.trade_id for r in job.silver().collect()) == sorted([*wanted, "new"])
    found = {(r.window_start.minute, r.symbol): int(r.trade_count) for r in job.windows().collect()}
    assert found == {(0, "AAPL"): 2} | {(n, "AAPL"): 1 for n in (1, 2, 3, 4, 6)}


def test_packs_have_files_of_the_target_size(session):
    table = Loads(session, shared_folder(session, "sizes"), session.createDataFrame([], "day INT, id BIGINT, text STRING").schema, ("day",), ("id",))
    rows = session.range(120_000).select((F.col("id") % 2).cast("int").alias("day"), "id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    for n in range(12):
        table.write(rows.where(F.col("id") % 12 == n), f"q-{n}")
    packed = table.pack(target_bytes=4 << 20, least=4, spare={"q-11"})
    table.clean(0)
    assert len(packed) == 1 and table.names() == [packed[0], "q-11"]
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{table.uri}/load={packed[0]}") for f in names if f.endswith(".parquet")]
    assert 2 <= len(sizes) <= 10 and max(sizes) < 8 << 20
    assert table.read().agg(F.count("*"), F.countDistinct("id"), F.min("day"), F.max("day")).first() == (120_000, 120_000, 0, 1)
    # Only what lies beside loads of its own size is copied again.
    for n in range(12, 16):
        table.write(rows.where(F.col("id") < 10), f"q-{n}")
    again = table.pack(target_bytes=1 << 30, least=4, spare={"q-15"})
    assert len(again) == 1 and packed[0] in table.read().select(LOAD).distinct().toPandas()[LOAD].tolist()


def test_a_load_that_is_not_finished_is_left_alone(session):
    table = Loads(session, shared_folder(session, "unfinished"), session.createDataFrame([], "id BIGINT").schema)
    for n in range(4):
        table.write(session.range(n, n + 1).select("id"), f"q-{n}")
    os.remove(f"{table.uri}/load=q-2/_SUCCESS")
    table.pack(least=2)
    table.clean(0)
    assert "q-2" in table.names() and table.read().count() == 4


def _scan(df):
    """Rows that the scan of a plan without shuffles gave on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))


def test_a_batch_opens_the_row_groups_that_may_hold_its_ids(session):
    """1,000 ids against 100 loads of 4,000 rows: absent ones open next to nothing, present ones their own loads."""
    schema = session.createDataFrame([], "trade_id STRING, id_code BIGINT, id_bucket INT").schema
    table = Loads(session, shared_folder(session, "lookup"), schema, (id_lookup.ID_BUCKET,), (id_lookup.ID_CODE,), id_lookup.WRITE_OPTIONS)
    ids = lambda first, last: id_lookup.with_id_code(session.range(first, last).select(F.concat(F.lit("trade-"), "id").alias("trade_id")))
    rows = ids(0, 400_000).withColumn(LOAD, (F.regexp_extract("trade_id", "[0-9]+", 0).cast("long") / 4000).cast("int").cast("string"))
    rows.repartition(8, LOAD).sortWithinPartitions(LOAD, "id_bucket", "id_code").write.options(**id_lookup.WRITE_OPTIONS).partitionBy(LOAD, "id_bucket").parquet(table.uri)
    stored = table.read()
    absent, present, few = ids(900_000, 901_000), ids(8_000, 9_000), ids(8_000, 8_002)
    assert _scan(id_lookup.possible_rows(stored, absent)) < 0.02 * 400_000
    assert _scan(id_lookup.possible_rows(stored, present)) < 0.04 * 400_000
    assert id_lookup.known_ids(stored, absent).count() == 0 and id_lookup.known_ids(stored, present).count() == 1000
    # Two ids lie in two buckets at most: the others are not listed.
    plan = id_lookup.possible_rows(stored, few)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "id_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    # Above the limit, buckets and a join decide.
    assert id_lookup.known_ids(stored, ids(399_000, 401_000), literal_ids=100).count() == 1000


def test_a_batch_writes_the_bars_that_it_touches(session):
    job = _job(session, "touched")
    first = [_trade(f"a{n}", f"00:{n:02}:10", symbol=s) for n in range(40) for s in ("aapl",)]
    job.apply(_variants(session, first), 0)
    second = [_trade("b1", "00:10:20"), _trade("b2", "00:10:30"), _trade("b3", "00:39:50"), _trade("b4", "00:39:20", symbol="msft"), _trade("a3", "00:03:10")]
    job.apply(_variants(session, second), 1)
    written = job.window_table.read().groupBy("version").count().collect()
    assert {r["version"]: r["count"] for r in written} == {1: 40, 2: 3}
    found = {(r.window_start.minute, r.symbol): int(r.trade_count) for r in job.windows().collect()}
    assert found[10, "AAPL"] == 3 and found[39, "AAPL"] == 2 and found[39, "MSFT"] == 1 and found[3, "AAPL"] == 1 and len(found) == 41
    whole = warehouse.minute_vwap(job.silver(), F.lit("2024-01-01 00:40:00").cast("timestamp"))
    columns = [n for n in schemas.WAREHOUSE_WINDOWS.fieldNames() if n != "loaded_at"]
    assert sorted(map(tuple, job.windows().select(*columns).collect())) == sorted(map(tuple, whole.select(*columns).collect()))
    # A batch of known ids alone writes no bar.
    job.apply(_variants(session, first[:5]), 2)
    assert job.window_table.read().where("version = 3").count() == 0


def test_only_touched_dates_are_read(session):
    job = _job(session, "dates")
    for n, day in enumerate(("01", "02")):
        job.apply(_variants(session, [{"trade_id": f"d{day}", "event_time": f"2024-01-{day}T00:30:00Z"}]), n)
    trades = job.silver_table.read()
    own = trades.where(F.col(LOAD) == "manual-1")
    bars = warehouse.minute_vwap(trades, F.lit("2024-01-02 01:00:00").cast("timestamp"), touched=own)
    assert bars.count() == 1
    assert "event_date" in bars._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
