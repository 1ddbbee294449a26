"""Micro-batches compute their rows once."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import bronze, warehouse
from tickloom.operators.silver import first_arrival
from tickloom.session import stream_session
from tickloom.sources.event_tape import read_events, to_envelopes
from tickloom.streaming import increments
from tickloom.streaming.handover import TimeOrderedTable

SF_DIR = "/root/testdata/sf0.001"


def _counting(spark, kind):
    seen = spark.sparkContext.accumulator(0)

    def note(value):
        seen.add(1)
        return value

    return seen, F.udf(note, kind)


def test_an_increment_types_its_trades_once(spark, tmp_path, monkeypatch):
    seen, note = _counting(spark, "string")
    monkeypatch.setattr(increments, "first_arrival", lambda df, *rest: first_arrival(df.withColumn("trade_id", note("trade_id")), *rest))
    rows = warehouse.to_variant(bronze.to_bronze(to_envelopes(read_events(spark, SF_DIR))))
    wanted = warehouse.variant_silver(rows)
    table = increments.WarehouseIncrements(stream_session(spark), "", str(tmp_path / "warehouse"), str(tmp_path / "checkpoints"), as_of=increments.latest_event)
    table.apply(rows, 0)
    assert seen.value == wanted.count()
    assert table.silver().count() == wanted.select("trade_id").distinct().count()


def test_a_hand_over_looks_at_the_time_of_a_row_once(spark, tmp_path):
    seen, note = _counting(spark, "bigint")
    rows = spark.range(1000).select(F.col("id").alias("value"), (F.col("id") * 7 % 1000).alias("moment"))
    table = TimeOrderedTable(stream_session(spark), str(tmp_path / "table"), str(tmp_path / "checkpoint"), note("moment"), files=3)
    table.add(rows, 0)
    assert seen.value == 1000
    found = spark.read.parquet(str(tmp_path / "table" / "*.parquet"))
    assert found.columns == ["value", "moment"] and found.count() == 1000
