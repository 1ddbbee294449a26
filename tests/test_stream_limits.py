"""A step takes all files of the table before it, unless a caller sets a limit."""

from __future__ import annotations

import shutil
from pathlib import Path

from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.programs import trade_streams
from tickloom.session import shared_folder, stream_session
from tickloom.streaming.graph import TradeStreams


def test_no_limit_by_default_so_that_no_row_is_late(spark):
    session = stream_session(spark, state_partitions=2)
    folder = shared_folder(session, "limits")
    seed = Path(folder.removeprefix("file:")) / "seed"
    graph = TradeStreams(session, session.range(0), f"{folder}/t", f"{folder}/c")
    rows = session.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SILVER if f.name != "event_ts"],
        F.lit("2024-01-01 00:00:10").cast("timestamp").alias("event_ts"),
    )
    rows.coalesce(1).write.parquet(str(seed))
    table = Path(graph.uri("silver").removeprefix("file:")) / "event_date=2024-01-01"
    table.mkdir(parents=True)
    part = next(seed.glob("*.parquet"))
    for n in range(1001):
        shutil.copy(part, table / f"part-{n:05}.parquet")
    query = graph.start("anomalies", "available-now")
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [1001]


def test_the_program_has_no_limit_either():
    args = trade_streams.arguments(["--source", "x", "--tables", "t", "--checkpoints", "c"])
    assert args.files_per_batch is None
