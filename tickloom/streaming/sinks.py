"""Checkpointed stream writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

AVAILABLE_NOW = "available-now"


def with_trigger(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_stream(
    df: DataFrame,
    name: str,
    uri: str | None,
    checkpoints: str,
    fmt: str = "parquet",
    trigger: str = "10 seconds",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start one named query with a checkpoint folder of its own.

    Table formats need ``uri``. Format ``kafka`` takes key and value columns and the
    options ``kafka.bootstrap.servers`` and ``topic``. All locations are URI strings.
    """
    writer = (
        df.writeStream.format(fmt)
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
        .options(**(options or {}))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = with_trigger(writer, trigger)
    return writer.start(uri) if uri else writer.start()
