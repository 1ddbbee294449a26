"""Readers that deliver record envelopes, as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickloom.schemas import ENVELOPE


# Spark's file sources ignore files that are older than the newest one by more than this, without a
# word, and forget their names after it. Ten years: nothing that is still delivered is ignored.
MAX_FILE_AGE = "3650d"


def topic_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    per_trigger: int = 5_000,
) -> dict[str, str]:
    """Options of a log-topic source: one topic, tolerant of expired offsets, rate limited."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(per_trigger),
    }


def read_envelopes(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    stream: bool = True,
) -> DataFrame:
    """Envelopes from ``kafka`` (see :func:`topic_options`) or from files of any Spark format.

    Files need no connector; ``maxFilesPerTrigger`` is their rate limit.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt)
    if stream and fmt != "kafka":
        reader = reader.option("maxFileAge", MAX_FILE_AGE)
    reader = reader.options(**(options or {}))
    if fmt == "kafka":
        columns = [field.name for field in ENVELOPE.fields]
        return reader.load().select(*columns)
    return reader.schema(ENVELOPE).load(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    stream: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table written by one of the sinks, with its declared layout."""
    reader = (spark.readStream if stream else spark.read).format(fmt)
    if stream and fmt != "delta":
        reader = reader.option("maxFileAge", MAX_FILE_AGE)
    reader = reader.options(**(options or {}))
    if fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def read_or_empty(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """The table, or no rows of the same layout while nobody has written it yet."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
