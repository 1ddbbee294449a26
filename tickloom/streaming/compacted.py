"""The current view of a compacted topic: the newest value of each key, without the keys that were deleted.

Within a partition the offset decides; should a key have moved to another partition, the later timestamp does. Neither
repeated nor reordered delivery changes the view.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.schemas import ENVELOPE
from tickloom.streaming.loads import KEEP_SECONDS, LEAST_LOADS, LOAD, TARGET_BYTES, Loads
from tickloom.streaming.sinks import AVAILABLE_NOW, with_trigger


def newest_messages(envelopes: DataFrame) -> DataFrame:
    """The newest message of each key, deletions included. A message without a key belongs to no view."""
    columns = ENVELOPE.fieldNames()
    message = F.struct(*columns)
    keyed = envelopes.where(F.col("key").isNotNull())
    # Both steps reduce in each task before the shuffle, so a key of very many messages is one row a task.
    last = keyed.groupBy("key", "topic", "partition").agg(F.max_by(message, "offset").alias("m")).select("m.*")
    return last.groupBy("key", "topic").agg(F.max_by(message, F.struct("timestamp", "offset", "partition")).alias("m")).select("m.*")


def current_view(envelopes: DataFrame) -> DataFrame:
    """Newest messages by key; a null value deletes its key."""
    return newest_messages(envelopes).where(F.col("value").isNotNull())


@dataclass
class CompactedTopic:
    """Keeps the newest messages of a stream of envelopes as a table of loads, one for each micro-batch."""

    spark: SparkSession
    uri: str
    checkpoint: str
    name: str = "compacted_topic"

    @property
    def table(self) -> Loads:
        return Loads(self.spark, self.uri, ENVELOPE, sort_by=("key",))

    def view(self) -> DataFrame:
        return current_view(self.table.read().drop(LOAD))

    def start(self, envelopes: DataFrame, trigger: str = AVAILABLE_NOW) -> StreamingQuery:
        writer = envelopes.writeStream.queryName(self.name).option("checkpointLocation", self.checkpoint).foreachBatch(self.apply)
        return with_trigger(writer, trigger).start()

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """A batch that is run again replaces its own load; messages of an abandoned checkpoint are only repeats."""
        self.table.write(newest_messages(batch), f"{self._query_id()}-{batch_id}")

    def pack(self, target_bytes: int = TARGET_BYTES, least: int = LEAST_LOADS, keep_seconds: float = KEEP_SECONDS) -> list[str]:
        """Pack loads and drop the messages that others in the same pack supersede."""
        table = self.table
        # Deletions stay: an older message of the key may lie in a load outside the pack.
        found = table.pack(target_bytes, least, reduce=newest_messages)
        table.clean(keep_seconds)
        return found

    def _query_id(self) -> str:
        try:
            return self.spark.read.schema("id STRING").json(f"{self.checkpoint}/metadata").first()["id"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return "manual"
