"""Hand-over between streaming steps in the order of event time.

A step that reads a table with a limit on files takes them by their modification time. If every file spans all the
times of its micro-batch, a limit below the files of one batch moves the watermark past rows that are still
to be read, and they are lost. Here each micro-batch is written as files of consecutive ranges of event time, which then
move into the table one after the other with rising modification times: a cut between any two files is a cut in time.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.streaming.sinks import with_trigger

STAGED, WHEN = "_handover", "_handover_when"


class TimeOrderedTable:
    """A folder of Parquet files that a stream fills in order of ``when``.

    ``files`` is the number of time ranges of a micro-batch, by default the session's shuffle partitions. A batch is written
    aside first; from then on it is only moved. A batch that is run again goes on where the moving stopped, so
    its rows arrive once. Stores that do not take modification times order files by the time of their move, and
    by name within one tick.
    """

    def __init__(self, spark: SparkSession, uri: str, checkpoint: str, when: Column, partition_by: Sequence[str] = (), files: int | None = None):
        self.spark, self.uri, self.checkpoint = spark, uri.rstrip("/"), checkpoint
        self.when, self.partition_by, self.files = when, tuple(partition_by), files
        self._last = 0

    def start(self, df: DataFrame, name: str, trigger: str) -> StreamingQuery:
        writer = df.writeStream.queryName(name).option("checkpointLocation", self.checkpoint).foreachBatch(self.add)
        return with_trigger(writer, trigger).start()

    def add(self, batch: DataFrame, batch_id: int) -> None:
        query = self._query_id()
        staged = f"{self.uri}/{STAGED}/{query}-{batch_id:012}"
        if not self._exists(f"{staged}/_SUCCESS"):
            # Ranges are found by a look at the rows: a stateful batch, and the time of each row, are computed only once.
            held = batch.withColumn(WHEN, self.when).persist()
            try:
                count = self.files or int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                ranged = held.repartitionByRange(count, WHEN).sortWithinPartitions(WHEN).drop(WHEN)
                ranged.write.mode("overwrite").partitionBy(*self.partition_by).parquet(staged)
            finally:
                held.unpersist()
        self._move(staged, f"{batch_id:012}-{query}")
        self._forget(query, batch_id)

    def _move(self, staged: str, prefix: str) -> None:
        files, root = self._path(staged)
        listing, found = files.listFiles(root, True), []
        while listing.hasNext():
            path = listing.next().getPath()
            if path.getName().startswith("part-"):
                found.append(path.toString())
        # Names of one writer's files begin with the number of its range.
        found.sort(key=lambda p: (p.rsplit("/", 1)[1].split("-")[1], p))
        moment = max(int(time.time() * 1000), self._last + 1)
        for n, source in enumerate(found):
            folder, _, name = source.rpartition("/")
            below = folder.split(f"/{STAGED}/", 1)[1].partition("/")[2]
            number = name.split("-")[1]
            target = self._path(f"{self.uri}/{below + '/' if below else ''}{prefix}-{number}-{n:05}.parquet")[1]
            files.mkdirs(target.getParent())
            files.setTimes(self._path(source)[1], moment + n, -1)
            if not files.rename(self._path(source)[1], target):
                raise OSError(f"cannot move {source} to {target}")
        self._last = moment + len(found)

    def _forget(self, query: str, batch_id: int) -> None:
        """The mark of a batch is needed until the next one has begun."""
        files, folder = self._path(f"{self.uri}/{STAGED}")
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(f"{query}-") and int(name.rsplit("-", 1)[1]) < batch_id - 1:
                files.delete(status.getPath(), True)

    def _query_id(self) -> str:
        try:
            return self.spark.read.schema("id STRING").json(f"{self.checkpoint}/metadata").first()["id"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return "manual"

    def _path(self, uri: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, uri: str) -> bool:
        files, path = self._path(uri)
        return files.exists(path)
