"""A table as a folder of append-only loads, and the job that packs them.

Every load is a folder ``load=<name>`` that one write fills or replaces. Packing copies many small loads into
one, in files of a target size. A pack counts only once the ledger beside the table lists it together with the loads
it replaces; that entry is one small file, written last. A reader looks at the ledger first and then
lists the folders, so at any time it sees either the old loads or the pack, never both and never
neither. Replaced loads are removed later, when no reader that has listed them can still be running.
"""

from __future__ import annotations

import math
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import sibling
from tickloom.sources.envelopes import read_or_empty

LOAD = "load"
PACK = "pack-"
LEDGER = "replaces STRING, listed_at BIGINT, pack STRING"

TARGET_BYTES = 128 << 20
# Loads are packed when so many of a similar size lie beside each other: each row is then copied once per tier.
LEAST_LOADS = 8
TIER_WIDTH, FIRST_TIER_BYTES = 4, 1 << 20
KEEP_SECONDS = 3600


class Loads:
    """``schema`` without the load column; ``sort_by`` orders the rows of a file, ``options`` go to its writer."""

    def __init__(
        self,
        spark: SparkSession,
        uri: str,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ):
        self.spark, self.uri, self.schema = spark, uri.rstrip("/"), schema
        self.partition_by, self.sort_by, self.options = tuple(partition_by), tuple(sort_by), dict(options or {})

    # Reading

    def read(self, spark: SparkSession | None = None) -> DataFrame:
        """All rows that count, with their load; which loads those are is fixed by this call."""
        ledger = self._ledger()
        gone = sorted({name for replaced in ledger.values() for name in replaced})
        rows = read_or_empty(spark or self.spark, self.uri, T.StructType([*self.schema.fields, T.StructField(LOAD, T.StringType())]))
        return rows.where(~F.col(LOAD).isin(gone) & (~F.col(LOAD).startswith(PACK) | F.col(LOAD).isin(sorted(ledger))))

    def names(self) -> list[str]:
        """Folders of all loads, whether they count or not."""
        return sorted(name.removeprefix(f"{LOAD}=") for name in self._list(self.uri) if name.startswith(f"{LOAD}="))

    def sizes(self) -> dict[str, tuple[int, int]]:
        """Bytes and files of every load that has any, from a listing that opens no file."""
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        name = F.regexp_extract("path", f"/{LOAD}=([^/]+)/", 1)
        try:
            found = listing.load(self.uri).select(name.alias(LOAD), "length")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r[LOAD]: (r["bytes"], r["files"]) for r in found.groupBy(LOAD).agg(F.sum("length").alias("bytes"), F.count("*").alias("files")).collect()}

    # Writing

    def write(self, rows: DataFrame, name: str) -> None:
        """Fill or replace one load, in few files: the rows of one folder go to one task, or to several if they are many."""
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        if self.sort_by:
            rows = rows.sortWithinPartitions(*self.partition_by, *self.sort_by)
        columns = [field.name for field in self.schema.fields]
        writer = rows.select(*columns).write.mode("overwrite").options(**self.options)
        writer.partitionBy(*self.partition_by).parquet(f"{self.uri}/{LOAD}={name}")

    def pack(
        self,
        target_bytes: int = TARGET_BYTES,
        least: int = LEAST_LOADS,
        spare: Iterable[str] = (),
        reduce: Callable[[DataFrame], DataFrame] | None = None,
        number: Callable[[Sequence[str]], str] = lambda names: "",
        everything: bool = False,
    ) -> list[str]:
        """Copy small loads of a similar size into one each, and return the new packs.

        Loads whose files are of half the target size on average stay as they are, as do unfinished ones and those in
        ``spare``; with ``everything`` all finished loads outside ``spare`` go into one pack. ``reduce`` may leave out rows that others of the same pack supersede, ``number`` begins a
        pack's name. One packer at a time; loads may be added meanwhile. Packs that an interrupted run left
        unlisted, and loads without any file, are removed.
        """
        ledger, spare = self._ledger(), set(spare)
        gone = {name for replaced in ledger.values() for name in replaced}
        sizes = self.sizes()
        for name in self.names():
            unlisted = name.startswith(PACK) and name not in ledger and name not in gone
            if unlisted or (name not in sizes and name not in spare and self._finished(name)):
                self._delete(f"{self.uri}/{LOAD}={name}")
        alike = defaultdict(list)
        for name, (size, files) in sorted(sizes.items()):
            counts = name in ledger if name.startswith(PACK) else True
            small = everything or size < files * target_bytes / 2
            if counts and small and name not in gone and name not in spare and self._finished(name):
                tier = 0 if everything else math.floor(math.log(max(size / FIRST_TIER_BYTES, 1), TIER_WIDTH))
                alike[tier].append(name)
        return [self._pack(names, target_bytes, reduce, number(names)) for _, names in sorted(alike.items()) if len(names) >= least]

    def _pack(self, names: list[str], target_bytes: int, reduce, number: str) -> str:
        pack = f"{PACK}{number}{uuid.uuid4().hex[:12]}"
        # File sizes follow the size that adaptive execution gives its partitions.
        own = sibling(self.spark, {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)})
        rows = self.read(own).where(F.col(LOAD).isin(names)).drop(LOAD)
        rows = reduce(rows) if reduce else rows
        self.write(rows if self.partition_by else rows.hint("rebalance"), pack)
        self._list_pack(pack, names)
        return pack

    def clean(self, keep_seconds: float = KEEP_SECONDS) -> list[str]:
        """Remove the loads replaced longer ago than any reader runs, and the ledger entries that nobody needs any more."""
        ledger, times = self._ledger(), self._listed_at()
        gone = {name for replaced in ledger.values() for name in replaced}
        here, removed = set(self.names()), []
        for pack, replaced in ledger.items():
            if times[pack] <= time.time() - keep_seconds:
                removed += [name for name in replaced if name in here]
        for name in removed:
            self._delete(f"{self.uri}/{LOAD}={name}")
        here -= set(removed)
        for pack, replaced in ledger.items():
            # The entry makes a pack count, and its loads not: it goes after both.
            if pack in gone and pack not in here and not here & set(replaced):
                self._delete(f"{self._ledger_uri}/pack={pack}")
        return removed

    # Ledger

    @property
    def _ledger_uri(self) -> str:
        return f"{self.uri}.packs"

    def _entries(self) -> DataFrame:
        return read_or_empty(self.spark, self._ledger_uri, T.StructType.fromDDL(LEDGER), "json")

    def _ledger(self) -> dict[str, list[str]]:
        """The packs that count and the loads each replaces: one name for each load that is not cleaned up yet."""
        found = defaultdict(list)
        for row in self._entries().collect():
            found[row["pack"]].append(row["replaces"])
        return dict(found)

    def _listed_at(self) -> dict[str, int]:
        return {r["pack"]: r["at"] for r in self._entries().groupBy("pack").agg(F.max("listed_at").alias("at")).collect()}

    def _list_pack(self, pack: str, names: Sequence[str]) -> None:
        entry = self.spark.createDataFrame([(name, int(time.time())) for name in names], "replaces STRING, listed_at BIGINT")
        entry.coalesce(1).write.mode("overwrite").json(f"{self._ledger_uri}/pack={pack}")

    # Folders, by the file system that the URI names

    def _path(self, uri: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _list(self, uri: str) -> list[str]:
        files, path = self._path(uri)
        return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []

    def _finished(self, name: str) -> bool:
        files, path = self._path(f"{self.uri}/{LOAD}={name}/_SUCCESS")
        return files.exists(path)

    def _delete(self, uri: str) -> None:
        files, path = self._path(uri)
        files.delete(path, True)
