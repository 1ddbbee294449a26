"""Warehouse increments: new bronze variants into decimal silver, then into minute bars.

All targets are folders of append-only loads (see ``loads``), one per micro-batch, named by the query's
persistent id and the batch number. A batch that is run again after a failure overwrites its
own load and compares with all others, so the result is the same, and a new checkpoint over
a filled table (whose batch numbers begin at 0 again) neither replaces nor repeats what is there.
Readers see the merged table: silver loads never share an id, and of the minute bars the
largest version wins. Versions grow with the table, not with the checkpoint.

What a batch costs follows from the batch: its ids are looked up in the row groups that may hold them (see
``operators.id_lookup``), and only bars whose minute and symbol it touches are totalled and written anew. The first
batch of a checkpoint writes the whole trailing span, which mends what an abandoned checkpoint left undone.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.operators import id_lookup, warehouse
from tickloom.operators.merge import latest_version
from tickloom.operators.silver import first_arrival
from tickloom.schemas import EVENT_DATE, dated
from tickloom.sources.envelopes import read_table
from tickloom.streaming.loads import KEEP_SECONDS, LEAST_LOADS, LOAD, PACK, TARGET_BYTES, Loads
from tickloom.streaming.sinks import AVAILABLE_NOW, with_trigger

VERSION = "version"
BAR = ("window_start", "symbol")
ORDER = ("source_offset", "event_ts")


def _more(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in columns.items())])


def latest_event(silver: DataFrame) -> Column:
    """The newest event time of a table, for use as its "now".

    Of a table partitioned by event date only the newest date is searched.
    """
    if EVENT_DATE in silver.columns:
        newest = silver.agg(F.max(EVENT_DATE)).scalar()
        silver = silver.filter(F.col(EVENT_DATE) == newest)
    return silver.agg(F.max("event_ts")).scalar()


@dataclass
class WarehouseIncrements:
    """``as_of`` gives the end of the trailing span from the silver table; default is the clock."""

    spark: SparkSession
    bronze: str
    root: str
    checkpoints: str
    as_of: Callable[[DataFrame], Column] | None = None
    name: str = "warehouse_increments"

    @property
    def silver_uri(self) -> str:
        return f"{self.root.rstrip('/')}/silver_valid_trades"

    @property
    def windows_uri(self) -> str:
        return f"{self.root.rstrip('/')}/gold_symbol_windows"

    @property
    def rejects_uri(self) -> str:
        return f"{self.root.rstrip('/')}/silver_rejects"

    @property
    def checkpoint(self) -> str:
        return f"{self.checkpoints.rstrip('/')}/{self.name}"

    @property
    def silver_table(self) -> Loads:
        schema = _more(dated(schemas.WAREHOUSE_SILVER), id_code=T.LongType(), id_bucket=T.IntegerType())
        return Loads(self.spark, self.silver_uri, schema, (EVENT_DATE, id_lookup.ID_BUCKET), (id_lookup.ID_CODE,), id_lookup.WRITE_OPTIONS)

    @property
    def window_table(self) -> Loads:
        return Loads(self.spark, self.windows_uri, _more(dated(schemas.WAREHOUSE_WINDOWS), version=T.IntegerType()), (EVENT_DATE,), BAR)

    @property
    def reject_table(self) -> Loads:
        return Loads(self.spark, self.rejects_uri, schemas.VARIANT_REJECTS)

    def silver(self) -> DataFrame:
        return self.silver_table.read().drop(LOAD, EVENT_DATE, id_lookup.ID_CODE, id_lookup.ID_BUCKET)

    def rejects(self) -> DataFrame:
        return self.reject_table.read().drop(LOAD)

    def windows(self) -> DataFrame:
        loads = self.window_table.read().drop(LOAD, EVENT_DATE)
        return latest_version(loads, BAR, VERSION)

    def start(self, trigger: str = AVAILABLE_NOW) -> StreamingQuery:
        """Read bronze from where the checkpoint stands; without new rows nothing runs."""
        rows = read_table(self.spark, self.bronze, schemas.VARIANT_BRONZE, stream=True)
        writer = (
            rows.writeStream.queryName(self.name)
            .option("checkpointLocation", self.checkpoint)
            .foreachBatch(self.apply)
        )
        return with_trigger(writer, trigger).start()

    def run_available(self) -> None:
        self.start(AVAILABLE_NOW).awaitTermination()

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch into all targets."""
        spark = batch.sparkSession
        load = f"{self._query_id(spark)}-{batch_id}"
        silver = self.silver_table
        held = batch.persist()
        # The lookup asks for the ids several times; the trades are typed and sorted for it once.
        incoming = id_lookup.with_id_code(first_arrival(warehouse.variant_silver(held), ("trade_id",), ORDER)).persist()
        try:
            self.reject_table.write(warehouse.variant_rejects(held), load)
            known = id_lookup.known_ids(silver.read(spark).where(F.col(LOAD) != load), incoming)
            fresh = incoming.join(known, "trade_id", "left_anti").withColumn(EVENT_DATE, F.to_date("event_ts"))
            silver.write(_stamped(fresh), load)
        finally:
            incoming.unpersist()
            held.unpersist()
        trades = silver.read(spark)
        as_of = self.as_of(trades) if self.as_of else None
        own = trades.where(F.col(LOAD) == load) if batch_id else None
        bars = warehouse.minute_vwap(trades, as_of, touched=own)
        version, name = self._version(load)
        bars = _stamped(bars).withColumn(EVENT_DATE, F.to_date("window_start")).withColumn(VERSION, F.lit(version))
        self.window_table.write(bars, name)

    def pack(self, target_bytes: int = TARGET_BYTES, least: int = LEAST_LOADS, keep_seconds: float = KEEP_SECONDS) -> list[str]:
        """Pack the loads of all targets, then remove those replaced long ago; it may run beside the stream, one at a time.

        The newest load of each query stays: after a failure its batch is run again and replaces it.
        """
        silver, rejects, windows = self.silver_table, self.reject_table, self.window_table
        packs = []
        for table in (silver, rejects):
            packs += table.pack(target_bytes, least, _newest(table.names()))
        packs += windows.pack(target_bytes, least, _newest(windows.names()), _newest_bars, _version_prefix)
        for table in (silver, rejects, windows):
            table.clean(keep_seconds)
        return packs

    def fold_windows(self) -> None:
        """Reduce the bars to their newest versions, as one load; run it while no batch runs.

        Readers see the same table at any time. The folders of the former loads go at once.
        """
        windows = self.window_table
        windows.pack(least=2, reduce=_newest_bars, number=_version_prefix, everything=True)
        windows.clean(0)

    def _query_id(self, spark: SparkSession) -> str:
        """The id that Spark keeps in the checkpoint; a name of its own for batches without a stream."""
        try:
            return spark.read.schema("id STRING").json(f"{self.checkpoint}/metadata").first()["id"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return "manual"

    def _version(self, load: str) -> tuple[int, str]:
        """Version and name of a load of bars: those it already has, or the next version of the table.

        Names begin with the version, so the newest one is known from the folders alone.
        """
        names = self.window_table.names()
        for name in names:
            if name.endswith(f"-{load}") and not name.startswith(PACK):
                return int(name.split("-", 1)[0]), name
        version = max(map(_version_of, names), default=0) + 1
        return version, f"{version:09}-{load}"


def _stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))


def _newest(names: Sequence[str]) -> set[str]:
    """The load of the largest batch number of each query; packs are of no query."""
    batches = defaultdict(list)
    for name in names:
        query, _, number = name.rpartition("-")
        if not name.startswith(PACK) and number.isdigit():
            batches[re.sub(r"^[0-9]{9}-", "", query)].append((int(number), name))
    return {max(found)[1] for found in batches.values()}


def _version_of(name: str) -> int:
    return int(name.removeprefix(PACK).split("-", 1)[0])


def _version_prefix(names: Sequence[str]) -> str:
    """A pack of bars begins with the largest version in it."""
    return f"{max(map(_version_of, names)):09}-"


def _newest_bars(bars: DataFrame) -> DataFrame:
    """The newest version of each bar, with its version."""
    return latest_version(bars.withColumn("_order", F.col(VERSION)), BAR, "_order")
