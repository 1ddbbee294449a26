"""Row-wise Arrow jobs that keep a frame's own columns apart from the results, and stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import arrays
from tickloom.session import shared_folder

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# (data, bounds, rows) -> one Arrow array for each result column
ChunkJob = Callable[[np.ndarray, np.ndarray, pa.StructArray], list]


def map_texts(docs: DataFrame, text: str, result: str, job: Callable[[], ChunkJob], chunk_bytes: int = arrays.CHUNK_BYTES) -> DataFrame:
    """Struct ``row`` with all columns of ``docs`` beside struct ``result`` of the DDL ``result``.

    ``job()`` runs once in each task and gives the function for chunks of rows. The row's own
    columns travel in a struct, so their names never clash with those of the result.
    """
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    schema = docs.sparkSession.createDataFrame([], f"result STRUCT<{result}>").schema
    names = [field.name for field in schema["result"].dataType]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = job()
        for batch in batches:
            rows = batch.column(0)
            for first, end, data, bounds in arrays.row_chunks(rows.field(text), chunk_bytes):
                part = rows.slice(first, end - first)
                found = pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in one(data, bounds, part)], names)
                yield pa.RecordBatch.from_arrays([part, found], ["row", "result"])

    out = T.StructType([packed.schema["row"], schema["result"]])
    return packed.mapInArrow(run, out)


def write_table(df: DataFrame, path: str) -> None:
    """Write Parquet; the shuffle files of the write go as soon as it has ended, not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES)
    conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read back, so that later steps start from files."""
    path = shared_folder(df.sparkSession, label)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_learned(id_column, modulus: int, held_out: int):
    """False for rows whose crc32 of the id as text leaves the held-out remainder; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus != held_out, F.lit(False))
