"""Fixed-size count tables that every task fills and Spark adds up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.frames import stored

BLOCK = 1 << 14


def count_table(df: DataFrame, fill: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], size: int, label: str) -> DataFrame:
    """Stored table (block, counts): a table of ``size`` counts, summed over all tasks.

    ``fill(batches, table)`` adds a task's rows to its own table of 32-bit counts; the sums have 64 bits. Blocks without counts are left
    out; blocks of one number are added up one after another, so memory does not grow with
    the number of tasks.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.uint32)
        fill(batches, table)
        for first in range(0, size, BLOCK * 16):
            numbers, packed = [], []
            for at in range(first, min(first + BLOCK * 16, size), BLOCK):
                part = table[at : at + BLOCK]
                if part.any():
                    numbers.append(at // BLOCK), packed.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(packed, np.uint32).astype(np.uint64)
                if number == current:
                    held += values
                    continue
                if current is not None:
                    yield _row(current, held)
                current, held = number, values
        if current is not None:
            yield _row(current, held)

    def _row(number, values):
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["block", "counts"])

    schema = "block INT, counts BINARY"
    return stored(df.mapInArrow(each, schema).repartition("block").sortWithinPartitions("block").mapInArrow(total, schema), label)


def read_counts(table: DataFrame, size: int) -> np.ndarray:
    """The whole table as an array; its size is fixed by ``size``, whatever the input."""
    counts = np.zeros(size, np.uint64)
    for row in table.toLocalIterator():
        values = np.frombuffer(row["counts"], np.uint64)
        counts[row["block"] * BLOCK : row["block"] * BLOCK + len(values)] = values
    return counts
