"""Merging an increment into a table, as functions of two relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.silver import first_arrival

def absent_rows(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows of ``incoming`` to append: one per key, the earliest, if ``current`` lacks the key.

    Repeats inside the increment are removed first. Only the keys of the increment that the
    table has are looked for in it, so the planner may send a small increment to the
    table instead of shuffling the table; which way is taken follows from its statistics.
    """
    arrivals = first_arrival(incoming, keys, order)
    known = current.select(*keys).join(arrivals.select(*keys), [*keys], "left_semi").distinct()
    return arrivals.join(known, [*keys], "left_anti")


def insert_absent(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    order: Sequence[str] = ("source_offset",),
) -> DataFrame:
    """``current`` with the absent rows added; existing rows stay as they are."""
    fresh = absent_rows(current, incoming, keys, order)
    return current.unionByName(fresh.select(*current.columns))


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = ("window_start", "symbol"),
) -> DataFrame:
    """``incoming`` (unique by key) plus the rows of ``current`` it does not replace.

    Both sides meet in one aggregate that keeps the newer row of each key, so each side is
    computed once.
    """
    columns = current.columns
    both = current.withColumn("_version", F.lit(0)).unionByName(
        incoming.select(*columns).withColumn("_version", F.lit(1))
    )
    return latest_version(both, keys, "_version").select(*columns)


def latest_version(versions: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Current view of an append-only table of row versions: the newest row per key."""
    columns = [name for name in versions.columns if name != version]
    newest = F.max_by(F.struct(*columns), version)
    return versions.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")
