"""Batch jobs over stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickloom import schemas
from tickloom.operators import bars
from tickloom.session import prepare
from tickloom.sources.envelopes import read_table


def rewrite_daily(
    spark: SparkSession, silver_uri: str, daily_uri: str, fmt: str = "parquet"
) -> None:
    """Recompute the daily rollup from the silver table and replace the daily table."""
    trades = read_table(prepare(spark), silver_uri, schemas.SILVER, fmt)
    if fmt == "delta":
        bars.daily(trades).write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(daily_uri)
    else:
        replace_folder(bars.daily(trades), daily_uri, fmt)


def replace_folder(rows: DataFrame, uri: str, fmt: str = "parquet") -> None:
    """Replace a table of plain files by ``rows``, whatever its columns were.

    The new table is written beside the old one and takes its place only when it is complete, so a job that is
    killed while writing leaves the old table as it was. The switch is two renames; a job killed between them
    leaves the old table beside its place, and the next run, or ``restore_folder``, puts it back. On stores
    without renames the switch takes as long as a copy.
    """
    spark, uri = rows.sparkSession, uri.rstrip("/")
    restore_folder(spark, uri)
    fresh, former = f"{uri}.next-{uuid.uuid4().hex}", f"{uri}{_FORMER}"
    rows.write.format(fmt).save(fresh)
    files, path = _hadoop_path(spark, uri)
    if files.exists(path):
        _rename(spark, uri, former)
    _rename(spark, fresh, uri)
    files.delete(_hadoop_path(spark, former)[1], True)


def restore_folder(spark: SparkSession, uri: str) -> None:
    """Finish or undo an interrupted switch, and remove tables that were never completed; one writer at a time."""
    files, path = _hadoop_path(spark, uri.rstrip("/"))
    former = _hadoop_path(spark, f"{uri.rstrip('/')}{_FORMER}")[1]
    if files.exists(former):
        if files.exists(path):
            files.delete(former, True)
        else:
            _rename(spark, former.toString(), path.toString())
    parent = path.getParent()
    for status in files.listStatus(parent) if parent is not None and files.exists(parent) else []:
        if status.getPath().getName().startswith(f"{path.getName()}.next-"):
            files.delete(status.getPath(), True)


_FORMER = ".former"


def _hadoop_path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _rename(spark: SparkSession, old: str, new: str) -> None:
    files, path = _hadoop_path(spark, old)
    if not files.rename(path, _hadoop_path(spark, new)[1]):
        raise OSError(f"cannot move {old} to {new}")
