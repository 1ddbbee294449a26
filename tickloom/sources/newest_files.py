"""Bounded read of the most recently written files of a table folder."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class NewestFiles:
    rows: DataFrame
    total: int
    loaded: int
    files: list[str]
    unreadable: list[str]

    def skipped(self, limit: int = 3) -> DataFrame:
        """Chosen files that were left out as a whole, because some of their rows cannot be read."""
        spark = self.rows.sparkSession
        return spark.createDataFrame([(f,) for f in sorted(self.unreadable)[:limit]], "file STRING")


def _plain(path):
    """Both listings spell local URIs differently: ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(F.url_decode(path), "^file:/+", "file:/")


def newest_files(
    spark: SparkSession, path: str, schema: StructType, count: int = 40
) -> NewestFiles:
    """Rows of the ``count`` newest Parquet files below ``path``.

    The listing reads no file content, only names and times; ``count`` paths come to
    the driver. Log folders (names with a leading underscore) are ignored, and a missing
    folder gives an empty result. A file of which any part cannot be read is left out as a whole: one
    pass over the chosen files compares the rows that can be read with the number the file states. A file
    that states no rows is whole.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    try:
        found = listing.load(path).select("path", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return NewestFiles(spark.createDataFrame([], schema), 0, 0, [], [])
    total = found.count()
    newest = found.orderBy(F.desc("modificationTime"), F.desc("path")).limit(count)
    files = [row.file for row in newest.select(_plain(F.col("path")).alias("file")).collect()]
    if not files:
        return NewestFiles(spark.createDataFrame([], schema), 0, 0, [], [])
    whole = _whole_files(spark, files, schema)
    broken = [f for f in files if f not in whole]
    readable = [f for f in files if f in whole]
    rows = spark.read.schema(schema).parquet(*readable) if readable else spark.createDataFrame([], schema)
    return NewestFiles(rows, total, len(files), files, broken)


def _whole_files(spark: SparkSession, files: list[str], schema: StructType) -> set[str]:
    """Those of a bounded list of files of which every stated row can be read."""
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
    name = _plain(F.col("_metadata.file_path")).alias("file")
    table = reader.parquet(*files)
    # The hash makes the scan decode all columns; without one, rows are counted from the footers.
    read = table.select(name, F.xxhash64(*table.columns).alias("code")).groupBy("file").agg(F.count("*").alias("read"), F.max("code").alias("code"))
    stated = reader.parquet(*files).select(name).groupBy("file").agg(F.count("*").alias("stated"))
    found = stated.join(read, "file", "left").select("file", (F.expr("read = stated AND code IS NOT NULL")).alias("whole")).collect()
    silent = [f for f in files if f not in {row.file for row in found}]
    return {row.file for row in found if row.whole} | set(_valid_files(spark, silent, schema))


def _valid_files(spark: SparkSession, files: list[str], schema: StructType) -> list[str]:
    """Those of a bounded list of files without rows that are Parquet files all the same; only footers are read."""
    if not files:
        return []
    strict = spark.read.schema(schema).option("ignoreCorruptFiles", "false")
    try:
        strict.parquet(*files).count()
    except (PySparkException, Py4JJavaError):
        # Some are not: each is asked by itself.
        return [f for f in files if _valid_files(spark, [f], schema)] if len(files) > 1 else []
    return files
