"""Which ids of an increment a table already holds, without reading the table.

Stored rows carry a hash of their id and a bucket of that hash. The bucket is a partition column, the hash
is sorted within files and has Parquet Bloom filters. An increment opens only the buckets it touches, and
a small one only the row groups that may hold one of its hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_CODE, ID_BUCKET = "id_code", "id_bucket"
BUCKETS = 8
# An increment of at most so many ids is sent to the scan as literals; a larger one meets its buckets in a join.
LITERAL_IDS = 10_000

# Filters as large as the row groups need, not of one size for all.
WRITE_OPTIONS = {
    f"parquet.bloom.filter.enabled#{ID_CODE}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def with_id_code(df: DataFrame, id_col: str = "trade_id", buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the hash of the id and its bucket; the number of buckets belongs to the table."""
    code: Column = F.xxhash64(id_col)
    return df.withColumn(ID_CODE, code).withColumn(ID_BUCKET, F.pmod(code, F.lit(buckets)).cast("int"))


def possible_rows(table: DataFrame, ids: DataFrame, literal_ids: int = LITERAL_IDS) -> DataFrame:
    """Rows of ``table`` whose hash may be among ``ids``; pruned by bucket, and by hash where the ids are few."""
    # At most the number of buckets, and at most one id more than the limit, come to the driver.
    buckets = [r[0] for r in ids.select(ID_BUCKET).distinct().collect()]
    found = table.where(F.col(ID_BUCKET).isin(buckets))
    codes = [r[0] for r in ids.select(ID_CODE).distinct().limit(literal_ids + 1).collect()]
    return found.where(F.col(ID_CODE).isin(codes)) if len(codes) <= literal_ids else found


def known_ids(table: DataFrame, ids: DataFrame, id_col: str = "trade_id", literal_ids: int = LITERAL_IDS) -> DataFrame:
    """The distinct ids of ``ids`` that ``table`` holds. Both carry hash and bucket; hashes only prune, ids decide."""
    wanted = ids.select(id_col)
    return possible_rows(table, ids, literal_ids).select(id_col).join(wanted, id_col, "left_semi").distinct()
