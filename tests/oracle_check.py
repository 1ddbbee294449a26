"""Compare registered queries with their SQL oracles: python tests/oracle_check.py DIR [NAME ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (int, Decimal)):
        return float(value) if isinstance(value, Decimal) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when columns, row count and values agree, whatever the order."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = _bag(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    kinds = {column[0]: str(column[1]) for column in result.description}
    other = {n: (k, kinds[n]) for n, k in spark_df.dtypes if TYPES.get(k) != kinds[n]}
    if other:
        return [f"types {other}"]
    actual = _bag(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    found = []
    if sum(actual.values()) != sum(expected.values()):
        found.append(f"rows {sum(actual.values())} against {sum(expected.values())}")
    extra, missing = actual - expected, expected - actual
    found += [f"only in Spark: {row}" for row in list(extra)[:3]]
    found += [f"only in SQL: {row}" for row in list(missing)[:3]]
    return found


def main() -> int:
    import __spark_entry__ as driver
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    connection, failed = connect(sf_dir), 0
    for name, function in driver.queries().items():
        if (wanted and name not in wanted) or name not in driver.oracle_sql():
            continue
        started = time.time()
        try:
            found = differences(function(spark, sf_dir), connection, driver.oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.2f}s", *found, sep="\n  ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
