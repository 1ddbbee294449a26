"""The daily rollup: replace the daily table from the silver table."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tickloom.plans.jobs import rewrite_daily
from tickloom.programs.common import session


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--silver", required=True)
    parser.add_argument("--daily", required=True)
    parser.add_argument("--table-format", default="parquet")
    args = parser.parse_args(argv)
    rewrite_daily(session("daily-rollup", spark), args.silver, args.daily, args.table_format)


if __name__ == "__main__":
    main()
