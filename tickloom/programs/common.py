"""What the programs share: the session and the arguments of an envelope source."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tickloom.sources.envelopes import read_envelopes, topic_options


def session(name: str, spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.builder.appName(name).getOrCreate()


def add_source(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--servers", help="Kafka servers; without them --source names a folder of envelope files")
    parser.add_argument("--topic", default="trades")
    parser.add_argument("--starting", default="latest")
    parser.add_argument("--per-trigger", type=int, default=5_000, help="records, or files, per micro-batch of the source")
    parser.add_argument("--source", help="folder of envelope files")
    parser.add_argument("--source-format", default="parquet")


def open_source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return read_envelopes(spark, "kafka", topic_options(args.servers, args.topic, args.starting, args.per_trigger))
    if not args.source:
        raise SystemExit("name --servers or --source")
    return read_envelopes(spark, args.source_format, {"maxFilesPerTrigger": str(args.per_trigger)}, args.source)
