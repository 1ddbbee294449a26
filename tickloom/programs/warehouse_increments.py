"""Warehouse increments: envelopes into variant bronze, decimal silver and minute bars."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tickloom.operators import bronze, warehouse
from tickloom.programs.common import add_source, open_source, session
from tickloom.session import stream_session
from tickloom.streaming.increments import WarehouseIncrements
from tickloom.streaming.sinks import AVAILABLE_NOW, write_stream


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    add_source(parser)
    parser.add_argument("--bronze", required=True, help="folder of the variant bronze table")
    parser.add_argument("--warehouse", required=True, help="root folder of silver, rejects and bars")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--trigger", default=AVAILABLE_NOW)
    parser.add_argument("--fold", action="store_true", help="reduce the bars to their newest versions afterwards")
    parser.add_argument("--pack", action="store_true", help="pack small loads of silver, rejects and bars afterwards")
    parser.add_argument("--state-partitions", type=int)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    own = stream_session(session("warehouse-increments", spark), args.state_partitions)
    job = WarehouseIncrements(own, args.bronze, args.warehouse, args.checkpoints)
    variants = warehouse.to_variant(bronze.to_bronze(open_source(own, args)))
    landing = write_stream(variants, "variant_bronze", args.bronze, args.checkpoints, trigger=args.trigger)
    if args.trigger == AVAILABLE_NOW:
        landing.awaitTermination()
        job.run_available()
        if args.fold:
            job.fold_windows()
        if args.pack:
            job.pack()
        return
    job.start(args.trigger)
    own.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
