"""The stream graph: source to bronze, silver, gold and messages."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tickloom.functions.rules import Thresholds, validation_rules
from tickloom.programs.common import add_source, open_source, session
from tickloom.session import stream_session
from tickloom.streaming.graph import STEPS, TradeStreams
from tickloom.streaming.progress import ProgressLog
from tickloom.streaming.sinks import AVAILABLE_NOW


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    add_source(parser)
    parser.add_argument("--tables", required=True, help="root folder of the tables")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--steps", nargs="*", default=list(STEPS), choices=list(STEPS))
    parser.add_argument("--trigger", default="10 seconds", help=f"an interval, or {AVAILABLE_NOW} to take what is there and stop")
    parser.add_argument("--state-partitions", type=int, help="fixed for the life of the checkpoints; default: the session's shuffle partitions")
    parser.add_argument("--watermark", default="2 minutes")
    parser.add_argument("--dedup", choices=("exact", "bounded"), default="exact")
    parser.add_argument("--table-format", default="parquet")
    parser.add_argument("--lenient", action="store_true", help="validation as plain SQL: nulls and NaN pass where no rule names them")
    parser.add_argument("--files-per-batch", type=int, help="files of a table that the next step takes in one micro-batch; default: no limit")
    parser.add_argument("--hand-over", type=int, help="time ranges of a micro-batch of bronze and silver; goes with --files-per-batch")
    parser.add_argument("--quantity", type=int, default=Thresholds().quantity)
    parser.add_argument("--notional", type=float, default=Thresholds().notional)
    parser.add_argument("--price-move", type=float, default=Thresholds().price_move)
    parser.add_argument("--prices", help="Parquet table (symbol, reference_price) in place of the fixed prices")
    parser.add_argument("--progress", help="table that gets every progress report")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    if args.files_per_batch and not args.hand_over:
        raise SystemExit("--files-per-batch needs --hand-over: without it a limit loses rows to the watermark")
    own = stream_session(session("trade-streams", spark), args.state_partitions)
    graph = TradeStreams(
        own,
        open_source(own, args),
        args.tables,
        args.checkpoints,
        watermark=args.watermark,
        dedup=args.dedup,
        table_format=args.table_format,
        brokers=args.servers,
        rules=validation_rules(strict=not args.lenient),
        prices=own.read.parquet(args.prices) if args.prices else None,
        thresholds=Thresholds(args.quantity, args.notional, args.price_move),
        hand_over=args.hand_over,
        read_options={"maxFilesPerTrigger": str(args.files_per_batch)} if args.files_per_batch else {},
    )
    log = ProgressLog(own, args.progress) if args.progress else None
    if log:
        own.streams.addListener(log)
    try:
        if args.trigger == AVAILABLE_NOW:
            finished = graph.run_available(args.steps)
            if log:
                log.wait(finished.values())
        else:
            for name in STEPS:
                if name in args.steps:
                    graph.start(name, args.trigger)
            own.streams.awaitAnyTermination()
    finally:
        if log:
            log.flush()
            own.streams.removeListener(log)


if __name__ == "__main__":
    main()
