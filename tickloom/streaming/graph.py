"""The stream graph: source to bronze, bronze to silver and dead letters, silver to gold.

Each table feeds the next one, so the source is read once and the ids of the dedup
step are held once, whatever the number of gold tables and topics.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.functions.rules import Rule, Thresholds, anomaly_rules, validation_rules
from tickloom.operators import anomalies, bars, bronze, payloads, silver
from tickloom.schemas import EVENT_DATE, dated
from tickloom.sources.envelopes import read_table
from tickloom.streaming.handover import TimeOrderedTable
from tickloom.streaming.sinks import AVAILABLE_NOW, write_stream


@dataclass(frozen=True)
class Step:
    """One query of the graph: where it reads, what it computes, where it writes."""

    reads: str | None
    build: Callable[["TradeStreams", DataFrame], DataFrame]
    folder: str
    schema: T.StructType
    topic: bool = False
    partition_by: tuple[str, ...] = ()
    when: str | None = None  # SQL of the event time, for tables that a step with a watermark reads


def _silver(graph: TradeStreams, table: DataFrame) -> DataFrame:
    valid = silver.valid_trades(
        bronze.parse(table), graph.rules, watermark=graph.watermark, mode=graph.dedup
    )
    return valid.withColumn(EVENT_DATE, F.to_date("event_ts"))


def _counted(df: DataFrame, metric: str, column: str, labels: Iterable[str]) -> DataFrame:
    """Counts the labels of a column while the rows pass, into the progress reports."""
    return df.observe(metric, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(column) == label).alias(label) for label in labels])


def _rejected(graph: TradeStreams, table: DataFrame) -> DataFrame:
    rules = graph.rules or validation_rules()
    # Custom rules may ask for any field.
    checked = silver.classify(bronze.parse(table, None if graph.rules else bronze.RULE_FIELDS), rules)
    return silver.reject(_counted(checked, "rejects", "validation_error", dict.fromkeys(r.label for r in rules)))


def _trades(graph: TradeStreams, table: DataFrame) -> DataFrame:
    return table.drop(EVENT_DATE).withWatermark("event_ts", graph.watermark)


def _anomalies(graph: TradeStreams, table: DataFrame) -> DataFrame:
    flagged = anomalies.flag(table.drop(EVENT_DATE), graph.prices, graph.thresholds)
    severities = dict.fromkeys(r.severity for r in anomaly_rules(graph.thresholds))
    return anomalies.only_anomalies(_counted(flagged, "flags", "severity", severities))


STEPS: Mapping[str, Step] = {
    "bronze": Step(
        None,
        lambda g, df: bronze.to_bronze(df),
        "bronze/raw_trades",
        schemas.BRONZE,
        when="try_to_timestamp(get_json_object(raw_payload, '$.event_time'))",
    ),
    "silver": Step(
        "bronze",
        _silver,
        "silver/valid_trades",
        dated(schemas.SILVER),
        partition_by=(EVENT_DATE,),
        when="event_ts",
    ),
    "dead_letters": Step(
        "bronze",
        lambda g, df: payloads.dead_letters(_rejected(g, df)),
        "topics/dead_letters",
        schemas.MESSAGE,
        topic=True,
    ),
    "anomalies": Step("silver", _anomalies, "gold/anomalies", schemas.ANOMALY),
    "tumbling": Step(
        "silver", lambda g, df: bars.tumbling(_trades(g, df)), "gold/tumbling", schemas.TUMBLING
    ),
    "sliding": Step(
        "silver", lambda g, df: bars.sliding(_trades(g, df)), "gold/sliding", schemas.SLIDING
    ),
    "sessions": Step(
        "silver", lambda g, df: bars.sessions(_trades(g, df)), "gold/sessions", schemas.SESSIONS
    ),
    "anomaly_messages": Step(
        "anomalies",
        lambda g, df: payloads.anomaly_messages(df),
        "topics/anomalies",
        schemas.MESSAGE,
        topic=True,
    ),
    "bar_messages": Step(
        "tumbling",
        lambda g, df: payloads.bar_messages(df),
        "topics/aggregates",
        schemas.MESSAGE,
        topic=True,
    ),
}


@dataclass
class TradeStreams:
    """All queries over one envelope stream.

    ``source`` must belong to ``spark``, a session made by ``stream_session``. Topics
    are written as Parquet messages unless ``brokers`` is set, which needs the Kafka
    connector on the class path. ``table_format`` other than Parquet needs its
    connector as well. ``rules``, ``prices`` and ``thresholds`` replace the defaults of
    validation and anomaly flags. ``read_options`` limit what a step takes from the table before it
    in one micro-batch; ``step_options`` add to them or replace them for single steps. There is no limit
    by default: every file of a table spans the times of its micro-batch, so a limit below the files of one
    batch moves the watermark past rows that are still to be read. With ``hand_over``, bronze and silver
    are written in files of consecutive event times (see ``handover``), as many as it says for
    each micro-batch, and limits lose nothing. A table is written in one of the two ways from its first batch on.
    """

    spark: SparkSession
    source: DataFrame
    root: str
    checkpoints: str
    watermark: str = "2 minutes"
    dedup: str = "exact"
    table_format: str = "parquet"
    brokers: str | None = None
    rules: Sequence[Rule] | None = None
    prices: DataFrame | None = None
    thresholds: Thresholds = Thresholds()
    read_options: Mapping[str, str] = field(default_factory=dict)
    step_options: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    hand_over: int | None = None
    topics: Mapping[str, str] = field(
        default_factory=lambda: {
            "dead_letters": "trades-rejected",
            "anomaly_messages": "trade-anomalies",
            "bar_messages": "trade-aggregates",
        }
    )

    def uri(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{STEPS[name].folder}"

    def table(
        self, name: str, stream: bool = False, options: Mapping[str, str] | None = None
    ) -> DataFrame:
        step = STEPS[name]
        fmt = "parquet" if step.topic else self.table_format
        return read_table(self.spark, self.uri(name), step.schema, fmt, stream, options)

    def start(self, name: str, trigger: str = "10 seconds") -> StreamingQuery:
        step = STEPS[name]
        if step.reads is None:
            read = self.source
        else:
            options = {**self.read_options, **self.step_options.get(name, {})}
            read = self.table(step.reads, stream=True, options=options)
        output = step.build(self, read)
        if step.topic and self.brokers:
            options = {"kafka.bootstrap.servers": self.brokers, "topic": self.topics[name]}
            return write_stream(
                output, name, None, self.checkpoints, "kafka", trigger, options=options
            )
        fmt = "parquet" if step.topic else self.table_format
        if self.hand_over and step.when and fmt == "parquet":
            checkpoint = f"{self.checkpoints.rstrip('/')}/{name}"
            table = TimeOrderedTable(self.spark, self.uri(name), checkpoint, F.expr(step.when), step.partition_by, self.hand_over)
            return table.start(output, name, trigger)
        return write_stream(
            output,
            name,
            self.uri(name),
            self.checkpoints,
            fmt,
            trigger,
            partition_by=step.partition_by,
        )

    def start_all(self, trigger: str = "10 seconds") -> list[StreamingQuery]:
        """Start every query, upstream first; ``spark.streams.awaitAnyTermination`` waits."""
        return [self.start(name, trigger) for name in STEPS]

    def run_available(self, wanted: Iterable[str] = tuple(STEPS)) -> dict[str, StreamingQuery]:
        """Process what is there now and stop: the wanted queries and what they read from.

        Queries on the same level run side by side.
        """
        needed = {name for last in wanted for name in self._lineage(last)}
        finished: dict[str, StreamingQuery] = {}
        while len(finished) < len(needed):
            level = [
                name
                for name in STEPS
                if name in needed
                and name not in finished
                and (STEPS[name].reads is None or STEPS[name].reads in finished)
            ]
            running = {name: self.start(name, AVAILABLE_NOW) for name in level}
            for query in running.values():
                query.awaitTermination()
            finished |= running
        return finished

    @staticmethod
    def _lineage(name: str | None) -> list[str]:
        steps = []
        while name is not None:
            steps.append(name)
            name = STEPS[name].reads
        return steps
