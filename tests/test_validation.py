import pytest
from pyspark.sql import functions as F

from tickloom.functions.rules import validation_rules
from tickloom.operators import bronze, payloads, silver
from trades import payload

CASES = {
    # payload: (strict outcome, outcome with the gaps of the plain form)
    '{"trade_id":"a","symbol":"X","side":"BUY","quantity":"100","price":"1.5"}': (
        "INVALID_QUANTITY",
        "INVALID_QUANTITY",
    ),
    '{"trade_id":"b","symbol":"X","quantity":100.5,"price":2}': (
        "INVALID_SIDE",
        "INVALID_QUANTITY",
    ),
    "not json": ("MISSING_TRADE_ID", "MISSING_TRADE_ID"),
    '{"trade_id":"c","price":NaN,"quantity":5}': ("MISSING_SYMBOL", "MISSING_SYMBOL"),
    '{"trade_id":"d","price":0,"quantity":99999999999}': ("MISSING_SYMBOL", "MISSING_SYMBOL"),
    '{"trade_id":5,"symbol":"","side":null}': ("INVALID_SIDE", "INVALID_QUANTITY"),
    '{"Trade_ID":"z"}': ("MISSING_TRADE_ID", "MISSING_TRADE_ID"),
    '{"trade_id":"e","price":1': ("MISSING_TRADE_ID", "MISSING_TRADE_ID"),
    '[{"trade_id":"arr"}]': ("MISSING_TRADE_ID", "MISSING_TRADE_ID"),
    payload(): (None, None),
    payload(side=None): ("INVALID_SIDE", None),
    payload(side=...): ("INVALID_SIDE", None),
    payload(symbol=""): (None, None),
    payload(quantity=99999999999): ("INVALID_QUANTITY", "INVALID_QUANTITY"),
    payload(quantity=2_000_000): (None, None),
    payload(quantity=-1): ("INVALID_QUANTITY", "INVALID_QUANTITY"),
    payload(price=0): ("INVALID_PRICE", "INVALID_PRICE"),
    payload(price=float("nan")): ("INVALID_PRICE", None),
    payload(event_time="bad"): ("INVALID_EVENT_TIME", "INVALID_EVENT_TIME"),
    payload(event_time="2026"): (None, None),
    payload(trade_id=None): ("MISSING_TRADE_ID", "MISSING_TRADE_ID"),
    payload(side="HOLD", quantity=-1): ("INVALID_SIDE", "INVALID_SIDE"),
}


@pytest.mark.parametrize("strict", [True, False])
def test_first_failure(bronze_of, strict):
    parsed = bronze.parse(bronze_of(CASES))
    rows = silver.classify(parsed, validation_rules(strict)).collect()
    found = {row.raw_payload: row.validation_error for row in rows}
    assert found == {text: outcome[0 if strict else 1] for text, outcome in CASES.items()}


def test_branches_cover_bronze(bronze_of):
    checked = silver.classify(bronze.parse(bronze_of(CASES)))
    assert silver.accept(checked).count() + silver.reject(checked).count() == len(CASES)


def test_accept_normalises(bronze_of):
    row = silver.accept(silver.classify(bronze.parse(bronze_of([payload()])))).first()
    assert (row.symbol, row.notional) == ("MSFT", 17_890)


def test_first_arrival_wins_and_a_hot_key_collapses_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("id-"), F.col("id")))
        .alias("trade_id"),
        F.timestamp_seconds(F.lit(1_000_000) - F.col("id")).alias("kafka_timestamp"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    kept = silver.first_arrival(rows)
    assert kept.count() == 20_001
    assert kept.filter("trade_id = 'hot'").first().offset == 29_997
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning(trade_id")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_dead_letter_message(spark):
    rejected = spark.sql(
        "SELECT 'UNKNOWN' AS message_key, 'MISSING_SYMBOL' AS validation_error, '{}' AS raw_payload,"
        " 'trades' AS topic, 1 AS partition, 7L AS offset,"
        " TIMESTAMP '2026-06-30 12:00:00' AS bronze_ingested_at"
    )
    row = payloads.dead_letters(rejected).first()
    assert row.key == "UNKNOWN"
    assert row.value == (
        '{"validation_error":"MISSING_SYMBOL","raw_payload":"{}","source_topic":"trades",'
        '"source_partition":1,"source_offset":7,"bronze_ingested_at":"2026-06-30T12:00:00.000Z"}'
    )
