from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions.contract import FIELDS, assert_contract, contract_errors
from tickloom.functions.instants import iso_instant
from trades import payload

CASES = [
    (payload(), []),
    (payload(quantity="100"), []),
    (payload(quantity=" 1_000 "), []),
    (payload(quantity=100.5), []),
    (payload(quantity=True), []),
    (payload(quantity=1_000_000.5), []),
    (payload(quantity=0.5), ["quantity: must be >= 1"]),
    (payload(quantity=-1), ["quantity: must be >= 1"]),
    (payload(quantity=1_000_001), ["quantity: must be <= 1000000"]),
    (payload(quantity=10**25), ["quantity: must be <= 1000000"]),
    (payload(quantity="1.5"), ["quantity: required integer"]),
    (payload(quantity=None), ["quantity: required integer"]),
    (payload(quantity=[1]), ["quantity: required integer"]),
    (payload(quantity=float("inf")), ["quantity: required integer"]),
    (payload(sequence=-0.5), []),
    (payload(sequence=-1), ["sequence: must be >= 0"]),
    (payload(sequence=10**37), []),
    (payload(sequence=10**39), ["sequence: more than 38 digits"]),
    (payload(sequence="9" * 50), ["sequence: more than 38 digits"]),
    (payload(sequence=-(10**39)), ["sequence: must be >= 0"]),
    (payload(price="1e3"), []),
    (payload(price="nan"), []),
    (payload(price=float("nan")), []),
    (payload(price="x"), ["price: required number"]),
    (payload(price=1e-7), ["price: must be >= 0.000001"]),
    (payload(price=...), ["price: required number"]),
    (payload(trade_id=5), ["trade_id: required string"]),
    (payload(trade_id="short"), ["trade_id: shorter than 8"]),
    (payload(trade_id="  short      "), ["trade_id: shorter than 8"]),
    (payload(symbol=" "), ["symbol: required string"]),
    (payload(symbol="ABCDEFGHI"), ["symbol: longer than 8"]),
    (payload(side="HOLD"), ["side: must be BUY or SELL"]),
    (payload(side="X"), ["side: shorter than 3", "side: must be BUY or SELL"]),
    (payload(side=...), ["side: required string"]),
    (payload(event_time=5), ["event_time: required datetime"]),
    (payload(event_time="20:00:00"), ["event_time: invalid datetime"]),
    (payload(event_time=" 2026-06-30"), ["event_time: invalid datetime"]),
    (payload(ingest_time="2026-06-30T12:00:01Z"), []),
    (payload(exchange="N", trader_id="t"), ["exchange: shorter than 2", "trader_id: shorter than 3"]),
]


def test_all_violations_in_order(bronze_of):
    rows = contract_errors(bronze_of([text for text, _ in CASES])).orderBy("offset").collect()
    for row, (text, expected) in zip(rows, CASES, strict=True):
        assert row.errors == expected, text
        assert row.valid == (not expected)
        assert (row.trade is None) == bool(expected)


@pytest.mark.parametrize("number", [2**53 + 1, 1751284800123456789, 2**63, 2**70, 0])
def test_whole_numbers_stay_exact(bronze_of, number):
    for row in contract_errors(bronze_of([payload(sequence=number), payload(sequence=str(number))])).collect():
        assert row.trade.sequence == number


def test_a_version_that_is_a_boolean(bronze_of):
    assert [r.trade.schema_version for r in contract_errors(bronze_of([payload(schema_version=True), payload(schema_version=1)])).orderBy("offset").collect()] == ["True", "1"]


def test_a_document_that_is_no_object_misses_every_field(bronze_of):
    for row in contract_errors(bronze_of(["not json", "[1]", "{}"])).collect():
        assert [e.split(":")[0] for e in row.errors] == [f.name for f in FIELDS]


def test_normalised_trade(bronze_of):
    text = payload(
        symbol=" msft ", quantity="100", event_time="2026-06-30T12:00:00-05:30", schema_version=...
    )
    trade = contract_errors(bronze_of([text])).first().trade
    assert (trade.symbol, trade.quantity, trade.quantity * trade.price) == ("MSFT", 100, 44_725)
    assert trade.event_time == datetime(2026, 6, 30, 17, 30)
    assert trade.schema_version == "1.0"


def test_strict_form_passes_good_rows_and_raises_all_errors_of_a_bad_one(bronze_of):
    assert assert_contract(bronze_of([payload()])).first().symbol == "MSFT"
    bad = assert_contract(bronze_of([payload(quantity=-1, side="HOLD")]))
    with pytest.raises(Exception, match="quantity: must be >= 1; side: must be BUY or SELL"):
        bad.collect()


INSTANTS = """2026-06-30 20260630 2026-W27 2026-W27-2 2026W272 2020-W53-7 2021-W53-1 2026-06-30T12
2026-06-30T12:30 2026-06-30T12:30:15 2026-06-30T12:30:15.5 2026-06-30T12:30:15,123456789
20260630T123015.25+0530 2026-06-30T12:30:15+00:00 2026-06-30T12:30:15.123456-05:30
2026-06-30T12:30:15+05 2026-06-30T12:30:15+05:30:10 2026-06-30x12:30 2026-13-01 2026-02-30
2026-06-30T24:00 2026-06-30T23:60 2026-06-30T23:59:60 bad 2026 12:00:00 2026-06-30T 2026-W00-1
2026-W27-8 0000-01-01 2026-06-30T12:3 2026-6-30 2024-02-29T00:00:00+23:59""".split()


def _python_instant(text):
    try:
        parsed = datetime.fromisoformat(text)
    except ValueError:
        return None
    parsed = parsed if parsed.tzinfo else parsed.replace(tzinfo=UTC)
    return parsed.astimezone(UTC).replace(tzinfo=None)


def test_instants_agree_with_the_standard_library(spark):
    df = spark.createDataFrame([(text,) for text in INSTANTS], "text STRING")
    found = df.select("text", iso_instant(F.col("text")).cast("timestamp_ntz").alias("at"))
    assert {r.text: r["at"] for r in found.collect()} == {t: _python_instant(t) for t in INSTANTS}
