"""The base trade of the tests and its JSON."""

from __future__ import annotations

import json

TRADE = {
    "trade_id": "fill-0042-77",
    "symbol": "msft",
    "side": "SELL",
    "quantity": 40,
    "price": 447.25,
    "event_time": "2025-03-14T09:26:53+00:00",
    "ingest_time": "2025-03-14T09:26:55+00:00",
    "exchange": "IEX",
    "trader_id": "desk-31",
    "sequence": 12,
    "schema_version": "1.0",
}


def payload(**changes) -> str:
    """The base trade as JSON; ``...`` as a value removes the field."""
    trade = {k: v for k, v in {**TRADE, **changes}.items() if v is not ...}
    return json.dumps(trade)
