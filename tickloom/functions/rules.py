"""Ordered rule lists, kept as data and compiled to one column each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A label that applies where the SQL condition is true (null counts as false)."""

    label: str
    condition: str
    severity: str | None = None


def first_label(rules: Sequence[Rule]) -> Column:
    """Label of the first rule that applies, else null."""
    return F.coalesce(*[F.when(F.expr(r.condition), F.lit(r.label)) for r in rules])


def first_severity(rules: Sequence[Rule]) -> Column:
    """Severity of the first rule that applies, else null."""
    return F.coalesce(*[F.when(F.expr(r.condition), F.lit(r.severity)) for r in rules])


def validation_rules(strict: bool = True) -> tuple[Rule, ...]:
    """Reasons to reject a parsed trade, in order of precedence.

    ``strict=False`` keeps two gaps of the plain SQL form: a null side is not
    rejected (``NULL NOT IN (...)`` is null), and a NaN price passes because Spark
    orders NaN above every number.
    """
    side = "side NOT IN ('BUY', 'SELL')"
    price = "price IS NULL OR price <= 0"
    if strict:
        side = f"side IS NULL OR {side}"
        price = f"{price} OR isnan(price)"
    return (
        Rule("MISSING_TRADE_ID", "trade_id IS NULL"),
        Rule("MISSING_SYMBOL", "symbol IS NULL"),
        Rule("INVALID_SIDE", side),
        Rule("INVALID_QUANTITY", "quantity IS NULL OR quantity <= 0"),
        Rule("INVALID_PRICE", price),
        Rule("INVALID_EVENT_TIME", "event_ts IS NULL"),
    )


@dataclass(frozen=True)
class Thresholds:
    """Inclusive lower bounds of the anomaly rules."""

    quantity: int = 25_000
    notional: float = 1_000_000.0
    price_move: float = 0.25


def anomaly_rules(limits: Thresholds = Thresholds()) -> tuple[Rule, ...]:
    return (
        Rule("HIGH_QUANTITY", f"quantity >= {int(limits.quantity)}", "high"),
        Rule("HIGH_NOTIONAL", f"notional >= {float(limits.notional)!r}D", "high"),
        Rule("PRICE_DISLOCATION", f"price_move_pct >= {float(limits.price_move)!r}D", "medium"),
    )
