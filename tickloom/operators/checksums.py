"""Where do two layers of trades differ? Checksums by day, then by hour, then by bar.

A checksum is a row count and the sum of row hashes, which does not depend on the order of rows. Each level is
computed only within the parts that differ on the level above; days that agree are not read again,
and where the layers are partitioned by event date they are not even opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import EVENT_DATE

# Days that differ are named to the scan as literals up to this number; more are met in a join.
LITERAL_DAYS = 1000


def _day(layer: DataFrame) -> Column:
    return F.col(EVENT_DATE) if EVENT_DATE in layer.columns else F.to_date("event_ts")


def checksums(layer: DataFrame, columns: Sequence[str], by: dict[str, Column]) -> DataFrame:
    """Row count and checksum of each group. A sum of 64-bit hashes as decimals cannot overflow."""
    code = F.xxhash64(*columns).cast("decimal(20,0)")
    return layer.groupBy(*[c.alias(n) for n, c in by.items()]).agg(F.count("*").alias("rows"), F.sum(code).alias("code"))


def differing_groups(left: DataFrame, right: DataFrame, columns: Sequence[str], by: dict[str, Column]) -> DataFrame:
    """Groups whose checksums differ: the group, left_rows, right_rows (0 where a side has none)."""
    sums = [
        checksums(side, columns, by).withColumnsRenamed({"rows": f"{name}_rows", "code": f"{name}_code"})
        for name, side in (("left", left), ("right", right))
    ]
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in by]
    condition = same[0]
    for more in same[1:]:
        condition &= more
    both = sums[0].alias("a").join(sums[1].alias("b"), condition, "full_outer")
    agree = F.col("left_rows").eqNullSafe(F.col("right_rows")) & F.col("left_code").eqNullSafe(F.col("right_code"))
    return both.where(~agree).select(
        *[F.coalesce(f"a.{n}", f"b.{n}").alias(n) for n in by],
        *[F.coalesce(f"{side}_rows", F.lit(0)).alias(f"{side}_rows") for side in ("left", "right")],
    )


def _within(layer: DataFrame, groups: DataFrame, by: dict[str, Column]) -> DataFrame:
    """Rows of the given groups."""
    wanted = groups.select(*[F.col(n).alias(f"_{n}") for n in by])
    condition = F.lit(True)
    for name, column in by.items():
        condition &= column.eqNullSafe(F.col(f"_{name}"))
    return layer.join(wanted, condition, "left_semi")


def _of_days(layer: DataFrame, days: DataFrame) -> DataFrame:
    named = [r["day"] for r in days.select("day").limit(LITERAL_DAYS + 1).collect()]
    if len(named) > LITERAL_DAYS:
        return _within(layer, days, {"day": _day(layer)})
    found = _day(layer).isin([d for d in named if d is not None])
    return layer.where(found | _day(layer).isNull() if None in named else found)


def differing_bars(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bars in which two layers of trades differ: window_start, symbol, left_rows, right_rows.

    ``columns`` are compared, by hash; both layers have them as the same types, ``event_ts`` and
    ``symbol``. Repeated rows count as often as they stand. A row without time or symbol is of the bar of null.
    """
    days = differing_groups(left, right, columns, {"day": _day(left)} if EVENT_DATE in left.columns and EVENT_DATE in right.columns else {"day": F.to_date("event_ts")})
    left, right = _of_days(left, days), _of_days(right, days)
    hour = {"hour": F.date_trunc("hour", "event_ts")}
    hours = differing_groups(left, right, columns, hour)
    bar = {"window_start": F.date_trunc("minute", "event_ts"), "symbol": F.col("symbol")}
    return differing_groups(_within(left, hours, hour), _within(right, hours, hour), columns, bar)


def differing_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that one layer has more often than the other: the columns and ``extra``, above 0 for the left layer, below for the right."""
    bar = {"window_start": F.date_trunc("minute", "event_ts"), "symbol": F.col("symbol")}
    bars = differing_bars(left, right, columns)
    sides = [_within(side, bars, bar).select(*columns).withColumn("extra", F.lit(sign)) for side, sign in ((left, 1), (right, -1))]
    return sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("extra").alias("extra")).where("extra <> 0")
