"""ISO-8601 text to an instant, stricter than Spark's cast: a bare year or time is no date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of accepted texts.
_USUAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?[+-](?:0\d|1[0-7]):[0-5]\d$"
_GENERAL = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-?W(\d{2})(?:-?(\d))?)"
    r"(?:\D(\d{2})(?::([0-5]\d)(?::([0-5]\d)(?:[.,](\d+))?)?|([0-5]\d)(?:([0-5]\d)(?:[.,](\d+))?)?)?"
    r"(?:Z|([+-])([01]\d|2[0-3])(?::?([0-5]\d)(?::?([0-5]\d)(?:\.\d+)?)?)?)?)?$"
)

# Group numbers of the pattern above in the order year, month, day, week, weekday, hour,
# minute, second, fraction, sign, offset hour, offset minute, offset second.
_PARTS = "$1|$2$4|$3$5|$6|$7|$8|$9$12|$10$13|$11$14|$15|$16|$17|$18"


def iso_instant(text: Column) -> Column:
    """Timestamp of an ISO date or date-time, null if the text is neither.

    No zone means UTC. The full form with an offset is one cast; texts without an
    offset, basic forms, short times and week dates are assembled from their parts.
    """
    return F.when(text.rlike(_USUAL), text.try_cast("timestamp")).when(
        text.rlike(_GENERAL), _from_parts(text)
    )


def _from_parts(text: Column) -> Column:
    """One match writes all parts into a list; the lambda binds that list for the assembly."""
    parts = F.split(F.regexp_replace(text, _GENERAL, _PARTS), r"\|")
    return F.element_at(F.transform(F.array(parts), _assemble), 1)


def _assemble(parts: Column) -> Column:
    year, month, day, week, weekday, hour, minute, second, fraction = (parts[i] for i in range(9))
    sign, offset_hour, offset_minute, offset_second = (parts[i] for i in range(9, 13))

    def number(part: Column, absent: int = 0) -> Column:
        return F.coalesce(part.try_cast("int"), F.lit(absent))

    first_week = F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("date"))
    monday = F.date_add(first_week, (number(week) - 1) * 7)
    in_year = number(weekday, 1).between(1, 7) & (F.weekofyear(monday) == number(week))
    week_date = F.when(in_year, F.date_add(monday, number(weekday, 1) - 1))
    calendar_date = F.concat_ws("-", year, month, day).try_cast("date")

    offset = number(offset_hour) * 3600 + number(offset_minute) * 60 + number(offset_second)
    seconds = number(hour) * 3600 + number(minute) * 60 + number(second)
    utc = seconds - F.when(sign == "-", -offset).otherwise(offset)
    date = F.when(week == "", calendar_date).otherwise(week_date)
    micros = (
        F.unix_date(date).cast("long") * 86_400_000_000
        + utc.cast("long") * 1_000_000
        + number(F.rpad(F.substring(fraction, 1, 6), 6, "0"))
    )
    return F.when((number(hour) < 24) & (number(year) > 0), F.timestamp_micros(micros))
