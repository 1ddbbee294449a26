"""The full trade contract: every violation of a row, and the normalised trade if there is none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.instants import iso_instant


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # text, whole, number or instant
    least: float | None = None  # shortest length or smallest value
    most: float | None = None  # longest length or largest value


# Fixed values of the contract, in reporting order.
FIELDS = (
    Field("trade_id", "text", least=8),
    Field("symbol", "text", least=1, most=8),
    Field("side", "text", least=3, most=4),
    Field("quantity", "whole", least=1, most=1_000_000),
    Field("price", "number", least=0.000001),
    Field("event_time", "instant"),
    Field("ingest_time", "instant"),
    Field("exchange", "text", least=2, most=16),
    Field("trader_id", "text", least=3, most=32),
    Field("sequence", "whole", least=0),
)
WHOLE = "decimal(38,0)"
LARGEST = "9" * 38
SIDES = ("BUY", "SELL")
SIDE_ERROR = "side: must be BUY or SELL"
DEFAULT_VERSION = "1.0"

# The characters Unicode counts as white space.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fixed patterns: texts that read as a whole number or as a number.
WHOLE_TEXT = r"^[+-]?\d+(?:_\d+)*$"
NUMBER_TEXT = (
    r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?"
    r"|inf|infinity|nan)$"
)


def _bound_text(bound: float) -> str:
    return f"{bound:.6f}".rstrip("0") if isinstance(bound, float) and bound < 1 else str(int(bound))


def _document(payload: str, names: list[str]) -> Column:
    """The contract's fields, each as a variant so that it keeps its JSON type.

    Bare NaN and Infinity, which strict JSON lacks, are read as texts.
    """
    fields = T.StructType([T.StructField(name, T.VariantType()) for name in names])
    quoted = F.regexp_replace(payload, r':\s*(NaN|-?Infinity)(?=\s*[,}])', ':"$1"')
    bare = F.contains(F.col(payload), F.lit("NaN")) | F.contains(F.col(payload), F.lit("Infinity"))
    return F.from_json(F.when(bare, quoted).otherwise(F.col(payload)), fields)


def _kind(value: Column) -> Column:
    """The first letters of the JSON type's name: STR, BIG, DEC, DOU, BOO, VOI, OBJ, ARR."""
    return F.substring(F.schema_of_variant(value), 1, 3)


def _get(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _trimmed(value: Column) -> Column:
    """The text without white space around it; most texts have none and are only looked at."""
    text = _get(value, "string")
    edges = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(edges.rlike("^[!-~]{2}$"), text).otherwise(F.trim(text, F.lit(BLANKS)))


def _read_text(value: Column) -> Column:
    return F.when(_kind(value) == "STR", _trimmed(value))


def _read_number(value: Column, pattern: str = NUMBER_TEXT) -> Column:
    """A double from a JSON number, a boolean or a numeric text, else null."""
    text = F.trim(_get(value, "string"), F.lit(BLANKS))
    digits = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    return (
        F.when(_kind(value).isin("BIG", "DEC", "DOU", "FLO"), _get(value, "double"))
        .when(_kind(value) == "BOO", _get(value, "boolean").cast("double"))
        .when((_kind(value) == "STR") & text.rlike(pattern), digits)
    )


def _read_whole(value: Column) -> Column:
    """A whole number of up to 38 digits, exact where the JSON has digits only; null if there is none.

    Fractions of JSON numbers are cut off. A fractional text and an infinite number are no whole
    numbers. A longer one becomes the largest or smallest of 38 digits, which the checks refuse.
    """
    kind = _kind(value)
    number = _read_number(value, WHOLE_TEXT)
    finite = (kind == "STR") | (F.abs(number) < float("inf"))
    digits = F.replace(F.trim(_get(value, "string"), F.lit(BLANKS)), F.lit("_"), F.lit(""))
    small = F.abs(number) < 2.0**53
    cut = F.when(small, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast(WHOLE))
    exact = F.when((kind == "STR"), digits.try_cast(WHOLE)).when(
        (kind == "BIG") | ((kind == "DEC") & ~small), _get(value, WHOLE)
    )
    beyond = F.lit(LARGEST).cast(WHOLE) * F.when(number < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(
        number.isNotNull() & finite, F.coalesce(exact, cut, number.try_cast(WHOLE), beyond.try_cast(WHOLE))
    )


def _read_instant(value: Column) -> Column:
    """The instant, and whether there was a text to read it from."""
    is_text = F.coalesce(_kind(value) == "STR", F.lit(False))
    offset = F.replace(_get(value, "string"), F.lit("Z"), F.lit("+00:00"))
    return F.struct(F.when(is_text, iso_instant(offset)).alias("at"), is_text.alias("is_text"))


READERS = {
    "text": _read_text,
    "whole": _read_whole,
    "number": _read_number,
    "instant": _read_instant,
}


def _readings(kind: str) -> Column:
    """All fields of a kind go through one reader, as an array in field order.

    As a lambda over an array the reader appears once in the plan; spelled out per field,
    the generated method grows beyond what the JVM compiles.
    """
    values = [F.col(f"_document.{f.name}") for f in FIELDS if f.kind == kind]
    read = READERS[kind]
    return F.transform(F.array(*values), lambda value: read(value)).alias(f"_{kind}")


def _read(field: Field) -> Column:
    position = [f.name for f in FIELDS if f.kind == field.kind].index(field.name)
    value = F.col(f"_{field.kind}")[position]
    return F.nullif(value, F.lit("")) if field.kind == "text" else value


def _violations(field: Field) -> list[Column]:
    value = _read(field)

    def error(broken: Column, message: str) -> Column:
        return F.when(broken, F.lit(f"{field.name}: {message}"))

    if field.kind == "instant":
        return [
            error(value["is_text"] & value["at"].isNull(), "invalid datetime"),
            error(~value["is_text"], "required datetime"),
        ]
    if field.kind == "text":
        found = [error(value.isNull(), "required string")]
        found.append(error(F.length(value) < field.least, f"shorter than {field.least}"))
        if field.most is not None:
            found.append(error(F.length(value) > field.most, f"longer than {field.most}"))
        return found

    below, above = value < field.least, None if field.most is None else value > field.most
    noun = "number"
    if field.kind == "whole":
        noun = "integer"
        below = value < F.lit(int(field.least))
        above = None if field.most is None else value > F.lit(int(field.most))
    found = [
        error(value.isNull(), f"required {noun}"),
        error(below, f"must be >= {_bound_text(field.least)}"),
    ]
    if above is not None:
        found.append(error(above, f"must be <= {_bound_text(field.most)}"))
    elif field.kind == "whole":
        found.append(error(value == F.lit(LARGEST).cast(WHOLE), "more than 38 digits"))
    return found


def _trade() -> Column:
    version = F.col("_document.schema_version")
    columns = []
    for field in FIELDS:
        value = _read(field)
        if field.kind == "instant":
            value = value["at"]
        elif field.kind == "whole" and field.most is not None:
            value = value.cast("bigint")
        elif field.name == "symbol":
            value = F.upper(value)
        columns.append(value.alias(field.name))
    version = F.when(version.isNull(), F.lit(DEFAULT_VERSION)).otherwise(
        F.when(_kind(version) == "BOO", F.initcap(_get(version, "string"))).otherwise(
            F.coalesce(_get(version, "string"), F.lit("None"))
        )
    )
    return F.struct(*columns, version.alias("schema_version"))


def contract_errors(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Add ``errors``, ``valid`` and ``trade`` for the JSON text in column ``payload``.

    ``errors`` holds all violations in field order, then the side check. ``trade`` is
    the normalised record (texts trimmed, symbol in capitals, times as instants), null
    where there are errors. The JSON keeps its own types here: a number is not a text.
    """
    names = [f.name for f in FIELDS] + ["schema_version"]
    # Each select rests on columns of the one before, so nothing is worked out twice; the
    # generators at both ends keep later predicates from copying the work below them.
    document = F.struct(_document(payload, names).alias("_document"))
    opened = df.select("*", F.inline(F.array(document)))
    read = opened.select("*", *map(_readings, READERS))
    side = _read(next(f for f in FIELDS if f.name == "side"))
    side_error = F.when(~side.isin(*SIDES), F.lit(SIDE_ERROR))
    checks = [check for field in FIELDS for check in _violations(field)] + [side_error]
    judged = read.withColumn("_errors", F.array_compact(F.array(*checks)))
    valid = F.size("_errors") == 0
    verdict = F.struct(
        F.col("_errors").alias("errors"),
        valid.alias("valid"),
        F.when(valid, _trade()).alias("trade"),
    )
    return judged.select(*df.columns, F.inline(F.array(verdict)))


def assert_contract(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """The normalised trades; the job fails with the joined errors of a row that has any."""
    judged = contract_errors(df, payload)
    failure = F.raise_error(F.array_join("errors", "; "))
    checked = F.when(F.col("valid"), F.col("trade")).otherwise(failure)
    return judged.select(F.inline(F.array(checked)))
