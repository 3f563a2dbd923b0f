"""Text to typed value, with the vendor-file rules for numbers, times and blanks.

Every function takes and returns a Column and stays on the JVM.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 29 integer digits cover the whole range of a 96-bit decimal number.
NUMBER_TYPE = "decimal(38,9)"
# For numbers that round to a bound: their size is known, so more digits fit after the point.
FINE_TYPE = "decimal(38,20)"
STORED_DECIMAL = "decimal(18,6)"

# Unit conversions as powers of ten.
UNIT_POWERS = {
    "kw_to_w": 3,
    "mw_to_w": 6,
    "kwh_to_wh": 3,
    "mwh_to_wh": 6,
}

# Data types a mapping may name, and their stored types.
STORED_TYPES = {
    "datetime": "timestamp",
    "decimal": STORED_DECIMAL,
    "double": "double",
    "float": "float",
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bool": "boolean",
    "boolean": "boolean",
    "string": "string",
}
NUMERIC_TYPES = ("decimal", "double", "float")

_GAP = r"[\t-\r ]*"
_DIGITS = r"(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_PLAIN_NUMBER = r"^-?[0-9]+(?:\.[0-9]+)?\z"
_ANY_NUMBER = (
    rf"^{_GAP}(?:¤{_GAP})?(?:"
    rf"¤?{_DIGITS}{_GAP}¤?{_GAP}[+-]?{_GAP}"
    rf"|[+-]¤?{_DIGITS}{_GAP}¤?{_GAP}"
    rf"|\(¤?{_DIGITS}{_GAP}¤?{_GAP}\){_GAP})\z"
)

_ISO_TIME = (
    r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"(?:[T ][0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]+)?)?"
    r"\s*(?:Z|GMT|[+-][0-9]{1,2}(?::?[0-9]{2})?)?)?\s*\z"
)
_CLOCK, _ZONE = r" [0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?", r" ?(?:Z|[+-][0-9]{2}:[0-9]{2})"
_CLOCK_PATTERN = " H:mm[:ss[.SSSSSS][.SSS]]"
# Other spellings: the shape of a text decides which patterns are tried, because a
# failed attempt costs far more than the comparison.
_OTHER_TIMES = (
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}.*[AaPp][Mm]$", "M/d/yyyy h:mm[:ss] a"),
    (rf"^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}{_CLOCK}{_ZONE}$", f"M/d/yyyy{_CLOCK_PATTERN}[ ]XXX"),
    (rf"^[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}{_CLOCK}{_ZONE}$", f"yyyy/M/d{_CLOCK_PATTERN}[ ]XXX"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", f"M/d/yyyy[{_CLOCK_PATTERN}]"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", f"yyyy/M/d[{_CLOCK_PATTERN}]"),
    (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}", "d-MMM-yyyy[ H:mm[:ss]]"),
    (r"^[0-9]{1,2} [A-Za-z]{4,9} [0-9]{4}", "d MMMM yyyy[ H:mm[:ss]]"),
    (r"^[A-Za-z]{4,9} [0-9]{1,2}, [0-9]{4}", "MMMM d, yyyy[ H:mm[:ss]]"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}.*GMT$", "d MMM yyyy H:mm:ss 'GMT'"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}", "d MMM yyyy[ H:mm[:ss]]"),
    (r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}", "MMM d, yyyy[ H:mm[:ss]]"),
)


def is_blank(value: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    # Most values start with a visible ASCII character; only the others need the pattern.
    starts_visible = F.ascii(value).between(33, 126)
    return value.isNull() | (~starts_visible & value.rlike(r"^[\t-\r\x{85}\p{Z}]*\z"))


def number_text(value: Column) -> Column:
    """A plain decimal literal for any accepted spelling of a number, else NULL.

    Accepted: outer blanks, leading or trailing sign, parentheses for negative,
    thousands commas, a decimal point, an exponent and the generic currency sign.
    """
    bare = F.regexp_replace(value, "[\t-\r ,¤]", "")
    bare = F.regexp_replace(bare, r"^\((.*)\)$", "-$1")
    bare = F.regexp_replace(bare, r"^([^+-].*)([+-])$", "$2$1")
    return F.when(value.rlike(_PLAIN_NUMBER), value).when(value.rlike(_ANY_NUMBER), bare)


def number(literal: Column) -> Column:
    """The value of a literal made by :func:`number_text`; NULL when out of range."""
    return literal.try_cast(NUMBER_TYPE)


def compares(literal: Column, value: Column, bound: Decimal) -> Column:
    """-1, 0 or 1: a number against a bound, before any rounding.

    ``value`` keeps nine fraction digits and ``FINE_TYPE`` twenty; a bound of
    zero goes by the sign and the digits of the literal itself, a number that
    lies within the rounding of another bound by the twenty digits.
    """
    negative = literal.startswith("-")
    filled = F.regexp_extract(literal, "^([^eE]*)", 1).rlike("[1-9]")
    if bound == 0:
        return F.when(value.isNull(), None).when(~filled, 0).when(negative, -1).otherwise(1)
    text = format(bound, "f")
    coarse = F.lit(text).cast(NUMBER_TYPE)
    fine, exact = literal.try_cast(FINE_TYPE), F.lit(text).try_cast(FINE_TYPE)
    sure = F.when(value < coarse, -1).when(value > coarse, 1)
    near = F.when(fine < exact, -1).when(fine > exact, 1)
    return F.when(value.isNull(), None).otherwise(F.coalesce(sure, near, F.lit(0)))


def number_display(literal: Column) -> Column:
    """How a parsed number is printed in a failure text: scale kept, no plus sign."""
    plain = F.regexp_replace(literal, r"^\+", "")
    plain = F.regexp_replace(plain, r"^(-?)0+(?=[0-9])", "$1")
    plain = F.regexp_replace(plain, r"^(-?)\.", "$10.")
    plain = F.regexp_replace(plain, r"\.$", "")
    expanded = F.regexp_replace(number(literal).cast("string"), r"\.?0+$", "")
    return F.when(literal.rlike("[eE]"), expanded).otherwise(plain)


def shift_decimal(literal: Column, power: int) -> Column:
    """Multiply a number literal by a power of ten without leaving text.

    Exact whatever the target type is: the stored value is rounded once, by the
    final cast, and never by an intermediate multiplication.
    """
    if power == 0:
        return literal
    has_exponent = literal.contains("e") | literal.contains("E")
    exponent = F.regexp_extract(literal, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    mantissa = F.regexp_extract(literal, r"^([^eE]*)", 1)
    return F.when(
        has_exponent,
        F.concat(mantissa, F.lit("E"), (exponent + F.lit(power)).cast("string")),
    ).otherwise(F.concat(literal, F.lit(f"E{power}")))


def parse_time(value: Column) -> Column:
    """Text to TIMESTAMP; no offset means UTC; NULL when it is not a full date."""
    trimmed = F.trim(value)
    # Spellings Spark's own parser misses: a zone named GMT, a zone after hours and minutes.
    padded = F.regexp_replace(trimmed, r"^(\S+[T ][0-9]{1,2}:[0-9]{1,2})(?=\s*(?:Z|GMT|[+-]))", "$1:00")
    iso = F.coalesce(F.try_to_timestamp(trimmed), F.try_to_timestamp(F.regexp_replace(padded, r"\s*GMT$", "Z")))
    undated = F.regexp_replace(trimmed, r"^(?:[A-Za-z]{3}|[A-Za-z]{3,6}day), ", "")
    parsed = F.when(value.rlike(_ISO_TIME), iso)
    for shape, pattern in _OTHER_TIMES:
        parsed = parsed.when(undated.rlike(shape), F.try_to_timestamp(undated, F.lit(pattern)))
    return parsed


def to_whole(value: Column, kind: str) -> Column:
    """Integer text to ``int`` or ``bigint``; NULL when it is not, or does not fit."""
    return value.try_cast(STORED_TYPES[kind])


def to_flag(value: Column) -> Column:
    """``true`` and ``false`` in any letter case; anything else is NULL."""
    word = F.lower(F.btrim(value, F.lit("\t\n\x0b\x0c\r ")))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def unit_power(conversion: str | None) -> int:
    return UNIT_POWERS.get((conversion or "").lower(), 0)


def numeric_value(literal: Column, kind: str, conversion: str | None) -> Column:
    """A number literal, unit-converted, as the stored type of ``kind``."""
    return shift_decimal(literal, unit_power(conversion)).try_cast(STORED_TYPES[kind])
