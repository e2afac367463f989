"""Text to typed values: null marker, casts, lists, JSON arrays, wide totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the two characters that stand for "no value" in the source files.
NULL_TEXT = "\\N"

WIDE = "decimal(38,0)"


def unmarked(column: Column) -> Column:
    """NULL where the text is the null marker; the empty string stays a value."""
    return F.nullif(column, F.lit(NULL_TEXT))


# Digits before and after the point that a number in an integer column may have.
_EXACT = "decimal(38,18)"
INTEGERS = ("tinyint", "smallint", "int", "bigint")

# Where a list of JSON values, at any depth, may hold something else than text: a number or an object.
_NUMBER_OR_OBJECT = r"[\[,:]\s*[-0-9{]"


def typed(column: Column, data_type: str) -> Column:
    """Text as `data_type`. Malformed text raises under ANSI mode.

    An integer may be written with a fraction or an exponent; it is rounded, halves away from zero.
    """
    text = unmarked(column)
    if data_type not in INTEGERS:
        return text.cast(data_type)
    # whole numbers are read directly; what is left is either another form of number or an error
    return F.coalesce(text.try_cast(data_type), F.round(text.cast(_EXACT), 0).cast(data_type))


def split_list(column: Column, separator: str = ",") -> Column:
    """Array of the pieces between literal separators, empty pieces kept."""
    pattern = separator if separator in (",", ";", ":", " ") else f"\\Q{separator}\\E"
    return F.split(unmarked(column), pattern, -1)


def json_strings(column: Column) -> Column:
    """JSON array as array of strings: NULL if well-formed but no array, error if malformed.

    The strict parser decides what is well-formed. It normalises numbers and sorts the keys of objects, so a list with
    either is read again by the lenient one, which keeps `1.0` and the order of keys.
    """
    text = unmarked(column)
    strict = F.try_variant_get(F.parse_json(text), "$", "array<string>")
    as_written = F.when(strict.isNotNull(), F.from_json(text, "array<string>"))
    return F.when(text.rlike(_NUMBER_OR_OBJECT), as_written).otherwise(strict)


def wide_total(column: Column) -> Column:
    """Exact sum with NULL counted as zero, beyond the range of a long."""
    addend = F.coalesce(column, F.lit(0)).cast("decimal(20,0)")
    return F.sum(addend).cast(WIDE)
