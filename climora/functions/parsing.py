"""Text to value: tolerant numbers, dates and blanks, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that may surround a Latin-1 cell, no-break space and next-line included.
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# Decimal literals with digit groups, and the names of the non-finite numbers.
_NUMBER = (
    r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)"
    r"(?:e[+-]?\d+(?:_\d+)*)?|inf|infinity|nan)$"
)


def strip_text(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def blank_to_null(text: Column) -> Column:
    """Strip, and turn what is left empty into NULL."""
    return F.nullif(strip_text(text), F.lit(""))


def empty_to_null(text: Column) -> Column:
    """Turn the empty text into NULL, without stripping."""
    return F.nullif(text, F.lit(""))


def tolerant_double(text: Column, decimal_comma: bool = False) -> Column:
    """Text to double; anything that is not a decimal number becomes NULL.

    Spark's own cast also takes Java spellings (``1.5d``, ``0x1p3``), so their letters are spoilt
    first. What this refuses wrongly, digit groups (``1_000``), ``inf`` and odd blanks, gets a second
    look; only those cells pay for the regular expression. The expression is kept short: a long one
    in many columns makes a generated method too large to be compiled.
    """
    cell = text.cast("string")
    spoilt = F.translate(cell, ",dDfFxX" if decimal_comma else "dDfFxX", ".######"[not decimal_comma :])
    usual = spoilt.try_cast("double")
    bare = strip_text(F.translate(cell, ",", ".") if decimal_comma else cell)
    unusual = F.when(bare.rlike(_NUMBER), F.replace(bare, F.lit("_"), F.lit(""))).try_cast("double")
    return F.when(cell != "", F.coalesce(usual, unusual))


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` to date; bad text becomes NULL."""
    return F.try_to_date(strip_text(text.cast("string")), "yyyyMMdd")


def slash_date(text: Column) -> Column:
    """``year/month/day`` to date, leading zeros optional; bad text becomes NULL."""
    return F.try_to_date(strip_text(text), "y/M/d")


def iso_date_text(day: Column) -> Column:
    return day.cast("string")


def csv_cells(line: Column, separator: str = ";") -> Column:
    """Cells of one delimited line; quotes are honoured where a line has any."""
    quoted = F.transform(
        F.regexp_extract_all(
            F.concat(line, F.lit(separator)),
            F.lit(rf'("(?:[^"]|"")*"|[^{separator}]*){separator}'),
            F.lit(1),
        ),
        lambda cell: F.when(
            cell.startswith('"') & cell.endswith('"') & (F.length(cell) >= 2),
            F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, separator))


def whole_number(value: Column) -> Column:
    """Double to integer, halves to the even neighbour (a plain cast would truncate)."""
    return F.bround(value).cast("int")


def leading_text(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)
