"""Column expressions on text: missing values, numeric text, safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smeltery.vocabulary import MISSING_TOKENS

# Fixed value: plain decimal text. No sign but minus, no exponent, no bare dot;
# \z (not $) so that a trailing line feed does not pass.
NUMERIC_TEXT = r"^-?[0-9]+(?:\.[0-9]+)?\z"

# Fixed value: text that a lenient reader of numbers accepts, exponent included.
LENIENT_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def null_if_missing(column: Column, tokens: tuple[str, ...] = MISSING_TOKENS) -> Column:
    """Trimmed text, or null when it is one of the missing-value tokens."""
    trimmed = F.trim(column)
    return F.when(~F.lower(trimmed).isin(*tokens), trimmed)


def without_commas(column: Column) -> Column:
    return F.replace(column, F.lit(","), F.lit(""))


def without_separators(column: Column) -> Column:
    """Drop thousands commas and all whitespace, inner whitespace included."""
    return F.regexp_replace(column, r"[,\s]", "")


def is_numeric_text(column: Column) -> Column:
    return column.rlike(NUMERIC_TEXT)


def is_blank(column: Column, is_text: bool = True) -> Column:
    """Null, or text that is empty once trimmed; other types are only null."""
    return column.isNull() | (F.trim(column) == "") if is_text else column.isNull()


def is_populated(column: Column) -> Column:
    return column.isNotNull() & (F.trim(column) != "")


def parse_number(cleaned: Column, target: str) -> Column:
    """Value of numeric text; null for other text and for values out of range."""
    return F.when(is_numeric_text(cleaned), cleaned.try_cast(target))


def coerce_text(column: Column) -> Column:
    """Text as a finite double, else null; an exponent is allowed here."""
    text = F.trim(column)
    return finite_or_null(F.when(text.rlike(LENIENT_NUMBER), text.try_cast("double")))


def finite_or_null(value: Column) -> Column:
    """Drop NaN and both infinities from a double column."""
    infinity = F.lit(float("inf"))
    return F.when(~F.isnan(value) & (F.abs(value) != infinity), value)
