"""Tolerant casts: text in, typed value or NULL out, never an error (ids C1-C5, C8-C10, C27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes, stated by its rule.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# The words that count as true in a text flag.
TRUE_WORDS = ("1", "true", "t", "yes", "y", "oui", "vrai")

# Checks run on the raw text with this margin, so that stripping is paid once, for valid text only.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"  # WHITESPACE
NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
WHOLE = r"[+-]?\d+(?:\.0*)?"
FIRST_NUMBER = r"\d+\.?\d*"


def strip(c: Column) -> Column:
    """Text without surrounding whitespace of any kind (plain trim only knows the space)."""
    return F.trim(c.cast("string"), F.lit(WHITESPACE))


def matches(c: Column, pattern: str) -> Column:
    """The text, surrounding whitespace aside, has the form of the pattern."""
    return c.cast("string").rlike(f"^{SPACE}(?:{pattern}){SPACE}$")


def to_double(c: Column) -> Column:
    """Text to double. The pattern check keeps out what a Java parser would take ('12d', 'NaN')."""
    return F.when(matches(c, NUMBER), strip(c).try_cast("double"))


def to_int(c: Column, to: str = "int") -> Column:
    """Text to integer, '12.0' is 12; a fraction or an overflow is NULL. Only odd forms such as '1e3' need a decimal."""
    number = strip(c).try_cast("decimal(38,9)")
    odd = F.when(matches(c, NUMBER) & (number % 1 == 0), number.try_cast(to))
    return F.when(matches(c, WHOLE), F.substring_index(strip(c), ".", 1).try_cast(to)).otherwise(odd)


def first_number(c: Column) -> Column:
    """First unsigned number inside a text such as '123.4 e'; NULL when there is none."""
    return F.regexp_substr(c, F.lit(FIRST_NUMBER)).try_cast("double")


def is_one(c: Column) -> Column:
    """Numeric flag; true when its integer part is 1, false for anything else and NULL."""
    number = to_double(c)
    return F.coalesce((number >= 1) & (number < 2), F.lit(False))


def is_truthy(c: Column) -> Column:
    """Text (or boolean) flag by word list; NULL is false."""
    return F.coalesce(F.lower(strip(c)).isin(*TRUE_WORDS), F.lit(False))


def is_letter_t(c: Column) -> Column:
    """Exactly the letter 't', case-sensitive; NULL is false."""
    return F.coalesce(c == F.lit("t"), F.lit(False))


def nan_to_null(c: Column) -> Column:
    """A double NaN is a missing value."""
    return F.when(~F.isnan(c), c)
