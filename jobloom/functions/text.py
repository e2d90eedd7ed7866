"""Small text helpers shared by the other function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters as the original store counts them: letters of any script, digits, underscore.
WORD = r"[\p{L}\p{N}_]"


def whole_word(pattern: str, boundary: str = "strict") -> str:
    """Java regex for `pattern` as a whole word, case ignored.

    strict: the match must start and end on a word character, so a pattern that ends in a sign
    (C++, C#) never matches. loose: only the neighbours must not be word characters.
    """
    flags = "(?i)" if pattern.isascii() else "(?iu)"
    if boundary == "strict":
        return f"{flags}(?<!{WORD})(?={WORD})(?:{pattern})(?<={WORD})(?!{WORD})"
    if boundary == "loose":
        return f"{flags}(?<!{WORD})(?:{pattern})(?!{WORD})"
    raise ValueError(f"unknown boundary: {boundary}")


def first_group(col: Column, regex: str, group: int = 1) -> Column:
    """regexp_extract that gives NULL, not '', when nothing matches."""
    return F.nullif(F.regexp_extract(col, regex, group), F.lit(""))


def not_blank(col: Column) -> Column:
    return col.isNotNull() & (F.trim(col) != "")


def fold(col: Column) -> Column:
    """Natural key form of a display name."""
    return F.lower(F.trim(col))


def text_to_boolean(col: Column) -> Column:
    """Boolean spelled as text, including on/off; anything else is NULL."""
    word = fold(col)
    return F.when(word == "on", F.lit(True)).when(word == "off", F.lit(False)).otherwise(word.try_cast("boolean"))


def slug(col: Column) -> Column:
    return F.lower(F.regexp_replace(col, r"\s+", "-"))


def iso_day(col: Column) -> Column:
    """The calendar day of a text that starts like YYYY-MM-DD; impossible days give NULL."""
    return F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(col, 1, 10).try_cast("date"))


def date_key(day: Column) -> Column:
    """Integer YYYYMMDD of a date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_date(key: Column) -> Column:
    """The date of an integer YYYYMMDD, of any year; the inverse of date_key."""
    part = lambda divisor, modulus: F.pmod(F.floor(key / divisor), F.lit(modulus)).cast("int")
    return F.make_date(part(10000, 10000), part(100, 100), part(1, 100))
