"""Text predicates and clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def text_or_blank(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def is_blank(column: Column) -> Column:
    """Null, empty, or nothing but Unicode white space."""
    return F.ltrim(text_or_blank(column), F.lit(_SPACES)) == ""


def is_empty(column: Column) -> Column:
    """Null or empty; white space counts as text."""
    return text_or_blank(column) == ""


def has_text(column: Column) -> Column:
    return text_or_blank(column) != ""


def strip(column: Column) -> Column:
    return F.trim(column, F.lit(_SPACES))


def blank_to_null(column: Column) -> Column:
    return F.when(~is_blank(column), column)


def split_list(column: Column) -> Column:
    """``'fr, de'`` -> ``['fr', 'de']``."""
    return F.transform(F.split(column, ","), strip)


def preview(column: Column, chars: int) -> Column:
    return F.substring(column, 1, chars)


def column_or(df: DataFrame, name: str, default: str | None = "") -> Column:
    """The column if the table has it, with nulls replaced; otherwise the default for every row."""
    if name not in df.columns:
        return F.lit(default).cast("string")
    return F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))


def first_existing(df: DataFrame, *names: str) -> Column:
    """The first of ``names`` that is a column of ``df``. Its nulls stay: names are tried, not values."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")
