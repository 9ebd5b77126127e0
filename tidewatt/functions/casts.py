"""Lenient and strict conversions from raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JVM parses '12f' and '3d' as numbers; no source file means them as such.
_TYPE_SUFFIX = r"[0-9.][dDfF]\s*$"
_ISO_DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(_column(c), F.lit(""))


def lenient_double(c: str | Column) -> Column:
    """Blank or unparseable text becomes NULL."""
    text = blank_to_null(c)
    return F.when(~text.rlike(_TYPE_SUFFIX), text.try_cast("double"))


def lenient_int(c: str | Column) -> Column:
    """As lenient_double, then rounded half away from zero; out of range becomes NULL."""
    return F.round(lenient_double(c)).try_cast("int")


def lenient_date(c: str | Column) -> Column:
    """Text starting with a full ISO day; a bare year or month is not a date."""
    text = blank_to_null(c)
    return F.when(text.rlike(_ISO_DAY), text.try_cast("date"))


def strict(c: str | Column, to: str) -> Column:
    """Fails the query on a bad value (ANSI cast)."""
    return _column(c).cast(to)


def null_tokens(c: str | Column, tokens=("", "NULL", "null")) -> Column:
    text = _column(c)
    return F.when(~text.isin(*tokens), text)


def strip_nul(c: str | Column) -> Column:
    return F.replace(_column(c), F.lit("\x00"), F.lit(""))
