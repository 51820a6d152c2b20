"""Reference dates and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statmart import codes
from statmart.functions.text import _col, code_for


def quarter_of(c: Column | str) -> Column:
    """First day of the quarter of a date or timestamp."""
    return F.trunc(_col(c).cast("date"), "quarter")


def quarter_start(c: Column | str) -> Column:
    """First day of the quarter of a ``yyyy-MM`` text (a day part is ignored); unreadable gives null."""
    return F.trunc(F.try_to_date(F.substring(F.trim(_col(c)), 1, 7), "yyyy-MM"), "quarter")


def year_start(c: Column | str) -> Column:
    """First of January of a year; null for what is no year from 1 to 9999."""
    year = _col(c).try_cast("int")
    return F.make_date(F.when(year.between(1, 9999), year), F.lit(1), F.lit(1))


def month_label(c: Column | str, missing: str = "Date unavailable") -> Column:
    """``2026-01-01`` as ``January 2026``."""
    return F.coalesce(F.date_format(_col(c), "MMMM yyyy"), F.lit(missing))


def month_number(c: Column | str) -> Column:
    """Month name or number text as 1 to 12; unknown names, other numbers and null give 0."""
    text = F.replace(F.lower(F.trim(_col(c))), F.lit("."), F.lit(""))
    named = code_for(text, codes.MONTH_NUMBERS)
    number = text.try_cast("int")
    return F.coalesce(named, F.when(number.between(1, 12), number), F.lit(0))


def iso_timestamp(c: Column | str) -> Column:
    """Timestamp text with microseconds, which are left out when they are zero."""
    return F.regexp_replace(F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
