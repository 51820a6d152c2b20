"""Number parsing and integer arithmetic that gives the same result everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statmart.functions.text import _col


def parse_count(c: Column | str, strip_commas: bool = True) -> Column:
    """Text to whole number: decimals are cut off, anything unreadable is null."""
    text = F.trim(_col(c))
    if strip_commas:
        text = F.replace(text, F.lit(","), F.lit(""))
    # The pattern keeps out texts only the JVM takes for numbers, such as "1d".
    decimal = F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    return F.coalesce(text.try_cast("bigint"), decimal.try_cast("bigint"))


def wide(c: Column | str) -> Column:
    """Whole number with room for exact products."""
    return _col(c).cast("decimal(38,0)")


def div(a: Column, b: Column) -> Column:
    """Integer division towards zero; null for a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("decimal(38,0)")))


def percent_one_decimal(part: Column | str, total: Column | str) -> Column:
    """Percentage with one decimal, halves up, from integers only; null without a total."""
    part, total = wide(part), wide(total)
    tenths = div(part * F.lit(2000) + total, total * F.lit(2))
    return tenths.cast("double") / F.lit(10.0)


def not_negative(c: Column | str) -> Column:
    """The value, or zero where it is below zero."""
    return F.greatest(_col(c), F.lit(0).cast("bigint"))


def grouped_label(c: Column | str) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.format_number(_col(c), 0)


def compact_label(c: Column | str, decimals: int = 2) -> Column:
    """``1234567`` as ``1.23M``, ``45600`` as ``46K``, smaller numbers in full."""
    n = _col(c).cast("bigint")
    scale = 10**decimals
    step = 1_000_000 // scale
    units = F.call_function("div", n + F.lit(step // 2), F.lit(step))
    millions = F.concat(
        F.call_function("div", units, F.lit(scale)).cast("string"),
        F.lit("."),
        F.lpad((units % F.lit(scale)).cast("string"), decimals, "0"),
        F.lit("M"),
    )
    thousands = F.concat(F.call_function("div", n + F.lit(500), F.lit(1000)).cast("string"), F.lit("K"))
    return F.when(n >= 1_000_000, millions).when(n >= 1_000, thousands).otherwise(grouped_label(n))
