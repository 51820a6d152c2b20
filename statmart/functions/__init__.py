"""Column functions: text, numbers and dates as built-in Spark expressions."""

from statmart.functions.dates import (
    iso_timestamp,
    month_label,
    month_number,
    quarter_of,
    quarter_start,
    year_start,
)
from statmart.functions.numbers import (
    compact_label,
    div,
    grouped_label,
    not_negative,
    parse_count,
    percent_one_decimal,
    wide,
)
from statmart.functions.text import (
    all_present,
    code_for,
    drop_null_tokens,
    is_blank,
    is_place,
    is_region,
    place_name,
    program_code,
    short_place,
    squeeze,
    starts_with,
    template,
)

__all__ = [
    "all_present", "code_for", "compact_label", "div", "drop_null_tokens", "grouped_label", "is_blank", "is_place",
    "is_region", "iso_timestamp", "month_label", "month_number", "not_negative", "parse_count",
    "percent_one_decimal", "place_name", "program_code", "quarter_of", "quarter_start", "short_place",
    "squeeze", "starts_with", "template", "wide", "year_start",
]
