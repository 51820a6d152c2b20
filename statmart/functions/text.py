"""Text cleaning and code lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from statmart import codes


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_null_tokens(c: Column | str, tokens: Iterable[str] = codes.NULL_TOKENS) -> Column:
    """Null where the cell holds a token that stands for a missing number."""
    c = _col(c)
    return F.when(~F.trim(c).isin(*tokens), c)


def is_blank(c: Column | str) -> Column:
    """True for null, empty and white-space cells."""
    return F.coalesce(F.trim(_col(c)) == "", F.lit(True))


def all_present(*columns: str) -> Column:
    """True where none of the columns is null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def squeeze(c: Column | str) -> Column:
    """Trim and turn every run of white space into one blank."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def starts_with(c: Column | str, prefix: str, when_null: bool) -> Column:
    """``startswith`` with a stated answer for null."""
    return F.coalesce(_col(c).startswith(prefix), F.lit(when_null))


def code_for(c: Column | str, mapping: Mapping[str, object], default: Column | None = None) -> Column:
    """Look a code up in a short fixed mapping; unmapped values give ``default``."""
    c = _col(c)
    if not mapping:
        return default if default is not None else F.lit(None)
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(entries, c)
    return found if default is None else F.coalesce(found, default)


def place_name(c: Column | str, rules: codes.PlaceRules = codes.DEFAULT_PLACES) -> Column:
    """Place name without its ``(12) `` list number, aliases merged."""
    clean = F.trim(_col(c))
    clean = F.when(clean.startswith("("), F.regexp_replace(clean, r"^\(\d+\)\s*", "")).otherwise(clean)
    return code_for(clean, dict(rules.aliases), default=clean)


def is_place(name: Column | str, rules: codes.PlaceRules = codes.DEFAULT_PLACES) -> Column:
    """True for a cleaned name that is a country and not a total or remainder row."""
    name = _col(name)
    low = F.lower(name)
    valid = (name != "") & ~low.isin(*rules.non_places) & ~low.startswith(rules.non_place_prefix)
    if rules.aggregates:
        valid = valid & ~name.isin(*rules.aggregates)
    return F.coalesce(valid, F.lit(False))


def is_region(c: Column | str, rules: codes.RegionRules = codes.CORRECTED_REGIONS) -> Column:
    """True for names of regions and provinces among countries; null is no region."""
    low = F.lower(_col(c))
    tests = [low.contains(text) for text in rules.contains] + [low.isin(*rules.exact)]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def program_code(
    c: Column | str,
    rules: Iterable[tuple[tuple[str, ...], tuple[str, ...], str]] = codes.PROGRAM_RULES,
    default: str = codes.DEFAULT_PROGRAM,
) -> Column:
    """Program code of a free-text program name; the first rule that fits wins."""
    text = squeeze(F.lower(_col(c)))
    chosen: Column | None = None
    for parts, whole, code in rules:
        fits = reduce(lambda a, b: a | b, [text.contains(p) for p in parts] + [text == w for w in whole])
        chosen = F.when(fits, code) if chosen is None else chosen.when(fits, code)
    return F.lit(default) if chosen is None else chosen.otherwise(default)


def short_place(c: Column | str, forms: Iterable[tuple[str, str]] = codes.PLACE_SHORT_FORMS) -> Column:
    """Chart-legend form of a place name."""
    return reduce(lambda acc, f: F.replace(acc, F.lit(f[0]), F.lit(f[1])), forms, _col(c))


def template(pattern: str, *values: Column | str, missing: str = "n/a") -> Column:
    """Fill ``%s`` places, writing ``missing`` for null."""
    return F.format_string(pattern, *[F.coalesce(_col(v).cast("string"), F.lit(missing)) for v in values])
