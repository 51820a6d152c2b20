import datetime

import pytest
from pyspark.sql import functions as F

from statmart import codes
from statmart import functions as fn


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_null_tokens(spark):
    cells = ["--", "- -", " N/A ", "n/a", "-", "12", None]
    assert values(spark, fn.drop_null_tokens("v"), cells) == [None, None, None, None, "-", "12", None]


def test_parse_count(spark):
    cells = ["1,234", " 7 ", "12.6", "-3.9", "1e3", "x", "", "1d", "NaN", "9007199254740993", None]
    assert values(spark, fn.parse_count("v"), cells) == [
        1234, 7, 12, -3, 1000, None, None, None, None, 9007199254740993, None,
    ]
    assert values(spark, fn.parse_count("v", strip_commas=False), ["1,234", "5"]) == [None, 5]


def test_place_name_and_validity(spark):
    cells = ["(12) Viet Nam", " Korea, Republic of", "Italy", "(x) Y", None]
    assert values(spark, fn.place_name("v"), cells) == ["Vietnam", "South Korea", "Italy", "(x) Y", None]
    names = ["Italy", "", "Other places", "unknown", "_", "Total", "total", "Central Africa", None]
    assert values(spark, fn.is_place("v"), names) == [True, False, False, False, False, False, True, False, False]


def test_region_rules(spark):
    names = ["Asia", "South Africa", "Italy", "Southeast Asia", "Ontario", "Total - Place of birth", None]
    assert values(spark, fn.is_region("v"), names) == [True, False, False, True, True, True, False]
    kept = values(spark, ~fn.is_region("v", codes.COMPATIBLE_REGIONS), names)
    assert [n for n, keep in zip(names, kept) if keep and n] == ["Asia", "Italy"]


@pytest.mark.parametrize("text, code", [
    ("International Mobility Program", "imp"),
    ("TFWP low wage", "tfwp"),
    ("Seasonal  Agricultural Worker", "tfwp"),
    ("Open Work Permit", "imp"),
    ("Post-Graduation", "imp"),
    (" IMP ", "imp"),
    ("imp stream", "imp"),
    ("impressive", "other"),
    ("", "other"),
    (None, "other"),
])
def test_program_code(one, text, code):
    assert one(fn.program_code(F.lit(text).cast("string"))) == code


def test_months(spark):
    cells = ["Jan", "SEPT.", " may ", "12", "Juin", None, "13", "-3", "2024", "0", "1"]
    assert values(spark, fn.month_number("v"), cells) == [1, 9, 5, 12, 0, 0, 0, 0, 0, 0, 1]


def test_quarters_and_labels(one):
    assert one(fn.quarter_start(F.lit("2024-05"))) == datetime.date(2024, 4, 1)
    assert one(fn.quarter_start(F.lit("2024-12-31"))) == datetime.date(2024, 10, 1)
    assert one(fn.quarter_start(F.lit("2024"))) is None
    day = F.lit("2026-01-01").cast("date")
    assert one(fn.quarter_of(day), F.year(day)) == (datetime.date(2026, 1, 1), 2026)
    assert one(fn.month_label(day)) == "January 2026"
    assert one(fn.month_label(F.lit(None).cast("date"))) == "Date unavailable"
    assert one(fn.year_start(F.lit(2021))) == datetime.date(2021, 1, 1)
    assert one(fn.year_start(F.lit(123456789))) is None and one(fn.year_start(F.lit(99999999999))) is None


def test_timestamp_text(one):
    stamp = F.lit("2026-04-26 11:33:53.019").cast("timestamp_ntz")
    assert one(fn.iso_timestamp(stamp)) == "2026-04-26 11:33:53.019000"
    assert one(fn.iso_timestamp(F.lit("2026-04-26 11:33:53").cast("timestamp_ntz"))) == "2026-04-26 11:33:53"


def test_percent_is_half_up_in_integers(spark):
    df = spark.createDataFrame([(1, 400), (7, 2000), (1, 3), (0, 5), (5, 0)], "n bigint, t bigint").coalesce(1)
    got = [r[0] for r in df.select(fn.percent_one_decimal("n", "t")).collect()]
    assert got == [0.3, 0.4, 33.3, 0.0, None]


def test_count_labels(spark):
    numbers = [1_234_567, 45_500, 44_499, 999, 999_500, 1_995_000, None]
    assert values(spark, fn.compact_label("v"), numbers, "bigint") == [
        "1.23M", "46K", "44K", "999", "1000K", "2.00M", None,
    ]
    assert values(spark, fn.compact_label("v", 1), [41_472_081], "bigint") == ["41.5M"]
    assert values(spark, fn.grouped_label("v"), [41_472_081], "bigint") == ["41,472,081"]


def test_text_helpers(one):
    assert one(fn.squeeze(F.lit("  a \t b "))) == "a b"
    assert one(fn.short_place(F.lit("United States of America"))) == "USA"
    assert one(fn.template("Study %s, work %s", F.lit(2025), F.lit(None))) == "Study 2025, work n/a"
    nothing = F.lit(None).cast("string")
    assert one(fn.starts_with(nothing, "T", False), fn.starts_with(nothing, "T", True)) == (False, True)
    assert one(fn.is_blank(nothing), fn.is_blank(F.lit(" ")), fn.is_blank(F.lit("a"))) == (True, True, False)
    assert one(fn.not_negative(F.lit(-3)), fn.not_negative(F.lit(3))) == (0, 3)
    assert one(fn.code_for(F.lit("x"), {"a": "b"}), fn.code_for(F.lit("a"), {"a": "b"})) == (None, "b")
