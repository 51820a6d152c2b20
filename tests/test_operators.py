import datetime

import pytest
from pyspark.sql import functions as F

from statmart.operators import dedupe, rollup, series


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_keep_first_follows_source_order(spark):
    df = spark.createDataFrame([("a", 3, 30), ("a", 1, 10), ("b", 2, 20), (None, 4, 1), (None, 5, 2)], "k string, o int, v int")
    assert dedupe.keep_first(df, ["k"], ["o"]).count() == 3
    assert rows(dedupe.keep_first(df, ["k"], ["o"]).filter("k is not null"), "k", "v") == [("a", 10), ("b", 20)]


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("c", 3), (None, 4)], "k string, v int")
    got = {r["k"]: (r["n_rows"], r["n_null_rows"]) for r in dedupe.key_violations(df, ["k"], ["v"]).collect()}
    assert got == {"a": (2, 0), "b": (1, 1), None: (1, 1)}


def test_latest_period_keeps_all_rows_of_the_latest_date(spark):
    data = [("x", 1, "p", 5), ("x", 2, "p", 6), ("x", 2, "q", None), ("y", 1, "p", 7), ("z", None, "p", 8), (None, 3, "p", 9)]
    df = spark.createDataFrame(data, "g string, d int, t string, count bigint")
    latest = rollup.rows_of_latest_period(df, by=["g"], at="d")
    assert rows(latest, "g", "d", "t", "period_total") == [("x", 2, "p", 6), ("x", 2, "q", 6), ("y", 1, "p", 7)]


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = dedupe.latest_per_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_annual_rollup_sums_suppressed_to_zero(spark):
    raw = spark.createDataFrame(
        [("2020", "X", "--"), ("2020", "X", "--"), ("2020", "Y", "1,234"), ("bad", "Y", "5"), ("2021", None, "5")],
        "y string, c string, t string",
    )
    assert rows(rollup.annual_rollup(raw, "y", "c", "country", "t")) == [(2020, "X", 0), (2020, "Y", 1234)]
    strict = rollup.annual_rollup(raw, "y", "c", "country", "t", strip_commas=False)
    assert rows(strict) == [(2020, "X", 0), (2020, "Y", 0)]


def test_latest_complete_year(spark):
    data = [("a", 2024, "x", 1), ("a", 2025, "x", 2), ("a", 2026, "x", 4), ("b", 2026, "y", 3), ("c", None, "z", 9)]
    df = spark.createDataFrame(data, "s string, ref_year int, country string, count bigint")
    assert rows(rollup.latest_period(df, 2026, ["s"])) == [("a", 2025, 2), ("b", 2026, 3)]
    assert rows(rollup.latest_period(df, None)) == [(2026, 7)]
    assert rollup.latest_period(df.filter("s = 'c'"), 2026).count() == 0
    assert rows(rollup.rows_of_latest_period(df, 2026, ["s"]), "s", "country", "count") == [("a", "x", 2), ("b", "y", 3)]


def test_latest_year_reads_the_facts_once(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.createDataFrame([(2024, "x", 1), (2025, "y", 2)], "ref_year int, country string, count bigint").write.parquet(path)
    facts = spark.read.parquet(path)
    latest = rollup.rows_of_latest_period(rollup.sum_by(facts, ["ref_year", "country"]), 2026)
    latest.collect()
    plan = latest._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_merge_and_sum(spark):
    a = spark.createDataFrame([("x", 1), ("y", None)], "country string, count bigint")
    b = spark.createDataFrame([("x", 2)], "country string, count bigint")
    assert {r[0]: r[1] for r in rollup.merge_counts([a, b], ["country"]).collect()} == {"x": 3, "y": None}
    assert rows(rollup.sum_by(a, ["country"], zero_default=True)) == [("x", 1), ("y", 0)]


def test_reference_period(spark):
    df = spark.createDataFrame([(2015,), (2020,), (None,)], "y int")
    assert rollup.reference_period(df, "y", "none").first()[0] == "2015 to 2020"
    assert rollup.reference_period(df.filter("y is null"), "y", "none").first()[0] == "none"


def test_rollup_groups(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4), ("d", 8)], "stream string, count bigint")
    assert rows(rollup.rollup_groups(df, "stream", {"a": "G", "b": "G"}, {"c": "See"})) == [("G", 3), ("See", 4), ("d", 8)]


def test_collect_ordered(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 5)], "country string, count bigint")
    order = [-F.col("count"), F.col("country")]
    got = rollup.collect_ordered(df, order, ["country"], "top").first()["top"]
    assert [r["country"] for r in got] == ["c", "a", "b"]
    assert rollup.collect_ordered(df.limit(0), order, ["country"], "top").first()["top"] == []
    many = spark.range(120_000).select(F.col("id").cast("string").alias("country"), F.col("id").alias("count"))
    assert rollup.collect_ordered(many, order, ["country"], "top").select(F.size("top")).first()[0] == 120_000


def test_percent_of_total(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 2), ("h", "c", 0), (None, "d", 3)], "g string, k string, count bigint")
    assert rows(series.percent_of_total(df), "k", "pct") == [("a", 16.7), ("b", 33.3), ("c", 0.0), ("d", 50.0)]
    grouped = series.percent_of_total(df, by=["g"])
    assert rows(grouped, "k", "total") == [("a", 3), ("b", 3), ("c", 0)]
    assert {r["k"]: r["pct"] for r in grouped.collect()} == {"a": 33.3, "b": 66.7, "c": None}


def test_year_window(spark):
    df = spark.createDataFrame([(y,) for y in (2015, 2016, 2017, None)], "y int")
    assert rows(series.year_window(df, F.col("y"), 2016)) == [(2016,), (2017,)]
    assert rows(series.year_window(df, F.col("y"), None, 2016)) == [(2015,), (2016,)]
    assert [r[0] for r in series.years_present(df.dropna(), F.col("y")).collect()] == [2015, 2016, 2017]


def test_pivot_keeps_missing_cells_null(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (2, "x", 7)], "i int, s string, count bigint")
    assert rows(series.pivot_series(df, ["i"], "s", "count", ["a", "b"]).filter("i = 1")) == [(1, 5, None)]


def test_blended_history(spark):
    quarterly = spark.createDataFrame([(datetime.date(2021, 7, 1), "permit", 9)], "ref_date date, stream string, count bigint")
    facts = spark.createDataFrame(
        [("study", 2019, 1), ("study", 2019, 2), ("work", 2019, 5), ("study", 2020, None), ("work", 2018, 7)],
        "stream string, ref_year int, count bigint",
    )
    names = {"study": "annual_study", "work": "annual_work", "asylum": "annual_asylum"}
    annual = series.align_to_driver(facts, "stream", "study", list(names), "ref_year")
    got = rows(series.blend_history(quarterly, annual, names), F.year("date"), "stream", "count", "has_source", "cadence")
    assert got == [
        (2019, "annual_asylum", 0, False, "annual"),
        (2019, "annual_study", 3, True, "annual"),
        (2019, "annual_work", 5, True, "annual"),
        (2020, "annual_asylum", 0, False, "annual"),
        (2020, "annual_study", 0, True, "annual"),
        (2020, "annual_work", 0, False, "annual"),
        (2021, "permit", 9, True, "quarterly"),
    ]
