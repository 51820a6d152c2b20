import pytest
from pyspark.sql import functions as F

from statmart import schemas
from statmart.plans import loads
from statmart.sources import catalog, delimited, grid, warehouse

BOM = "﻿"


def test_stat_csv_skips_the_byte_order_mark(spark, tmp_path):
    path = tmp_path / "population.csv"
    path.write_text(BOM + 'REF_DATE,GEO,VALUE\n2024-05,Canada,"41"\n2024-05,Canada,42\n2024-08,,7\n', encoding="utf-8")
    raw = delimited.read_stat_csv(spark, str(path), with_order=True)
    assert raw.columns[:3] == ["REF_DATE", "GEO", "VALUE"]
    got = loads.population_quarterly(raw).collect()
    assert [(str(r["ref_date"]), r["geo"], r["population"]) for r in got] == [("2024-04-01", "Canada", 41)]


def test_source_order_over_several_files(spark, tmp_path):
    for name, value in (("a.csv", 1), ("b.csv", 2)):
        lines = "".join(f"2024-01,Canada,{value}{i:04d}\n" for i in range(500))
        (tmp_path / name).write_text("REF_DATE,GEO,VALUE\n" + lines)
    raw = delimited.read_stat_csv(spark, str(tmp_path), with_order=True).repartition(7)
    assert [r["population"] for r in loads.population_quarterly(raw).collect()] == [10000]


def test_admin_tsv_null_tokens(spark, tmp_path):
    path = tmp_path / "permits.csv"
    text = "EN_YEAR\tEN_COUNTRY_OF_CITIZENSHIP\tTOTAL\n2024\tIndia\t1,200\n2024\tIndia\t--\n2024\tn/a\t5\n"
    path.write_text(BOM + text, encoding="utf-8")
    raw = delimited.read_admin_tsv(spark, str(path))
    assert [tuple(r) for r in loads.permits_by_country(raw).collect()] == [(2024, "India", 1200, 0)]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`A (9)` int, `Immigrant status:Total[1]` int, `Immigrant status:X[3]` int, other int")
    kept = delimited.select_columns(df, ["A (9)"], lambda c: c.startswith("Immigrant") and "[3]" in c)
    assert kept.columns == ["A (9)", "Immigrant status:X[3]"]
    assert delimited.first_present(df, ["missing", "other"]) == "other"
    assert df.select(delimited.column_tagged(df, "Immigrant status", "[1]")).first()[0] == 2
    assert delimited.column_tagged(df, "Immigrant status", "[11]", required=False) is None
    with pytest.raises(ValueError):
        delimited.column_tagged(df, "Immigrant status", "[11]")
    with pytest.raises(ValueError):
        delimited.first_present(df, ["missing"])


CELLS = "sheet string, row_idx bigint, col_idx int, value string, is_text boolean"


def cells(spark, lines):
    data = [
        ("s", i, j, v, not (v or "").isdigit()) for i, line in enumerate(lines) for j, v in enumerate(line) if v is not None
    ]
    return spark.createDataFrame(data, CELLS)


def test_header_probe(spark):
    sheet = cells(spark, [["title"], [], ["Country", "Type", "Year"], ["a", "b", "3"]])
    assert grid.header_rows(sheet).first()["header_row"] == 2
    names = {r["col_idx"]: r["name"] for r in grid.promote_header(sheet).collect()}
    assert names == {0: "Country", 1: "Type", 2: "Year"}
    assert grid.header_rows(cells(spark, [["title"], ["a", "1", "2"]])).first()["header_row"] == 0


def test_unpivot_year_totals(spark):
    sheet = cells(spark, [
        ["Claimants"],
        ["Country", "Type", "a", "b", "c"],
        [None, None, "2019 Total", "2020 Total", "Jan 2021"],
        ["all", None, "9", "9", "9"],
        ["Italy", None, "1,234", "--", "5"],
        ["Italy", "sub", "7", "7", "7"],
        [" ", None, "8", "8", "8"],
        ["Spain", "--", "12.6", None, "5"],
        ["n/a", None, "4", "4", "4"],
    ])
    got = sorted((r["country"], r["ref_year"], r["count"]) for r in grid.unpivot_year_totals(sheet).collect())
    assert got == [("Italy", 2019, 1234), ("Italy", 2020, None), ("Spain", 2019, 12), ("Spain", 2020, None)]
    assert loads.asylum_claimants(sheet).columns == ["ref_year", "ref_month", "country", "province", "count"]


def test_best_resource(spark):
    schema = "dataset string, id string, name string, description string, format string, last_modified string"
    df = spark.createDataFrame(
        [
            ("d", "1", "Holders by country", "citizenship", "CSV", "2024"),
            ("d", "2", "Holders by country", "citizenship", "csv", "2025"),
            ("d", "3", "Holders by province", "citizenship", "csv", "2026"),
            ("d", "4", "By country", None, "xlsx", None),
            ("e", "5", "By country", None, None, None),
            ("e", "6", "By country", "", "", ""),
        ],
        schema,
    )
    best = catalog.best_resources(df, ["dataset"], ["country", "citizenship", "holders"], required=["country"])
    assert {(r["dataset"], r["id"], r["score"]) for r in best.collect()} == {("d", "2", 7), ("e", "5", 2)}
    ties = catalog.best_resources(df, ["dataset"], ["country"], min_score=2, all_ties=True)
    assert {r["id"] for r in ties.filter("dataset = 'e'").collect()} == {"5", "6"}
    pinned = catalog.best_resources(df, ["dataset"], [], pinned=["3"]).collect()
    assert [r["id"] for r in pinned] == ["3"]
    both = catalog.best_resources(df, ["dataset"], ["country", "citizenship", "holders"], required=["country"], pinned=["3"])
    assert {(r["dataset"], r["id"], r["score"]) for r in both.collect()} == {("d", "3", None), ("e", "5", 2)}
    assert catalog.best_resources(df, ["dataset"], ["country"], min_score=9).count() == 0


def test_missing_tables_and_sources(spark, tmp_path):
    empty = warehouse.read_table(spark, str(tmp_path), schemas.POPULATION.name)
    assert empty.columns == schemas.POPULATION.schema.names and empty.isEmpty()
    with pytest.raises(warehouse.MissingSource, match="permits"):
        warehouse.require_source(empty, "permits")
    with pytest.raises(warehouse.MissingSource):
        warehouse.require_source(None, "permits")
    full = spark.range(1)
    assert warehouse.require_source(full, "permits") is full


def test_views_and_bound_parameters(spark):
    warehouse.register_views({"permits": spark.createDataFrame([(2024, 3), (2025, 4)], "ref_year int, count bigint")})
    got = spark.sql("select sum(count) from permits where ref_year = :year", args={"year": 2025}).first()[0]
    assert got == 4


def test_census_loads(spark):
    columns = ["REF_DATE", "GEO", "Citizenship (9)", "Age (8D)", "Gender (3)", "Statistics (3)", "Place of birth (290)",
               "Immigrant status (11):Total[1]", "Immigrant status (11):Immigrants[3]", "Immigrant status (11):NPR[11]"]
    def row(citizen, place, total, immigrant=None, npr=None, age="Total - Age", geo="Canada"):
        return ("2021", geo, citizen, age, "Total - Gender", "Count", place, total, immigrant, npr)
    nat, total = "Canadian citizens by naturalization", "Total – Place of birth"
    raw = spark.createDataFrame([
        row("Canadian citizens by birth", total, "100"),
        row(nat, total, "50"),
        row("Not Canadian citizens", total, "30", "20", "10"),
        row("Total - Citizenship", total, "180"),
        row("Canadian citizens by birth", total, "9", age="0 to 14"),
        row(nat, None, "3"),
        row(nat, "Asia", "30"),
        row(nat, "South Africa", "8"),
        row(nat, " Italy ", "12"),
        row(nat, "Spain", "0"),
        row(nat, "France", "5", geo="Ontario"),
    ], ", ".join(f"`{c}` string" for c in columns))
    status = sorted((r["status"], r["count"]) for r in loads.status_breakdown(raw).collect())
    assert status == [("canadian_born", 100), ("naturalized", 50), ("non_permanent_resident", 10), ("permanent_resident", 20)]
    without = raw.drop(columns[-1])
    assert loads.status_breakdown(without).filter(F.col("status") == "non_permanent_resident").count() == 0
    assert sorted((r["country"], r["count"]) for r in loads.naturalized_by_country(raw).collect()) == [("Italy", 12), ("South Africa", 8)]


def test_npr_load_maps_and_drops(spark):
    label = "Work permit holders only"
    raw = spark.createDataFrame(
        [("2024-01", " Canada ", label, "5", 2), ("2024-03", "Canada", label, "4", 1), ("2024-01", "Canada", "Total", "9", 3)],
        "REF_DATE string, GEO string, `Non-permanent resident types` string, VALUE string, _row int",
    )
    got = [tuple(r)[1:] for r in loads.npr_by_type(raw, order=["_row"]).collect()]
    assert got == [("Canada", "permit_work_only", 4)]


def test_program_column_must_exist(spark):
    with pytest.raises(ValueError):
        loads.work_permit_programs(spark.createDataFrame([("2024", "1")], "EN_YEAR string, TOTAL string"))
