import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from statmart import schemas
from statmart.operators import lineage
from statmart.operators.lineage import SourceMeta
from statmart.plans import documents, marts, refresh, views
from statmart.sinks import BrokenKey, append_rows, publish_rows, replace_slice, replace_table, shape_for, versions
from statmart.sources.warehouse import LostTable, read_document, read_table, table_path


def d(text):
    return datetime.date.fromisoformat(text)


def simple_loads(spark, **changes):
    """A small warehouse: three countries, two quarters, one census."""
    def frame(rows, schema):
        return lambda: spark.createDataFrame(rows, schema)

    by_country = "ref_year int, ref_month int, country string, count bigint"
    whole = {"province": "_", "source_dataset": "test"}
    facts = [(2024, 0, "Italy", 6), (2024, 0, "Spain", 3), (2024, 0, "Viet Nam", 2), (2024, 0, "Vietnam", 2),
             (2026, 0, "Italy", 1)]
    builds = {
        "population_quarterly": (schemas.POPULATION, frame(
            [(d("2025-10-01"), "Canada", 1000), (d("2026-01-01"), "Canada", 1010)],
            "ref_date date, geo string, population bigint"), {"source_table": "test"}, "ref_date"),
        "npr_by_type_quarterly": (schemas.NPR, frame(
            [(d("2025-10-01"), "Canada", "permit_work_only", 4), (d("2026-01-01"), "Canada", "permit_work_only", 6),
             (d("2026-01-01"), "Canada", "asylum_no_permit", 4), (d("2026-01-01"), "Elsewhere", "permit_other", 99)],
            "ref_date date, geo string, npr_type string, count bigint"), {"source_table": "test"}, "ref_date"),
        "status_breakdown_census": (schemas.STATUS_CENSUS, frame(
            [(2021, "Canada", "canadian_born", 700), (2021, "Canada", "naturalized", 200),
             (2021, "Canada", "permanent_resident", 100), (2021, "Canada", "non_permanent_resident", 5)],
            "census_year int, geo string, status string, count bigint"), {"source_table": "test"}, "census_year"),
        "naturalized_by_country_census": (schemas.NATURALIZED, frame(
            [(2021, "Italy", 30), (2021, "Asia", 10), (2021, "Total", 40)], "census_year int, country string, count bigint"),
            {"source_table": "test"}, "census_year"),
        "study_permits_monthly": (schemas.STUDY, frame(facts, by_country), {**whole, "study_level": "_"}, "ref_year"),
        "work_permits_monthly": (schemas.WORK, frame(facts, by_country), {**whole, "program_stream": "work_permit"}, "ref_year"),
        "permanent_residents_monthly": (schemas.PERMANENT, frame(facts, by_country),
                                        {**whole, "immigration_category": "permanent_resident"}, "ref_year"),
        "work_permit_programs_monthly": (schemas.WORK_PROGRAMS, lambda: None, {}, None),
        "asylum_claimants_monthly": (schemas.ASYLUM, frame([], by_country), whole, None),
    }
    out = []
    for key, (table, build, constants, period) in builds.items():
        out.append(refresh.Load(SourceMeta(key, "id-" + key, "test"), table, changes.get(key, build), constants, period,
                                optional=key == "work_permit_programs_monthly"))
    return out


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root, folder = (str(tmp_path_factory.mktemp(n)) for n in ("warehouse", "data"))
    done = refresh.refresh(spark, root, simple_loads(spark), folder, documents.Export(as_of=2026, k=2, first_annual_year=2024, first_quarterly_year=2025))
    return root, folder, done


def doc(folder, name):
    return json.loads((Path(folder) / name).read_text())


def test_refresh_outcome(spark, published):
    root, folder, done = published
    assert done.failures == {} and set(done.skipped) == {"work_permit_programs_monthly", "asylum_claimants_monthly"}
    assert done.rows["population_quarterly"] == 2 and len(done.published) == 11
    log = {r["dataset_key"]: r for r in read_table(spark, root, "source_loads").collect()}
    assert log["work_permit_programs_monthly"]["status"] == "skipped"
    assert log["population_quarterly"]["reference_period"] == "2025-10-01 to 2026-01-01"
    assert len({r["load_id"] for r in log.values()}) == len(log)
    runs = lineage.current_runs(read_table(spark, root, "pipeline_runs")).collect()
    assert [(r["status"], "population_quarterly" in r["sources_fetched"]) for r in runs] == [("success", True)]
    assert sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith(".")) == sorted([*documents.DOCUMENTS, *SECTIONS])


SECTIONS = [
    "population_history.data.jsonl", "status_breakdown.census_snapshots.jsonl", "visa_streams_history.data.jsonl",
    "origin_pr_history.data.jsonl", "origin_naturalized.all_census_data.jsonl",
]


def section(folder, name):
    return [json.loads(line) for part in sorted(Path(folder, name).glob("part-*")) for line in part.read_text().splitlines()]


def test_documents(published):
    _, folder, _ = published
    assert doc(folder, "population_current.json")["population"] == 1010
    assert sorted(r["date"] for r in section(folder, "population_history.data.jsonl")) == ["2025-10-01", "2026-01-01"]
    status = doc(folder, "status_breakdown.json")
    assert [r["count"] for r in status["actual_latest"]["rows"]] == [700, 200, 100, 10]
    assert [r["count"] for r in status["estimated_latest"]["rows"]] == [700, 200, 100, 10]
    assert status["estimated_latest"]["total"] == status["estimated_latest"]["reconciles_to_population_total"] == 1010
    assert status["source_dates"] == {"population_current": "2026-01-01", "npr_current": "2026-01-01", "census_status": "2021"}
    assert len(section(folder, "status_breakdown.census_snapshots.jsonl")) == 4 and status["latest_census_year"] == 2021
    streams = doc(folder, "visa_streams_current.json")
    assert streams["streams"] == [
        {"stream": "permit_work_only", "count": 6, "pct": 60.0}, {"stream": "asylum_no_permit", "count": 4, "pct": 40.0},
    ]
    assert (streams["total_npr"], streams["ref_date"]) == (10, "2026-01-01")
    history = doc(folder, "visa_streams_history.json")
    data = sorted((r["date"], r["stream"], r["count"]) for r in section(folder, "visa_streams_history.data.jsonl"))
    assert data[:3] == [
        ("2024-01-01", "annual_asylum_claimants", 0), ("2024-01-01", "annual_study_permit_holders", 13),
        ("2024-01-01", "annual_work_permit_holders", 13),
    ]
    assert len(data) == 6 and history["series_meta"]["permit_other"]["group"] == "Quarterly"
    programs = doc(folder, "work_permit_sources_current.json")
    assert (programs["available"], programs["ref_year"], programs["total"], programs["streams"]) == (False, None, 0, [])
    assert programs["freshness"]["sources"][0]["reference_period"] is None
    assert doc(folder, "origin_pr_current.json")["top2"] == [{"country": "Italy", "count": 6}, {"country": "Vietnam", "count": 4}]
    assert {r["year"] for r in section(folder, "origin_pr_history.data.jsonl")} == {2024, 2026}
    temp = doc(folder, "origin_temp_current.json")
    assert (temp["study_permits"]["ref_year"], temp["asylum_claimants"]["ref_year"]) == (2024, None)
    assert temp["asylum_claimants"]["top2"] == []
    listed = sorted(section(folder, "origin_naturalized.all_census_data.jsonl"), key=lambda r: -r["count"])
    assert [r["country"] for r in listed] == ["Total", "Italy", "Asia"]
    overview = doc(folder, "origin_overview.json")["categories"]
    assert [c["category"] for c in overview] == ["foreign_born_total", "naturalized", "permanent_resident", "temporary_resident"]
    for c in overview:
        assert sum(r["count"] for r in c["top2"]) + c["non_top_2"] == c["total"]
    assert overview[1]["top2"] == [{"country": "Italy", "count": 150}, {"country": "Asia", "count": 50}]
    assert overview[3]["source_period"] == "Study 2024, work 2024, asylum n/a"


def test_document_can_be_read_back(spark, published):
    _, folder, _ = published
    row = read_document(spark, folder + "/population_current.json", "population bigint, ref_date date, source string").first()
    assert (row["population"], row["ref_date"]) == (1010, d("2026-01-01"))


def test_failed_source_keeps_old_rows_and_marks_documents(spark, tmp_path):
    root, folder = str(tmp_path / "warehouse"), str(tmp_path / "data")
    refresh.refresh(spark, root, simple_loads(spark), None)

    def broken():
        raise RuntimeError("download failed")

    duplicate = spark.createDataFrame([(2021, "Italy", 1), (2021, "Italy", 2)], "census_year int, country string, count bigint")
    loads = simple_loads(spark, population_quarterly=broken, naturalized_by_country_census=lambda: duplicate,
                         study_permits_monthly=lambda: None)
    done = refresh.refresh(spark, root, loads, folder, documents.Export(as_of=2026))
    assert set(done.failures) == {"population_quarterly", "naturalized_by_country_census", "study_permits_monthly"}
    assert read_table(spark, root, "population_quarterly").count() == 2
    assert read_table(spark, root, "naturalized_by_country_census").count() == 3
    fresh = doc(folder, "population_current.json")["freshness"]
    assert fresh["stale"] and fresh["failed_sources"] == [{"dataset_key": "population_quarterly", "error": "download failed"}]
    assert fresh["sources"][0]["status"] == "failed" and fresh["latest_source_reference"] is None
    assert not doc(folder, "visa_streams_current.json")["freshness"]["stale"]


def test_empty_warehouse_publishes_what_needs_no_rows(spark, tmp_path):
    done = refresh.refresh(spark, str(tmp_path / "warehouse"), [], str(tmp_path / "data"), documents.Export(as_of=2026))
    assert "population_current.json" not in done.published and "status_breakdown.json" in done.published
    status = doc(str(tmp_path / "data"), "status_breakdown.json")
    assert status["latest_census_year"] == 2021 and status["estimated_latest"]["total"] == 0
    assert status["actual_latest"]["rows"][0]["ref_date"] == "2021-01-01"


def test_failing_publication_fails_the_run(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(refresh, "export_all", fail)
    root = str(tmp_path / "warehouse")
    with pytest.raises(RuntimeError, match="disk full"):
        refresh.refresh(spark, root, [], str(tmp_path / "data"))
    run = lineage.current_runs(read_table(spark, root, "pipeline_runs")).first()
    assert run["status"] == "failed" and run["finished_at"] is not None and "disk full" in run["notes"]


def test_slice_replace_keeps_other_slices(spark, tmp_path):
    path = table_path(str(tmp_path), schemas.POPULATION.name)
    def rows(*data):
        df = spark.createDataFrame(list(data), "ref_date date, geo string, population bigint")
        return shape_for(df, schemas.POPULATION, {"source_table": "test"})
    day = d("2026-01-01")
    assert replace_slice(rows((day, "Canada", 1), (day, "Ontario", 2)), path, "geo", schemas.POPULATION).rows == 2
    replace_slice(rows((day, "Canada", 3)), path, "geo", schemas.POPULATION)
    assert replace_slice(rows(), path, "geo", schemas.POPULATION).rows == 0
    with pytest.raises(BrokenKey):
        replace_slice(rows((day, "Canada", 4), (day, "Canada", 5)), path, "geo", schemas.POPULATION)
    with pytest.raises(BrokenKey):
        replace_slice(rows((day, "Canada", None)), path, "geo", schemas.POPULATION)
    got = read_table(spark, str(tmp_path), schemas.POPULATION.name)
    assert sorted((r["geo"], r["population"]) for r in got.collect()) == [("Canada", 3), ("Ontario", 2)]
    assert [p.name for p in Path(tmp_path).iterdir()] == [schemas.POPULATION.name]


def test_table_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    def held():
        return versions.frame(spark, path, df.schema).count()
    assert replace_table(df, path).rows == 2
    assert replace_table(df.limit(0), path, keep_if_empty=True).rows == 0 and held() == 2
    assert replace_table(df.filter("i = 1"), path).rows == 1 and held() == 1
    assert replace_table(df.limit(0), path).rows == 0 and held() == 0


def test_rows_can_be_published_in_parallel(spark, tmp_path):
    publish_rows(spark.createDataFrame([("a", None), ("b", 2)], "k string, n int"), str(tmp_path / "rows"))
    got = spark.read.schema("k string, n int").json(str(tmp_path / "rows")).collect()
    assert sorted(tuple(r) for r in got if r["n"]) == [("b", 2)] and len(got) == 2


def test_period_is_that_of_the_load(spark, tmp_path):
    """A slice load states what it has loaded, not what its table holds."""
    root = str(tmp_path)

    def load(*rows):
        df = spark.createDataFrame(list(rows), "ref_date date, geo string, population bigint")
        meta = SourceMeta("population_quarterly", "id", resource_name="table 1")
        return refresh.Load(meta, schemas.POPULATION, lambda: df, {"source_table": "test"}, "ref_date")

    refresh.load_all(spark, root, "r1", [load((d("1990-01-01"), "Ontario", 1))])
    refresh.load_all(spark, root, "r2", [load((d("2025-01-01"), "Canada", 2))])
    log = {r["run_id"]: r for r in read_table(spark, root, "source_loads").collect()}
    assert [log[r]["reference_period"] for r in ("r1", "r2")] == ["1990-01-01 to 1990-01-01", "2025-01-01 to 2025-01-01"]
    assert log["r2"]["resource_name"] == "table 1"
    assert read_table(spark, root, "population_quarterly").count() == 2


def test_a_load_that_cannot_be_logged_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    root, calls = str(tmp_path), []

    def broken_once(df, path):
        calls.append(path)
        if len(calls) == 1:
            raise OSError("log is full")
        append_rows(df, path)

    monkeypatch.setattr(refresh, "append_rows", broken_once)
    loads = [load for load in simple_loads(spark) if load.meta.dataset_key in ("population_quarterly", "npr_by_type_quarterly")]
    done = refresh.load_all(spark, root, "r", loads)
    assert done.rows == {"population_quarterly": 2, "npr_by_type_quarterly": 4} and "log is full" in done.failures["population_quarterly"]


def test_failed_load_keeps_its_traceback(spark, tmp_path):
    def broken():
        raise RuntimeError("x" * 5000)

    refresh.load_all(spark, str(tmp_path), "r", [next(iter(simple_loads(spark, population_quarterly=broken)))])
    notes = read_table(spark, str(tmp_path), "source_loads").first()["notes"]
    assert "Traceback" in notes and "x" * 5000 in notes


def test_lost_table_is_an_error(spark, tmp_path):
    """Replacements move nothing (``test_versions``), so there is nothing a read could bring back."""
    root = str(tmp_path)
    wanted = ("population_quarterly", "naturalized_by_country_census")
    refresh.load_all(spark, root, "r", [load for load in simple_loads(spark) if load.meta.dataset_key in wanted])
    for name, rows in (("naturalized_by_country_census", 3), ("population_quarterly", 2)):
        assert read_table(spark, root, name).count() == rows
        (tmp_path / name).rename(tmp_path / f".{name}.elsewhere")
        with pytest.raises(LostTable):
            read_table(spark, root, name)
    assert read_table(spark, root, "npr_by_type_quarterly").count() == 0


def test_sections_of_any_size(spark, tmp_path):
    rows = spark.range(120_000).select(F.col("id").alias("year"), F.lit("a").alias("country"), F.lit(1).alias("count"))
    assert documents.publish(documents.Document(spark.range(1), {"data": rows}), str(tmp_path), "x.json")
    assert spark.read.json(documents.section_path(str(tmp_path), "x.json", "data")).count() == 120_000


@pytest.mark.parametrize("name, tables", [
    ("origin_temp_current.json", 3), ("origin_naturalized.json", 2), ("origin_pr_current.json", 1), ("visa_streams_current.json", 1),
])
def test_a_document_reads_a_table_once(spark, published, name, tables):
    """The load log aside. Naturalised: once for the list, and its newest year from a column of its own."""
    root, _, _ = published
    head = documents.DOCUMENTS[name](refresh.warehouse(spark, root), documents.Export(as_of=2026, k=2)).head
    head.write.format("noop").mode("overwrite").save()
    plan = head._jdf.queryExecution().executedPlan().toString()
    head.collect()
    plan = head._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") - plan.count("source_loads") <= tables


def test_closing_event_wins_within_one_instant(spark):
    at = datetime.datetime(2026, 1, 1)
    opened = lineage.run_event(spark, "r", at, "running")
    closed = lineage.run_event(spark, "r", at, "success", at, ["a"])
    other = lineage.run_event(spark, "s", at, "running")
    runs = lineage.current_runs(opened.unionByName(closed).unionByName(other))
    assert {r["run_id"]: r["status"] for r in runs.collect()} == {"r": "success", "s": "running"}


def test_newer_failure_hides_older_period(spark):
    at = datetime.datetime(2026, 1, 1)
    loads = spark.createDataFrame([
        ("1", "a", "success", "2020 to 2025", at),
        ("2", "a", "failed", None, at + datetime.timedelta(days=1)),
        ("3", "b", "success", "2019", at),
        ("4", "z", "success", "2030", at),
    ], "load_id string, dataset_key string, status string, reference_period string, loaded_at timestamp")
    got = lineage.freshness_rows(loads, ["a", "b"], {}).collect()
    assert [(r["dataset_key"], r["status"], r["stale"]) for r in got] == [("a", "failed", False), ("b", "success", False)]
    assert got[0]["latest_source_reference"] == "2019" and got[0]["last_success_reference"] == "2019"
    assert lineage.freshness_rows(loads, ["a"], {"a": "x", "z": "y"}).first()["stale"]
    assert lineage.latest_loads(loads, []).count() == 0


PUBLISHED = {
    # Published top-10 lists, greatest first, and their remainders.
    "naturalized": ([("Asia", 2190036), ("India", 385331), ("Philippines", 343995), ("China", 324729),
                     ("United Kingdom", 282703), ("Hong Kong", 151628), ("Italy", 137852), ("Pakistan", 137432),
                     ("Vietnam", 118249), ("United States", 112411)], 2501284),
    "permanent_resident": ([("Cameroon", 1018750), ("Algeria", 230178), ("Morocco", 222079), ("France", 166239),
                            ("Ivory Coast, Republic of", 147911), ("Haiti", 142369),
                            ("Congo, Democratic Republic of the", 98039), ("Tunisia", 70332), ("Burundi", 45183),
                            ("Mauritius", 34100)], 301788),
    "temporary_resident": ([("India", 590572), ("China", 264474), ("Nigeria", 177748), ("Haiti", 114058),
                            ("Mexico", 105974), ("Philippines", 98922), ("Iran", 82845), ("France", 63690),
                            ("Bangladesh", 55306), ("Algeria", 52527)], 1070325),
}


def test_published_foreign_born_total(spark):
    rows = [
        (category, sum(n for _, n in top) + rest, [{"country": c, "count": n} for c, n in top], rest)
        for category, (top, rest) in PUBLISHED.items()
    ]
    own = spark.createDataFrame(
        rows, "category string, target bigint, top array<struct<country:string,count:bigint>>, _rest bigint"
    )
    got = {r["category"]: r for r in marts._with_foreign_born(own, 10).collect()}
    total = got["foreign_born_total"]
    # The published list.
    assert (total["total"], total["non_top"]) == (11839059, 2183445)
    assert [r["count"] for r in total["top"]] == [
        2501284, 2190036, 1070325, 1018750, 975903, 589203, 442917, 301788, 282705, 282703,
    ]
    assert [r["country"] for r in total["top"]] == [
        "Non-top-10 Naturalized", "Asia", "Non-top-10 Temporary Residents", "Cameroon", "India", "China", "Philippines",
        "Non-top-10 Permanent Residents", "Algeria", "United Kingdom",
    ]
    for category, (top, rest) in PUBLISHED.items():
        assert [(r["country"], r["count"]) for r in got[category]["top"]] == top
        assert got[category]["non_top"] == rest


def test_view_fallbacks(spark):
    schema = "category string, top array<struct<country:string,count:bigint>>, non_top bigint"
    df = spark.createDataFrame([("naturalized", [("a", 1)], 0), ("foreign_born_total", [("b", 2)], 5)], schema)
    assert sorted(tuple(r) for r in views.category_rows(df, "nothing").collect()) == [
        ("foreign_born_total", "Non-top-10", 5), ("foreign_born_total", "b", 2),
    ]
    assert [tuple(r) for r in views.category_rows(df, "naturalized").collect()] == [("naturalized", "a", 1)]
    tie = spark.createDataFrame([(2024, c, 1) for c in "cab"], "year int, country string, count bigint")
    assert [r["country"] for r in views.top_countries(tie, 2).collect()] == ["a", "b"]


def test_alias_collision_is_merged(spark):
    df = spark.createDataFrame(
        [(2024, "Korea, South", 3), (2024, "Korea, Republic of", 4), (2024, "(1) Other", 9)],
        "ref_year int, country string, count bigint",
    )
    assert [tuple(r) for r in marts.origin_top(df, 2026).collect()] == [(2024, "South Korea", 7)]
    assert marts.origin_top(df, 2026, check_places=False).count() == 2


def test_temporary_top_leaves_out_missing_counts(spark):
    df = spark.createDataFrame(
        [("study", 2024, "a", None), ("study", 2024, "b", 2), ("work", 2026, "c", 1)],
        "stream string, ref_year int, country string, count bigint",
    )
    got = marts.temporary_top(df, 2026).collect()
    assert [(r["stream"], r["country"]) for r in got] == [("study", "b"), ("work", "c")]
