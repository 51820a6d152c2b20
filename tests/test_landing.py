"""Sheets, catalogs and extracts as they lie in a landing folder; loads side by side."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from statmart import schemas
from statmart.operators.lineage import SourceMeta
from statmart.plans import loads, refresh
from statmart.plans.landing import Resource, landing_loads
from statmart.sinks.rejects import read_rejects
from statmart.sources import catalog, delimited, grid
from statmart.sources.warehouse import read_table
from test_refresh import simple_loads


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "10", "spark.sql.files.minPartitionNum": "64"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


# -- sheets --------------------------------------------------------------------


def test_rows_are_numbered_over_many_splits(spark, tmp_path, small_splits):
    lines = {"a": [f"row {i},{i}" for i in range(500)], "b b": ["", "x", "", "", '"y,1",2', ""] * 60}
    for name, rows in lines.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(rows) + "\n")
    read = spark.read.text(str(tmp_path))
    assert read.select(F.col("_metadata.file_block_start")).distinct().count() > 10
    got = {(r["sheet"], r["row_idx"], r["col_idx"]): (r["value"], r["is_text"]) for r in grid.read_grid(spark, str(tmp_path)).collect()}
    want = {}
    for i in range(500):
        want["a", i, 0], want["a", i, 1] = (f"row {i}", True), (str(i), False)
    for i, row in enumerate(lines["b b"]):
        if row == "x":
            want["b b", i, 0] = ("x", True)
        elif row:
            want["b b", i, 0], want["b b", i, 1] = ("y,1", True), ("2", False)
    assert got == want


def test_fields_as_they_are_written(spark, tmp_path):
    text = '﻿a,"b ""c"" d",,  e ,"",12,-1.5e3,"12",1 000,"open\n'
    text += ',,"' + "x" * 30_000 + '",' + '""' * 5 + "\r\nlast"
    (tmp_path / "s.csv").write_text(text, encoding="utf-8")
    got = {(r["row_idx"], r["col_idx"]): (r["value"], r["is_text"]) for r in grid.read_grid(spark, str(tmp_path / "s.csv")).collect()}
    assert got == {
        (0, 0): ("a", True), (0, 1): ('b "c" d', True), (0, 3): ("  e ", True), (0, 5): ("12", False), (0, 6): ("-1.5e3", False),
        (0, 7): ("12", True), (0, 8): ("1 000", True), (0, 9): ('"open', True), (1, 2): ("x" * 30_000, True), (1, 3): ('""""', True), (2, 0): ("last", True),
    }


def test_sheets_of_folders_and_other_separators(spark, tmp_path):
    for name in ("a%2Fb", "c d"):
        (tmp_path / f"sheet={name}").mkdir()
        (tmp_path / f"sheet={name}" / "part-0").write_text("x\ty, z\n")
    got = grid.read_grid(spark, str(tmp_path), sep="\t").collect()
    assert {(r["sheet"], r["col_idx"], r["value"]) for r in got} == {(s, i, v) for s in ("a/b", "c d") for i, v in enumerate(("x", "y, z"))}


def test_repeated_cells_are_defined(spark):
    cells = [(0, 0, "A", True), (0, 1, "B", True), (0, 2, "C", True), (1, 2, "2019 Total", True), (1, 2, "2019 Total", True)]
    cells += [(3, 0, "Italy", True), (3, 0, "Italy", True), (3, 2, "5", False), (3, 2, "12", False), (3, 2, "--", True), (4, 0, "Spain", True), (4, 2, "--", True)]
    df = spark.createDataFrame([("s", *c) for c in cells], "sheet string, row_idx bigint, col_idx int, value string, is_text boolean")
    got = sorted((r["country"], r["ref_year"], r["count"]) for r in grid.unpivot_year_totals(df).collect())
    assert got == [("Italy", 2019, 12), ("Spain", 2019, None)]


def test_asylum_from_a_landing_file(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "warehouse")
    landing.mkdir()
    (landing / "claimants.csv").write_text(
        'Claimants by country\n\n"Country","Category","2019","2020"\n,,"2019 Total","2020 Total"\nAll,,99,99\n'
        'Italy,,"1,234",--\nItaly,sub,7,7\nSpain,,12.6,\n'
    )
    found = {schemas.ASYLUM.name: Resource(str(landing / "claimants.csv"), "r1", "claimants")}
    sources = [s for s in landing_loads(spark, found) if s.meta.dataset_key == schemas.ASYLUM.name]
    done = refresh.load_all(spark, root, "r", sources)
    assert (done.rows, done.failures) == ({schemas.ASYLUM.name: 4}, {})
    got = sorted((r["country"], r["ref_year"], r["count"]) for r in read_table(spark, root, schemas.ASYLUM.name).collect())
    assert got == [("Italy", 2019, 1234), ("Italy", 2020, None), ("Spain", 2019, 12), ("Spain", 2020, None)]
    assert read_table(spark, root, schemas.LOADS.name).first()["resource_name"] == "claimants"


# -- catalogs ------------------------------------------------------------------


def test_package_responses(spark, tmp_path):
    good = {"id": "r1", "name": "By country", "format": "CSV", "last_modified": "2026", "size": 3, "tags": ["a"], "description": {"en": "x"}}
    responses = {
        "a": {"help": "h", "success": True, "result": {"id": "a", "title": "A", "owner": {"x": 1}, "resources": [good, {"id": "r2"}, {"name": "nameless"}]}},
        "b": {"success": False, "error": {"message": "not found"}},
        "c": {"success": True, "result": {"id": "c", "resources": []}},
        "d": {"success": True, "result": {"id": "d"}},
        "f": {"result": {"id": "f", "resources": [good]}},
    }
    for name, response in responses.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(response, indent=2))
    (tmp_path / "e.json").write_text('{"success": true, "result": {"id": "e", "reso')
    rows = {r["id"]: r for r in catalog.read_catalog(spark, str(tmp_path)).collect()}
    assert set(rows) == {"r1", "r2"}
    assert (rows["r1"]["dataset_id"], rows["r1"]["title"], json.loads(rows["r1"]["description"])) == ("a", "A", {"en": "x"})
    assert rows["r2"]["format"] is None and rows["r2"]["url"] is None
    errors = {r["file"][-6]: r["error"] for r in catalog.broken_packages(spark, str(tmp_path)).collect()}
    assert errors == {"b": "the request has failed", "c": "no resources", "d": "no resources", "e": "not a package response", "f": "the request has failed"}
    best = catalog.best_resources(catalog.read_catalog(spark, str(tmp_path)), ["dataset_id"], ["country"]).collect()
    assert [(r["dataset_id"], r["id"], r["score"]) for r in best] == [("a", "r1", 3)]


def test_package_responses_as_lines(spark, tmp_path):
    line = json.dumps({"success": True, "result": {"id": "a", "resources": [{"id": "r1", "name": "x"}]}})
    (tmp_path / "all.json").write_text(f"{line}\n{line}\nnot json\n[1, 2]\n")
    assert catalog.read_catalog(spark, str(tmp_path), one_per_file=False).count() == 1
    assert catalog.broken_packages(spark, str(tmp_path), one_per_file=False).count() == 2


# -- malformed rows ------------------------------------------------------------


TSV = "EN_YEAR\tEN_COUNTRY_OF_CITIZENSHIP\tTOTAL\n"


def test_rows_with_too_many_fields(spark, tmp_path):
    (tmp_path / "p.csv").write_text('REF_DATE,GEO,VALUE\n2020-01,A,1\n2020-04,A,2,99,zz\n2020-07,A\n2020-10,"A, b",4\n')
    path = str(tmp_path / "p.csv")
    with pytest.raises(Exception, match="more than 3 fields"):
        delimited.read_stat_csv(spark, path).collect()
    with pytest.raises(Exception, match="more than 3 fields"):
        delimited.read_stat_csv(spark, path).select("GEO").collect()
    marked = delimited.read_stat_csv(spark, path, surplus="mark")
    good, rejected = delimited.split_rejects(marked)
    assert [tuple(r)[:3] for r in good.collect()] == [("2020-01", "A", "1"), ("2020-07", "A", None), ("2020-10", "A, b", "4")]
    assert rejected.seen()
    assert [tuple(r)[1:] for r in rejected.rows.collect()] == [("more fields than columns", "2020-04", "2020-04,A,2,99,zz")]
    with pytest.raises(ValueError, match="surplus"):
        delimited.read_stat_csv(spark, path, surplus="drop")


@pytest.mark.parametrize("allowed, status", [(2, "success"), (1, "failed")])
def test_rejects_of_a_load(spark, tmp_path, allowed, status):
    landing, root = tmp_path / "study.csv", str(tmp_path / "warehouse")
    landing.write_text(TSV + "2024\tItaly\t5\n2024\tItaly\t6\tx\n2024\tSpain\t7\n2024\tSpain\t1\ty\tz\n")
    sources = [s for s in landing_loads(spark, {schemas.STUDY.name: Resource(str(landing))}, most_rejects=allowed) if s.meta.dataset_key == schemas.STUDY.name]
    done = refresh.load_all(spark, root, "run 1", sources)
    record = read_table(spark, root, schemas.LOADS.name).first()
    kept = read_rejects(spark, root).collect()
    assert sorted((r["run_id"], r["dataset_key"], r["line"]) for r in kept) == [
        ("run 1", schemas.STUDY.name, "2024\tItaly\t6\tx"), ("run 1", schemas.STUDY.name, "2024\tSpain\t1\ty\tz"),
    ]
    assert record["status"] == status
    rows = sorted((r["country"], r["count"]) for r in read_table(spark, root, schemas.STUDY.name).collect())
    if status == "success":
        assert rows == [("Italy", 5), ("Spain", 7)] and record["notes"] == "2 malformed rows left out" and done.rejected == {schemas.STUDY.name: 2}
    else:
        assert rows == [] and "2 malformed rows, 1 allowed" in done.failures[schemas.STUDY.name]


def test_an_extract_without_rejects_keeps_none(spark, tmp_path):
    (tmp_path / "study.csv").write_text(TSV + "2024\tItaly\t5\n")
    sources = [s for s in landing_loads(spark, {schemas.STUDY.name: Resource(str(tmp_path / "study.csv"))}) if s.meta.dataset_key == schemas.STUDY.name]
    done = refresh.load_all(spark, str(tmp_path / "w"), "r", sources)
    assert done.rejected == {} and read_rejects(spark, str(tmp_path / "w")).count() == 0


def test_an_empty_extract_counts_as_missing(spark, tmp_path):
    (tmp_path / "study.csv").write_text(TSV)
    found = {name: Resource(str(tmp_path / "study.csv")) for name in (schemas.STUDY.name,)}
    sources = [s for s in landing_loads(spark, found) if s.meta.dataset_key == schemas.STUDY.name]
    done = refresh.load_all(spark, str(tmp_path / "w"), "r", sources)
    assert "no resource found" in done.failures[schemas.STUDY.name]
    assert read_table(spark, str(tmp_path / "w"), schemas.LOADS.name).first()["status"] == "failed"


# -- loads side by side --------------------------------------------------------


def chosen(spark, *names, **changes):
    return [s for s in simple_loads(spark, **changes) if s.meta.dataset_key in names]


NAMES = ("population_quarterly", "npr_by_type_quarterly", "status_breakdown_census")


def test_a_hanging_source_is_cancelled_and_the_others_finish(spark, tmp_path):
    """One source waits in a Spark job that would take minutes."""
    def slow(rows):
        for batch in rows:
            time.sleep(300)
            yield batch

    hanging = spark.createDataFrame([("2026-01-01", "Canada", 1)], "ref_date string, geo string, population bigint").repartition(1)
    hanging = hanging.mapInPandas(slow, hanging.schema)
    sources = chosen(spark, *NAMES, population_quarterly=lambda: hanging)
    started = time.monotonic()
    done = refresh.load_all(spark, str(tmp_path), "r", sources, workers=3, seconds=20)
    assert time.monotonic() - started < 100
    assert "not done after 20 s" in done.failures["population_quarterly"]
    assert set(done.rows) == set(NAMES[1:])
    log = {r["dataset_key"]: r["status"] for r in read_table(spark, str(tmp_path), "source_loads").collect()}
    assert log == {NAMES[0]: "failed", NAMES[1]: "success", NAMES[2]: "success"}
    assert read_table(spark, str(tmp_path), "population_quarterly").count() == 0


def test_a_late_source_cannot_count(spark, tmp_path, monkeypatch):
    """One source hangs outside of its jobs: it is left behind, and what it writes later is refused."""
    monkeypatch.setattr(refresh, "GRACE", 1.0)
    wake, back = threading.Event(), threading.Event()
    rows = next(s for s in simple_loads(spark) if s.meta.dataset_key == "population_quarterly").build()

    def waits():
        wake.wait(120)
        back.set()
        return rows

    done = refresh.load_all(spark, str(tmp_path), "r", chosen(spark, *NAMES, population_quarterly=waits), workers=2, seconds=15)
    assert "not to be cancelled" in done.failures["population_quarterly"] and len(done.rows) == 2
    wake.set()
    assert back.wait(20)
    deadline = time.monotonic() + 20
    while time.monotonic() < deadline and read_table(spark, str(tmp_path), "population_quarterly").isEmpty():
        time.sleep(1)
    assert read_table(spark, str(tmp_path), "population_quarterly").count() == 0


def test_several_sources_at_a_time(spark, tmp_path):
    """Two sources that wait for each other both finish; with one place they could not."""
    both = threading.Barrier(2, timeout=30)
    build = {s.meta.dataset_key: s.build for s in simple_loads(spark)}

    def meets(name):
        def wait():
            both.wait()
            return build[name]()
        return wait

    sources = chosen(spark, *NAMES[:2], **{name: meets(name) for name in NAMES[:2]})
    done = refresh.load_all(spark, str(tmp_path), "r", sources, workers=2)
    assert done.rows == {NAMES[0]: 2, NAMES[1]: 4} and done.failures == {}


def test_records_come_in_the_order_of_the_loads(spark, tmp_path):
    refresh.load_all(spark, str(tmp_path), "r", [refresh.Load(SourceMeta(f"s{i}", "x"), schemas.POPULATION, lambda: None) for i in range(5)])
    log = read_table(spark, str(tmp_path), "source_loads").orderBy("loaded_at").collect()
    assert [r["dataset_key"] for r in log] == [f"s{i}" for i in range(5)]


def test_latest_wins_loads_still_shape_rows(spark):
    assert loads.asylum_claimants(spark.createDataFrame([], "sheet string, row_idx bigint, col_idx int, value string, is_text boolean")).count() == 0
