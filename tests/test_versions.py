"""Replacement under readers, logs that are compacted, and sets of documents."""

import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from statmart import schemas
from statmart.operators import lineage
from statmart.plans import documents, refresh
from statmart.sinks import files, logs, replace_slice, replace_table, shape_for, versions
from statmart.sinks.documents import published_set
from statmart.sources.warehouse import periods, read_latest, read_table, table_path
from test_refresh import d, doc, simple_loads

NAME = schemas.POPULATION.name


def population(spark, *rows):
    df = spark.createDataFrame([(d(day), geo, n) for day, geo, n in rows], "ref_date date, geo string, population bigint")
    return shape_for(df, schemas.POPULATION, {"source_table": "test"})


def held(spark, root, name=NAME):
    return sorted((str(r["ref_date"]), r["geo"], r["population"]) for r in read_table(spark, root, name).collect())


@pytest.fixture
def watched(spark, tmp_path, monkeypatch):
    """Reads the table before and after every step that touches the file system."""
    seen = []

    def watch(owner, name):
        method = getattr(owner, name)

        def step(*args, **kwargs):
            seen.append(held(spark, str(tmp_path)))
            try:
                return method(*args, **kwargs)
            finally:
                seen.append(held(spark, str(tmp_path)))

        monkeypatch.setattr(owner, name, step)

    def start():
        for name in ("create", "remove", "folders"):
            watch(files, name)
        watch(DataFrameWriter, "parquet")
        return seen

    return start


def test_readers_see_old_or_new_rows_at_every_step(spark, tmp_path, watched):
    path = table_path(str(tmp_path), NAME)
    old = [("2026-01-01", "Canada", 1), ("2026-01-01", "Ontario", 2)]
    replace_slice(population(spark, *old), path, "geo", schemas.POPULATION)
    seen = watched()
    replace_slice(population(spark, ("2026-04-01", "Canada", 3), ("2026-04-01", "Ontario", 4), ("2026-04-01", "Yukon", 5)), path, "geo", schemas.POPULATION)
    new = [("2026-04-01", "Canada", 3), ("2026-04-01", "Ontario", 4), ("2026-04-01", "Yukon", 5)]
    assert seen[0] == sorted(old) and seen[-1] == new
    # All slices of a load change together, once.
    assert all(s in (sorted(old), new) for s in seen) and seen.index(new) > len(seen) // 3
    assert seen == sorted(seen, key=lambda s: s == new)
    del seen[:]
    replace_table(population(spark, ("2027-01-01", "Canada", 6)), path, schemas.POPULATION)
    assert all(s in (new, [("2027-01-01", "Canada", 6)]) for s in seen) and seen[-1] != new


def test_a_frame_resolved_before_a_replacement_can_still_be_read(spark, tmp_path):
    path = table_path(str(tmp_path), NAME)
    replace_table(population(spark, ("2026-01-01", "Canada", 1)), path, schemas.POPULATION)
    before = read_table(spark, str(tmp_path), NAME)
    for n in range(versions.KEEP - 1):
        replace_table(population(spark, ("2026-01-01", "Canada", n + 2)), path, schemas.POPULATION)
        assert [r["population"] for r in before.collect()] == [1]
    for n in range(9):
        replace_table(population(spark, ("2026-01-01", "Canada", 100 + n)), path, schemas.POPULATION)
    assert held(spark, str(tmp_path)) == [("2026-01-01", "Canada", 108)]
    assert len([p for p in Path(path).iterdir() if p.name.startswith("load=")]) == versions.KEEP
    assert len([p for p in (Path(path) / "_versions").iterdir() if p.suffix == ".json"]) == versions.KEEP


def test_reading_moves_nothing(spark, tmp_path, monkeypatch):
    path = table_path(str(tmp_path), NAME)
    replace_slice(population(spark, ("2026-01-01", "Canada", 1)), path, "geo", schemas.POPULATION)
    monkeypatch.setattr(files, "_rename", lambda *_: pytest.fail("a read has moved something"))
    before = sorted(str(p) for p in Path(path).rglob("*"))
    assert held(spark, str(tmp_path)) == [("2026-01-01", "Canada", 1)]
    replace_slice(population(spark, ("2026-01-01", "Ontario", 2)), path, "geo", schemas.POPULATION)
    assert set(before) <= {str(p) for p in Path(path).rglob("*")}


def test_a_pointer_that_is_not_complete_is_passed_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "PATIENCE", 0.2)
    path = table_path(str(tmp_path), NAME)
    replace_slice(population(spark, ("2026-01-01", "Canada", 1)), path, "geo", schemas.POPULATION)
    for text in ("", '{"folders": {"geo=Can'):
        number = versions.current(spark, path).number
        (Path(path) / "_versions" / f"{number + 1:012d}.json").write_text(text)
        assert versions.current(spark, path).number == number
    replace_slice(population(spark, ("2026-01-01", "Ontario", 2)), path, "geo", schemas.POPULATION)
    assert held(spark, str(tmp_path)) == [("2026-01-01", "Canada", 1), ("2026-01-01", "Ontario", 2)]


def test_a_load_that_dies_before_its_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    path = table_path(str(tmp_path), NAME)
    replace_table(population(spark, ("2026-01-01", "Canada", 1)), path, schemas.POPULATION)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            replace_table(population(spark, ("2026-01-01", "Canada", 2)), path, schemas.POPULATION)
    assert held(spark, str(tmp_path)) == [("2026-01-01", "Canada", 1)]
    # What it has written stays until it is old.
    assert len([p for p in Path(path).iterdir() if p.name.startswith("load=")]) == 2
    monkeypatch.setattr(versions, "ORPHAN_AGE", -10)
    replace_table(population(spark, ("2026-01-01", "Canada", 3)), path, schemas.POPULATION)
    assert len([p for p in Path(path).iterdir() if p.name.startswith("load=")]) == 2


def test_a_first_write_does_not_count_before_its_pointer(spark, tmp_path):
    path = table_path(str(tmp_path), NAME)
    population(spark, ("2026-01-01", "Canada", 1)).write.parquet(versions.new_folder(path))
    assert held(spark, str(tmp_path)) == []


def test_writers_that_meet(spark, tmp_path):
    """Slices of several writers at a time are all there afterwards."""
    path = table_path(str(tmp_path), NAME)
    failed = []

    def write(i):
        try:
            replace_slice(population(spark, ("2026-01-01", f"Place {i}", i)), path, "geo", schemas.POPULATION)
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and held(spark, str(tmp_path)) == [("2026-01-01", f"Place {i}", i) for i in range(6)]


def test_only_one_writer_gets_a_number(spark, tmp_path):
    target = str(tmp_path / "x" / "1.json")
    assert files.create(spark, target, "a") and not files.create(spark, target, "b")
    assert files.read_text(spark, target) == "a" and files.read_text(spark, target + "2") is None


def test_tables_without_pointers_are_read_as_they_lie(spark, tmp_path):
    path = table_path(str(tmp_path), NAME)
    population(spark, ("2026-01-01", "Canada", 1), ("2026-01-01", "Ontario", 2)).write.partitionBy("geo").parquet(path)
    assert len(held(spark, str(tmp_path))) == 2
    replace_slice(population(spark, ("2026-04-01", "Canada", 3)), path, "geo", schemas.POPULATION)
    assert held(spark, str(tmp_path)) == [("2026-01-01", "Ontario", 2), ("2026-04-01", "Canada", 3)]


def test_slices_of_a_table_that_was_written_whole(spark, tmp_path):
    path = table_path(str(tmp_path), NAME)
    replace_table(population(spark, ("2026-01-01", "Canada", 1), ("2026-01-01", "Ontario", 2)), path, schemas.POPULATION)
    replace_slice(population(spark, ("2026-04-01", "Canada", 3)), path, "geo", schemas.POPULATION)
    assert held(spark, str(tmp_path)) == [("2026-01-01", "Ontario", 2), ("2026-04-01", "Canada", 3)]
    plain = str(tmp_path / "plain")
    replace_table(population(spark, ("2026-01-01", "Canada", 1)), plain)
    with pytest.raises(ValueError, match="written whole"):
        replace_slice(population(spark, ("2026-04-01", "Canada", 3)), plain, "geo")


def test_slices_with_odd_names(spark, tmp_path):
    path = table_path(str(tmp_path), NAME)
    names = ["a/b", "x=y", "50 %", "é", "2024", "c:d"]
    replace_slice(population(spark, *[("2026-01-01", g, 1) for g in names]), path, "geo", schemas.POPULATION)
    assert [r[1] for r in held(spark, str(tmp_path))] == sorted(names)
    assert versions.partitions(spark, path, "geo") == sorted(names)


# -- periods -------------------------------------------------------------------


def yearly(spark, root, *rows):
    df = spark.createDataFrame(list(rows), "ref_year int, country string, count bigint")
    whole = {"ref_month": 0, "immigration_category": "all", "province": "_", "source_dataset": "x"}
    replace_table(shape_for(df, schemas.PERMANENT, whole), table_path(root, schemas.PERMANENT.name), schemas.PERMANENT)


def test_the_latest_period_is_read_alone(spark, tmp_path):
    root, name = str(tmp_path), schemas.PERMANENT.name
    assert periods(spark, root, name) == [] and read_latest(spark, root, name, 2026).count() == 0
    yearly(spark, root, *[(y, c, y) for y in range(2015, 2027) for c in ("Italy", "Spain")])
    assert periods(spark, root, name) == list(range(2015, 2027))
    for as_of, want in ((2026, 2025), (None, 2026), (2000, 2026), (2020, 2019)):
        latest = read_latest(spark, root, name, as_of)
        assert {r["ref_year"] for r in latest.collect()} == {want}
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(ref_year#" in plan and f"= {want})" in plan
    # The files of other years are not opened.
    for folder in Path(root, name).rglob("ref_year=20*"):
        if not folder.name.endswith("2025"):
            for part in folder.iterdir():
                part.write_text("broken")
    assert read_latest(spark, root, name, 2026).count() == 2


def test_periods_of_dates(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(d("2025-10-01"), "Canada", "a", 1), (d("2026-01-01"), "Canada", "a", 2)], "ref_date date, geo string, npr_type string, count bigint")
    replace_table(shape_for(df, schemas.NPR, {"source_table": "x"}), table_path(root, schemas.NPR.name), schemas.NPR)
    assert periods(spark, root, schemas.NPR.name) == [d("2025-10-01"), d("2026-01-01")]
    assert [r["count"] for r in read_latest(spark, root, schemas.NPR.name).collect()] == [2]


# -- one pass ------------------------------------------------------------------


def test_an_extract_is_computed_once(spark, tmp_path):
    """Rows, period and missing values come from the pass that writes; only keys are read back."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(50).select(F.lit(2026).alias("census_year"), F.col("id").cast("string").alias("country"), F.col("id").alias("count"))
    df = df.mapInPandas(count, df.schema)
    done = replace_table(shape_for(df, schemas.NATURALIZED, {"source_table": "x"}), str(tmp_path / "t"), schemas.NATURALIZED,
                         period=F.max("census_year").cast("string"))
    assert (done.rows, done.period, done.null_rows) == (50, "2026", 0) and seen.value == 50


# -- logs ----------------------------------------------------------------------


def test_compaction_keeps_what_a_log_says(spark, tmp_path):
    root = str(tmp_path)
    path = table_path(root, schemas.LOADS.name)

    def state():
        log = read_table(spark, root, schemas.LOADS.name)
        return sorted(tuple(r) for r in log.collect()), [tuple(r) for r in lineage.latest_loads(log, ["a", "b"]).collect()]

    for i in range(5):
        logs.append(lineage.load_record(spark, f"r{i}", lineage.SourceMeta("ab"[i % 2], "id"), "success", reference_period=str(i)), path)
    before = state()
    resolved = logs.frame(spark, path, schemas.LOADS.schema)
    assert logs.compact(spark, path, schemas.LOADS.schema) == 5 and state() == before
    assert logs.compact(spark, path, schemas.LOADS.schema) == 0
    at = logs.current(spark, path)
    assert at.snapshot and at.tail == () and len(at.covered) == 5
    assert resolved.count() == 5
    for i in range(5, 5 + 2 * versions.KEEP):
        logs.append(lineage.load_record(spark, f"r{i}", lineage.SourceMeta("ab"[i % 2], "id"), "failed"), path)
        known = state()
        logs.compact(spark, path, schemas.LOADS.schema, least_files=1)
        assert state() == known and len(known[0]) == i + 1
    # Covered files go once no version kept needs them.
    assert len([p for p in Path(path).iterdir() if p.name.endswith(".parquet")]) <= versions.KEEP
    assert len(list((Path(path) / "_snapshots").iterdir())) <= versions.KEEP


def test_compaction_of_runs(spark, tmp_path):
    path = table_path(str(tmp_path), schemas.RUNS.name)
    at = lineage.datetime(2026, 1, 1)
    for event in (lineage.run_event(spark, "r", at, "running"), lineage.run_event(spark, "r", at, "success", at, ["a"]), lineage.run_event(spark, "s", at, "running")):
        logs.append(event, path)
    def runs():
        return sorted(tuple(r) for r in lineage.current_runs(read_table(spark, str(tmp_path), schemas.RUNS.name)).collect())
    before = runs()
    logs.compact(spark, path, schemas.RUNS.schema)
    assert runs() == before and len(before) == 2


# -- sets of documents -----------------------------------------------------------


def test_a_failing_document_leaves_the_set_as_it_was(spark, tmp_path, monkeypatch):
    root, folder = str(tmp_path / "warehouse"), str(tmp_path / "data")
    export = documents.Export(as_of=2026, k=2, first_annual_year=2024, first_quarterly_year=2025)
    first = refresh.refresh(spark, root, simple_loads(spark), folder, export)
    shown = published_set(spark, folder)
    assert shown.run_id == first.run_id and sorted(shown.documents) == sorted(first.published)
    assert json.loads(Path(shown.path("population_current.json")).read_text())["population"] == 1010
    assert spark.read.json(shown.path("population_history.json", "data")).count() == 2

    newer = spark.createDataFrame([(d("2026-04-01"), "Canada", 2000)], "ref_date date, geo string, population bigint")
    calls = list(documents.DOCUMENTS)

    def broken(*_):
        raise RuntimeError("no space left")

    with monkeypatch.context() as m:
        m.setitem(documents.DOCUMENTS, calls[5], broken)
        with pytest.raises(RuntimeError, match="no space"):
            refresh.refresh(spark, root, simple_loads(spark, population_quarterly=lambda: newer), folder, export)
    again = published_set(spark, folder)
    assert (again.run_id, again.folder) == (shown.run_id, shown.folder)
    # Fixed names have not changed either, and nothing of the failed set is left.
    assert doc(folder, "population_current.json")["population"] == 1010
    assert len([p for p in Path(folder, ".published").iterdir() if p.name.startswith("load=")]) == 1
    last = refresh.refresh(spark, root, [], folder, export)
    renewed = published_set(spark, folder)
    assert renewed.run_id == last.run_id and doc(folder, "population_current.json")["population"] == 2000
    assert json.loads(Path(shown.path("population_current.json")).read_text())["population"] == 1010


def test_skipped_documents_are_named(spark, tmp_path):
    folder = str(tmp_path / "data")
    assert published_set(spark, folder) is None
    done = refresh.refresh(spark, str(tmp_path / "warehouse"), [], folder, documents.Export(as_of=2026))
    shown = published_set(spark, folder)
    assert sorted([*shown.documents, *shown.skipped]) == sorted(documents.DOCUMENTS) and "population_current.json" in shown.skipped
    assert sorted(shown.documents) == sorted(done.published)
